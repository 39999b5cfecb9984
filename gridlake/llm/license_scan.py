"""License scans: MinHash bands over overlapping text windows, verified by exact shingle containment.

Texts and license templates are words (runs of letters and digits, ASCII
lower-cased) and the hashes of ``SHINGLE`` consecutive words; of a shorter template,
of as many words as it has, so that a short notice is found inside a text.  For each
template length a text is covered by overlapping windows somewhat longer than the
template, a quarter of it apart, so every copy lies wholly in a window.  A
window's MinHash values (one minimum per hash function, each a band) look up the
templates of that length.  A copy that holds a share ``c`` of a template's
shingles has a Jaccard similarity of at least ``c / (SLACK + 1 - c)`` with its
window and is retrieved with ``1 - (1 - J) ** BANDS``: more than 0.999 for the
smallest share that counts.  Retrieved windows are decided by the exact share of
the template's shingles in them.  Where templates of several licenses match the same
words, the one that covers the most words counts, then the one with the larger share.

Templates are a parameter, a list or a table (license, text) that the driver reads, so a text is scanned in one narrow
pass; only findings are shuffled.

Cases: null and empty texts have no findings; templates without
words match nothing; rows that repeat a doc_id add up to one finding for each
license; a null doc_id is kept as such; a text of any length is searched whole;
extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnum import U64, _lower_table, mix, runs, shingle_hashes, sliding_min, slices, span_hashes

SHINGLE = 5
CONTAINED = 0.8
SLACK = 1.5          # window length by template length
BANDS = 12

# License notices, as published.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("MIT", "Released under the MIT License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in "
                   "writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
                   "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific "
                   "language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version. This program is distributed in the hope that it will be useful, "
                "but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
                "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions: The above copyright notice and this permission notice shall be included in all "
            "copies or substantial portions of the Software."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met: Redistributions of source code must retain the above copyright "
            "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
            "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
            "documentation and/or other materials provided with the distribution."),
)

_GNU = ("This {0} is free software{1} you can redistribute it and/or modify it under the terms of the GNU {2}General Public "
        "License as published by the Free Software Foundation{3} either version {4} of the License, or (at your option) any "
        "later version. This {0} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even "
        "the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {2}General Public License "
        "for more details.")
_LINE = "This work is licensed under the GNU {}General Public License, version {}."

#: What the query looks for: the notices above, those of sibling licenses, and the names of licenses.
NOTICES = TEMPLATES + (
    ("All-rights-reserved", "All rights reserved."),
    ("MIT", "MIT License"),
    ("BSD", "BSD License"),
    ("Apache-2.0", "Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License 2.0"),
    ("GPL-2.0", _GNU.format("program", ";", "", ";", "2")),
    ("LGPL-2.1", _GNU.format("library", ";", "Lesser ", ";", "2.1")),
    ("LGPL-3.0", _GNU.format("program", ":", "Lesser ", ",", "3")),
    ("AGPL-3.0", _GNU.format("program", ":", "Affero ", ",", "3")),
    *((name, _LINE.format(kind, version)) for name, kind, version in (
        ("GPL", "", ""), ("GPL-2.0", "", "2"), ("LGPL", "Lesser ", ""), ("LGPL-2.1", "Lesser ", "2.1"),
        ("LGPL-3.0", "Lesser ", "3"), ("AGPL", "Affero ", ""), ("AGPL-3.0", "Affero ", "3"))),
    ("GPL", "GNU General Public License"),
    ("GPL-2.0", "GNU General Public License version 2"),
    ("GPL-3.0", "GNU General Public License version 3"),
    ("LGPL", "GNU Lesser General Public License"),
    ("LGPL-2.1", "GNU Lesser General Public License version 2.1"),
    ("LGPL-3.0", "GNU Lesser General Public License version 3"),
    ("AGPL", "GNU Affero General Public License"),
    ("AGPL-3.0", "GNU Affero General Public License version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
                "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
    ("MPL-2.0", "Mozilla Public License, v. 2.0"),
    ("MPL-2.0", "Mozilla Public License Version 2.0"),
    ("MPL-2.0", "Mozilla Public License 2.0"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-4.0", "CC BY 4.0"),
    ("CC-BY-SA-4.0", "CC BY-SA 4.0"),
    ("CC-BY-ND-4.0", "CC BY-ND 4.0"),
    ("CC-BY-NC-4.0", "CC BY-NC 4.0"),
    ("CC-BY-NC-SA-4.0", "CC BY-NC-SA 4.0"),
    ("CC-BY-NC-ND-4.0", "CC BY-NC-ND 4.0"),
    ("CC0-1.0", "CC0 1.0"),
)


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    t = np.zeros(256, np.uint8)
    for a, b in ((48, 58), (97, 123), (128, 256)):
        t[a:b] = 1
    return t


def words_of(data: np.ndarray, offsets: np.ndarray):
    """Word hashes and their text, in text order."""
    low = _lower_table()[data]
    starts, ends, text = runs(_kinds()[low], offsets)
    return span_hashes(low, starts, ends), text


def hash_values(h: np.ndarray, i: int) -> np.ndarray:
    return mix(h ^ mix(np.array([i + 1], U64)))


def _prepared(templates):
    """By shingle length: {(window, step): band -> {minimum: [template numbers]}}, and the shingle sets."""
    sets, groups = [], {}
    for i, (_, t) in enumerate(templates):
        raw = np.frombuffer(t.encode(), np.uint8)
        words, text = words_of(raw, np.array([0, len(raw)]))
        k = min(SHINGLE, len(words))
        sets.append(np.unique(shingle_hashes(words, text, k, whole_if_short=False)[0]) if k else words)
        if k:
            groups.setdefault(k, []).append(i)
    plans = {}
    for k, members in groups.items():
        least = None
        for i in sorted(members, key=lambda i: len(sets[i])):
            n = len(sets[i])
            if least is None or n > 1.1 * least:           # templates of about one length share their windows
                least = n
                longest = max(len(sets[j]) for j in members if n <= len(sets[j]) <= 1.1 * n)
                window = max(longest, int(np.ceil(SLACK * n))) if n > 1 else 1
                step = max(1, min(n // 4, window - longest))
                # of a template with one shingle, that shingle is the only band
                bands = plans.setdefault(k, {}).setdefault((window, step), [{} for _ in range(BANDS if n > 1 else 1)])
            for b in range(len(bands)):
                bands[b].setdefault(int(hash_values(sets[i], b).min()), []).append(i)
    return sets, plans


def scan(docs: DataFrame, templates=TEMPLATES, contained: float = CONTAINED) -> DataFrame:
    """Findings of ``docs(doc_id, text)``: doc_id, license, contained, first_shingle, last_shingle, n_windows.

    ``templates``: pairs of license and text, or a table with these columns.
    """
    if isinstance(templates, DataFrame):
        templates = [tuple(r) for r in templates.select("license", "text").where("text is not null").distinct().collect()]
    templates = tuple(templates)
    sets, plans = _prepared(templates)

    def find(words, text, n_texts):
        """(text, template, from, to, share) of retrieved and verified windows of a slice."""
        found = {}
        for k, by_window in plans.items():
            h, owner = shingle_hashes(words, text, k, whole_if_short=False)
            if len(h):
                for t, *r in find_k(h, owner, n_texts, by_window):
                    found.setdefault(t, []).append((k, *r))
        return [(t, *r) for t in sorted(found) for r in best(found[t])]

    def find_k(h, text, n_texts, by_window):
        """(text, template, places of its shingles, share)."""
        begin = np.searchsorted(text, np.arange(n_texts + 1))
        out = []
        values = [hash_values(h, b) for b in range(max(map(len, by_window.values())))]
        for (window, step), bands in by_window.items():
            hits = {}
            for b, lookup in enumerate(bands):
                near = np.zeros(1 << 16, bool)             # by the last bits, then exactly
                near[[k & 0xFFFF for k in lookup]] = True
                # a window may run over its text's end here; it is cut at the end when verified
                padded = np.concatenate([values[b], np.full(window - 1, ~U64(0), U64)])
                least = sliding_min(padded, window)
                for p in np.flatnonzero(near[least & U64(0xFFFF)]).tolist():
                    if (found := lookup.get(int(least[p]))) and (p - begin[text[p]]) % step == 0:
                        hits.setdefault(p, set()).update(found)
            for p, found in sorted(hits.items()):
                t = int(text[p])
                end = min(p + window, int(begin[t + 1]))
                for i in found:
                    inside = np.flatnonzero(np.isin(h[p:end], sets[i]))
                    share = len(np.unique(h[p:end][inside])) / len(sets[i])
                    if share >= contained:
                        out.append((t, i, p + inside - int(begin[t]), share))
        return out

    def best(found):
        """Of a text's findings those whose words are not another license's: (template, from, to, share)."""
        spans = [(np.unique(at[:, None] + np.arange(k)), i, at, share) for k, i, at, share in found]
        spans.sort(key=lambda x: (-len(x[0]), -x[3], templates[x[1]][0], x[1], x[2][0]))
        held, out = {}, []
        for words, i, at, share in spans:
            name = templates[i][0]
            if 2 * sum(held.get(w, name) != name for w in words.tolist()) > len(words):
                continue
            for w in words.tolist():
                held.setdefault(w, name)
            out.append((i, int(at[0]), int(at[-1]), share))
        return out

    def run(batches):
        for batch in batches:
            ids, rows = batch["doc_id"], []
            for at, data, offsets in slices(batch["text"]):
                words, text = words_of(data, offsets)
                rows += [(at + t, *r) for t, *r in find(words, text, len(offsets) - 1)]
            cols = list(zip(*rows)) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(cols[0], pa.int64())), pa.array([templates[i][0] for i in cols[1]], pa.string()),
                 pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.float64())],
                names=["doc_id", "license", "first", "last", "share"])

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    found = texts.mapInArrow(run, "doc_id bigint, license string, first bigint, last bigint, share double")
    return (found.groupBy("doc_id", "license")
            .agg(F.max("share").alias("contained"), F.min("first").alias("first_shingle"),
                 F.max("last").alias("last_shingle"), F.count("*").alias("n_windows")))

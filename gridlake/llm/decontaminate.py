"""Benchmark decontamination by template windows.

Texts are reduced to templates: numbers, units after numbers and names
(capitalised words inside a sentence) become typed placeholders, other words are
case-folded, punctuation goes.  Windows of ``WINDOW`` template tokens
that hold at least ``LITERALS`` plain words are hashed; windows of documents and
of benchmark items join on hash and then on the template itself.  Items are also
taken as they look inside a sentence, where a capital at their start counts.

With ``whole`` (as the queries and the pipeline call it) both sides also give the
same windows with case folded (Unicode) and names as plain words, so that copies
in upper, title or lower case are found, and a third set of the folded words as
they are, whatever they hold, whose hits always count; all sets share the coverage
rule.  Whole items shorter than a window then need as large a share of plain words
as a window does, and those of fewer than ``SHORTEST`` tokens match exactly and, by
default (``short="line"``), only where they are a whole line or a whole text: a
common word is no copy of an item that consists of it.  ``short="anywhere"`` takes
them inside a line too.

Hits of one document, item and alignment (document position less item position)
are one match.  Its slots must be consistent: one item value may not stand for
two different document values of its kind.  Without ``whole`` a match with such a
clash is dropped.  With it, each item value stands for the document value that
most windows of the match give it (of equally many the item's own, then the
least), windows that say otherwise are dropped, and windows whose values are all
the item's own stay.  Then the item's tokens that the remaining windows cover
are counted; a document is contaminated by an item when at least ``MATCHED``
tokens are covered, or all of a shorter item.

Window hashes of the benchmark go to the tasks as a filter if they take at most
``FILTER_BYTES`` (checked by counting them); a larger benchmark is joined by a
shuffle of all window hashes.  Either way the join decides.

Cases: null and empty texts have no windows; characters of scripts without spaces
are a token each; items of fewer than ``SHORTEST`` tokens match nothing without
``whole``; items of fewer than ``WINDOW`` tokens are one window; a text of any length is matched whole; rows that repeat a
doc_id add up to one document, rows that repeat an item_id are one item; null ids match nothing in
``matches``, while ``clean`` judges a document without id by its text; extra columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .textnum import U64, _lower_table, mix, runs, slices, span_hashes

WINDOW = 8
LITERALS = 5
MATCHED = 10
SHORTEST = 5
FILTER_BYTES = 16 << 20

# Units that follow a number.
UNITS = ("mm", "cm", "m", "km", "in", "inch", "inches", "ft", "feet", "foot", "yard", "yards", "mile", "miles",
         "mg", "g", "kg", "t", "oz", "lb", "lbs", "pound", "pounds", "gram", "grams", "kilogram", "kilograms",
         "ml", "l", "liter", "liters", "litre", "litres", "gallon", "gallons",
         "s", "sec", "second", "seconds", "min", "minute", "minutes", "h", "hour", "hours", "day", "days",
         "week", "weeks", "month", "months", "year", "years",
         "percent", "dollar", "dollars", "euro", "euros", "cent", "cents", "usd", "eur",
         "meter", "meters", "metre", "metres", "kilometer", "kilometers", "degrees", "mph", "kmh")

NUM, UNIT, NAME = U64(0x11), U64(0x22), U64(0x33)
TYPED, FOLDED, EXACT = 0, 1, 2               # sets of windows: names typed, names as plain words, nothing typed
# Code points of scripts written without spaces, and of the punctuation among them.
UNSPACED = ((0x0E00, 0x0EFF), (0x0F40, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF),
            (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x3FFFF))
BETWEEN = ((0x3000, 0x303F), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
MARKS = {1: "<num>", 2: "<unit>", 3: "<name>"}


@lru_cache(maxsize=1)
def _tables():
    kind = np.zeros(256, np.uint8)
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        kind[a:b] = 1
    digit = np.zeros(256, bool)
    digit[48:58] = True
    point = np.zeros(256, bool)
    point[[44, 46]] = True                       # , and . inside a number
    stop = np.zeros(256, bool)
    stop[[10, 13, 33, 46, 58, 59, 63, 34, 40]] = True     # after these a capital letter says nothing
    return kind, digit, point, stop


@lru_cache(maxsize=1)
def _unit_hashes() -> np.ndarray:
    raw = " ".join(UNITS).encode()
    data = np.frombuffer(raw, np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.append(0, ends[:-1] + 1)
    return np.sort(span_hashes(data, starts, ends))


def fold(data: np.ndarray, offsets: np.ndarray):
    """Case-folded bytes of a slice and their offsets; folding keeps the tokens' number and order."""
    if not len(data) or data.max() < 128:
        return _lower_table()[data], offsets
    raw, at = data.tobytes(), offsets.tolist()
    parts = [raw[a:b].decode("utf-8", "surrogateescape").casefold().encode("utf-8", "surrogateescape")
             for a, b in zip(at, at[1:])]
    return np.frombuffer(b"".join(parts), np.uint8), np.cumsum([0, *map(len, parts)])


def _split(data: np.ndarray, kind: np.ndarray) -> None:
    """Make each character of a script without spaces a run of its own, and its punctuation a separator."""
    at = np.flatnonzero(data >= 0xE0)                    # first bytes of three and four
    at = at[at + np.where(data[at] >= 0xF0, 3, 2) < len(data)]
    wide = data[at] >= 0xF0
    low = [data[at + i].astype(np.int64) & 63 for i in (1, 2)] + [data[at + 2 + wide].astype(np.int64) & 63]
    lead = data[at].astype(np.int64)
    point = np.where(wide, ((lead & 7) << 18) | (low[0] << 12) | (low[1] << 6) | low[2],
                     ((lead & 15) << 12) | (low[0] << 6) | low[1])

    def within(ranges):
        return np.any([(point >= a) & (point <= b) for a, b in ranges], axis=0)
    alone, between = within(UNSPACED), within(BETWEEN)
    for chosen, values in ((alone, 2 + np.arange(alone.sum()) % 2), (between, np.zeros(between.sum()))):
        for i in range(4):
            here = (i < 3) | wide[chosen]
            kind[at[chosen][here] + i] = values[here]


def _spans(data: np.ndarray, offsets: np.ndarray):
    """Tokens of a slice: ``(start, end, text)``."""
    kinds, digit, point, _ = _tables()
    kind = kinds[data]
    if len(data) > 2:
        d = digit[data]
        inner = point[data[1:-1]] & d[:-2] & d[2:]
        kind[1:-1][inner] = 1
        if data.max() >= 0xE0:
            _split(data, kind)
    return runs(kind, offsets)


def templates(data: np.ndarray, offsets: np.ndarray):
    """Tokens of a slice: ``(word hash, kind, text, folded bytes, start, end)``; kinds 0 word, 1 number, 2 unit, 3 name.

    ``start`` and ``end`` are places in the folded bytes.
    """
    _, digit, _, stop = _tables()
    starts, ends, text = _spans(data, offsets)
    low, low_offsets = fold(data, offsets)
    low_starts, low_ends, _ = (starts, ends, text) if low_offsets is offsets else _spans(low, low_offsets)
    h = span_hashes(low, low_starts, low_ends)
    token = np.zeros(len(starts), np.int8)
    if not len(starts):
        return h, token, text, low, low_starts, low_ends
    number = digit[data[starts]]
    token[number] = 1
    first = np.append(True, text[1:] != text[:-1])
    after = np.append(False, number[:-1]) & ~first & ~number
    where = np.flatnonzero(after)
    units = _unit_hashes()
    token[where[units[np.minimum(np.searchsorted(units, h[where]), len(units) - 1)] == h[where]]] = 2
    lead = data[starts]
    capital = (lead >= 65) & (lead <= 90)
    second = data[np.minimum(starts + 1, len(data) - 1)]
    capital |= (lead == 0xC3) & (second >= 0x80) & (second <= 0x9E)      # Latin capitals with marks
    where = np.flatnonzero(capital & ~first & (token == 0))
    stops = np.concatenate([[0], np.cumsum(stop[data])])
    inside = stops[starts[where]] == stops[ends[where - 1]]
    token[where[inside]] = 3
    return h, token, text, low, low_starts, low_ends


def family_of(h, token, family: int):
    """``(template hash, kind)`` of the tokens in a set of windows."""
    if family == EXACT:
        return h, np.zeros_like(token)
    if family == FOLDED:
        token = np.where(token == 3, 0, token)
    return np.where(token == 0, h, np.array([0, NUM, UNIT, NAME], U64)[token]), token


def windows(h, token, text, size: int, least: int):
    """``(first tokens, hashes)`` of windows of ``size`` tokens of one text with ``least`` plain words."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    odd = mix(np.arange(1, size + 1, dtype=U64)) | U64(1)
    with np.errstate(over="ignore"):
        x = np.full(n, U64(size))
        for i in range(size):
            x = x + h[i:i + n] * odd[i]
    plain = np.concatenate([[0], np.cumsum(token == 0)])
    ok = (text[:n] == text[size - 1:]) & (plain[size:] - plain[:n] >= least)
    at = np.flatnonzero(ok)
    return at, mix(x[at])


def whole_lines(first: np.ndarray, size: int, text: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Which windows of ``size`` tokens begin a line or text and end one."""
    line = np.concatenate([[0], np.cumsum(low == 10)])
    other = np.ones(len(text) + 1, bool)                   # token i is not on the line of the one before
    other[1:-1] = (text[1:] != text[:-1]) | (line[starts[1:]] > line[ends[:-1]])
    return other[first] & other[first + size]


def _emit(kinds_of_windows, keep, short: str = "anywhere"):
    """(id, text) -> a row for each window of the ``(set, size, least plain words)`` (whose hash ``keep`` has, if given).

    ``short="line"``: windows of fewer than ``SHORTEST`` tokens only where they are whole lines.
    """
    names = ["id", "family", "hash", "size", "pos", "tokens", "template", "slots"]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string())]

    def rows(batch):
        for at, data, offsets in slices(batch["text"]):
            h, token, text, low, starts, ends = templates(data, offsets)
            begin = np.searchsorted(text, np.arange(len(offsets)))
            typed = {k: family_of(h, token, k) for k in {k for k, *_ in kinds_of_windows}}
            raw = None
            for family, size, least in kinds_of_windows:
                first, x = windows(*typed[family], text, size, least)
                if keep is not None and len(keep):
                    hit = keep[np.minimum(np.searchsorted(keep, x), len(keep) - 1)] == x
                    first, x = first[hit], x[hit]
                if size < SHORTEST and short == "line" and len(first):
                    on = whole_lines(first, size, text, low, starts, ends)
                    first, x = first[on], x[on]
                if family == EXACT and len(first):       # a text's equal windows cover the same
                    pairs = np.stack([text[first], x.view(np.int64)], axis=1)
                    once = np.sort(np.unique(pairs, axis=0, return_index=True)[1])
                    first, x = first[once], x[once]
                if not len(first):
                    continue
                raw = raw or low.tobytes()
                for f, v in zip(first.tolist(), x.view(np.int64).tolist()):
                    t = int(text[f])
                    words = [raw[a:b].decode("utf-8", "replace") for a, b in zip(starts[f:f + size], ends[f:f + size])]
                    kinds = typed[family][1][f:f + size].tolist()
                    yield (at + t, family, v, size, f - int(begin[t]), int(begin[t + 1] - begin[t]),
                           " ".join(MARKS.get(k) or w for k, w in zip(kinds, words)),
                           [w for k, w in zip(kinds, words) if k])

    def run(batches):
        for batch in batches:
            ids, held = batch["id"], []
            for row in rows(batch):
                held.append(row)
                if len(held) >= 20_000:
                    yield _batch(ids, held)
                    held = []
            yield _batch(ids, held)

    def _batch(ids, held):
        cols = list(zip(*held)) if held else [[]] * len(names)
        return pa.RecordBatch.from_arrays(
            [ids.take(pa.array(cols[0], pa.int64())), *(pa.array(c, t) for c, t in zip(cols[1:], types[1:]))], names=names)
    return run


SCHEMA = "id bigint, family int, hash bigint, size int, pos bigint, tokens bigint, template string, slots array<string>"


def matches(docs: DataFrame, benchmark: DataFrame, whole: bool = False, short: str = "line") -> DataFrame:
    """(doc_id, item_id, matched, item_tokens, changed): consistent matches, whatever their length.

    ``whole``: also the folded and exact windows, windows against the vote of their match dropped.  ``matched``: item tokens covered; ``changed``: distinct item values with another value in the document.
    """
    def texts(df, key):
        return (df.where(F.col(key).isNotNull() & F.col("text").isNotNull())
                .select(F.col(key).cast("bigint").alias("id"), F.col("text").cast("binary").alias("text")))

    # Windows of the items: of WINDOW tokens, and whole shorter items.
    sizes = range(SHORTEST, WINDOW + 1)
    if whole:
        sets = [(k, n, LITERALS * n // WINDOW) for k in (TYPED, FOLDED) for n in sizes]
        sets += [(EXACT, n, 0) for n in range(1, WINDOW + 1)]
    else:
        sets = [(TYPED, n, min(LITERALS, n)) for n in sizes]
    plain = texts(benchmark, "item_id")
    inside = (plain.withColumn("text", F.concat(F.lit("x ").cast("binary"), "text"))
              .mapInArrow(_emit([x for x in sets if x[0] == TYPED], None), SCHEMA).where("pos > 0")
              .withColumn("pos", F.col("pos") - 1).withColumn("tokens", F.col("tokens") - 1))
    items = stored(plain.mapInArrow(_emit(sets, None), SCHEMA).unionByName(inside)
                   .where((F.col("size") == WINDOW) | (F.col("size") == F.col("tokens"))).distinct(), "bench-windows")
    per_size = {(r["family"], r["size"]): r["count"] for r in items.groupBy("family", "size").count().collect()}   # few rows
    keep = None
    if 8 * sum(per_size.values()) <= FILTER_BYTES:
        keep = np.unique(np.array([r["hash"] for r in items.select("hash").distinct().collect()], np.int64).view(U64))
    hits = texts(docs, "doc_id").mapInArrow(_emit([x for x in sets if x[:2] in per_size], keep, short), SCHEMA) if per_size else items.limit(0)
    hits = hits.select(F.col("id").alias("doc_id"), "family", "hash", "template", F.col("pos").alias("doc_pos"),
                       F.col("slots").alias("doc_slots"))
    joined = stored(hits.join(items.withColumnRenamed("id", "item_id"), ["family", "hash", "template"])
              .select("doc_id", "item_id", "family", (F.col("doc_pos") - F.col("pos")).alias("shift"), "pos", "size", "tokens",
                      "slots", "doc_slots"), "bench-hits")
    covered = F.array_distinct(F.flatten(F.collect_set(F.sequence("pos", F.col("pos") + F.col("size") - 1))))
    if whole:
        pairs = F.array_distinct(F.arrays_zip("slots", "doc_slots"))
        new = F.transform(F.filter(pairs, lambda x: x["slots"] != x["doc_slots"]), lambda x: x["slots"])
        match = ["doc_id", "item_id", "shift", "tokens"]
        # a window alone must not give an item value two document values
        alone = joined.where(F.size(pairs) == F.size(F.array_distinct("slots"))).withColumn("pairs", pairs)
        votes = (alone.where((F.col("family") != EXACT) & (F.size("pairs") > 0))
                 .select(*match, F.explode("pairs").alias("p"))
                 .groupBy(*match, F.col("p.slots").alias("value"), F.col("p.doc_slots").alias("stands")).agg(F.count("*").alias("n"))
                 .groupBy(*match, "value")
                 .agg(F.min_by("stands", F.struct(-F.col("n"), F.col("value") != F.col("stands"), "stands")).alias("stands"))
                 .groupBy(*match).agg(F.map_from_entries(F.collect_list(F.struct("value", "stands"))).alias("vote")))
        agrees = F.forall("pairs", lambda x: x["slots"] == x["doc_slots"]) \
            | F.forall("pairs", lambda x: x["doc_slots"] == F.col("vote")[x["slots"]])
        # exact hits are one a text, so they say nothing about an alignment
        consistent = (alone.join(votes, match, "left").where((F.col("family") == EXACT) | F.coalesce(agrees, F.lit(False)))
                      .groupBy(*match)
                      .agg(covered.alias("covered"), F.max(F.col("family") != EXACT).alias("aligned"),
                           F.size(F.array_distinct(F.flatten(F.collect_set(new)))).alias("changed"))
                      .withColumn("changed", F.when(F.col("aligned"), F.col("changed"))))
    else:
        # slots: each item value of an alignment must stand for one document value
        values = (joined.select("doc_id", "item_id", "shift", F.explode(F.arrays_zip("slots", "doc_slots")).alias("s"))
                  .groupBy("doc_id", "item_id", "shift", F.col("s.slots").alias("value"))
                  .agg(F.min("s.doc_slots").alias("low"), F.max("s.doc_slots").alias("high")))
        slots = values.groupBy("doc_id", "item_id", "shift").agg(
            F.max(F.col("low") != F.col("high")).alias("clash"),
            F.sum((F.col("low") != F.col("value")).cast("int")).alias("changed"))
        consistent = (joined.groupBy("doc_id", "item_id", "shift", "tokens").agg(covered.alias("covered"))
                      .join(slots, ["doc_id", "item_id", "shift"], "left")
                      .where(~F.coalesce("clash", F.lit(False))))
    return (consistent.groupBy("doc_id", "item_id")
            .agg(F.size(F.array_distinct(F.flatten(F.collect_set("covered")))).cast("bigint").alias("matched"),
                 F.max("tokens").alias("item_tokens"),
                 F.coalesce(F.min("changed"), F.lit(0)).cast("bigint").alias("changed")))


def contaminated(docs: DataFrame, benchmark: DataFrame, whole: bool = False, short: str = "line") -> DataFrame:
    """Pairs that count: doc_id, item_id, matched, item_tokens, changed."""
    return matches(docs, benchmark, whole, short).where(F.col("matched") >= F.least(F.lit(MATCHED), "item_tokens"))


def clean(docs: DataFrame, benchmark: DataFrame, whole: bool = False, short: str = "line") -> DataFrame:
    """``docs`` without contaminated documents; all columns stay.  Rows without id are judged each by its text."""
    found = contaminated(docs, benchmark, whole, short).select("doc_id").distinct()
    nameless = docs.where(F.col("doc_id").isNull())
    kept = docs.join(found, "doc_id", "left_anti").select(*docs.columns)
    if nameless.isEmpty():
        return kept
    by_text = nameless.select(F.xxhash64("text").alias("doc_id"), "text")
    bad = contaminated(by_text, benchmark, whole, short).select(F.col("doc_id").alias("_text")).distinct()
    return kept.where(F.col("doc_id").isNotNull()).unionByName(
        nameless.withColumn("_text", F.xxhash64("text")).join(bad, "_text", "left_anti").select(*docs.columns))

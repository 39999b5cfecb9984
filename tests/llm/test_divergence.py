"""op11: against a plain computation over dictionaries, for tiles and trees of several shapes."""
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from gridlake.llm import divergence as D

SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n bigint"


def plain(rows, min_docs, top=10):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(
        c.lower() if "A" <= c <= "Z" else c for c in text or ""))) for _, text, lang, source, *_ in rows]
    df, count, sources = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, words in docs:
        df[lang].update(set(words))
        count[lang, source].update(words)
        sources[lang].add(source)
    out = []
    for lang, names in sources.items():
        kept = [t for t, n in df[lang].items() if n >= min_docs]
        total = {s: sum(count[lang, s][t] for t in kept) for s in names}

        def p(c, n):
            return 1 + 10**9 * (c + 2) // (n + 2 * len(kept))
        whole = sum(total.values())
        for s in names:
            pairs = [(sum((p(count[lang, s][t], total[s]) - p(count[lang, o][t], total[o])) ** 2
                          // (p(count[lang, s][t], total[s]) + p(count[lang, o][t], total[o])) for t in kept), o)
                     for o in names if o != s]
            terms = []
            for t in kept:
                x, y = p(count[lang, s][t], total[s]), p(sum(count[lang, o][t] for o in names), whole)
                if count[lang, s][t] and x > y:
                    terms.append(((x - y) ** 2 // (x + y), t))
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items = sorted(items, key=lambda i: (-i[0], i[1].encode()))[:most]
                out += [(lang, s, part, item, value, r) for r, (value, item) in enumerate(items, 1)]
    return sorted(out)


def corpus(n=400, seed=1):
    rng = np.random.default_rng(seed)
    words = ["Alpha", "beta", "GAMMA", "delta-x", "été", "Ünder", "x1y", "naïve", "the", "THE", "日本 語", "end."]
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.34 else f"s{rng.integers(12)}"
        lang = ["en", "de", None][rng.integers(3)]
        k = int(rng.integers(0, 9))
        own = [f"{source}word"] * int(rng.integers(0, 3))
        text = " ".join([words[j] for j in rng.integers(0, len(words), k)] + own) if rng.random() > 0.05 else None
        rows.append((i, text, lang, source if rng.random() > 0.03 else None, "clash", 7))
    rows += [(1, "the the beta", "en", "s1", None, None)] * 3                    # repeated rows
    rows.append((None, "beta " * 30_000 + "fin", "de", "long", None, None))     # a very long text
    rows.append((5, "lonely words", "xx", "only", None, None))                  # one source, no kept term
    rows += [(6, "", "yy", "a", None, None), (7, None, "yy", "b", None, None)]  # no terms at all
    return rows


@pytest.mark.parametrize("k,block,tile", [(2, 64, 100_000), (4, 3, 20), (3, 5, 1)])
def test_against_plain_computation(spark, k, block, tile):
    rows = corpus()
    got = D.audit(spark.createDataFrame(rows, SCHEMA), min_docs=4, k=k, rows_per_block=block, cells_per_tile=tile)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = sorted(map(tuple, got.collect()))
    want = plain(rows, 4)
    assert got == want
    assert ("yy", "a", "pair", "b", 0, 1) in got and not [r for r in got if r[0] == "xx"]


def test_empty_table(spark):
    assert D.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_flushing_a_task_early(spark, monkeypatch):
    monkeypatch.setattr(D, "FLUSH_CELLS", 5)
    rows = corpus(60)
    import pyarrow as pa
    batch = pa.RecordBatch.from_arrays([pa.array([r[2] or "" for r in rows]), pa.array([r[3] or "" for r in rows]),
                                        pa.array([(r[1] or "").encode() for r in rows], pa.binary())],
                                       names=["lang", "source", "text"])
    sums = Counter()
    for out in D._cells([batch]):
        for lang, source, term, n, docs in zip(*(c.to_pylist() for c in out.columns)):
            sums[lang, source, term, "n"] += n
            sums[lang, source, term, "docs"] += docs
    monkeypatch.undo()
    whole = Counter()
    for out in D._cells([batch]):
        for lang, source, term, n, docs in zip(*(c.to_pylist() for c in out.columns)):
            whole[lang, source, term, "n"] += n
            whole[lang, source, term, "docs"] += docs
    assert +sums == +whole and {k[:2] for k in sums} == {k[:2] for k in whole}


def test_quadtree_walk():
    rng = np.random.default_rng(3)
    for k in (2, 3, 4):
        dense = np.where(rng.random((13, 50)) < 0.15, rng.integers(1, 9, (13, 50)), 0)
        dense[:, 20:40] = 0                                # a zero quadrant
        r, c = np.nonzero(dense)
        tree = D.QuadTree(r, c, *dense.shape, k)
        share = (dense[r, c] * 1000)[tree.order]
        zero = np.arange(13) + 5
        full = np.where(dense > 0, dense * 1000, zero[:, None])
        for split in (None, 4):
            sums, seen = D.joint_sums(tree, share, zero, split)
            for g in range(13):
                for h in range(13):
                    on = g < h if split is None else g < split <= h
                    either = (dense[g] > 0) | (dense[h] > 0)
                    assert seen[g, h] == (either.sum() if on else 0)
                    assert sums[g, h] == (D.gaps(full[g], full[h])[either].sum() if on else 0)


def test_shares_are_exact():
    count = np.array([0, 5, 10**12, 9 * 10**14], np.int64)
    total, terms = np.full(4, 9 * 10**14, np.int64), 7
    assert D.shares(count, total, terms).tolist() == [1 + 10**9 * (int(c) + 2) // (9 * 10**14 + 14) for c in count]

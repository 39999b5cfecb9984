"""The n-gram Jaccard join against all pairs."""

import random
import re

import pytest

from gridlake.llm import jaccard_join


def brute(rows, k, num, den):
    def shingles(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
        if not w:
            return frozenset()
        return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) or frozenset([tuple(w)])
    sets = [(i, shingles(t)) for i, t in rows]
    up = {i: i for i, _ in rows if i is not None}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is None or j is None or not a or not b:
                continue
            n = len(a & b)
            if den * n >= num * (len(a) + len(b) - n):
                p, q = root(i), root(j)
                up[max(p, q)] = min(p, q)
    return sorted([(i, len(s), None if i is None else root(i)) for i, s in sets], key=str)


def corpus(seed, n):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    passage = [rnd.choice(vocab) for _ in range(40)]
    rows = [(1000, None), (1001, ""), (1002, " \t\n"), (1003, "One Two"), (1004, "one\x0btwo"), (1005, "solo"),
            (1006, "a b c"), (1007, "A B C"), (1008, "a b c d"), (None, "a b c"), (1009, "é   É"), (1010, "é   É")]
    base = []
    for i in range(n):
        if base and rnd.random() < 0.55:
            w = list(rnd.choice(base))
            for _ in range(rnd.randrange(0, max(2, len(w) // 30))):
                at = rnd.randrange(len(w))
                rnd.choice([lambda: w.__setitem__(at, rnd.choice(vocab)), lambda: w.insert(at, "new"),
                            lambda: w.pop(at) if len(w) > 1 else None])()
            if not w:
                w = ["x"]
        else:
            w = [rnd.choice(vocab) for _ in range(rnd.choice([3, 8, 12, 20, 60, 150, 300]))]
            if rnd.random() < 0.4:
                w[len(w) // 2:len(w) // 2] = passage
        base.append(w)
        rows.append((i, " ".join(w)))
    rows += [(3, rows[20][1]), (3, rows[20][1]), (5, rows[-1][1])]      # repeated ids
    return rows


@pytest.mark.parametrize("k,num,den,sample", [(3, 90, 100, 4), (5, 80, 100, 2)])
def test_components_match_all_pairs(spark, monkeypatch, k, num, den, sample):
    rows = corpus(k, 260)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string")
    if k == 5:
        monkeypatch.setattr(jaccard_join, "BLOCK", 4000)          # many small tiles
    got = sorted(map(tuple, jaccard_join.join(docs, k, num, den, sample).collect()), key=str)
    assert got == brute(rows, k, num, den)


def test_one_of_each_group_stays(spark):
    rows = corpus(9, 60)
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, size string")
    kept = jaccard_join.keep_one(docs, k=5, num=80, den=100, sample=2)
    assert kept.columns == docs.columns
    lost = {i for i, _, c in brute(rows, 5, 80, 100) if i is not None and i != c}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(
        i for i, _ in rows if i is not None and i not in lost)


def test_no_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard_join.join(empty).count() == 0

"""Embedding near-dedup against all pairs."""

import numpy as np

from gridlake.llm import embed_dedup as ed


def brute(rows, limit):
    ok = [(k, i, np.array(v, float)) for k, (i, v) in enumerate(rows)
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    n_links, up = {k: 0 for k in range(len(rows))}, {i: i for i, _ in rows}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for a, (k, i, v) in enumerate(ok):
        for m, j, w in ok[:a]:
            if len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= limit:
                n_links[k] += 1
                n_links[m] += 1
                p, q = sorted((root(i), root(j)))
                up[q] = p
    return [(i, n_links[k], None if i is None else root(i)) for k, (i, _) in enumerate(rows)]


def rows_of(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    rows, hub = [], rng.standard_normal(dim)
    for i in range(n):
        kind = rng.integers(4)
        v = {0: rng.standard_normal(dim), 1: hub + 0.25 * rng.standard_normal(dim),
             2: np.array(rows[rng.integers(len(rows))][1]) if rows else hub,
             3: hub * rng.uniform(0.1, 5)}[int(kind)]
        rows.append((int(i), [float(np.float32(x)) for x in v]))
    rows += [(5000, None), (5001, []), (5002, [0.0] * dim), (5003, [None] + [1.0] * (dim - 1)),
             (5004, [float("nan")] * dim), (5005, [float("inf")] + [1.0] * (dim - 1)), (None, rows[0][1]),
             (5006, rows[0][1][:8]), (5007, [-0.0] + [0.0] * (dim - 2) + [1.0]), (5008, [0.0] * (dim - 1) + [1.0])]
    return rows


def test_links_and_components(spark, monkeypatch):
    rows = rows_of(1, 300)
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, pattern string")
    want = {k: v for k, *v in brute(rows, 0.9)}
    for block in (1024, 16):
        monkeypatch.setattr(ed, "BLOCK", block)
        got = {r.vec_id: [r.n_links, r.component_id] for r in ed.near_duplicates(frame).collect()}
        assert set(got) == set(want) and len(got) == len(rows)
        total = sum(v[0] for v in want.values())
        assert sum(v[0] for v in got.values()) >= 0.9 * total
        assert all(got[k][0] <= want[k][0] for k in want)          # no link below the limit
        same = sum(got[k][1] == want[k][1] for k in want)
        assert same >= 0.97 * len(rows)


def test_repeated_ids_and_no_rows(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])],
                                  "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ed.near_duplicates(frame).collect()))
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False), (3, 1, 1, False)]
    assert ed.near_duplicates(frame.where("vec_id = 9")).count() == 0

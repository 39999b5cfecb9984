"""op3: scores follow texts and labels alone; long texts; the fit against a plain solver."""
import random
import zlib

import numpy as np

from gridlake.llm import quality as Q


def corpus(n=300, seed=3):
    rng = random.Random(seed)
    good = ["river", "mountain", "teacher", "walks", "quietly", "along", "the", "shore"]
    bad = ["buy", "now", "!!!", "click", "free", "$$$", "here", "win"]
    rows = []
    for i in range(n):
        y = int(rng.random() < 0.6)
        rows.append((" ".join(rng.choices(good if y else bad, k=rng.randint(5, 40))), y))
    return rows + [rows[0], rows[1], (rows[2][0], 1 - rows[2][1])]          # repeated texts, one with both labels


def ids_like(rows, first):
    """Other ids for the rows, held out alike: the n-th free id of each kind from ``first`` on."""
    out, free = [], {True: [], False: []}
    at = first
    for i in range(len(rows)):
        want = zlib.crc32(str(i).encode()) % 5 == 0
        while not free[want]:
            free[zlib.crc32(str(at).encode()) % 5 == 0].append(at)
            at += 1
        out.append(free[want].pop(0))
    return out


def test_other_ids_give_the_same_scores(spark):
    rows = corpus()
    scores = []
    for ids in (list(range(len(rows))), ids_like(rows, 10_000), ids_like(rows, 777_777)[:]):
        docs = spark.createDataFrame([(d, t) for d, (t, _) in zip(ids, rows)], "doc_id long, text string").repartition(5)
        labels = spark.createDataFrame([(d, y) for d, (_, y) in zip(ids, rows)], "doc_id long, quality int").repartition(3)
        got = {r.doc_id: (r.held_out, r.score, r.predicted) for r in Q.classify(docs, labels, fit_rows=200).collect()}
        scores.append([got[d] for d in ids])
    assert scores[0] == scores[1] == scores[2]
    held = [(s, y) for s, (_, y) in zip(scores[0], rows) if s[0]]
    assert np.mean([s[2] == y for s, y in held]) > 0.9


def test_a_very_long_text_is_scored_whole(spark):
    rows = corpus()
    end = "buy now !!! click free $$$ here win " * 30_000
    texts = [t for t, _ in rows] + ["river walks along the shore " + end]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, (_, y) in enumerate(rows)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in Q.classify(docs, labels).collect()}
    assert got[len(rows)] < 0.3


def test_descent_solves_the_hinge_loss():
    """The dual solution against subgradient steps on the same objective."""
    rng = np.random.default_rng(5)
    rows = [np.unique(rng.integers(0, 30, rng.integers(2, 9))) for _ in range(120)]
    scale = rng.normal(size=30)
    y = np.sign(np.array([scale[r].sum() for r in rows]) + rng.normal(size=120) * 0.3)
    cost = np.where(y > 0, 0.7, 1.3)
    x = np.zeros((120, 31))
    for i, r in enumerate(rows):
        x[i, r] = scale[r] / np.sqrt((scale[r] ** 2).sum())
        x[i, 30] = 1.0

    def loss(w):
        return 0.5 * w @ w + (cost * np.maximum(0, 1 - y * (x @ w))).sum()
    w = Q.dual_coordinate_descent(rows, y, scale, cost, epochs=400)
    best, v = np.inf, np.zeros(31)
    for t in range(1, 20_001):
        on = y * (x @ v) < 1
        v = v - (v - (x[on] * (cost[on] * y[on])[:, None]).sum(0)) / (t + 10)
        best = min(best, loss(v))
    assert loss(w) <= best * 1.001

"""The pipeline against a brute-force version of its stages, and the components helper."""

import hashlib
import random
import re

import numpy as np

import corpus_pipeline
from gridlake.llm import quality
from gridlake.llm.common import components

from test_bpe_secrets import _direct
from test_jaccard import brute


def _tables(tmp_path, spark):
    rnd = random.Random(11)
    vocab = [f"v{i}" for i in range(300)]

    def text(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))
    bench = [(i, text(20)) for i in range(5)]
    rows, labels = [], []
    for i in range(260):
        t, good = text(rnd.randrange(15, 80)), True
        kind = rnd.random()
        if kind < 0.15:
            t, good = t.replace(" ", " | "), False
        elif kind < 0.3 and rows:
            t = rnd.choice(rows)[1] + " more"
            good = "|" not in t
        elif kind < 0.35:
            t = t + " " + rnd.choice(bench)[1] + " " + text(5)
        elif kind < 0.4:
            t = t + f' token = "{hashlib.sha1(str(i).encode()).hexdigest()}" ' + text(4)
        rows.append((i, t))
        labels.append((i, int(good), 0))
    rows += [(500, None), (501, ""), (502, rows[3][1])]
    frame = [(i, t, "en", f"s{(i or 0) % 7}", None if t is None else len(t)) for i, t in rows]
    base = str(tmp_path)
    spark.createDataFrame(frame, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{base}/benchmark.parquet")
    return base, rows, bench


def test_pipeline_matches_brute_force(spark, tmp_path):
    base, rows, bench = _tables(tmp_path, spark)
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    good = {r.doc_id for r in quality.classify(docs, labels).collect() if r.predicted}
    kept = [r for r in rows if r[0] in good]
    group = {i: c for i, _, c in brute(kept, 5, 80, 100)}
    kept = [r for r in kept if group[r[0]] == r[0]]
    kept = [(i, t) for i, t in kept if not any(b in (t or "") for _, b in bench)]
    seen = {}
    for i, t in kept:
        for v in re.findall(r'token = "([0-9a-f]{40})"', t or ""):
            seen.setdefault(v, set()).add(f"s{i % 7}")
    want = []
    for i, t in kept:
        for v, owners in seen.items():
            if len(owners) < 3 and t:
                t = t.replace(v, "[secret]")
        want.append((i, *_direct(t)))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, base).collect()]
    assert sorted(got) == sorted(want) and 50 < len(got) < len(rows)


def test_stages_keep_the_columns(spark, tmp_path):
    base, rows, _ = _tables(tmp_path, spark)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, base)
        assert out.columns == docs.columns
        assert stage(spark, docs.where("doc_id < 0"), base).count() == 0


def test_components_match_union_find(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (300, 2))] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(7, 7), (2000, x := 2001), (x, 2000)]
    up = {}

    def root(i):
        while up.setdefault(i, i) != i:
            i = up[i]
        return i
    for a, b in edges:
        if a != b:
            p, q = sorted((root(a), root(b)))
            up[q] = p
    want = {i: root(i) for i in up}
    frame = spark.createDataFrame([*edges, (None, 3), (3, None)], "x long, y long").repartition(7)
    got = [tuple(r) for r in components(frame).collect()]
    assert dict(got) == want and len(got) == len(want)
    assert components(frame.where("x < 0")).count() == 0

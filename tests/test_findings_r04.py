"""Tests of the findings of round 4 (F1: tests/llm/test_shuffle_files.py)."""

import json

from conftest import raw_frame
from test_findings_r03 import GOOD

from gridlake.session import FREE_SHUFFLES, ensure_checkpoint_dir
from gridlake.sources.files import Files
from gridlake.streaming import ingest as S

BUFFER = "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB"


class _Writer:
    """Stands for a stream's writer; tells the session's settings at its start."""

    def __init__(self, spark):
        self.spark = spark

    def start(self):
        return {k: self.spark.conf.get(k, None) for k in (BUFFER, "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB")}


def test_state_partitions_share_their_write_buffers(spark):
    """outside the heap an executor held two buffers of 64 MB and 8 MB of blocks a state partition."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n, each in ((8, 8), (72, 3), (600, 1)):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            assert list(S._start(spark, _Writer(spark)).values()) == [str(each), "2"]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert spark.conf.get(BUFFER, None) is None


def test_a_batch_is_not_kept_by_the_executors(spark, registry, monkeypatch):
    """rows and results of a batch wait in the scratch folder, which the batch clears."""
    real, kept = S._stage, []

    def staged(spark_, cfg, results, batch_id):
        kept.append(spark_.sparkContext._jsc.getPersistentRDDs().size())
        real(spark_, cfg, results, batch_id)
    monkeypatch.setattr(S, "_stage", staged)
    texts = [json.dumps(dict(GOOD, request_id=f"r{i % 30}")) for i in range(40)] + ["[1]", "not json"]
    scratch = Files(spark, ensure_checkpoint_dir(spark))
    before = spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get(FREE_SHUFFLES, None)
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    for size, n in ((None, 1), (10, 5)):
        held = {x for x in scratch.names("") if x.startswith("batch-")}
        out = S.drain(spark, [raw_frame(spark, texts)], registry, batch_size=size)
        assert {x for x in scratch.names("") if x.startswith("batch-")} == held
        rows = out.batches().collect()
        assert len(rows) == n and sum(r["landed"] for r in rows) == 42
        assert [sum(r[c] for r in rows) for c in ("readings", "rejects", "duplicates")] == [30, 2, 10]
        assert spark.read.parquet(out.cfg.path("raw")).count() == 42
    assert kept == [cached, cached]
    assert (spark.conf.get("spark.sql.files.openCostInBytes"), spark.conf.get(FREE_SHUFFLES, None)) == before


def test_flushes_are_numbered_and_joined_in_tasks_of_bounded_rows(spark, registry, monkeypatch):
    """the numbering and the join of the flushes had as many tasks as the session's partitions, whatever the rows."""
    monkeypatch.setattr(S, "ROWS_PER_TASK", 10)
    real_cut, real_stage, seen, finest = S.cut, S._stage, [], []
    monkeypatch.setattr(S, "cut", lambda rows, *a, **how: (seen.append(how), real_cut(rows, *a, **how))[1])

    def staged(spark_, cfg, results, batch_id):
        finest.append(results.sparkSession.conf.get(S.FINEST, None))
        real_stage(spark_, cfg, results, batch_id)
    monkeypatch.setattr(S, "_stage", staged)
    before = spark.conf.get(S.FINEST, None)
    scratch = Files(spark, ensure_checkpoint_dir(spark))
    left = {x for x in scratch.names("") if x.startswith("numbered-")}
    texts = [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(100)]
    out = S.drain(spark, [raw_frame(spark, texts)], registry, batch_size=30)
    assert sorted((r["flush"], r["landed"], r["readings"]) for r in out.batches().collect()) == \
        [(0, 30, 30), (1, 30, 30), (2, 30, 30), (3, 10, 10)]
    assert [how["ranges"] for how in seen] == [20] and finest == ["20"]      # 100 rows and 100 new ids
    assert {x for x in scratch.names("") if x.startswith("numbered-")} == left
    assert spark.conf.get(S.FINEST, None) == before

"""Tests of the findings of round 3."""

import json

from conftest import raw_frame
from pyspark.sql import functions as F

from gridlake.plans.normalize import normalize

GOOD = {"request_id": "r1", "device_id": "D1", "data": {"serial_no": "s", "total_output_power": 5, "today_e": 1,
                                                        "total_e": 2, "s1v": 3, "inv_temp": 4, "f": 50, "fault_code": 0}}


def test_flushes_of_a_batch_are_written_together(spark, registry, tmp_path, monkeypatch):
    """the number of write jobs does not grow with the number of flushes."""
    from pyspark.sql import DataFrameWriter

    from gridlake.streaming import ingest as S
    real, paths = DataFrameWriter.parquet, []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (paths.append(path), real(self, path, *a, **k)))
    texts = [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(60)]
    out = S.drain(spark, [raw_frame(spark, texts)], registry, batch_size=10)
    jobs = [p for p in paths if "/sink/" in p]
    assert len(jobs) <= 6, jobs                      # raw rows, four tables, columns of a table without rows
    log = sorted((r["flush"], r["landed"], r["readings"], r["processed"]) for r in out.batches().collect())
    assert log == [(f, 10, 10, 10) for f in range(6)]
    assert out.readings().count() == 60 and out.status().count() == 120
    assert spark.read.parquet(out.cfg.path("rejects")).count() == 0
    by_flush = spark.read.parquet(out.cfg.path("readings")).where("flush = 2").select("request_id").collect()
    assert sorted(r[0] for r in by_flush) == [f"r{i}" for i in range(20, 30)]


def test_rows_are_not_brought_together_by_key_set(spark, registry, tmp_path):
    """F2, F8: a few key sets hold all payloads; their scores are looked up without moving rows."""
    texts = [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(30)] + ['{"x": 1}']
    registry.write.parquet(str(tmp_path / "reg"))
    for kw in ({"plan": "rules"}, {"as_of": True}):
        readings = normalize(raw_frame(spark, texts), spark.read.parquet(str(tmp_path / "reg")), **kw).readings
        readings.collect()
        plan = readings._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_keys" not in plan and "hashpartitioning(_epoch" not in plan
        assert readings.count() == 30


def test_stream_queries_do_not_store_the_lake(spark, tmp_path, monkeypatch):
    """the stream's result is kept by the state of the input, without a batch run over all payloads."""
    from gridlake.plans import queries as Q
    monkeypatch.setattr(Q, "lake", lambda *a: (_ for _ in ()).throw(AssertionError("lake")))
    (spark.range(40).select("id", (F.col("id") % 3).alias("user_id"), F.lit("view").alias("event_type"),
                            F.lit(2.5).alias("value"), F.lit('{"k": 4}').alias("props"),
                            F.timestamp_seconds(F.lit(1704067200) + F.col("id")).cast("timestamp_ntz").alias("ts"))
     .withColumnRenamed("id", "event_id").write.parquet(str(tmp_path / "events.parquet")))
    assert Q.q_batch_stats(spark, str(tmp_path)).first().asDict() == {"batches": 2, "records": 41}
    states = Q.q_stream_dedupe(spark, str(tmp_path)).collect()
    assert len(states) == 41 and sum(r["error"] is not None for r in states) == 1


def test_rows_with_payloads_are_not_sorted_to_find_duplicates(spark, registry):
    """the contested ids are hashed; sorts of payloads spill once a task holds many."""
    texts = [json.dumps(dict(GOOD, request_id=f"r{i % 20}")) for i in range(30)]
    run = normalize(raw_frame(spark, texts), registry)
    counts = {r["outcome"]: r["count"] for r in run.results.groupBy("outcome").count().collect()}
    assert counts == {"reading": 20, "duplicate": 10}
    plan = run.results._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin [request_id" in plan and "SortMergeJoin [request_id" not in plan


def test_marks_read_the_status_once_a_frame(spark):
    """landed ids and their state come from one lookup in the status."""
    from gridlake.operators import lifecycle as L
    status = spark.createDataFrame([("a", False, "x", 1, 1), ("b", True, None, 2, 4)],
                                   "raw_id string, processed boolean, error string, attempts int, seq bigint")
    ids = spark.createDataFrame([("a",), ("a",), ("c",), (None,)], "raw_id string")
    entries, unknown = L.mark(ids, status, True, None, status=status)
    assert [(r["raw_id"], r["processed"], r["attempts"], r["seq"]) for r in entries.collect()] == [("a", True, 2, 2)]
    assert sorted(str(r["raw_id"]) for r in unknown.collect()) == ["None", "c"]
    plan = entries._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1, plan


def test_tasks_of_a_batch_follow_its_rows(spark, registry, monkeypatch):
    """results of a batch are cached in tasks of bounded rows, not merged by compressed bytes."""
    from gridlake.streaming import ingest as S
    monkeypatch.setattr(S, "ROWS_PER_TASK", 20, raising=False)
    real, cached = S._stage, []
    monkeypatch.setattr(S, "_stage", lambda spark_, cfg, results, batch_id: (
        cached.append([r["count"] for r in results.groupBy(F.spark_partition_id()).count().collect()]),
        real(spark_, cfg, results, batch_id)))
    out = S.drain(spark, [raw_frame(spark, [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(100)])], registry)
    assert sum(cached[0]) == 100 and max(cached[0]) <= 40 and len(cached[0]) >= 5, cached
    assert out.readings().count() == 100

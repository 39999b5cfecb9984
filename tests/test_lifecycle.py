"""Raw lifecycle: landing, status log, retry, retention, stats, stream."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from conftest import raw_frame
from gridlake.operators import lifecycle as L
from gridlake.plans.normalize import normalize
from gridlake.plans.reprocess import reprocess
from gridlake.sources import registry as R

GOOD = {"request_id": "g1", "source_id": "current_format", "data": {"f": 50}}
UNKNOWN = {"request_id": "u1", "foo": 3}


def test_landing_keeps_text_and_ids(spark):
    raw = L.land(raw_frame(spark, [json.dumps(GOOD), "[1]", json.dumps({"request_id": ""})]))
    rows = raw.orderBy("raw_id").collect()
    assert rows[0]["request_id"] == "g1" and rows[0]["payload"] == json.dumps(GOOD)
    assert rows[1]["request_id"] == "raw-1-0" and rows[2]["request_id"] == "raw-2-0"
    assert rows[0]["received_date"].isoformat() == "2025-11-17"


def test_status_and_retry_without_limit_q10(spark, registry):
    raw = L.land(raw_frame(spark, [json.dumps(GOOD), json.dumps(UNKNOWN), "{bad"]))
    n = normalize(raw, registry)
    log = L.landing_status(raw).unionByName(L.outcome_status(n.outcomes))
    status = L.current_status(log)
    pend = {r["raw_id"] for r in L.pending(raw, status).collect()}
    assert pend == {"raw-1-0", "raw-2-0"}
    s = L.raw_stats(status).first()
    assert (s["total_raw"], s["unprocessed"], s["with_errors"], s["processed"]) == (3, 2, 2, 1)
    # fix the registry: a mapping for the unknown layout
    spec = {"source_id": "foo_dev", "nested_path": "", "rules": [("foo", "fault_code", "int", "", None, False)]}
    fixed = R.create_mapping(spark, registry, spec)
    rep = reprocess(raw, status, fixed)
    assert [r["request_id"] for r in rep.readings.collect()] == ["u1"]
    status2 = L.current_status(log.unionByName(rep.status))
    by_id = {r["raw_id"]: r for r in status2.collect()}
    assert by_id["raw-1-0"]["processed"] and by_id["raw-2-0"]["attempts"] == 2
    # the broken row stays pending however often it was tried; a limit is the caller's choice
    log3 = log.unionByName(rep.status)
    for _ in range(5):
        now = L.current_status(log3)
        again, _unknown = L.mark(spark.createDataFrame([("raw-2-0",)], "raw_id string"), raw, False, "invalid JSON", now)
        log3 = spark.createDataFrame(log3.unionByName(again).collect(), log3.schema)
    status3 = L.current_status(log3)
    assert L.pending_oldest(raw, status3).count() == L.raw_stats(status3).first()["unprocessed"] == 1
    assert L.pending(raw, status3, max_attempts=3).count() == 0
    assert [r["raw_id"] for r in L.exhausted(raw, status3, 3).collect()] == ["raw-2-0"]


def test_reprocess_marks_rows_of_stored_ids(spark, registry):
    raw = L.land(raw_frame(spark, [json.dumps(GOOD), json.dumps(dict(GOOD, request_id="g2"))]))
    status = L.current_status(L.landing_status(raw))
    stored = spark.createDataFrame([("g1",)], "request_id string")
    rep = reprocess(raw, status, registry, stored_request_ids=stored)
    assert [r["request_id"] for r in rep.readings.collect()] == ["g2"]
    now = L.current_status(L.landing_status(raw).unionByName(rep.status))
    assert L.pending(raw, now).count() == 0
    assert now.where("raw_id = 'raw-0-0'").first()["error"] == "duplicate request_id"


def test_mark_takes_any_landed_id_and_reports_unknown(spark):
    ids = ["9f1c2d3e-0000-4000-8000-000000000001", "late-raw-0-0", "raw-1-0"]
    raw = L.land(raw_frame(spark, ["{}"] * 3).withColumn(
        "raw_id", F.element_at(F.array(*map(F.lit, ids)), F.substring("raw_id", 5, 1).cast("int") + 1)))
    asked = spark.createDataFrame([(i,) for i in [*ids, ids[0], "never landed"]], "raw_id string")
    entries, unknown = L.mark(asked, raw, True, None)
    assert sorted(r["raw_id"] for r in entries.collect()) == sorted(ids)
    assert [tuple(r) for r in unknown.collect()] == [("never landed", "unknown raw id")]


def test_apply_retention_rewrites_old_dates_only(spark, registry, tmp_path):
    from gridlake.plans.lake import raw_table
    texts = [json.dumps(dict(GOOD, request_id=f"g{i}")) for i in range(3)] + ["{bad"]
    days = ["2025-11-15 06:00:00", "2025-11-16 06:00:00", "2025-11-17 06:00:00", "2025-11-16 07:00:00"]
    raw = L.land(raw_frame(spark, texts).withColumn(
        "received_at", F.element_at(F.array(*map(F.lit, days)), F.substring("raw_id", 5, 1).cast("int") + 1).cast("timestamp")))
    table = raw_table(spark, str(tmp_path / "raw"))
    table.append(raw)
    status = L.current_status(L.landing_status(raw).unionByName(L.outcome_status(normalize(raw, registry).outcomes)))
    later = [p for p in table.parts() if p.date == "2025-11-17"]
    before = table.read()
    assert L.apply_retention(table, status, datetime(2025, 11, 16, 23)) == 2
    assert sorted(r["raw_id"] for r in table.read().collect()) == ["raw-2-0", "raw-3-0"]
    assert [p for p in table.parts() if p.date == "2025-11-17"] == later       # not rewritten
    assert "2025-11-15" not in {p.date for p in table.parts()}
    assert before.count() == 4                              # readers of the version before go on
    assert L.apply_retention(table, status, datetime(2025, 11, 16, 23)) == 0
    table.vacuum(least_age_seconds=0)
    assert sorted(r["raw_id"] for r in table.read().collect()) == ["raw-2-0", "raw-3-0"]
    assert sum(len(table.files.names(f"data/{s}")) > 0 for s in table.files.names("data")) == 2


def test_retention_r3(spark, registry):
    raw = L.land(raw_frame(spark, [json.dumps(GOOD), json.dumps(UNKNOWN),
                                   json.dumps(dict(GOOD, request_id="g2"))]))
    n = normalize(raw, registry)
    status = L.current_status(L.landing_status(raw).unionByName(L.outcome_status(n.outcomes)))
    cutoff = datetime(2025, 11, 17, 6, 2)      # rows at 06:00, 06:01, 06:02
    kept, deleted = L.retention(raw, status, cutoff)
    assert sorted(r["raw_id"] for r in kept.collect()) == ["raw-1-0", "raw-2-0"]
    assert deleted.first()["deleted"] == 1       # strict "<", pending row kept


def test_ingest_stats_and_rate(spark, registry):
    faulty = dict(GOOD, request_id="g2", data={"fault_code": 4})
    raw = L.land(raw_frame(spark, [json.dumps(GOOD), json.dumps(faulty), "x", json.dumps(GOOD)]))
    n = normalize(raw, registry)
    s = L.ingest_stats(n.outcomes, F.col("fault")).first()
    assert (s["total_records"], s["fault_records"], s["normal_records"]) == (2, 1, 1)
    assert (s["inserted_count"], s["failed_count"]) == (2, 2) and s["success_rate"] == 50.0
    rate = L.ingest_rate(n.outcomes, 120).orderBy("window_start").collect()
    assert [r["received"] for r in rate] == [2, 2]
    rec = L.reconcile(n.outcomes, n.readings).first()
    assert (rec["inserted_count"], rec["total_records"], rec["discrepancy"], rec["missing"]) == (2, 2, 0, 0)


def test_time_range_scan_s8(spark):
    raw = L.land(raw_frame(spark, ["{}"] * 5))
    out = L.by_time_range(raw, datetime(2025, 11, 17, 6, 1), datetime(2025, 11, 17, 6, 3), 2)
    assert [r["raw_id"] for r in out.collect()] == ["raw-3-0", "raw-2-0"]


def test_stream_matches_batch_and_is_idempotent(spark, registry, tmp_path):
    from gridlake.streaming.ingest import StreamConfig, batch_stats, start_ingest
    texts = [json.dumps(dict(GOOD, request_id=f"r{i}", data={"f": i})) for i in range(20)]
    texts += [json.dumps(dict(GOOD, request_id="r3")), "nope"]
    src = str(tmp_path / "in")
    raw_frame(spark, texts).select("raw_id", "payload", "received_at").repartition(3) \
        .write.parquet(src)
    reg_path = str(tmp_path / "reg")
    registry.write.parquet(reg_path)
    cfg = StreamConfig(sink=str(tmp_path / "sink"), checkpoint=str(tmp_path / "ckpt"),
                       max_files_per_trigger=1)
    for _ in range(2):          # second run: same checkpoint, nothing new to do
        q = start_ingest(spark, src, cfg, lambda s: s.read.parquet(reg_path), available_now=True)
        q.awaitTermination()
        assert q.exception() is None
    got = spark.read.parquet(cfg.path("readings"))
    batch = normalize(raw_frame(spark, texts), registry).readings
    assert got.count() == 20 and batch.count() == 20
    assert sorted(r["request_id"] for r in got.collect()) == sorted(r["request_id"] for r in batch.collect())
    st = batch_stats(spark, cfg).first()
    assert st["records"] == len(texts) and st["batches"] == 3
    # overlapping input arrives later: a resend of r3 and one new payload
    late = [json.dumps(dict(GOOD, request_id="r3")), json.dumps(dict(GOOD, request_id="r99"))]
    raw_frame(spark, late, start="2025-11-17 06:30:00").select("raw_id", "payload", "received_at") \
        .withColumn("raw_id", F.concat(F.lit("late-"), "raw_id")).write.mode("append").parquet(src)
    q = start_ingest(spark, src, cfg, lambda s: s.read.parquet(reg_path), available_now=True)
    q.awaitTermination()
    assert q.exception() is None
    got = spark.read.parquet(cfg.path("readings"))
    assert got.count() == 21 and got.where("request_id = 'r3'").count() == 1
    log = spark.read.parquet(cfg.path("batches"))
    assert log.agg(F.sum("duplicates")).first()[0] == 2   # in-batch resend + late resend
    assert spark.read.parquet(cfg.path("raw")).count() == len(texts) + 2


def _stream_setup(spark, registry, tmp_path, texts):
    from gridlake.streaming.ingest import StreamConfig
    src, reg = str(tmp_path / "in"), str(tmp_path / "reg")
    raw_frame(spark, texts).select("raw_id", "payload", "received_at").coalesce(1).write.parquet(src)
    registry.write.parquet(reg)
    return src, reg, StreamConfig(sink=str(tmp_path / "sink"), checkpoint=str(tmp_path / "ckpt"))


def _drain(spark, src, reg, cfg):
    from gridlake.streaming.ingest import start_ingest
    q = start_ingest(spark, src, cfg, lambda s: s.read.parquet(reg), available_now=True)
    try:
        q.awaitTermination()
    except Exception:                                   # noqa: BLE001 the planted failure
        return False
    return q.exception() is None


def test_replayed_batch_keeps_its_rows(spark, registry, tmp_path, monkeypatch):
    """A batch that fails after any of its writes gives the same folders when it is replayed."""
    from pyspark.sql import DataFrameWriter
    texts = [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(4)] + ["bad", json.dumps(dict(GOOD, request_id="r1"))]
    src, reg, cfg = _stream_setup(spark, registry, tmp_path, texts)
    real = DataFrameWriter.parquet
    for fail_after in ("raw", "readings", "rejects", "status", "batches"):
        def parquet(self, path, *a, **k):
            real(self, path, *a, **k)
            if f"/sink/{fail_after}/" in path:
                raise RuntimeError("planted")
        monkeypatch.setattr(DataFrameWriter, "parquet", parquet)
        assert not _drain(spark, src, reg, cfg)
        monkeypatch.setattr(DataFrameWriter, "parquet", real)
    assert _drain(spark, src, reg, cfg)
    count = lambda name: spark.read.parquet(cfg.path(name)).count()      # noqa: E731
    assert (count("readings"), count("rejects"), count("status"), count("raw")) == (4, 1, 12, 6)
    assert spark.read.parquet(cfg.path("batches")).agg(F.sum("duplicates")).first()[0] == 1


def test_strict_mode_refuses_before_writing(spark, registry, tmp_path):
    import dataclasses
    src, reg, cfg = _stream_setup(spark, registry, tmp_path, [json.dumps(GOOD), "bad"])
    assert not _drain(spark, src, reg, dataclasses.replace(cfg, strict=True))
    assert not (tmp_path / "sink" / "readings").exists()
    assert _drain(spark, src, reg, cfg)
    assert spark.read.parquet(cfg.path("readings")).count() == 1


def test_resend_a_day_later_is_stored_once(spark, registry, tmp_path):
    src, reg, cfg = _stream_setup(spark, registry, tmp_path, [json.dumps(GOOD)])
    assert _drain(spark, src, reg, cfg)
    raw_frame(spark, [json.dumps(GOOD)], start="2025-11-18 09:00:00").select("raw_id", "payload", "received_at") \
        .withColumn("raw_id", F.lit("resend")).write.mode("append").parquet(src)
    assert _drain(spark, src, reg, cfg)
    assert spark.read.parquet(cfg.path("readings")).count() == 1
    assert spark.read.parquet(cfg.path("status")).where("raw_id = 'resend' and processed").count() == 1


def test_stream_rate_and_dedupe(spark, tmp_path):
    from gridlake.streaming.ingest import dedupe_stream, stream_ingest_rate
    src = str(tmp_path / "in2")
    texts = [json.dumps({"request_id": "a"}), json.dumps({"request_id": "a"}), json.dumps({"request_id": "b"})]
    raw_frame(spark, texts).select("raw_id", "payload", "received_at").write.parquet(src)
    stream = spark.readStream.schema("raw_id string, payload string, received_at timestamp").parquet(src)
    q = dedupe_stream(stream).writeStream.format("memory").queryName("dd").trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.sql("select count(*) c from dd").first()["c"] == 2
    q2 = (stream_ingest_rate(stream, seconds=60).writeStream.format("memory").queryName("rr")
          .outputMode("complete").trigger(availableNow=True).start())
    q2.awaitTermination()
    assert spark.sql("select sum(received) s from rr").first()["s"] == 3

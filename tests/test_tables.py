"""Stored tables: versions and retention under failure, status log, counters, deep pages, listings."""

import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import raw_frame
from gridlake.catalog import READINGS_SCHEMA
from gridlake.operators import lifecycle as L
from gridlake.operators import metrics as M
from gridlake.operators import query as Q
from gridlake.plans.lake import Lake, raw_table, readings_table
from gridlake.plans.normalize import normalize
from gridlake.sources import registry as R
from gridlake.sources.status_log import StatusLog
from gridlake.sources.versions import ConcurrentCommit

GOOD = {"request_id": "g1", "source_id": "current_format", "data": {"f": 50}}


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def made_readings(spark, n, start="2025-11-17 00:00:00", seconds=60, rid="r"):
    """n readings, one every ``seconds``; every third is faulty, every fifth shares its time with the one before."""
    i = F.col("id")
    at = (F.lit(start).cast("timestamp") + F.make_dt_interval(secs=((i - F.when(i % 5 == 4, 1).otherwise(0)) * seconds)
                                                              .cast("decimal(18,6)")))
    values = {"request_id": F.concat(F.lit(rid), F.lpad(i.cast("string"), 6, "0")), "ts": at,
              "device_id": F.concat(F.lit("D"), (i % 7).cast("string")), "alarm_1": F.when(i % 3 == 0, 1).otherwise(0)}
    cols = [values.get(f.name, F.lit(0 if f.dataType.simpleString() in ("double", "bigint") else "x"))
            .cast(f.dataType).alias(f.name) for f in READINGS_SCHEMA.fields]
    return spark.range(n).select(*cols)


# ------------------------------------------------------------------ versions

def test_versions_commits_and_readers(spark, tmp_path):
    table = readings_table(spark, str(tmp_path / "t"))
    assert table.version() == 0 and table.read().count() == 0
    table.append(made_readings(spark, 100))
    early = table.read()
    table.append(made_readings(spark, 50, "2025-11-19 00:00:00", rid="s"))
    assert table.version() == 2 and early.count() == 100 and table.read().count() == 150
    assert table.read(version=1).count() == 100
    with pytest.raises(ConcurrentCommit):
        table.commit([], [], 1)                       # someone has made version 2
    assert sum(p.rows for p in table.parts()) == 150 and all(sum(p.hours) == p.rows for p in table.parts())


def test_time_range_reads_parts_that_can_match(spark, tmp_path):
    table = raw_table(spark, str(tmp_path / "raw"))
    for day in (15, 16, 17):
        table.append(L.land(raw_frame(spark, ["{}"] * 4, f"2025-11-{day} 06:00:00")))
    start, end = datetime(2025, 11, 16, 6, 1, tzinfo=timezone.utc), datetime(2025, 11, 16, 6, 2, tzinfo=timezone.utc)
    df = table.read(start=start, end=end)
    plan = physical(df)
    assert len(df.inputFiles()) == 1
    assert "PartitionFilters: [isnotnull(received_date" in plan and "GreaterThanOrEqual(received_at" in plan
    assert sorted(r["raw_id"] for r in df.collect()) == ["raw-1-0", "raw-2-0"]


def test_time_range_query_prunes(spark):
    from gridlake.plans.queries import QUERIES
    plan = physical(QUERIES["time_range"](spark, "/root/testdata/sf0.001"))
    assert "parseJson" not in plan and "TakeOrderedAndProject" in plan
    assert "PartitionFilters: [isnotnull(received_date" in plan and "GreaterThanOrEqual(received_at" in plan


def test_compaction_and_vacuum(spark, tmp_path):
    table = readings_table(spark, str(tmp_path / "t"))
    for i in range(3):
        table.append(made_readings(spark, 20, rid=f"b{i}-"))
    table.append(made_readings(spark, 5, "2025-12-01 00:00:00", rid="z"))
    before, rows = table.read(), sorted(map(str, table.read().collect()))
    table.compact()
    assert len(table.parts()) == 2 and sorted(map(str, table.read().collect())) == rows
    assert table.compact() == table.version() == 5           # nothing left to do
    assert before.count() == 65
    assert not table.vacuum()                                # too young
    assert len(table.vacuum(least_age_seconds=0)) == 3
    assert sorted(map(str, table.read().collect())) == rows


def test_busy_date_is_split_and_quiet_ones_are_not(spark, tmp_path):
    table = readings_table(spark, str(tmp_path / "t"))
    rows = made_readings(spark, 60_000, "2025-11-01 00:00:00", seconds=1)
    for day in range(2, 8):
        rows = rows.unionByName(made_readings(spark, 30, f"2025-11-{day:02d} 12:00:00", rid=f"q{day}-"))
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        table.append(rows.repartition(16))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = [f.rsplit("/", 2)[1] for f in table.read().inputFiles()]
    assert files.count("ts_date=2025-11-01") > 1
    quiet = [files.count(f"ts_date=2025-11-{d:02d}") for d in range(2, 8)]
    # one file each, but for a date whose rows were dealt to a partition of the busy one
    assert quiet.count(1) >= 4 and len(files) < 16 * 7 / 3
    assert table.read().count() == 60_000 + 180


# ------------------------------------------------------------------ retention under failure

STEPS = ("write", "measure", "create", "rename", "after")


@pytest.mark.parametrize("step", STEPS)
def test_retention_killed_at_any_step_loses_nothing(spark, registry, tmp_path, monkeypatch, step):
    texts = [json.dumps(dict(GOOD, request_id=f"g{i}")) for i in range(4)] + ["{bad"]
    raw = L.land(raw_frame(spark, texts))
    table = raw_table(spark, str(tmp_path / "raw"))
    table.append(raw)
    status = L.current_status(L.landing_status(raw).unionByName(L.outcome_status(normalize(raw, registry).outcomes)))
    cutoff = datetime(2025, 11, 17, 6, 3)
    everything = {f"raw-{i}-0" for i in range(5)}
    kept = {"raw-3-0", "raw-4-0"}

    def stop(*a, **k):
        raise RuntimeError("killed")
    cls, files = type(table), type(table.files)
    if step == "write":
        from pyspark.sql import DataFrameWriter
        monkeypatch.setattr(DataFrameWriter, "parquet", stop)
    elif step == "measure":                     # the new segment is written
        monkeypatch.setattr(cls, "_measure", stop)
    elif step == "create":                      # its parts are known
        monkeypatch.setattr(files, "create", stop)
    elif step == "rename":                      # the manifest's text lies under its hidden name
        def half(self, name, text):
            real(self, name.replace("/", "/.", 1), text)
            stop()
        real = files.create
        monkeypatch.setattr(files, "create", half)
    else:                                       # committed, the caller dies
        def late(self, *a):
            done(self, *a)
            stop()
        done = cls.commit
        monkeypatch.setattr(cls, "commit", late)
    with pytest.raises(RuntimeError):
        L.apply_retention(table, status, cutoff)
    monkeypatch.undo()
    ids = lambda: {r["raw_id"] for r in raw_table(spark, table.root).read().collect()}      # noqa: E731
    assert ids() == (kept if step == "after" else everything)
    L.apply_retention(table, status, cutoff)
    assert ids() == kept
    table.vacuum(least_age_seconds=0)
    assert ids() == kept


# ------------------------------------------------------------------ status log

def test_status_log_needs_no_shuffle_and_compacts(spark, registry, tmp_path):
    raw = L.land(raw_frame(spark, [json.dumps(GOOD), json.dumps({"request_id": "u1", "foo": 1}), "{bad"]))
    log = StatusLog(spark, str(tmp_path / "status"), buckets=4)
    assert log.current().count() == 0
    log.append(L.status_entries(normalize(raw, registry).results))
    for _ in range(3):
        now = log.current()
        entries, _unknown = L.mark(spark.createDataFrame([("raw-2-0",)], "raw_id string"), raw, False, "still bad", now)
        log.append(entries.join(raw.select("raw_id", "received_at"), "raw_id"))
    plan = physical(log.current())
    assert "Exchange" not in plan and plan.count("Scan parquet") == 1 and "Bucketed: true" in plan
    want = sorted(map(str, log.current().collect()))
    assert {r["raw_id"]: r["attempts"] for r in log.current().collect()} == {"raw-0-0": 1, "raw-1-0": 1, "raw-2-0": 4}
    assert {r["raw_id"] for r in log.pending().collect()} == {"raw-1-0", "raw-2-0"}
    assert log.entries().count() == 9
    assert log.compact() == 3 and log.entries().count() == 3
    assert sorted(map(str, log.current().collect())) == want
    assert "Exchange" not in physical(log.current())
    log.vacuum()
    assert sorted(map(str, log.current().collect())) == want and len(log.files.names("versions")) == 1


def test_lifecycle_queries_scan_each_side_once(spark):
    from gridlake.plans.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    for key, scans, parses in (("raw_current_status", 1, 0), ("pending_oldest", 1, 0), ("reprocess", 3, 1)):
        df = QUERIES[key](spark, sf)
        plan = physical(df)
        assert plan.count("FileScan parquet") <= scans + (key == "reprocess"), (key, plan)
        assert optimized(df).count("parseJson(") == parses, key
    assert "Exchange" not in physical(QUERIES["raw_current_status"](spark, sf))


def test_outcomes_parse_once(spark, registry, tmp_path):
    table = raw_table(spark, str(tmp_path / "raw"))
    table.append(L.land(raw_frame(spark, [json.dumps(GOOD), json.dumps(GOOD), "x"])))
    out = normalize(table.read(), registry).outcomes
    assert optimized(out).count("parseJson(") == 1
    keys = [line for line in physical(out).splitlines() if "FileScan" in line and "payload" not in line]
    assert physical(out).count("FileScan parquet") == 2 and len(keys) == 1       # one of them without payloads
    assert {r["raw_id"]: r["outcome"] for r in out.collect()} == {
        "raw-0-0": "reading", "raw-1-0": "duplicate", "raw-2-0": "reject"}


def test_hot_request_id_is_aggregated_before_the_shuffle(spark, registry):
    from gridlake.operators.intake import contested
    rows = spark.range(5000).select(
        F.concat(F.lit("raw-"), F.col("id").cast("string")).alias("raw_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("request_id"),
        F.lit("2025-11-17").cast("timestamp").alias("received_at"))
    got = contested(rows)
    assert [tuple(r) for r in got.collect()] == [("hot", "raw-0")]
    plan = physical(got)
    assert plan.index("functions=[min(") < plan.index("Exchange") < plan.index("functions=[partial_min(")


# ------------------------------------------------------------------ counters

def test_counters_equal_recomputed_numbers_through_a_retry(spark, registry, tmp_path):
    texts = [json.dumps(dict(GOOD, request_id=f"g{i}", data={"f": 1, "fault_code": i % 2})) for i in range(6)]
    texts += [json.dumps(dict(GOOD, request_id="g1")), "{bad", json.dumps({"request_id": "u1", "foo": 3}),
              json.dumps({"request_id": "u2", "foo": 4})]
    lake = Lake(spark, str(tmp_path / "lake"))
    landed = lake.land(raw_frame(spark, texts))
    assert landed == len(texts)
    spec = {"source_id": "foo_dev", "nested_path": "", "rules": [("foo", "fault_code", "int", "", None, False)]}

    def same():
        got = M.ingest_stats(lake.batches()).first().asDict()
        last = lake.results().groupBy("raw_id").agg(F.max_by(F.struct("outcome", "fault", "request_id"), "batch_id").alias("s")) \
            .select("raw_id", "s.*")
        want = L.ingest_stats(last, F.col("fault")).first().asDict()
        assert {k: got[k] for k in ("total_records", "normal_records", "fault_records", "inserted_count")} == \
            {k: want[k] for k in ("total_records", "normal_records", "fault_records", "inserted_count")}
        assert M.raw_stats(lake.batches()).first() == L.raw_stats(lake.status.current()).first()
        assert lake.readings.read().count() == got["total_records"]
        return got
    lake.process(landed, registry)
    first = same()
    assert (first["total_records"], first["failed_count"], first["buffer_size"]) == (6, 4, 0)
    lake.retry(R.create_mapping(spark, registry, spec), 1)
    assert same()["total_records"] == 8
    # rows that have landed and wait for their run
    lake.land(raw_frame(spark, ["{}"] * 3, "2025-11-20 00:00:00").withColumn("raw_id", F.concat(F.lit("n"), "raw_id")))
    M.write_batch(spark, f"{lake.root}/batches", 2, dict.fromkeys(M.COUNTERS, 0) | {"landed": 3})
    assert M.ingest_stats(lake.batches()).first()["buffer_size"] == 3


# ------------------------------------------------------------------ pages and listings

@pytest.fixture(scope="module")
def paged(spark, tmp_path_factory):
    table = readings_table(spark, str(tmp_path_factory.mktemp("paged") / "t"))
    table.append(made_readings(spark, 2000, seconds=97))
    table.append(made_readings(spark, 700, "2025-11-18 10:00:00", seconds=1, rid="busy"))
    rows = sorted(((r["ts"], r["request_id"]) for r in table.read().select("ts", "request_id").collect()),
                  key=lambda r: r[1])
    rows.sort(key=lambda r: r[0], reverse=True)
    return table, [r[1] for r in rows]


@pytest.mark.parametrize("fine", [Q.PAGE_RANGE, 10])
@pytest.mark.parametrize("page,size", [(1, 50), (7, 33), (54, 50), (55, 50), (13, 200), (1, 5000), (9, 300)])
def test_pages_of_a_table(paged, monkeypatch, fine, page, size):
    table, order = paged
    monkeypatch.setattr(Q, "PAGE_RANGE", fine)
    got = [r["request_id"] for r in Q.page_of(table, page, size).collect()]
    assert got == order[(page - 1) * size:page * size]


def test_deep_page_reads_its_range_only(spark, paged):
    table, order = paged
    df = Q.page_of(table, 1200, 2)
    assert [r["request_id"] for r in df.collect()] == order[2398:2400]
    plan = physical(df)
    assert "TakeOrderedAndProject" in plan and "GreaterThanOrEqual(ts" in plan and "LessThanOrEqual(ts" in plan
    one_hour = df._jdf.queryExecution().optimizedPlan().toString()
    skipped = int(one_hour.split("Offset ")[1].split()[0].strip("(),")) if "Offset " in one_hour else 0
    assert skipped < 60


@pytest.mark.parametrize("ranges", [100, 1_000_000, 7])
def test_listing_in_order_without_a_sampling_sort(paged, ranges):
    table, order = paged
    df = Q.in_order(table, Q.is_fault(), ranges)
    assert "rangepartitioning" not in physical(df)
    got = [r["request_id"] for r in df.collect()]
    faulty = {r["request_id"] for r in table.read().where(Q.is_fault()).collect()}
    assert got == [r for r in order if r in faulty] and len(got) > 800
    if ranges == 100:
        sizes = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert max(r["count"] for r in sizes) <= 200 and len(sizes) > 5


# ------------------------------------------------------------------ registry as of a time

def test_registry_as_of(spark, registry):
    spec = {"source_id": "foo_dev", "nested_path": "", "rules": [("foo", "fault_code", "int", "", None, False)]}
    t = [datetime(2025, 11, 17, 6, m, 30, tzinfo=timezone.utc) for m in range(8)]
    reg = R.create_mapping(spark, registry, spec, at=t[0])                                        # from minute 1 on
    reg = R.update_mapping(spark, reg, dict(spec, rules=[("foo", "alarm_1", "int", "", None, False)]), at=t[2])
    reg = R.delete_mapping(spark, reg, "foo_dev", at=t[4])
    reg = R.create_mapping(spark, reg, spec, at=t[5])
    texts = [json.dumps({"request_id": f"r{i}", "foo": 5}) for i in range(8)]
    run = normalize(raw_frame(spark, texts), reg, as_of=True)
    got = {r["request_id"]: (r["fault_code"], r["alarm_1"]) for r in run.readings.collect()}
    assert got == {"r1": (5, 0), "r2": (5, 0), "r3": (0, 5), "r4": (0, 5), "r6": (5, 0), "r7": (5, 0)}
    assert {r["request_id"] for r in run.rejects.collect()} == {"r0", "r5"}
    # each row as by the registry of its time alone
    for i, at in enumerate(t):
        one = raw_frame(spark, texts).where(F.col("raw_id") == f"raw-{i}-0")
        alone = normalize(one, R.as_of(reg, at - timedelta(seconds=30)), plan="rules").readings.collect()
        assert [(r["fault_code"], r["alarm_1"]) for r in alone] == [got[r] for r in [f"r{i}"] if r in got]
    now = normalize(raw_frame(spark, texts), reg).readings
    assert now.count() == 8


def test_unknown_and_hinted_sources_as_of(spark, registry):
    texts = [json.dumps(GOOD), json.dumps({"request_id": "x", "nothing": 1}), "{bad", json.dumps(dict(GOOD))]
    a = normalize(raw_frame(spark, texts), registry, as_of=True)
    b = normalize(raw_frame(spark, texts), registry)
    for name in ("readings", "rejects", "outcomes"):
        assert sorted(map(str, getattr(a, name).collect())) == sorted(map(str, getattr(b, name).collect()))


# ------------------------------------------------------------------ flushes and the keyed stream

def test_numbers_follow_the_order(spark):
    from gridlake.streaming.flush import cut, numbered
    rows = spark.range(1003).select((F.col("id") * 7919 % 1003).alias("a"), (F.col("id") % 3).alias("b"))
    got = numbered(rows, "a", ranges=13).collect()
    assert all(r["number"] == r["a"] for r in got) and len(got) == 1003
    sizes = [r["count"] for r in cut(rows, 100, "a").groupBy("flush").count().orderBy("flush").collect()]
    assert sizes == [100] * 10 + [3]
    many = spark.range(30_000).select((F.col("id") * 7919 % 30_000).alias("a"))        # more rows than are sampled
    assert numbered(many, "a", ranges=8).where("number <> a").count() == 0
    assert cut(rows.limit(0), 10, "a").count() == 0
    with pytest.raises(ValueError):
        cut(rows, 0, "a")


def test_flushes_are_committed_alone_and_keep_their_cuts(spark, registry, tmp_path, monkeypatch):
    from gridlake.streaming import ingest as S
    texts = [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(25)] + ["bad", json.dumps(dict(GOOD, request_id="r3"))]
    src, reg = str(tmp_path / "in"), str(tmp_path / "reg")
    raw_frame(spark, texts).select("raw_id", "payload", "received_at").repartition(4).write.parquet(src)
    registry.write.parquet(reg)
    cfg = S.StreamConfig(sink=str(tmp_path / "sink"), checkpoint=str(tmp_path / "ckpt"), batch_size=10)

    def run():
        q = S.start_ingest(spark, src, cfg, lambda s: s.read.parquet(reg), available_now=True)
        try:
            q.awaitTermination()
        except Exception:                                   # noqa: BLE001 the planted failure
            return False
        return q.exception() is None
    real, written = S._write_flush, []

    def stops_in_flush_1(spark_, cfg_, results, batch_id, flush, n):
        if flush == 1:
            raise RuntimeError("planted")
        written.append(flush)
        real(spark_, cfg_, results, batch_id, flush, n)
    monkeypatch.setattr(S, "_write_flush", stops_in_flush_1)
    assert not run()
    first = sorted(r["request_id"] for r in spark.read.parquet(cfg.path("readings")).collect())
    assert len(first) == 10 and S.batches(spark, cfg).count() == 1            # flush 0 is there
    monkeypatch.setattr(S, "_write_flush", lambda *a: (written.append(a[4]), real(*a)))
    assert run() and written == [0, 1, 2]                                    # and is not written again
    got = spark.read.parquet(cfg.path("readings"))
    assert sorted(r["request_id"] for r in got.where("flush = 0").collect()) == first
    log = {r["flush"]: (r["landed"], r["readings"], r["rejects"], r["duplicates"]) for r in S.batches(spark, cfg).collect()}
    assert log == {0: (10, 10, 0, 0), 1: (10, 10, 0, 0), 2: (7, 5, 1, 1)}
    with pytest.raises(ValueError):
        S.StreamConfig(sink="x", checkpoint="y", batch_size=10_001)


def test_stream_knows_ids_by_state_alone(spark, registry, tmp_path):
    """Many batches, resends a day later, a restart; what is stored is not read again."""
    from gridlake.streaming import ingest as S
    base = raw_frame(spark, [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(6)])
    days = [base.withColumn("received_at", F.col("received_at") + F.make_dt_interval(days=F.lit(d)))
            .withColumn("raw_id", F.concat(F.lit(f"d{d}-"), "raw_id")) for d in range(3)]
    out = S.drain(spark, days, registry)
    assert out.readings().count() == 6
    log = sorted((r["batch_id"], r["readings"], r["duplicates"]) for r in out.batches().collect())
    assert log == [(0, 6, 0), (1, 0, 6), (2, 0, 6)]
    query = S.start_ingest(spark, f"{out.cfg.sink[:-5]}/input", out.cfg, lambda s: registry, available_now=True)
    query.awaitTermination()
    stream = spark.readStream.schema(S.RAW_INPUT_SCHEMA).parquet(f"{out.cfg.sink[:-5]}/input")
    plan = S.with_new_ids(stream)._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate [request_id" in plan


def test_published_batches_are_compacted_and_added_once(spark, registry, tmp_path, monkeypatch):
    from gridlake.streaming import ingest as S
    base = raw_frame(spark, [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(5)] + ["bad"])
    out = S.drain(spark, [base, base.withColumn("raw_id", F.concat(F.lit("again-"), "raw_id"))], registry)
    lake = Lake(spark, str(tmp_path / "lake"))
    real = type(lake.raw).append

    def dies(self, df, note=None):
        if self.date == "received_date":
            raise RuntimeError("planted")
        return real(self, df, note)
    monkeypatch.setattr(type(lake.raw), "append", dies)
    with pytest.raises(RuntimeError):                      # readings are in, raw rows are not
        S.publish(spark, out.cfg, lake)
    monkeypatch.undo()
    for _ in range(2):
        assert S.publish(spark, out.cfg, lake) == 1
        assert (lake.raw.read().count(), lake.readings.read().count()) == (12, 5)
        assert lake.raw.note() == lake.readings.note() == {"through": 1}
        # the invalid text and its copy have ids of their own: both wait
        assert sorted(r["raw_id"] for r in lake.status.pending().collect()) == ["again-raw-5-0", "raw-5-0"]
    assert len(lake.readings.parts()) == 1                 # one date, one part


def test_a_later_batch_knows_settled_ids(spark, registry, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    first = raw_frame(spark, [json.dumps(dict(GOOD, request_id=f"r{i}")) for i in range(4)])
    again = raw_frame(spark, [json.dumps(dict(GOOD, request_id=r)) for r in ("r1", "n1", "n1", "r3")], "2025-11-19 00:00:00") \
        .withColumn("raw_id", F.concat(F.lit("b-"), "raw_id"))
    lake.process(lake.land(first), registry, 0)
    n = lake.land(again)
    for _ in range(2):                                     # the second time replaces the batch's results
        lake.process(n, registry, 1, lake.raw.read(start=datetime(2025, 11, 19)))
        got = {r["raw_id"]: r["outcome"] for r in lake.results().where("batch_id = 1").collect()}
        assert lake.readings.read().count() == 5
        assert got == {"b-raw-0-0": "duplicate", "b-raw-1-0": "reading", "b-raw-2-0": "duplicate", "b-raw-3-0": "duplicate"}
    totals = M.ingest_stats(lake.batches()).first()
    assert (totals["total_records"], totals["failed_count"], totals["buffer_size"]) == (5, 3, 0)

"""Plan shape: the properties the engine relies on at scale."""

import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from conftest import raw_frame
from gridlake.operators import query as Q
from gridlake.operators.detect import detect, detect_by_join
from gridlake.plans.normalize import normalize
from gridlake.sources.registry import compile_registry
from gridlake.sources.sinks import write_readings


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


PAYLOADS = [
    {"request_id": "a", "device_type": "Inv", "data": {"serialno": "S", "totaloutputpower": 1000}},
    {"request_id": "b", "data": {"sno": "S", "p": 1, "e": 2, "te": 3, "pv1v": 4, "pv1c": 5, "gvr": 6,
                                 "gvs": 7, "gvt": 8, "itmp": 9}},
    {"request_id": "c", "data": {"s1v": 1, "total_output_power": 2, "f": 3}},
    {"request_id": "d", "foo": 1},
    {"request_id": "e", "source_id": "current_format", "data": {}},
]


def test_dedupe_is_partial_before_shuffle(spark, registry):
    n = normalize(raw_frame(spark, [json.dumps(p) for p in PAYLOADS]), registry)
    plan = physical(n.firsts)
    assert plan.count("WindowGroupLimit") == 2
    # the partial limit sits below the exchange
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")


def test_payload_parsed_once(spark, registry):
    n = normalize(raw_frame(spark, [json.dumps(p) for p in PAYLOADS]), registry)
    for df in (n.readings, n.rejects.where(F.col("error") != ""), n.detected.where("source_id = 'Inv'")):
        plan = optimized(df)
        assert plan.count("parseJson(") == 1, plan.count("parseJson(")


def test_mapping_not_reinlined_into_filters(spark, registry):
    n = normalize(raw_frame(spark, [json.dumps(p) for p in PAYLOADS]), registry)
    base = len(optimized(n.readings))
    filtered = n.readings.where(Q.is_fault() & (F.col("device_type") == "Inv"))
    assert len(optimized(filtered)) < base * 1.2


def test_detect_plans_agree(spark, registry):
    n = normalize(raw_frame(spark, [json.dumps(p) for p in PAYLOADS]), registry)
    a = {r["request_id"]: r["source_id"] for r in detect(n.firsts, compile_registry(registry)).collect()}
    b = {r["request_id"]: r["source_id"] for r in detect_by_join(n.firsts, registry).collect()}
    assert a == b == {"a": "Inv", "b": "Inv_short", "c": "current_format", "d": None, "e": "current_format"}


def test_readings_scan_prunes_and_pushes(spark, registry, tmp_path):
    n = normalize(raw_frame(spark, [json.dumps(dict(PAYLOADS[2], request_id=f"r{i}")) for i in range(5)]),
                  registry)
    path = str(tmp_path / "readings")
    write_readings(n.readings, path)
    stored = spark.read.parquet(path)
    flt = Q.RecordFilter(device_id="unknown", start=datetime(2025, 11, 17, tzinfo=timezone.utc),
                         end=datetime(2025, 11, 17, 23, tzinfo=timezone.utc), limit=3)
    df = Q.query_records(stored, flt)
    plan = physical(df)
    pushed = plan[plan.index("PushedFilters: ["):]
    assert "EqualTo(device_id,unknown)" in pushed and "GreaterThanOrEqual(ts," in pushed
    assert "PartitionFilters: [isnotnull(ts_date" in plan
    assert "TakeOrderedAndProject" in plan
    assert df.count() == 3


def test_fault_dim_broadcast_and_latest_per_code_partial(spark, registry):
    n = normalize(raw_frame(spark, [json.dumps(dict(PAYLOADS[2], request_id=f"r{i}", source_id="current_format",
                                                    data={"fault_code": i % 3})) for i in range(9)]),
                  registry)
    assert "BroadcastHashJoin" in physical(Q.fault_stats(spark, n.readings))
    plan = physical(Q.latest_per_code(n.readings, 2))
    assert plan.index("Exchange") < plan.rindex("WindowGroupLimit")
    got = Q.latest_per_code(n.readings, 2).groupBy("fault_code").count().collect()
    assert sorted(r["count"] for r in got) == [2, 2]


def test_sql_views_and_show_tables(spark, registry):
    n = normalize(raw_frame(spark, [json.dumps(p) for p in PAYLOADS]), registry)
    names = Q.register_views(spark, {"inverter_data": n.readings, "rejects_view": n.rejects})
    got = {r["tableName"] for r in Q.list_tables(spark, names).collect()}
    assert got == {"inverter_data", "rejects_view"}
    row = Q.sql(spark, "SELECT count(*) AS c, max(time) AS t FROM inverter_data").first()
    assert row["c"] == 4 and row["t"] is not None     # a, b, c, e map; d is unknown


def test_document_omits_empty_fields_p24(spark):
    from gridlake.operators.expected import to_document
    df = spark.createDataFrame([("a", 0.0, 5, "")], "id string, p double, n bigint, s string")
    doc = json.loads(to_document(df, ["id", "p", "n", "s"]).first()["document"])
    assert doc == {"id": "a", "n": 5}


def test_device_local_time_p25(spark):
    from gridlake.functions.timefn import device_local_time
    row = spark.range(1).select(
        device_local_time(F.lit("17/11/2025"), F.lit("06:45:00"), F.lit("Asia/Kolkata"))
        .cast("timestamp_ntz").alias("t")).first()
    assert row["t"] == datetime(2025, 11, 17, 1, 15)


def test_rule_array_plan_matches_compiled(spark, registry):
    from test_golden import LEGACY, LONG_KEY
    texts = [json.dumps(p) for p in PAYLOADS + [LONG_KEY, LEGACY]] + ["[1]", "{bad"]
    raw = raw_frame(spark, texts)
    a = normalize(raw, registry, plan="compiled")
    b = normalize(raw, registry, plan="rules")
    for name in ("readings", "rejects"):
        x, y = getattr(a, name), getattr(b, name)
        assert x.count() == y.count() and x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_auto_plan_switches_on_registry_size(spark):
    from gridlake.sources.registry import registry_frame
    specs = [{"source_id": f"s{i:02d}", "nested_path": "", "rules": [(f"k{i}", "slave_id", "string", "", None, False)]}
             for i in range(12)]
    n = normalize(raw_frame(spark, [json.dumps({"k7": "x"})]), registry_frame(spark, specs))
    assert n.plan == "rules"
    r = n.readings.first()
    assert r["device_type"] == "s07" and r["slave_id"] == "x"


def test_spread_only_touches_small_inputs(spark):
    from gridlake.operators.common import spread
    many = spark.range(0, 1000, numPartitions=64)
    assert spread(many, 16) is many                      # enough splits: no shuffle added
    one = spark.range(0, 1000, numPartitions=1)
    assert spread(one, 16).rdd.getNumPartitions() == 16


def test_points_roundtrip_absent_fields_s5_s6(spark):
    from gridlake.sources.sinks import from_points, tag_set, to_points
    pts = spark.createDataFrame(
        [("r1", {"device_id": "D1", "source": "solar_monitoring"}, (5.5, 2), datetime(2025, 1, 1))],
        "request_id string, tags map<string,string>, fields struct<total_output_power:double, alarm_1:bigint>, "
        "time timestamp")
    back = from_points(pts).first()
    assert back["device_id"] == "D1" and back["device_name"] == "" and back["signal_strength"] == ""
    assert back["total_output_power"] == 5.5 and back["alarm_1"] == 2
    assert back["inverter_temp"] == 0.0 and back["fault_code"] == 0 and back["serial_no"] == ""
    n = normalize(raw_frame(spark, [json.dumps(PAYLOADS[0])]), __import__("gridlake.sources.registry",
                  fromlist=["x"]).seed_registry(spark))
    p = to_points(n.readings).select(tag_set(F.col("tags")).alias("t"), "measurement").first()
    assert p["measurement"] == "inverter_data"
    assert p["t"] == "device_id=unknown,device_name=unknown,device_type=Inv,source=solar_monitoring"


def test_payload_parsed_once_through_land(spark, registry):
    from gridlake.operators.lifecycle import land
    raw = land(raw_frame(spark, [json.dumps(p) for p in PAYLOADS]), keep_parsed=True)
    assert optimized(normalize(raw, registry).readings).count("parseJson") <= 1


def test_both_plans_agree_on_conflicting_rules(spark):
    """Mixed types, unreadable later rules, JSON null defaults and odd key names."""
    from gridlake.sources.registry import registry_frame
    conflicts = [("alarm1", "alarm_1", "int", "", None, False), ("alarm1", "alarm_1", "string", "", None, False),
                 ("p", "power", "float", "", None, False), ("txt", "total_output_power", "string", "", None, False),
                 ("a'b", "serial_no", "string", "", None, False), ('q"r', "model_no", "string", "", None, False),
                 ("t", "temperature", "float", "", None, True)]
    texts = [json.dumps(p) for p in (
        {"request_id": "1", "source_id": "s00", "alarm1": 3, "p": 3, "txt": "no number", "a'b": "x", 'q"r': "y", "t": 1},
        {"request_id": "2", "source_id": "s00", "p": 5, "t": 2}, {"request_id": "3", "source_id": "s00", "p": 5},
        {"request_id": "4", "source_id": "s01", "alarm1": 1, "t": None})]
    for n in (2, 9):
        specs = [{"source_id": f"s{i:02d}", "nested_path": "", "rules": conflicts} for i in range(n)]
        reg = registry_frame(spark, specs)
        got = []
        for plan in ("compiled", "rules"):
            run = normalize(raw_frame(spark, texts), reg, plan=plan)
            got.append((sorted(map(str, run.readings.collect())), sorted(map(str, run.rejects.collect()))))
        assert got[0] == got[1]
        assert len(got[0][0]) + len(got[0][1]) == 4


def test_read_queries_prune_the_stored_table(spark):
    from gridlake.plans.queries import QUERIES
    plan = physical(QUERIES["records_filter"](spark, "/root/testdata/sf0.001"))
    assert "parseJson" not in plan and "Window" not in plan
    assert "PartitionFilters: [isnotnull(ts_date" in plan and "EqualTo(device_id,INV-0042)" in plan
    power = physical(QUERIES["device_power"](spark, "/root/testdata/sf0.001"))
    schema = power[power.index("ReadSchema"):]
    assert "serial_no" not in schema and "total_output_power" in schema


def test_reconcile_finds_rows_missing_from_the_store(spark, registry):
    from gridlake.operators import lifecycle as L
    raw = L.land(raw_frame(spark, [json.dumps(dict(PAYLOADS[4], request_id=f"q{i}")) for i in range(4)]))
    n = normalize(raw, registry)
    r = L.reconcile(n.outcomes, n.readings.where("request_id <> 'q2'")).first()
    assert (r["inserted_count"], r["total_records"], r["discrepancy"], r["missing"]) == (4, 3, 1, 1)

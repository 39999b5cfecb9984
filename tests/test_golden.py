"""Golden tests: the reference's sample payloads and the decisions of SURVEY §1.5."""

import json
from datetime import datetime, timezone

import pytest

from conftest import raw_frame
from gridlake.plans.normalize import normalize
from gridlake.sources.registry import compile_specs

LONG_KEY = {
    "device_type": "Inv", "device_name": "Inverter-01", "device_id": "INV001",
    "date": "17/11/2025", "time": "06:45:00", "time_zone": "Asia/Kolkata",
    "latitude": "12.97", "longitude": "77.59", "software_ver": "1.0",
    "signal_strength": "-67", "loginterval": "300", "battery_status": "1", "valid": True,
    "data": {"slaveid": "1", "serialno": "SN123456", "modelname": "EHU10K-ET",
             "totaloutputpower": 5432000, "todaye": 45000000, "totale": 1100000000,
             "pv1voltage": 45640, "pv1current": 36000, "pv2voltage": 50500, "pv2current": 38000,
             "pv3voltage": 0, "pv3current": 0, "pv4voltage": 0, "pv4current": 0,
             "gridvoltager": 23000, "gridvoltages": 23500, "gridvoltaget": 24000,
             "gridcurrentr": 4500, "gridcurrents": 4700, "gridcurrentt": 4600,
             "invertertemp": 530, "frequency": 500000, "alarm1": 0, "alarm2": 0, "alarm3": 0},
}
LEGACY = {"device_id": "INV-777", "device_name": "Legacy", "device_timestamp": "2025-11-17T06:45:00Z",
          "data": {"serial_no": "SN-777", "s1v": 352, "total_output_power": 5200, "f": 50,
                   "today_e": 21, "total_e": 3412, "inv_temp": 42, "fault_code": 0}}


def run(spark, registry, payloads, **kw):
    texts = [p if isinstance(p, str) else json.dumps(p) for p in payloads]
    return normalize(raw_frame(spark, texts), registry, **kw)


def one(df):
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0].asDict()


def test_long_key_sample(spark, registry):
    r = one(run(spark, registry, [LONG_KEY]).readings)
    assert r["device_type"] == "Inv" and r["serial_no"] == "SN123456"
    assert r["total_output_power"] == 5432.0 and r["today_e"] == 45000.0 and r["total_e"] == 1100000.0
    assert r["pv1_voltage"] == 456.4          # true division (Q13)
    assert r["pv1_current"] == 360.0 and r["pv2_voltage"] == 505.0 and r["pv2_current"] == 380.0
    assert (r["grid_voltage_r"], r["grid_voltage_s"], r["grid_voltage_t"]) == (230.0, 235.0, 240.0)
    assert (r["grid_current_r"], r["grid_current_s"], r["grid_current_t"]) == (4.5, 4.7, 4.6)
    assert r["inverter_temp"] == 53.0 and r["frequency"] == 500.0
    assert r["signal_strength"] == "-67" and r["slave_id"] == "1" and r["model_name"] == "EHU10K-ET"
    # no device_timestamp: event time is the receive time (Q25)
    assert r["ts"] == datetime(2025, 11, 17, 6, 0)


def test_legacy_by_signature(spark, registry):
    r = one(run(spark, registry, [LEGACY]).readings)
    assert r["device_type"] == "current_format"
    assert r["serial_no"] == "SN-777" and r["pv1_voltage"] == 352.0
    assert r["total_output_power"] == 5200.0 and r["frequency"] == 50.0
    assert r["today_e"] == 21.0 and r["total_e"] == 3412.0 and r["inverter_temp"] == 42.0
    assert r["ts"] == datetime(2025, 11, 17, 6, 45)


def test_short_key_layout_and_q11(spark, registry):
    p = {"request_id": "s1", "data": {"sno": "X", "model": "M", "p": 1000, "e": 250, "te": 9000,
                                      "pv1v": 3000, "gvr": 2300, "itmp": 450, "fr": 5000, "al1": 2}}
    r = one(run(spark, registry, [p]).readings)
    assert r["device_type"] == "Inv_short" and r["model_name"] == "M"
    assert r["total_output_power"] == 1000 * 0.001
    assert r["today_e"] == 250 * 0.01 and r["total_e"] == 9000 * 0.01   # e = today, te = total
    assert r["alarm_1"] == 2


def test_required_field_enforced_q2(spark, registry):
    p = dict(LONG_KEY, data={k: v for k, v in LONG_KEY["data"].items() if k != "serialno"})
    n = run(spark, registry, [p])
    assert n.readings.count() == 0
    assert one(n.rejects)["error"] == "required field missing: serialno"


def test_invalid_and_non_object_rejected(spark, registry):
    n = run(spark, registry, ['{"a": ', "[1,2]", "null", '"text"', "12"])
    errs = [r["error"] for r in n.rejects.collect()]
    assert errs == ["invalid JSON"] * 5


def test_unknown_source_and_default_source_q3(spark, registry):
    p = {"request_id": "u1", "foo": 1}
    assert one(run(spark, registry, [p]).rejects)["error"] == "unknown data source"
    # live rule: fall back to Inv, whose required serialno is then missing
    n = run(spark, registry, [p], default_source="Inv")
    assert one(n.detected.select("source_id"))["source_id"] == "Inv"


def test_hint_precedence_source_id_over_device_type(spark, registry):
    p = dict(LEGACY, source_id="current_format", device_type="Inv")
    assert one(run(spark, registry, [p]).readings)["device_type"] == "current_format"
    p2 = dict(LEGACY, source_id="nope", device_type="current_format")
    assert one(run(spark, registry, [p2]).readings)["device_type"] == "current_format"


def test_signature_tie_smallest_id_q20(spark):
    specs = [{"source_id": sid, "nested_path": "", "rules": [("a", "slave_id", "string", "", None, False)]}
             for sid in ("zeta", "alpha")]
    n = normalize(raw_frame(spark, [json.dumps({"a": "1"})]), mappings=compile_specs(specs))
    assert one(n.readings)["device_type"] == "alpha"


def test_root_fallback_and_json_null(spark, registry):
    p = {"request_id": "n1", "source_id": "current_format", "inv_temp": 7,
         "data": {"s1v": None, "total_output_power": "123.5", "serial_no": None}}
    r = one(run(spark, registry, [p]).readings)
    assert r["inverter_temp"] == 7.0            # found at root (P1)
    assert r["pv1_voltage"] == 0.0              # JSON null is present: no default, converts to 0
    assert r["total_output_power"] == 123.5     # numeric string parsed (Q16)
    assert r["serial_no"] == ""                 # present null string -> "" (Q18), not the default
    assert r["device_id"] == "unknown"


def test_defaults_stored_as_is_q19(spark, registry):
    p = {"request_id": "d1", "source_id": "current_format", "data": {"f": 50}}
    r = one(run(spark, registry, [p]).readings)
    assert r["serial_no"] == "UNKNOWN" and r["total_output_power"] == 0.0


def test_transforms_q1_q15(spark):
    spec = {"source_id": "t", "nested_path": "", "rules": [
        ("x", "total_output_power", "float", "add:2.5", None, False),
        ("y", "total_e", "float", "subtract:1", None, False),
        ("z", "today_e", "float", "divide:0", None, False),
        ("w", "pv1_voltage", "float", "bogus:3", None, False),
        ("u", "pv2_voltage", "int", "multiply:0.5", None, False)]}
    text = json.dumps({"x": 0, "y": 10, "z": 7, "w": 4, "u": 3})
    r = one(normalize(raw_frame(spark, [text]), mappings=compile_specs([spec])).readings)
    assert r["total_output_power"] == 2.5       # add on 0 computed (Q15)
    assert r["total_e"] == 9.0
    assert r["today_e"] == 7.0                  # divide by 0 leaves the value
    assert r["pv1_voltage"] == 4.0              # unknown op leaves the value
    assert r["pv2_voltage"] == 1.5              # int keeps the fraction by default (Q14)
    r2 = one(normalize(raw_frame(spark, [text]), mappings=compile_specs([spec]),
                       int_mode="truncate").readings)
    assert r2["pv2_voltage"] == 1.0


def test_bool_and_string_conversions_q17_q18(spark):
    spec = {"source_id": "c", "nested_path": "", "rules": [
        ("b", "total_output_power", "float", "", None, False),
        ("n", "serial_no", "string", "", None, False),
        ("s", "model_name", "string", "", None, False)]}
    text = json.dumps({"b": True, "n": 1234567, "s": 1.5})
    r = one(normalize(raw_frame(spark, [text]), mappings=compile_specs([spec])).readings)
    assert r["total_output_power"] == 0.0       # bool -> number is 0
    assert r["serial_no"] == "1234567"          # plain decimal text, not 1.234567e+06
    assert r["model_name"] == "1.5"


def test_duplicates_first_by_receive_time(spark, registry):
    n = run(spark, registry, [LEGACY, LEGACY | {"request_id": "x"}, LEGACY])
    ids = sorted((r["request_id"], r["raw_id"]) for r in n.readings.collect())
    # the two payloads without a request id get their raw id (P20): all three differ
    assert len(ids) == 3
    p = dict(LEGACY, request_id="same")
    n2 = run(spark, registry, [p, p, p])
    r = one(n2.readings)
    assert r["raw_id"] == "raw-0-0"
    assert n2.duplicates.count() == 2


def test_accounting_invariant(spark, registry):
    texts = [LONG_KEY, LEGACY, dict(LEGACY, request_id="r"), dict(LEGACY, request_id="r"),
             "{bad", {"foo": 1}]
    n = run(spark, registry, texts)
    total = n.readings.count() + n.rejects.count() + n.duplicates.count()
    assert total == len(texts)
    assert n.outcomes.count() == len(texts)


@pytest.mark.parametrize("text,ok", [
    ("2025-11-17T06:45:00Z", True), ("2025-11-17T06:45:00.5Z", True),
    ("2025-11-17T06:45:00.123456+05:30", True), ("2025-11-17T06:45:00.123456789Z", True),
    ("2025-11-17", False), ("2025-11-17 06:45:00Z", False), ("junk", False)])
def test_rfc3339(spark, text, ok):
    from pyspark.sql import functions as F
    from gridlake.functions.timefn import parse_rfc3339
    v = spark.range(1).select(parse_rfc3339(F.lit(text)).alias("t")).first()["t"]
    assert (v is not None) == ok


def test_rfc3339_offset_value(spark):
    from pyspark.sql import functions as F
    from gridlake.functions.timefn import parse_rfc3339
    v = spark.range(1).select(parse_rfc3339(F.lit("2025-11-17T06:45:00+05:30"))
                              .cast("timestamp_ntz").alias("t")).first()["t"]
    assert v == datetime(2025, 11, 17, 1, 15)


def test_fault_predicates_q4_q6(spark, registry):
    from gridlake.operators import query as Q
    a = dict(LEGACY, request_id="a", data=dict(LEGACY["data"], fault_code=3))
    b = dict(LEGACY, request_id="b")
    r = run(spark, registry, [a, b]).readings
    assert [x["request_id"] for x in r.where(Q.is_fault()).collect()] == ["a"]
    assert [x["request_id"] for x in r.where(Q.is_normal()).collect()] == ["b"]
    flt = Q.RecordFilter(fault_code=5)
    assert Q.count_records(r, flt).first()["total"] == 1
    assert Q.count_records(r, Q.RecordFilter(fault_code=-1)).first()["total"] == 0


def test_record_filter_params_f4():
    from gridlake.operators.query import RecordFilter
    f = RecordFilter.from_params({"limit": "-3", "offset": "x", "fault_code": "z",
                                  "start_time": "bad", "device_id": "D"})
    assert (f.limit, f.offset, f.fault_code, f.start, f.device_id) == (100, 0, None, None, "D")
    g = RecordFilter.from_params({"limit": "5", "offset": "2", "start_time": "2025-01-01T00:00:00Z"})
    assert (g.limit, g.offset) == (5, 2) and g.start == datetime(2025, 1, 1, tzinfo=timezone.utc)


def test_expected_format_p22(spark):
    from pyspark.sql import functions as F
    from gridlake.operators.expected import expected_format
    texts = [json.dumps({"device_type": "Inv", "request_id": "e1", "latitude": 5,
                         "data": {"p": "12abc", "sno": 7, "al1": "3x", "itmp": None}}),
             json.dumps({"device_type": "Inv"})]
    df = raw_frame(spark, texts).select("raw_id", F.try_parse_json("payload").alias("v"))
    rows = {r["raw_id"]: r for r in expected_format(df, keep=["raw_id"]).collect()}
    r = rows["raw-0-0"]
    assert r["latitude"] == "0"                 # non-string counts as absent
    assert r["total_output_power"] == 12.0      # leading numeric prefix
    assert r["serial_no"] == ""                 # strings only from strings
    assert r["alarm_1"] == 3 and r["inverter_temp"] == 0.0 and r["valid"] is True
    assert rows["raw-1-0"]["error"] == "no data object found in payload"


def test_short_key_rename_p15(spark):
    from pyspark.sql import functions as F
    from gridlake.functions.keys import rename_short_keys
    m = F.create_map(F.lit("power"), F.lit(1), F.lit("today_energy"), F.lit(2), F.lit("other"), F.lit(3))
    keys = spark.range(1).select(F.array_sort(F.map_keys(rename_short_keys(m))).alias("k")).first()["k"]
    assert keys == ["e", "other", "p"]

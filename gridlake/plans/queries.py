"""Driver queries: one per operator group of SURVEY §7.5.

Each function takes ``(spark, sf_dir)``, derives the telemetry payloads from
the ``events`` table of that folder (``sources.payloads``) and runs the real
engine over all of them.  Timestamps leave as ``timestamp_ntz`` (UTC wall
clock) so they compare with plain SQL timestamps.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import DETAIL_COLUMNS, READING_COLUMNS, RETRY_BATCH, SAMPLE_MAPPING, SEED_MAPPINGS
from ..functions.keys import payload_keys, rename_short_keys
from ..functions.timefn import device_local_time, event_time
from ..functions.transform import scale
from ..functions.variant import (as_object, convert, get_float, get_int, get_string,
                                 get_string_strict, string_if_string)
from ..operators import expected as X
from ..operators import lifecycle as L
from ..operators import query as Q
from ..operators.detect import detect, detect_by_join
from ..operators.intake import vget
from ..operators.mapping import preview
from ..functions.memo import memo
from ..operators import metrics as M
from ..session import prepare, scratch_path
from ..sources import registry as R
from ..sources.files import Files
from ..sources.payloads import mixed_rows, payload_rows, payloads
from ..sources.sinks import from_points, tag_set, to_points
from .lake import Lake, raw_table
from .normalize import Normalized, normalize
from .reprocess import reprocess

UTC = timezone.utc

# Parameters of the listing queries (fixed so Spark and the oracle agree).
FILTER_DEVICE = "INV-0042"
FILTER_START = datetime(2024, 1, 3, tzinfo=UTC)
FILTER_END = datetime(2024, 1, 25, 23, 59, 59, tzinfo=UTC)
FILTER_OFFSET, FILTER_LIMIT = 5, 20
PAGE_NO, PAGE_SIZE = 3, 50
DEEP_PAGE, DEEP_SIZE = 100, 7
FLUSH_SIZE = 2500
LATEST_N = 10
RANGE_START = datetime(2024, 1, 10, tzinfo=UTC)
RANGE_END = datetime(2024, 1, 12, tzinfo=UTC)
RANGE_LIMIT = 100
RETENTION_CUTOFF = datetime(2024, 1, 15, tzinfo=UTC)
TRANSFORMS = {"multiply": "multiply:2.5", "divide": "divide:8", "add": "add:1.5",
              "subtract": "subtract:0.25"}


def ntz(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("timestamp_ntz")


def out_ts(df: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        df = df.withColumn(c, ntz(c))
    return df


# ------------------------------------------------------------------ shared inputs

def stored_registry(spark: SparkSession, name: str, build) -> DataFrame:
    """A registry as a stored table, written once per application (configuration, not data)."""
    def write():
        path = scratch_path(spark, name)
        build().coalesce(1).write.parquet(path)
        return path
    return spark.read.parquet(memo(("registry at", name), write))


def registry(spark: SparkSession) -> DataFrame:
    return stored_registry(spark, "registry", lambda: R.seed_registry(spark))


def ingest(spark: SparkSession, sf_dir: str, **kw) -> Normalized:
    prepare(spark)
    raw = L.land(payloads(spark, sf_dir), keep_parsed=True)
    return normalize(raw, registry(spark), **kw)


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(spark, sf_dir).readings


def input_state(spark: SparkSession, sf_dir: str) -> tuple:
    """The input's path and the times of its files' last changes."""
    source = f"{sf_dir.rstrip('/')}/events.parquet"
    files = Files(spark, source)
    names = files.names("")
    return source, tuple((n, files.modified(n if len(names) > 1 or n != source.rsplit("/", 1)[1] else ""))
                         for n in sorted(names))


def lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The stored tables of one ingest of the input, written once per application and state of its files.

    Landing, normalisation, status entries and counters run once; the queries
    over stored tables then read those, as they would on a running service.
    """
    prepare(spark)

    def build():
        made = Lake(spark, scratch_path(spark, "lake"))
        landed = made.land(payloads(spark, sf_dir))
        made.process(landed, registry(spark))
        return made.root
    return Lake(spark, memo(("lake", *input_state(spark, sf_dir)), build))


def stored_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored readings: date folders, sorted by device and time."""
    return lake(spark, sf_dir).readings.read()


# ------------------------------------------------------------------ normalisation

def q_normalize_canonical(spark, sf):
    return out_ts(readings(spark, sf).select(*READING_COLUMNS), "ts")


def q_normalize_rule_plan(spark, sf):
    """The same readings through the rule-array plan used for large registries."""
    return out_ts(ingest(spark, sf, plan="rules").readings.select(*READING_COLUMNS), "ts")


def q_detect_source(spark, sf):
    n = ingest(spark, sf)
    return n.detected.groupBy("source_id").agg(F.count("*").alias("n"))


def q_detect_default_source(spark, sf):
    n = ingest(spark, sf, default_source="Inv")
    return n.detected.groupBy("source_id").agg(F.count("*").alias("n"))


def q_detect_rule_join(spark, sf):
    n = ingest(spark, sf)
    det = detect_by_join(n.firsts, registry(spark))
    return det.groupBy("source_id").agg(F.count("*").alias("n"))


def q_rejects(spark, sf):
    return ingest(spark, sf).rejects.select("raw_id", "request_id", "error")


def q_root_fallback_defaults(spark, sf):
    return readings(spark, sf).select("request_id", "serial_no", "inverter_temp", "pv1_voltage")


def _convert_query(data_type: str):
    def q(spark, sf):
        df = ingest(spark, sf).firsts
        v = F.col("v")
        # of every payload; null where it has no such key
        cols = {"power": ("data", "total_output_power"), "s1v": ("data", "s1v"),
                "fault": ("data", "fault_code"), "serial": ("data", "serial_no")}
        out = [F.col("request_id")]
        for name, keys in cols.items():
            x = vget(v, *keys)
            out.append(F.when(x.isNotNull(), convert(x, data_type)).alias(name))
        return df.select(*out)
    return q


def _transform_query(op: str):
    spec = {"source_id": f"t_{op}", "nested_path": "data",
            "rules": [("p", "value", "float", TRANSFORMS[op], None, False),
                      ("p", "zero_divisor", "float", "divide:0", None, False) if op == "divide"
                      else ("p", "raw", "float", "", None, False)]}
    mapping = R.compile_specs([spec])[0]

    def q(spark, sf):
        return preview(ingest(spark, sf).firsts, mapping, keep=["request_id"]).drop("error")
    return q


def q_unit_scale(spark, sf):
    df = ingest(spark, sf).firsts
    v = F.col("v")

    def num(key):
        return F.try_variant_get(vget(v, "data", key), "$", "double")
    return df.select("request_id",
                     scale(num("p"), "power").alias("power"),
                     scale(num("te"), "energy").alias("energy"),
                     scale(num("pv1v"), "voltage").alias("voltage"),
                     scale(num("p"), "current").alias("current"),
                     scale(num("itmp"), "temperature").alias("temperature"),
                     scale(num("fr"), "frequency").alias("frequency"))


def q_payload_keys(spark, sf):
    n = ingest(spark, sf)
    keys = F.array_join(payload_keys(as_object(F.col("v"))), ",")
    return n.firsts.groupBy(keys.alias("keys")).agg(F.count("*").alias("n"))


def q_short_keys(spark, sf):
    n = ingest(spark, sf)
    data = as_object(vget(F.col("v"), "data"))
    keys = F.array_join(F.array_sort(F.map_keys(rename_short_keys(data))), ",")
    return (n.firsts.where(data.isNotNull())
            .groupBy(keys.alias("keys")).agg(F.count("*").alias("n")))


def q_alias_canonical(spark, sf):
    return X.coalesce_aliases(ingest(spark, sf).firsts, keep=["request_id"])


def q_event_time(spark, sf):
    n = ingest(spark, sf)
    ts = event_time(string_if_string(vget(F.col("v"), "device_timestamp")), F.col("received_at"))
    return n.firsts.select("request_id", ntz(ts).alias("ts"))


def q_request_ids(spark, sf):
    return ingest(spark, sf).firsts_all.select("request_id", "raw_id")


def q_expected_format(spark, sf):
    n = ingest(spark, sf)
    df = X.expected_format(n.firsts, keep=[])
    return df


def _mixed(spark, sf) -> DataFrame:
    """Expected format of the payloads of loose senders: numbers as text, fractions, booleans, arrays and null."""
    prepare(spark)
    n = normalize(mixed_rows(spark, sf), registry(spark))
    return X.expected_format(n.firsts, keep=[])


def q_expected_format_mixed(spark, sf):
    return _mixed(spark, sf)


def q_documents_omit_empty(spark, sf):
    """The documents of those payloads with empty fields left out."""
    df = _mixed(spark, sf).drop("error")
    return X.to_document(df, df.columns).select("request_id", "document")


def q_device_local_time(spark, sf):
    """Device time from its date, time and zone strings (P25)."""
    at = device_local_time(F.col("date"), F.col("time"), F.col("time_zone"))
    return _mixed(spark, sf).select("request_id", "time_zone", ntz(at).alias("device_time"))


def q_points(spark, sf):
    p = to_points(readings(spark, sf))
    return p.select("request_id", "measurement", tag_set(F.col("tags")).alias("tags"),
                    *[F.col(f"fields.{c}").alias(c) for c in DETAIL_COLUMNS], ntz("time").alias("time"))


def q_points_roundtrip(spark, sf):
    back = from_points(to_points(readings(spark, sf)))
    return out_ts(back.select("request_id", "device_type", "device_name", "device_id", "signal_strength",
                              *DETAIL_COLUMNS, "ts"), "ts")


# ------------------------------------------------------------------ reads

def _flt() -> Q.RecordFilter:
    return Q.RecordFilter(device_id=FILTER_DEVICE, start=FILTER_START, end=FILTER_END,
                          limit=FILTER_LIMIT, offset=FILTER_OFFSET)


LISTING = ["request_id", "device_id", "ts", "total_output_power", "fault_code"]


def q_records_filter(spark, sf):
    return out_ts(Q.query_records(stored_readings(spark, sf), _flt()).select(*LISTING), "ts")


def q_records_count(spark, sf):
    return Q.count_records(stored_readings(spark, sf), _flt())


def _alarm_cols(df):
    return df.select("request_id", "alarm_1", "alarm_2", "alarm_3", "fault_code")


def q_fault_only(spark, sf):
    return _alarm_cols(stored_readings(spark, sf).where(Q.is_fault()))


def q_normal_only(spark, sf):
    return _alarm_cols(stored_readings(spark, sf).where(Q.is_normal()))


def q_time_range(spark, sf):
    raw = lake(spark, sf).raw.read(start=RANGE_START, end=RANGE_END)
    out = L.by_time_range(raw, RANGE_START, RANGE_END, RANGE_LIMIT)
    return out_ts(out.select("raw_id", "request_id", "received_at"), "received_at")


PAGE_COLS = ["request_id", "ts", "device_name", "pv1_voltage", "total_output_power",
             "inverter_temp", "fault_code"]


def q_page_listing(spark, sf):
    return out_ts(Q.page_of(lake(spark, sf).readings, PAGE_NO, PAGE_SIZE).select(*PAGE_COLS), "ts")


def q_page_deep(spark, sf):
    """A page far from the newest row, read from the hours that hold it."""
    return out_ts(Q.page_of(lake(spark, sf).readings, DEEP_PAGE, DEEP_SIZE).select(*PAGE_COLS), "ts")


def q_page_meta(spark, sf):
    return Q.page_meta(stored_readings(spark, sf), PAGE_NO, PAGE_SIZE)


def q_latest_n(spark, sf):
    return out_ts(Q.latest(stored_readings(spark, sf), LATEST_N).select(*LISTING), "ts")


def q_latest_faults(spark, sf):
    return out_ts(Q.latest(stored_readings(spark, sf), LATEST_N, only_faults=True).select(*LISTING), "ts")


def q_active_faults(spark, sf):
    return out_ts(Q.active_faults(lake(spark, sf).readings), "ts")


def q_latest_faults_per_code(spark, sf):
    df = Q.latest_per_code(stored_readings(spark, sf))
    return out_ts(df.select("fault_code", "request_id", "ts", "rn"), "ts")


def q_fault_stats(spark, sf):
    return Q.fault_stats(spark, stored_readings(spark, sf))


def q_fault_codes(spark, sf):
    return Q.fault_codes(spark, stored_readings(spark, sf))


def q_fault_totals(spark, sf):
    return Q.fault_totals(stored_readings(spark, sf))


def q_device_power(spark, sf):
    return Q.device_power(stored_readings(spark, sf))


def q_total_count(spark, sf):
    return Q.total_count(stored_readings(spark, sf))


SQL_ADHOC = ("SELECT device_type, COUNT(*) AS n, MAX(time) AS last_time "
             "FROM inverter_data WHERE fault_code > 0 GROUP BY device_type")


def q_sql_adhoc(spark, sf):
    Q.register_views(spark, {"inverter_data": stored_readings(spark, sf)})
    return out_ts(Q.sql(spark, SQL_ADHOC), "last_time")


# ------------------------------------------------------------------ stats and raw lifecycle

def q_ingest_stats(spark, sf):
    """Counters observed while the run was written."""
    return M.ingest_stats(lake(spark, sf).batches())


def q_raw_stats(spark, sf):
    return M.raw_stats(lake(spark, sf).batches())


def q_raw_current_status(spark, sf):
    return lake(spark, sf).status.current().select("raw_id", "processed", "error", "attempts")


def q_pending_oldest(spark, sf):
    """The oldest pending rows, from the status log alone."""
    p = (lake(spark, sf).status.pending().orderBy(F.col("received_at").asc(), F.col("raw_id").asc())
         .limit(RETRY_BATCH))
    return out_ts(p.select("raw_id", "received_at", "error"), "received_at")


def q_mark_status(spark, sf):
    """Rows marked processed by id, and asked-for ids that never landed.

    One event in twenty is marked by its raw id; another one in twenty is asked for
    under an id that no row has.
    """
    stored = lake(spark, sf)
    events = spark.read.parquet(f"{sf}/events.parquet").select("event_id")
    ids = events.where("event_id % 20 in (1, 3)").select(F.concat(
        F.lit("raw-"), F.col("event_id").cast("string"),
        F.when(F.col("event_id") % 20 == 1, F.lit("-0")).otherwise(F.lit("-9"))).alias("raw_id"))
    current = stored.status.current()
    entries, unknown = L.mark(ids, current, True, None, status=current, at=FIX_AT)
    return entries.select("raw_id", "processed", "error", "attempts").unionByName(
        unknown, allowMissingColumns=True)


FIXED_INV = dict(SEED_MAPPINGS[0])
FIXED_INV["rules"] = [(r[0], r[1], r[2], r[3], "UNKNOWN", False) if r[0] == "serialno" else r
                      for r in SEED_MAPPINGS[0]["rules"]]
FOO_MAPPING = {"source_id": "foo_device", "description": "unmatched layout", "nested_path": "",
               "rules": [("foo", "temperature", "int", "", None, False)]}
FIX_AT = datetime(2024, 2, 1, tzinfo=UTC)


def fixed_registry(spark, at: datetime = FIX_AT) -> DataFrame:
    reg = registry(spark)
    reg = R.update_mapping(spark, reg, FIXED_INV, at=at)
    return R.create_mapping(spark, reg, FOO_MAPPING, at=at)


def q_reprocess(spark, sf):
    stored = lake(spark, sf)
    result = reprocess(stored.raw.read(), stored.status.current(), fixed_registry(spark),
                       stored_request_ids=stored.readings.read().select("request_id"))
    return result.readings.select("request_id", "device_type", "serial_no", "inverter_temp")


def q_registry_as_of(spark, sf):
    """A replay of all payloads, each by the registry in force when it was received.

    The registry gets a corrected mapping and a new one at RETENTION_CUTOFF.
    """
    prepare(spark)
    changed = stored_registry(spark, "registry-changed", lambda: fixed_registry(spark, RETENTION_CUTOFF))
    run = normalize(lake(spark, sf).raw.read(), changed, as_of=True)
    return run.readings.select("request_id", "device_type", "serial_no", "inverter_temp")


def q_retention(spark, sf):
    """The raw table after old processed rows have been deleted from it."""
    stored = lake(spark, sf)
    table = raw_table(spark, scratch_path(spark, "retention"))
    table.append(stored.raw.read())
    L.apply_retention(table, stored.status.current(), RETENTION_CUTOFF)
    return out_ts(table.read().select("raw_id", "received_at"), "received_at")


def q_reconcile(spark, sf):
    """What the run reports as inserted against what the store holds."""
    return L.reconcile(ingest(spark, sf).outcomes, stored_readings(spark, sf))


def q_ingest_rate(spark, sf):
    return out_ts(L.ingest_rate(lake(spark, sf).outcomes()), "window_start")


def q_raw_landing(spark, sf):
    raw = L.land(payloads(spark, sf))
    return out_ts(raw.select("raw_id", "request_id", "payload", "received_at", "received_date"),
                  "received_at")


# ------------------------------------------------------------------ registry against data

def q_mapping_usage(spark, sf):
    """Registry statistics per active mapping with the payloads routed to it."""
    n = ingest(spark, sf)
    reg = R.active(registry(spark)).select(
        "source_id",
        F.size("mappings").cast("bigint").alias("fields"),
        F.size(F.filter("mappings", lambda r: r["required"])).cast("bigint").alias("required_fields"),
        F.size(F.filter("mappings", lambda r: r["transform"] != "")).cast("bigint").alias("transformed_fields"),
        F.array_join(F.transform("mappings", lambda r: r["standard_field"]), ",").alias("targets"))
    used = n.detected.groupBy("source_id").agg(F.count("*").alias("payloads"))
    return (reg.join(used, "source_id", "left")
            .withColumn("payloads", F.coalesce("payloads", F.lit(0)).cast("bigint")))


def q_mapping_exists(spark, sf):
    """Hinted payloads whose hint names an active mapping (J6, semi join)."""
    n = ingest(spark, sf)
    v = F.col("v")
    hints = n.firsts.select(F.coalesce(string_if_string(vget(v, "source_id")),
                                       string_if_string(vget(v, "device_type"))).alias("source_id"))
    hints = hints.where(F.col("source_id").isNotNull())
    found = R.mapping_exists(hints, registry(spark))
    return found.groupBy("source_id").agg(F.count("*").alias("n"))


def q_mapping_lookup(spark, sf):
    """Per payload its mapping's rule count (J1: broadcast join on source_id)."""
    n = ingest(spark, sf)
    reg = R.active(registry(spark)).select("source_id", F.size("mappings").alias("n_rules"))
    joined = n.detected.join(reg, "source_id", "inner")
    return joined.groupBy("source_id", "n_rules").agg(F.count("*").alias("n"))


def q_mapping_preview(spark, sf):
    n = ingest(spark, sf)
    mapping = R.compile_specs([SAMPLE_MAPPING])[0]
    return preview(n.firsts, mapping, keep=["request_id"])


def q_typed_getters(spark, sf):
    n = ingest(spark, sf)
    root = as_object(F.col("v"))
    data = as_object(vget(F.col("v"), "data"))
    df = n.firsts.select("request_id", root.alias("_r"), data.alias("_d"))
    return df.select(
        "request_id",
        get_string(F.col("_r"), "device_name", "unknown").alias("device_name"),
        get_string(F.col("_r"), "device_id", "unknown").alias("device_id"),
        get_string_strict(F.col("_r"), "source_id", "").alias("source_hint"),
        F.coalesce(get_float(F.col("_d"), "total_output_power", -1.0), F.lit(-1.0)).alias("power"),
        F.coalesce(get_float(F.col("_d"), "s1v", -1.0), F.lit(-1.0)).alias("s1v"),
        F.coalesce(get_int(F.col("_d"), "fault_code", -1), F.lit(-1).cast("bigint")).alias("fault"))


def q_stream_ingest(spark, sf):
    from ..streaming.ingest import run_available_now
    out = run_available_now(spark, payload_rows(spark, sf).select("raw_id", "payload", "received_at"),
                            registry(spark))
    return out_ts(out.select(*READING_COLUMNS), "ts")


def _drained(spark, sf):
    """An ingest stream that got all payloads, and on a later day the resent ones again."""
    from ..streaming.ingest import Drained, StreamConfig, drain

    def run():
        rows = payload_rows(spark, sf)
        first = rows.where("copy = 0")
        later = rows.where("copy = 1").withColumn("received_at", F.col("received_at") + F.make_dt_interval(days=F.lit(1)))
        out = drain(spark, [first, later], registry(spark))
        return out.cfg.sink, out.cfg.checkpoint
    prepare(spark)
    sink, checkpoint = memo(("drained", *input_state(spark, sf)), run)
    return Drained(spark, StreamConfig(sink=sink, checkpoint=checkpoint))


def q_stream_dedupe(spark, sf):
    """Each raw row's state after a stream that meets resends a day after the first copy."""
    return L.current_status(_drained(spark, sf).status()).select("raw_id", "processed", "error", "attempts")


def q_batch_stats(spark, sf):
    """Writer counters of that stream."""
    return M.batch_stats(_drained(spark, sf).batches()).drop("last_flush")


def q_stream_flush(spark, sf):
    """Records, readings, rejects and duplicates of every flush of at most FLUSH_SIZE records."""
    from ..streaming.ingest import drain
    out = drain(spark, [payload_rows(spark, sf)], registry(spark), batch_size=FLUSH_SIZE)
    return out.batches().select("flush", F.col("landed").alias("records"), "readings", "rejects", "duplicates")


def q_stream_rate(spark, sf):
    """The ingest rate kept by a stream over two deliveries (T5)."""
    from ..streaming.ingest import run_rate
    rows = payload_rows(spark, sf)
    cut = F.lit(RETENTION_CUTOFF).cast("timestamp")
    out = run_rate(spark, [rows.where(F.col("received_at") < cut), rows.where(F.col("received_at") >= cut)])
    return out_ts(out, "window_start")


QUERIES = {
    "normalize_canonical": q_normalize_canonical,
    "normalize_rule_plan": q_normalize_rule_plan,
    "detect_source": q_detect_source,
    "detect_default_source": q_detect_default_source,
    "detect_rule_join": q_detect_rule_join,
    "rejects": q_rejects,
    "root_fallback_defaults": q_root_fallback_defaults,
    "convert_int": _convert_query("int"),
    "convert_float": _convert_query("float"),
    "convert_string": _convert_query("string"),
    "convert_bool": _convert_query("bool"),
    "transform_multiply": _transform_query("multiply"),
    "transform_divide": _transform_query("divide"),
    "transform_add": _transform_query("add"),
    "transform_subtract": _transform_query("subtract"),
    "unit_scale": q_unit_scale,
    "payload_keys": q_payload_keys,
    "short_keys": q_short_keys,
    "alias_canonical": q_alias_canonical,
    "event_time": q_event_time,
    "request_ids": q_request_ids,
    "expected_format": q_expected_format,
    "points": q_points,
    "points_roundtrip": q_points_roundtrip,
    "records_filter": q_records_filter,
    "records_count": q_records_count,
    "fault_only": q_fault_only,
    "normal_only": q_normal_only,
    "time_range": q_time_range,
    "page_listing": q_page_listing,
    "page_meta": q_page_meta,
    "latest_n": q_latest_n,
    "latest_faults": q_latest_faults,
    "active_faults": q_active_faults,
    "latest_faults_per_code": q_latest_faults_per_code,
    "fault_stats": q_fault_stats,
    "fault_codes": q_fault_codes,
    "fault_totals": q_fault_totals,
    "device_power": q_device_power,
    "total_count": q_total_count,
    "sql_adhoc": q_sql_adhoc,
    "ingest_stats": q_ingest_stats,
    "raw_stats": q_raw_stats,
    "raw_current_status": q_raw_current_status,
    "pending_oldest": q_pending_oldest,
    "reprocess": q_reprocess,
    "retention": q_retention,
    "reconcile": q_reconcile,
    "ingest_rate": q_ingest_rate,
    "raw_landing": q_raw_landing,
    "mapping_usage": q_mapping_usage,
    "mapping_exists": q_mapping_exists,
    "mapping_lookup": q_mapping_lookup,
    "mapping_preview": q_mapping_preview,
    "typed_getters": q_typed_getters,
    "stream_ingest": q_stream_ingest,
    "expected_format_mixed": q_expected_format_mixed,
    "documents_omit_empty": q_documents_omit_empty,
    "device_local_time": q_device_local_time,
    "page_deep": q_page_deep,
    "mark_status": q_mark_status,
    "registry_as_of": q_registry_as_of,
    "stream_dedupe": q_stream_dedupe,
    "batch_stats": q_batch_stats,
    "stream_flush": q_stream_flush,
    "stream_rate": q_stream_rate,
}


"""Telemetry payloads derived from the driver's ``events`` table (FIXTURES §4).

Every event becomes one JSON payload whose layout depends on its
``event_type``; events with ``event_id % 50 = 7`` are sent twice with the
same text.  The text is built with column expressions only, so the payload
set grows with ``events`` and is produced by scan tasks in parallel (no
shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.memo import memo
from ..operators.common import spread
from ..session import prepare

RESEND_MOD, RESEND_REM = 50, 7
MISSING_SERIAL_MOD, MISSING_SERIAL_REM = 25, 3


def _q(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _s(c: Column) -> Column:
    return c.cast("string")


def _kv(key: str, value: Column, quoted: bool = False, comma: bool = True) -> Column:
    text = F.concat(F.lit(f'"{key}":'), _q(value) if quoted else _s(value))
    return F.concat(text, F.lit(",")) if comma else text


def event_columns(events: DataFrame) -> DataFrame:
    """events -> event_id, user_id, kind, ts, k, cents, dev, dts, value."""
    return events.select(
        "event_id", "user_id", F.col("event_type").alias("kind"), "ts", "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("bigint").alias("k"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"),
        F.concat(F.lit("INV-"), F.lpad(_s(F.col("user_id")), 4, "0")).alias("dev"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("dts"),
    )


def payload_text() -> Column:
    """JSON text of one payload from the columns of :func:`event_columns`."""
    eid, uid, k, cents = F.col("event_id"), F.col("user_id"), F.col("k"), F.col("cents")
    dev, dts, kind = F.col("dev"), F.col("dts"), F.col("kind")
    rid = F.concat(F.lit("req-"), _s(eid))
    name = F.concat(F.lit("N"), _s(uid))
    serial = F.concat(F.lit("SN"), _s(uid))
    k_odd = (k % 2) == 1

    head = F.concat(F.lit("{"), _kv("request_id", rid, True))

    click = F.concat(
        head, _kv("device_type", F.lit("Inv"), True), _kv("device_id", dev, True),
        _kv("device_name", name, True), _kv("signal_strength", _s(k % 5), True),
        _kv("device_timestamp", dts, True), F.lit('"data":{'),
        F.when((eid % MISSING_SERIAL_MOD) == MISSING_SERIAL_REM, F.lit(""))
         .otherwise(_kv("serialno", serial, True)),
        _kv("totaloutputpower", cents * 10), _kv("pv1voltage", cents),
        _kv("invertertemp", k * 10 + 5), _kv("frequency", F.lit(50000)),
        _kv("alarm1", k % 11, comma=False), F.lit("}}"))

    view = F.concat(
        head, _kv("device_id", dev, True), _kv("device_name", name, True),
        _kv("device_timestamp", dts, True), F.lit('"data":{'),
        _kv("sno", serial, True), _kv("model", F.concat(F.lit("M"), _s(k % 4)), True),
        _kv("p", cents), _kv("e", k), _kv("te", cents), _kv("pv1v", k),
        _kv("gvr", F.lit(2300)), _kv("itmp", k), _kv("fr", F.lit(5000)),
        _kv("al2", k % 3, comma=False), F.lit("}}"))

    def legacy(hinted: bool) -> Column:
        root = (F.concat(_kv("source_id", F.lit("current_format"), True),
                         _kv("device_name", name, True),
                         _kv("device_timestamp", F.lit("not-a-time"), True))
                if hinted else
                F.concat(_kv("device_id", dev, True), _kv("device_name", name, True),
                         _kv("device_timestamp", dts, True)))
        power = _kv("total_output_power", _s(cents), True) if hinted else _kv("total_output_power", cents)
        s1v = F.lit('"s1v":null,') if hinted else _kv("s1v", k)
        return F.concat(
            head, root,
            F.when(k_odd, _kv("inv_temp", k)).otherwise(F.lit("")),
            F.lit('"data":{'),
            F.when(k_odd, _kv("serial_no", serial, True)).otherwise(F.lit("")),
            s1v, power, _kv("f", F.lit(50)), _kv("today_e", k), _kv("total_e", cents),
            F.when(k_odd, F.lit("")).otherwise(_kv("inv_temp", k)),
            _kv("fault_code", k % 11, comma=False), F.lit("}}"))

    error = (F.when((k % 3) == 0, F.concat(F.lit('{"device_id": "'), dev, F.lit('", "id": '), _s(eid)))
              .when((k % 3) == 1, F.concat(F.lit("["), _s(eid), F.lit("]")))
              .otherwise(F.concat(F.lit('{"device_id": "'), dev, F.lit('", "request_id": "'), rid,
                                  F.lit('", "foo": '), _s(k), F.lit("}"))))

    return (F.when(kind == "click", click)
             .when(kind == "view", view)
             .when(kind == "purchase", legacy(False))
             .when(kind == "signup", legacy(True))
             .otherwise(error))


def payload_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw_id, event_id, kind, copy, payload, received_at for every payload sent.

    ``received_at = ts + (copy + 1) minutes``; resends are the ``copy = 1`` rows.
    """
    prepare(spark)
    ev = event_columns(spread(spark.read.parquet(f"{sf_dir}/events.parquet")))
    copies = F.when((F.col("event_id") % RESEND_MOD) == RESEND_REM, F.array(F.lit(0), F.lit(1))) \
              .otherwise(F.array(F.lit(0)))
    rows = ev.withColumn("copy", F.explode(copies))
    return rows.select(
        F.concat(F.lit("raw-"), _s(F.col("event_id")), F.lit("-"), _s(F.col("copy"))).alias("raw_id"),
        "event_id", "kind", "copy",
        memo("payload_text", payload_text).alias("payload"),
        (F.col("ts").cast("timestamp")
         + F.make_dt_interval(mins=F.col("copy") + 1)).alias("received_at"),
    )


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landing input: raw_id, payload, received_at, source_ip."""
    return payload_rows(spark, sf_dir).select(
        "raw_id", "payload", "received_at", F.lit("").alias("source_ip"))


def mixed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second payload of every event, as loose senders write it: raw_id, event_id, payload, received_at.

    Even events use the short-key layout, odd ones the layout of
    ``current_format``.  Power and energy come, by half the event id modulo 6, as text with a
    numeric prefix, as a fraction, as a boolean, as an array, as null and as text
    without a number; date, time and zone of the device are strings.
    """
    prepare(spark)
    ev = event_columns(spread(spark.read.parquet(f"{sf_dir}/events.parquet")))
    eid, uid, k, cents = F.col("event_id"), F.col("user_id"), F.col("k"), F.col("cents")
    kind = F.shiftright(eid, 1) % 6
    power = (F.when(kind == 0, _q(F.concat(_s(cents), F.lit(" mW"))))
             .when(kind == 1, F.concat(_s(cents), F.lit(".25")))
             .when(kind == 2, F.lit("true")).when(kind == 3, F.concat(F.lit("["), _s(cents), F.lit("]")))
             .when(kind == 4, F.lit("null")).otherwise(F.lit('"n/a"')))
    alarm = (F.when(kind == 0, _q(F.concat(_s(k % 11), F.lit(" active")))).when(kind == 1, F.concat(_s(k % 11), F.lit(".75")))
             .when(kind == 2, F.lit("false")).otherwise(_s(k % 11)))
    serial = F.when(kind == 5, _s(uid)).otherwise(_q(F.concat(F.lit("SN"), _s(uid))))
    zone = (F.when(uid % 3 == 0, F.lit("Asia/Kolkata")).when(uid % 3 == 1, F.lit("UTC")).otherwise(F.lit("")))
    short = F.concat(_kv("sno", serial), _kv("p", power), _kv("e", power), _kv("pv1v", k), _kv("gct", power),
                     _kv("al1", alarm), _kv("al3", k % 2, comma=False))
    legacy = F.concat(_kv("serial_no", serial), _kv("total_output_power", power), _kv("today_e", power),
                      _kv("s1v", k), _kv("inv_temp", power), _kv("fault_code", alarm, comma=False))
    text = F.concat(
        F.lit("{"), _kv("request_id", F.concat(F.lit("mix-"), _s(eid)), True),
        _kv("device_type", F.when(eid % 2 == 0, F.lit("Inv")).otherwise(F.lit("current_format")), True),
        _kv("device_id", F.col("dev"), True), _kv("device_name", F.concat(F.lit("N"), _s(uid)), True),
        _kv("date", F.date_format("ts", "dd/MM/yyyy"), True), _kv("time", F.date_format("ts", "HH:mm:ss"), True),
        _kv("time_zone", zone, True),
        _kv("latitude", F.when(kind < 3, _q(F.concat(_s(k % 90), F.lit(".5")))).otherwise(_s(k % 90))),
        _kv("software_ver", F.concat(F.lit("v"), _s(k % 7)), True), _kv("loginterval", k % 60),
        F.lit('"data":{'), F.when(eid % 2 == 0, short).otherwise(legacy), F.lit("}}"))
    return ev.select(F.concat(F.lit("mix-"), _s(eid)).alias("raw_id"), "event_id", text.alias("payload"),
                     F.col("ts").cast("timestamp").alias("received_at"))

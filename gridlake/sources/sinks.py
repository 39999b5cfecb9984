"""Sinks of the canonical readings.

* S4: Parquet, one folder per event date, rows sorted by ``device_id, ts``
  inside each file so min/max statistics prune device and time predicates
  (the role indexes play in a document store).
* S5/S6: the time-series point shape (measurement, string tags, typed fields,
  time) and the typed read-back from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import (DEFAULT_TAGS, DETAIL_COLUMNS, DOUBLE_DETAILS, LONG_DETAILS,
                       MEASUREMENT, STRING_DETAILS)

TAG_COLUMNS = ["device_type", "device_name", "device_id"]


def write_readings(readings: DataFrame, path: str, mode: str = "append",
                   max_records_per_file: int = 5_000_000, within: str | None = None) -> None:
    """Write readings partitioned by event date, clustered by device and time.

    A rebalance brings the rows of a date together before the write; the runtime
    plan splits a busy date over several tasks and merges quiet ones, by bytes,
    so files follow bytes and not tasks times dates.  Row groups carry min/max
    statistics (sorted device and time) and a bloom filter on ``device_id``, so
    device lookups skip row groups without the device.  ``within``: column of folders
    above the date's, by which rows have been brought together.
    """
    rows, folders = readings.withColumn("ts_date", F.to_date("ts")), ["ts_date"]
    if within is None:
        rows = rows.hint("rebalance", F.col("ts_date"))
    else:
        folders = [within, *folders]
    (rows.sortWithinPartitions(*folders, "device_id", "ts")
     .write.mode(mode).option("maxRecordsPerFile", max_records_per_file)
     .option("parquet.bloom.filter.enabled#device_id", "true")
     .partitionBy(*folders).parquet(path))


def read_readings(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


def to_points(readings: DataFrame) -> DataFrame:
    """Readings -> points: measurement, tags map, fields struct, time.

    An empty ``signal_strength`` tag is left out; the constant ``source`` tag
    is added to every point.
    """
    tag_items = []
    for c in TAG_COLUMNS + ["signal_strength"]:
        tag_items += [F.lit(c), F.col(c)]
    for k, v in DEFAULT_TAGS.items():
        tag_items += [F.lit(k), F.lit(v)]
    tags = F.map_filter(F.create_map(*tag_items),
                        lambda k, v: ~((k == "signal_strength") & (v == "")))
    fields = F.struct(*[F.col(c) for c in DETAIL_COLUMNS if c != "fault_code"],
                      F.col("fault_code"))
    return readings.select(F.lit(MEASUREMENT).alias("measurement"), "request_id",
                           tags.alias("tags"), fields.alias("fields"), F.col("ts").alias("time"))


def tag_set(tags) -> F.Column:
    """Sorted ``key=value`` list of a tag map, comma separated."""
    return F.array_join(F.array_sort(F.transform(
        F.map_entries(tags), lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")


def from_points(points: DataFrame) -> DataFrame:
    """Points -> readings columns; an absent tag or field reads as "" / 0."""
    cols = [F.col("request_id")]
    for c in TAG_COLUMNS + ["signal_strength"]:
        cols.append(F.coalesce(F.col("tags").getItem(c), F.lit("")).alias(c))
    cols.append(F.col("time").alias("ts"))
    names = set(points.schema["fields"].dataType.names)
    for c in STRING_DETAILS:
        cols.append((F.coalesce(F.col("fields").getField(c), F.lit("")) if c in names else F.lit("")).alias(c))
    for c in DOUBLE_DETAILS:
        cols.append((F.coalesce(F.col("fields").getField(c).try_cast("double"), F.lit(0.0))
                     if c in names else F.lit(0.0)).alias(c))
    for c in LONG_DETAILS:
        cols.append((F.coalesce(F.col("fields").getField(c).try_cast("bigint"), F.lit(0).cast("bigint"))
                     if c in names else F.lit(0).cast("bigint")).alias(c))
    return points.select(*cols)

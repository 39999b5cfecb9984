"""Cutting a batch into flushes of a fixed number of records.

The file source bounds a micro-batch by files or bytes, not by rows.  Rows are
numbered instead, in two passes and without bringing them together: each range
of the order counts its rows, the counts before a range are its offset, and a row's
number is that offset plus its place in the range.  The number depends on the
order alone, so a replayed batch is cut at the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

PLACE_BITS = 33          # monotonically_increasing_id: partition above, place in the partition below


def numbered(rows: DataFrame, *order: str, ranges: int | None = None, path: str | None = None) -> DataFrame:
    """``rows`` with ``number``, the 0-based position in ``order`` (which must tell rows apart).

    The ranges come from a sample that differs from run to run, so rows are written
    with their places (to ``path``, which the caller may delete later, or a folder of
    their own) and both passes read those; give slim rows.
    """
    spark = rows.sparkSession
    ranges = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = path or scratch_path(spark, "numbered")
    (rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
     .withColumn("_place", F.monotonically_increasing_id()).write.parquet(path))
    placed = spark.read.parquet(path)
    in_range = F.shiftright("_place", PLACE_BITS).alias("_range")
    before = F.sum("_n").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = (placed.groupBy(in_range).agg(F.count("*").alias("_n"))          # a row a range
               .select("_range", F.coalesce(before, F.lit(0)).alias("_offset")))
    return (placed.withColumn("_range", F.shiftright("_place", PLACE_BITS)).join(F.broadcast(offsets), "_range")
            .withColumn("number", F.col("_offset") + F.col("_place").bitwiseAND(F.lit((1 << PLACE_BITS) - 1)))
            .drop("_range", "_offset", "_place"))


def cut(rows: DataFrame, size: int, *order: str, ranges: int | None = None, path: str | None = None) -> DataFrame:
    """``rows`` with ``flush``: rows 0 to size - 1 of the order are flush 0, and so on; the last may be smaller."""
    if size < 1:
        raise ValueError("a flush has at least one record")
    return (numbered(rows, *order, ranges=ranges, path=path)
            .withColumn("flush", F.floor(F.col("number") / size).cast("bigint")).drop("number"))

"""Small helpers shared by operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def project_once(df: DataFrame, *cols) -> DataFrame:
    """Append ``cols`` to ``df``, each evaluated exactly once per row.

    Catalyst pushes a filter through a projection by inlining the projected
    expressions into the predicate, so a filter on a costly derived column
    (a parsed payload, a detected source) would evaluate it twice, or many
    times when the column feeds other derived columns.  Emitting the columns
    from a generator (``inline`` of a one-element array) stops that: predicates
    on generator output stay above it, and projections are not merged across it.
    """
    return df.select("*", F.inline(F.array(F.struct(*cols))))


SPREAD_BYTES = 256 << 20


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give the scan of a small input as many partitions as the application has cores.

    A small input stored as one file or row group would otherwise run every
    per-row step before the first shuffle in a single task; it is dealt out
    round-robin.  Inputs of more than ``SPREAD_BYTES`` are never shuffled here,
    however many cores there are, nor are those with enough splits.
    """
    try:
        target = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        current = df.rdd.getNumPartitions()
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:  # Spark Connect: no RDD view; leave the scan as it is
        return df
    if current < target and size <= SPREAD_BYTES:
        return df.repartition(target)
    return df

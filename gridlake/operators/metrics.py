"""Live counters, taken while rows are written.

A run's counters are observed metrics of the very write that stores its
outcomes, so they cost no pass of their own.  Each batch keeps one row of them;
totals are sums over those rows.  A batch that is replayed replaces its row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..catalog import STORE_TYPE

#: Counters of a batch.  ``pending`` and ``errors`` are changes: a retry that
#: succeeds gives -1 and, if its row had an error, -1.
COUNTERS = ("landed", "readings", "faults", "rejects", "duplicates", "errors", "processed")
SCHEMA = ", ".join(f"{c} bigint" for c in COUNTERS) + ", flushed_at timestamp, batch_id bigint, flush bigint"


def _outcome_counts() -> list:
    reading, duplicate = F.col("outcome") == "reading", F.col("outcome") == "duplicate"
    return [F.count_if(reading).alias("readings"), F.count_if(reading & F.col("fault")).alias("faults"),
            F.count_if(F.col("outcome") == "reject").alias("rejects"), F.count_if(duplicate).alias("duplicates"),
            F.count_if(F.col("error").isNotNull() & (F.col("error") != "")).alias("errors")]


def count_outcomes(outcomes: DataFrame, by: str) -> DataFrame:
    """The rows of counters of landed ``outcomes`` (outcome, error, fault), one for each value of ``by``."""
    counts = outcomes.groupBy(by).agg(F.count("*").alias("landed"), *_outcome_counts())
    return (counts.withColumn("processed", F.col("readings") + F.col("duplicates"))
            .select(by, *COUNTERS, F.current_timestamp().alias("flushed_at")))


def observe_outcomes(outcomes: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """``outcomes`` (outcome, error, fault) with its counters observed by whoever writes it."""
    seen = Observation(name)
    return outcomes.observe(seen, F.count("*").alias("settled"), *_outcome_counts()), seen


def observe_landing(raw: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return raw.observe(seen, F.count("*").alias("landed")), seen


def batch_row(landed: int, seen: dict, errors_before: int = 0) -> dict:
    """Counters of a batch from its observations; ``errors_before``: retried rows that had an error."""
    return {"landed": landed, "readings": seen["readings"], "faults": seen["faults"], "rejects": seen["rejects"],
            "duplicates": seen["duplicates"], "errors": seen["errors"] - errors_before,
            "processed": seen["readings"] + seen["duplicates"]}


def write_batch(spark: SparkSession, path: str, batch_id: int, counters: dict, flush: int = 0) -> None:
    """The row of a batch, or of a flush of it; its folder is there when the row is (a rename of one file)."""
    row = spark.createDataFrame([tuple(int(counters[c]) for c in COUNTERS)], ", ".join(f"{c} bigint" for c in COUNTERS))
    (row.withColumn("flushed_at", F.current_timestamp()).coalesce(1)
     .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}/flush={flush}"))


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """A row a flush."""
    return spark.read.schema(SCHEMA).parquet(path)


def _total(name: str):
    return F.coalesce(F.sum(name), F.lit(0)).cast("bigint")


def ingest_stats(batches: DataFrame) -> DataFrame:
    """The ingest counters (G2); ``buffer_size`` is what has landed without an outcome yet."""
    inserted, failed = _total("readings"), _total("rejects") + _total("duplicates")
    first_tries = F.coalesce(F.sum(F.when(F.col("landed") > 0, F.col("readings") + F.col("rejects")
                                          + F.col("duplicates"))), F.lit(0))
    return batches.agg(
        inserted.alias("total_records"), (inserted - _total("faults")).alias("normal_records"),
        _total("faults").alias("fault_records"), inserted.alias("inserted_count"), failed.alias("failed_count"),
        (_total("landed") - first_tries).cast("bigint").alias("buffer_size"),
        F.when(inserted + failed == 0, F.lit(100.0)).otherwise(inserted / (inserted + failed) * 100)
         .alias("success_rate"),
        F.lit(STORE_TYPE).alias("database_type"))


def raw_stats(batches: DataFrame) -> DataFrame:
    """Backlog counters (G3) over all batches and retries."""
    total, processed = _total("landed"), _total("processed")
    return batches.agg(
        total.alias("total_raw"), (total - processed).alias("unprocessed"), _total("errors").alias("with_errors"),
        processed.alias("processed"),
        F.when(total == 0, F.lit(0.0)).otherwise(processed / total * 100).alias("processing_rate"))


def batch_stats(batches: DataFrame) -> DataFrame:
    """Writer counters (G9): batches, records, last flush."""
    return batches.agg(F.count("*").alias("batches"), _total("landed").alias("records"),
                       F.max("flushed_at").alias("last_flush"))

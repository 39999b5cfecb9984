"""The stored tables of one ingest, as the service keeps them.

``land`` writes raw rows, ``process`` runs the normalisation over landed rows and
writes its results once; readings, rejects, status entries and counters come
from that one pass::

    raw/       VersionedTable, receive-date folders, sorted by time
    results/   every raw row with its outcome and mapped columns, by batch
    readings/  VersionedTable, event-date folders, sorted by device and time
    status/    StatusLog, bucketed by raw id
    batches/   a row of counters a batch
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import ERR_DUPLICATE, RAW_SCHEMA, READINGS_SCHEMA, REJECTS_COLUMNS
from ..operators import lifecycle as L
from ..operators import metrics as M
from ..sources.files import Files
from ..sources.status_log import StatusLog
from ..sources.versions import VersionedTable
from .normalize import as_readings, normalize
from .reprocess import reprocess

RAW_COLUMNS = [f for f in RAW_SCHEMA.fields if f.name != "received_date"]


def raw_table(spark: SparkSession, root: str) -> VersionedTable:
    """Raw rows (S3): one folder per receive date, sorted by time, so a time range reads few row groups."""
    return VersionedTable(spark, root, type(RAW_SCHEMA)(RAW_COLUMNS), "received_date", "received_at",
                          sort=("received_at", "raw_id"))


def readings_table(spark: SparkSession, root: str) -> VersionedTable:
    """Readings (S4): one folder per event date, sorted by device and time, with a bloom filter on the device."""
    return VersionedTable(spark, root, READINGS_SCHEMA, "ts_date", "ts", sort=("device_id", "ts"),
                          bloom=("device_id",))


@dataclass
class Lake:
    spark: SparkSession
    root: str

    @cached_property
    def raw(self) -> VersionedTable:
        return raw_table(self.spark, f"{self.root}/raw")

    @cached_property
    def readings(self) -> VersionedTable:
        return readings_table(self.spark, f"{self.root}/readings")

    @cached_property
    def status(self) -> StatusLog:
        return StatusLog(self.spark, f"{self.root}/status")

    def results(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/results")

    def outcomes(self) -> DataFrame:
        return self.results().select("raw_id", "request_id", "received_at", "outcome", "error", "fault")

    def rejects(self) -> DataFrame:
        return self.results().where("outcome = 'reject'").select(*REJECTS_COLUMNS)

    def batches(self) -> DataFrame:
        return M.read_batches(self.spark, f"{self.root}/batches")

    def land(self, payloads: DataFrame) -> int:
        """Append payload rows to the raw table; return how many (observed while they are written)."""
        raw, seen = M.observe_landing(L.land(payloads), "landing")
        self.raw.append(raw)
        return seen.get["landed"]

    def process(self, landed: int, registry: DataFrame, batch_id: int = 0, raw: DataFrame | None = None) -> None:
        """Normalise landed rows and write results, readings, status entries and counters.

        Rows whose request id an earlier batch has settled are duplicates; only the
        ids of earlier results are read for that.  (The stream keeps ids as state instead.)
        Batch ids grow; a batch that is run again writes the same results and adds no reading twice.
        """
        raw = self.raw.read() if raw is None else raw
        raw = raw.drop("received_date")
        earlier = [n for n in Files(self.spark, self.root).names("results") if n.startswith("batch_id=")
                   and int(n.split("=")[1]) < batch_id]
        if earlier:
            stored = self.spark.read.parquet(*[f"{self.root}/results/{n}" for n in earlier]).select("request_id").distinct()
            raw = raw.join(stored.withColumn("_stored", F.lit(True)), "request_id", "left")
            late = raw.where("_stored").select(
                "raw_id", "request_id", "payload", "received_at", F.lit("duplicate").alias("outcome"),
                F.lit(ERR_DUPLICATE).alias("error"), F.lit(False).alias("fault"))
            found = normalize(raw.where("_stored is null").drop("_stored"), registry).results
            found = found.unionByName(late, allowMissingColumns=True)
        else:
            found = normalize(raw, registry).results
        results, seen = M.observe_outcomes(found, f"outcomes-{batch_id}")
        folder = f"{self.root}/results/batch_id={batch_id}"
        results.write.mode("overwrite").parquet(folder)
        results = self.spark.read.parquet(folder)
        self._store(results, batch_id)
        self.status.append(L.status_entries(results))
        M.write_batch(self.spark, f"{self.root}/batches", batch_id, M.batch_row(landed, seen.get))

    def _store(self, results: DataFrame, batch_id: int) -> None:
        """Append a batch's readings, unless the table's version says that it has come to this batch."""
        if self.readings.note().get("through", -1) < batch_id:
            self.readings.append(as_readings(results.where("outcome = 'reading'")), {"through": batch_id})

    def retry(self, registry: DataFrame, batch_id: int) -> None:
        """Try pending rows again with the registry as it is now (R2); results are a batch of their own."""
        pending = self.status.pending()
        again = reprocess(self.raw.read(), pending, registry,
                          stored_request_ids=self.readings.read().select("request_id"))
        errors = pending.where("error is not null and error <> ''").count()
        results, seen = M.observe_outcomes(again.results, "retry")
        folder = f"{self.root}/results/batch_id={batch_id}"
        results.write.mode("overwrite").parquet(folder)
        results = self.spark.read.parquet(folder)
        self._store(results, batch_id)
        self.status.append(results.select(
            "raw_id", F.col("outcome").isin("reading", "duplicate").alias("processed"), "error",
            (F.col("attempts") + 1).alias("attempts"), F.col("received_at").alias("at"),
            (F.col("seq") + 1).alias("seq"), "received_at"))
        M.write_batch(self.spark, f"{self.root}/batches", batch_id, M.batch_row(0, seen.get, errors))

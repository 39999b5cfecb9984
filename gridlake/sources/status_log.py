"""The status log of raw rows as a stored, bucketed, compacted table.

Entries ``(raw_id, processed, error, attempts, at, seq)`` are appended and never
changed.  They lie in files bucketed by ``raw_id``, so the current state (the
entry with the highest ``(seq, at)`` of each id) is an aggregation inside each
bucket: no shuffle, one scan.  Entries are slim and carry the time of landing,
so finding pending rows reads no payloads.

Compaction writes the current state to a new table and names it in a pointer
file, which is the commit; it chooses the number of buckets by the number of
rows, so a bucket stays one task's work however long the log lives.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import RAW_STATUS_SCHEMA
from ..operators.lifecycle import current_status
from .files import Files
from .versions import ConcurrentCommit

ROWS_PER_BUCKET = 5_000_000


def status_schema() -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_STATUS_SCHEMA.fields)


class StatusLog:
    """Entries under ``root``; ``received_at`` of an entry is its row's landing time."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.files = Files(spark, self.root)
        self.least = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # -------------------------------------------------------------- the pointer

    def version(self) -> int:
        return max((int(n[:-5]) for n in self.files.names("versions") if n[:-5].isdigit()), default=0)

    def _state(self, version: int | None = None) -> dict | None:
        version = self.version() if version is None else version
        return json.loads(self.files.read(f"versions/{version}.json")) if version else None

    def _commit(self, state: dict, base: int) -> None:
        if not self.files.create(f"versions/{base + 1}.json", json.dumps(state)):
            raise ConcurrentCommit(f"version {base + 1} of {self.root} exists")

    def _table(self, state: dict) -> str:
        """The session's name for the table at the state's folder."""
        name = "status_" + re.sub(r"\W", "_", state["folder"]) + "_" + format(zlib.crc32(self.root.encode()), "x")
        if not self.spark.catalog.tableExists(name):
            self.spark.sql(
                f"CREATE TABLE {name} ({status_schema()}, received_at timestamp) USING parquet "
                f"CLUSTERED BY (raw_id) SORTED BY (raw_id) INTO {int(state['buckets'])} BUCKETS "
                f"LOCATION '{self.root}/{state['folder']}'")
        return name

    def _new(self, entries: DataFrame, buckets: int, base: int) -> None:
        state = {"folder": f"entries-{uuid.uuid4().hex[:12]}", "buckets": buckets}
        self._insert(entries, state)
        self._commit(state, base)

    def _insert(self, entries: DataFrame, state: dict) -> None:
        """One file a bucket: rows are dealt by the same hash as the buckets."""
        name = self._table(state)
        columns = [F.col(f.name).cast(f.dataType) for f in RAW_STATUS_SCHEMA.fields]
        (entries.select(*columns, "received_at").repartition(int(state["buckets"]), "raw_id")
         .write.mode("append").insertInto(name))

    # -------------------------------------------------------------- use

    def append(self, entries: DataFrame) -> None:
        """Add entries ``(..., received_at)``; adding an entry twice changes nothing that is read."""
        state = self._state()
        if state is None:
            self._new(entries, self.least, 0)
        else:
            self._insert(entries, state)

    def entries(self) -> DataFrame:
        state = self._state()
        if state is None:
            return self.spark.createDataFrame([], f"{status_schema()}, received_at timestamp")
        name = self._table(state)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def current(self) -> DataFrame:
        """One row an id: ``raw_id, processed, error, attempts, at, seq, received_at``."""
        return current_status(self.entries())

    def pending(self) -> DataFrame:
        return self.current().where(~F.col("processed"))

    def compact(self) -> int:
        """Keep the current state only; return the number of ids."""
        base = self.version()
        if not base:
            return 0
        n = self.entries().select("raw_id").distinct().count()      # within buckets
        self._new(self.current(), max(self.least, -(-n // ROWS_PER_BUCKET)), base)
        return n

    def vacuum(self) -> None:
        """Drop what earlier versions named."""
        newest = self._state()
        if newest is None:
            return
        for version in range(1, self.version()):
            if f"{version}.json" in self.files.names("versions"):
                old = self._state(version)
                if old["folder"] != newest["folder"]:
                    self.spark.sql(f"DROP TABLE IF EXISTS {self._table(old)}")
                    self.files.delete(old["folder"])
                self.files.delete(f"versions/{version}.json")

"""Retry of pending raw rows (R2, Q10).

All pending rows are retried in one distributed job (no 100-row batches, so
permanently failing rows cannot starve the rest); the run reuses the
normalisation plan.  The status is narrowed to pending ids first and only those
rows of the raw table are looked up, so payloads of settled rows are not moved.
Rows whose request id already has a stored reading are duplicates: they are
not written again and their status says so.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..catalog import ERR_DUPLICATE
from ..operators import lifecycle as L
from .normalize import Normalized, normalize


@dataclass
class Reprocessed:
    run: Normalized
    pending: DataFrame               # raw_id, attempts, seq of the rows that are tried again
    stored: DataFrame | None         # raw rows whose request id is stored already

    @property
    def readings(self) -> DataFrame:
        return self.run.readings

    @property
    def rejects(self) -> DataFrame:
        return self.run.rejects

    @cached_property
    def results(self) -> DataFrame:
        """Every retried row with its outcome, mapped columns and the ``attempts`` and ``seq`` it had."""
        out = self.run.results
        if self.stored is not None:
            late = self.stored.select("raw_id", "request_id", "payload", "received_at",
                                      F.lit("duplicate").alias("outcome"), F.lit(ERR_DUPLICATE).alias("error"),
                                      F.lit(False).alias("fault"))
            out = out.unionByName(late, allowMissingColumns=True)
        return out.join(self.pending, "raw_id")

    @property
    def status(self) -> DataFrame:
        """New status entries (append to raw_status)."""
        return self.results.select(
            "raw_id", F.col("outcome").isin("reading", "duplicate").alias("processed"), "error",
            (F.col("attempts") + 1).cast("int").alias("attempts"), F.col("received_at").alias("at"),
            (F.col("seq") + 1).cast("bigint").alias("seq"))


def reprocess(raw: DataFrame, status: DataFrame, registry: DataFrame, *,
              stored_request_ids: DataFrame | None = None,
              max_attempts: int | None = None, **kw) -> Reprocessed:
    """Retry pending rows with the current registry; return readings and status entries.

    ``status``: the current state; raw rows without an entry are pending too
    unless the state is that of a stored log (it carries ``received_at``), which
    has an entry for every landed row.
    """
    if "received_at" in status.columns:
        open_ = status.where(~F.col("processed"))
        if max_attempts is not None:
            open_ = open_.where(F.col("attempts") < max_attempts)
        pending = open_.select("raw_id", "attempts", "seq")
        todo = raw.join(pending.select("raw_id"), "raw_id", "left_semi")
    else:
        found = L.pending(raw, status, max_attempts)
        pending = found.select("raw_id", F.coalesce("attempts", F.lit(0)).alias("attempts"),
                               F.coalesce("seq", F.lit(0)).alias("seq"))
        todo = found
    todo = todo.select("raw_id", "request_id", "payload", "received_at")
    stored = None
    if stored_request_ids is not None:
        seen = stored_request_ids.select("request_id").distinct().withColumn("_seen", F.lit(True))
        known = todo.join(seen, "request_id", "left")
        stored = known.where("_seen").drop("_seen")
        todo = known.where("_seen is null").drop("_seen")
    return Reprocessed(normalize(todo, registry, **kw), pending, stored)



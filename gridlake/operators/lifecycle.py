"""Raw table lifecycle.

The raw table is append-only and never updated: processing results go to an
append-only status log ``raw_status(raw_id, processed, error, attempts, at,
seq)``, and the current state of a raw row is its status entry with the
highest ``seq`` (W7).  Retention writes a new snapshot instead of deleting in
place.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import ERR_UNKNOWN_RAW_ID, RATE_INTERVAL_SECONDS, RETRY_BATCH, STORE_TYPE
from ..functions.timefn import micros
from .intake import parse


# ------------------------------------------------------------------ landing

def land(payloads: DataFrame, keep_parsed: bool = False) -> DataFrame:
    """Payload rows -> raw rows with request id (P20) and receive date.

    ``raw_id`` is assigned by the caller before landing (a stable id such as
    a source offset), so a re-run lands the same ids.  ``keep_parsed`` also
    returns the parsed payload (``v``, ``is_object``) for a run that goes on
    with these very rows, so that no text is parsed twice.
    """
    source_ip = F.coalesce(F.col("source_ip"), F.lit("")) if "source_ip" in payloads.columns else F.lit("")
    staged = parse(payloads.select("raw_id", "payload", "received_at", source_ip.alias("source_ip")),
                   keep=("source_ip",))
    out = staged.select("raw_id", "request_id", "payload", "received_at", "source_ip",
                        F.to_date("received_at").alias("received_date"),
                        *(("v", "is_object") if keep_parsed else ()))
    return out


def write_raw(raw: DataFrame, path: str, mode: str = "append") -> None:
    """Append raw rows, one folder per receive date."""
    raw.write.mode(mode).partitionBy("received_date").parquet(path)


def by_time_range(raw: DataFrame, start: datetime, end: datetime, limit: int) -> DataFrame:
    """Raw rows with start <= received_at <= end, newest first, at most ``limit``."""
    cond = F.col("received_at").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    if "received_date" in raw.columns:
        cond = cond & F.col("received_date").between(F.lit(start.date()), F.lit(end.date()))
    return (raw.where(cond)
            .orderBy(F.col("received_at").desc(), F.col("raw_id").asc())
            .limit(limit))


# ------------------------------------------------------------------ status log

def landing_status(raw: DataFrame) -> DataFrame:
    """The first status entry of every landed row: pending, no attempt yet."""
    return raw.select("raw_id", F.lit(False).alias("processed"),
                      F.lit(None).cast("string").alias("error"),
                      F.lit(0).alias("attempts"), F.col("received_at").alias("at"),
                      F.lit(0).cast("bigint").alias("seq"))


def outcome_status(outcomes: DataFrame, attempt: int = 1, seq: int = 1,
                   at: Column | None = None) -> DataFrame:
    """Status entries of one processing run.

    reading -> processed; duplicate -> processed with its reason;
    reject -> still pending, with the error (so it is retried).
    """
    o = F.col("outcome")
    return outcomes.select(
        "raw_id",
        o.isin("reading", "duplicate").alias("processed"),
        F.col("error"),
        F.lit(attempt).alias("attempts"),
        (at if at is not None else F.col("received_at")).alias("at"),
        F.lit(seq).cast("bigint").alias("seq"))


def status_entries(results: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Both entries of freshly landed and processed rows, landing and outcome, from one pass over ``results``.

    They carry ``received_at``, as the stored log does, and the ``keep`` columns.
    """
    settled = F.col("outcome").isin("reading", "duplicate")
    entry = "processed", "error", "attempts", "at", "seq"
    none = F.lit(None).cast("string")
    both = F.array(*[F.struct(*[c.alias(n) for n, c in zip(entry, values)]) for values in (
        (F.lit(False), none, F.lit(0), F.col("received_at"), F.lit(0).cast("bigint")),
        (settled, F.col("error"), F.lit(1), F.col("received_at"), F.lit(1).cast("bigint")))])
    return (results.select("raw_id", "received_at", *keep, F.inline(both))
            .select("raw_id", *entry, "received_at", *keep))


def mark(raw_ids: DataFrame, raw: DataFrame, processed: bool, error: str | None,
         status: DataFrame | None = None, at: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """Explicit status entries: mark processed / mark error / reset for reprocessing.

    Returns ``(entries, unknown)``.  Any landed id is valid, whatever its shape;
    ids that were never landed come back in ``unknown`` (``raw_id, error``), so
    nothing is lost silently.  With the current ``status`` the entries follow it
    in ``seq`` and keep counting attempts; a reset starts counting anew.  A status
    that stands for the landed rows too (``raw is status``) is looked up once for both.
    """
    ids = raw_ids.select("raw_id").distinct()
    reset = not processed and error is None
    if status is not None and raw is status:
        asked = ids.join(status.select("raw_id", F.col("attempts").alias("_n"), F.col("seq").alias("_s"),
                                       F.lit(True).alias("_landed")), "raw_id", "left")
        unknown, known = asked.where("_landed is null"), asked.where("_landed")
    else:
        landed = raw.select("raw_id").distinct()
        unknown, known = ids.join(landed, "raw_id", "left_anti"), ids.join(landed, "raw_id", "left_semi")
    unknown = unknown.select("raw_id", F.lit(ERR_UNKNOWN_RAW_ID).alias("error"))
    if status is not None:
        if raw is not status:
            known = known.join(status.select("raw_id", F.col("attempts").alias("_n"), F.col("seq").alias("_s")),
                               "raw_id", "left")
        attempts = F.lit(0) if reset else F.coalesce("_n", F.lit(0)) + 1
        seq = F.coalesce("_s", F.lit(0)) + 1
    else:
        attempts, seq = F.lit(0 if reset else 1), F.lit(1)
    entries = known.select(
        "raw_id", F.lit(processed).alias("processed"),
        F.lit(error).cast("string").alias("error"),
        attempts.cast("int").alias("attempts"),
        (F.lit(at).cast("timestamp") if at else F.current_timestamp()).alias("at"),
        seq.cast("bigint").alias("seq"))
    return entries, unknown


def current_status(log: DataFrame) -> DataFrame:
    """Latest status per raw row (W7): the entry with the highest ``(seq, at)``.

    A hash aggregation with a partial (map-side) step, so a raw id with many
    entries collapses before the shuffle.
    """
    timed = ["received_at"] if "received_at" in log.columns else []
    latest = F.max_by(F.struct("processed", "error", "attempts", "at", *timed), F.struct("seq", "at"))
    return (log.groupBy("raw_id")
            .agg(latest.alias("s"), F.max("seq").alias("seq"))
            .select("raw_id", "s.processed", "s.error", "s.attempts", "s.at", "seq", *(f"s.{c}" for c in timed)))


def with_status(raw: DataFrame, status: DataFrame) -> DataFrame:
    return raw.join(status.drop("at", "received_at"), "raw_id", "left")


def pending(raw: DataFrame, status: DataFrame, max_attempts: int | None = None) -> DataFrame:
    """Raw rows still to process: every unprocessed one.

    The count of attempts is information, not a limit; a caller that wants a
    limit passes ``max_attempts`` and finds the rest in :func:`exhausted`.
    """
    open_ = with_status(raw, status).where(~F.coalesce(F.col("processed"), F.lit(False)))
    if max_attempts is None:
        return open_
    return open_.where(F.coalesce(F.col("attempts"), F.lit(0)) < max_attempts)


def exhausted(raw: DataFrame, status: DataFrame, max_attempts: int) -> DataFrame:
    """Unprocessed rows that ``pending`` leaves out under the same limit."""
    return (with_status(raw, status)
            .where(~F.coalesce(F.col("processed"), F.lit(False))
                   & (F.coalesce(F.col("attempts"), F.lit(0)) >= max_attempts)))


def pending_oldest(raw: DataFrame, status: DataFrame, limit: int = RETRY_BATCH,
                   max_attempts: int | None = None) -> DataFrame:
    """The oldest ``limit`` pending rows."""
    return (pending(raw, status, max_attempts)
            .orderBy(F.col("received_at").asc(), F.col("raw_id").asc())
            .limit(limit))


# ------------------------------------------------------------------ stats

def raw_stats(status: DataFrame) -> DataFrame:
    """total_raw, unprocessed, with_errors, processed, processing_rate (G3), one pass."""
    total = F.count("*")
    unprocessed = F.count_if(~F.col("processed"))
    return status.agg(
        total.alias("total_raw"),
        unprocessed.alias("unprocessed"),
        F.count_if(F.col("error").isNotNull() & (F.col("error") != "")).alias("with_errors"),
        (total - unprocessed).alias("processed"),
        F.when(total == 0, F.lit(0.0))
         .otherwise((total - unprocessed) / total * 100).alias("processing_rate"))


def ingest_stats(outcomes: DataFrame, fault: Column) -> DataFrame:
    """Ingest counters (G2) from one processing run.

    ``outcomes`` carries ``outcome`` (reading / reject / duplicate) and
    ``fault`` is evaluated on reading rows.  fault = any alarm > 0, normal =
    total - fault (Q4).
    """
    is_reading = F.col("outcome") == "reading"
    total = F.count_if(is_reading)
    faults = F.count_if(is_reading & fault)
    inserted = total
    failed = F.count_if(F.col("outcome") != "reading")
    return outcomes.agg(
        total.alias("total_records"),
        (total - faults).alias("normal_records"),
        faults.alias("fault_records"),
        inserted.alias("inserted_count"),
        failed.alias("failed_count"),
        F.count_if(F.col("outcome").isNull()).alias("buffer_size"),
        F.when(inserted + failed == 0, F.lit(100.0))
         .otherwise(inserted / (inserted + failed) * 100).alias("success_rate"),
        F.lit(STORE_TYPE).alias("database_type"))


def ingest_rate(outcomes: DataFrame, seconds: int = RATE_INTERVAL_SECONDS) -> DataFrame:
    """Received / processed per second and failures per ``seconds`` window."""
    w = F.window("received_at", f"{seconds} seconds")
    return (outcomes.groupBy(w.alias("w"))
            .agg(F.count("*").alias("received"),
                 F.count_if(F.col("outcome") == "reading").alias("processed"),
                 F.count_if(F.col("outcome") != "reading").alias("failed"))
            .select(F.col("w.start").alias("window_start"), "received", "processed", "failed",
                    (F.col("received") / F.lit(float(seconds))).alias("received_per_sec"),
                    (F.col("processed") / F.lit(float(seconds))).alias("processed_per_sec")))


# ------------------------------------------------------------------ retention

def retention(raw: DataFrame, status: DataFrame, cutoff: datetime) -> tuple[DataFrame, DataFrame]:
    """(kept rows, deleted count): processed rows received strictly before ``cutoff`` go.

    Pending rows are kept whatever their age.  Only rows up to the cutoff's date
    are joined with the status; later ones pass as they are.
    """
    upto = F.col("received_date") <= F.lit(cutoff.date())
    old = with_status(raw.where(upto), status)
    drop = ((F.col("received_at") < F.lit(cutoff).cast("timestamp"))
            & F.coalesce(F.col("processed"), F.lit(False)))
    kept = old.where(~drop).select(*raw.columns).unionByName(
        raw.where(~upto | F.col("received_date").isNull()))
    deleted = old.where(drop).agg(F.count("*").alias("deleted"))
    return kept, deleted


def apply_retention(table, status: DataFrame, cutoff: datetime) -> int:
    """Delete processed rows before ``cutoff`` from a stored raw table; return how many.

    ``table`` is a :class:`~gridlake.sources.versions.VersionedTable`.  Only parts
    that begin before the cutoff are read and joined.  Dates that lose some rows
    are written anew beside the table, dates that lose all are only left out of
    the next version, and one commit switches to it: a job lost anywhere before
    has changed nothing, readers of the version before go on with its files, and
    those are deleted later by ``table.vacuum()``.
    """
    base = table.version()
    old = [p for p in table.parts(base) if p.first is not None and p.first < micros(cutoff)]
    joined = with_status(table.of_parts(old), status)
    drop = ((F.col("received_at") < F.lit(cutoff).cast("timestamp"))
            & F.coalesce(F.col("processed"), F.lit(False)))
    counts = {r[0].isoformat(): (r["gone"], r["kept"]) for r in joined.groupBy(table.date).agg(   # a row a date
        F.count_if(drop).alias("gone"), F.count_if(~drop).alias("kept")).collect()}
    touched = {d for d, (gone, _) in counts.items() if gone}
    if not touched:
        return 0
    mixed = [p for p in old if p.date in touched and counts[p.date][1]]
    stay = with_status(table.of_parts(mixed), status).where(~drop).select(*table.schema.names)
    table.commit(table.stage(stay) if mixed else [], [p for p in old if p.date in touched], base)
    return sum(gone for gone, _ in counts.values())


# ------------------------------------------------------------------ reconciliation

def reconcile(outcomes: DataFrame, readings: DataFrame) -> DataFrame:
    """inserted vs stored: inserted, total_records, discrepancy, missing.

    ``missing`` counts rows reported as inserted whose request id has no
    stored reading.  One full outer join on request_id and one aggregation; no one-row joins.
    """
    inserted = (outcomes.where(F.col("outcome") == "reading")
                .select("request_id", F.lit(True).alias("_i")))
    stored = readings.select("request_id", F.lit(True).alias("_s"))
    both = inserted.join(stored, "request_id", "full_outer")
    i, s = F.col("_i").isNotNull(), F.col("_s").isNotNull()
    return both.agg(
        F.count_if(i).alias("inserted_count"),
        F.count_if(s).alias("total_records"),
        (F.count_if(i) - F.count_if(s)).alias("discrepancy"),
        F.count_if(i & ~s).alias("missing"))


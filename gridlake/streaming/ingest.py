"""Continuous ingest as a Structured Streaming job.

``readStream`` (files) -> land -> keyed state -> ``foreachBatch``.

Request ids are unique for all time (T4, W8).  The stream itself tells which ids
it has never seen: a ``dropDuplicates`` on the id alone, without watermark, whose
state is a RocksDB store partitioned by the id's hash and kept in the
checkpoint.  A batch looks up its own ids in its own partitions, point by point,
whatever has been stored before, and a replayed batch starts from the state
before it and gets the same answer.  Its rows and the new ids arrive together
in ``foreachBatch``; of several rows with one new id the first by
``(received_at, raw_id)`` counts (T2), all others are duplicates.

Every micro-batch and its results are written to the scratch folder once and read from
there, so an executor's memory does not follow the size of a batch.  A batch re-reads the registry (T3), lands its rows, and is cut into
flushes of at most ``batch_size`` records (S16).  One job a table writes the
readings, rejects, status entries and counters of all flushes beside the tables,
a folder a flush; a flush is then moved into place alone, its row of counters last, which is
its commit: when a batch is replayed, committed flushes are left alone and
the others get the same folders again.  Strict mode refuses a batch before
anything is written.  The trigger plays the role of the batch writer's timer:
``processingTime`` for a flush interval, ``availableNow`` to drain and stop.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..catalog import (BATCH_SIZE_BOUNDS, DEFAULT_FLUSH_INTERVAL_MS, ERR_DUPLICATE, FLUSH_INTERVAL_MS_BOUNDS,
                       RATE_INTERVAL_SECONDS)
from ..operators import lifecycle as L
from ..operators import metrics as M
from ..operators.intake import request_id_of
from ..plans.normalize import as_readings, normalize
from ..session import prepare, scratch_path, shuffles_freed
from ..sources.files import Files
from ..sources.sinks import write_readings
from .flush import cut

ROWS_PER_TASK = 50_000
FINEST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
TABLES = ("readings", "rejects", "status", "batches")       # in the order in which a flush gets them

RAW_INPUT_SCHEMA = "raw_id string, payload string, received_at timestamp"

ROCKSDB = "spark.sql.streaming.stateStore.rocksdb"

# Settings of the keyed state, read when a query starts.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{ROCKSDB}.changelogCheckpointing.enabled": "true",
    f"{ROCKSDB}.blockCacheSizeMB": "2",
}

# An executor keeps the write buffers of all its state partitions, outside the heap: two of
# 64 MB each if left alone.  Together they get about this much, whatever their number.
STATE_BUFFERS_MB = 256
STATE_BUFFER_MB_BOUNDS = 1, 8


def state_conf(spark: SparkSession) -> dict[str, str]:
    """Settings of the keyed state for a query with the session's number of state partitions."""
    lo, hi = STATE_BUFFER_MB_BOUNDS
    each = STATE_BUFFERS_MB // int(spark.conf.get("spark.sql.shuffle.partitions"))
    return {**STATE_CONF, f"{ROCKSDB}.writeBufferSizeMB": str(min(max(each, lo), hi))}


@dataclass
class StreamConfig:
    """``sink``: folder of raw/, readings/, rejects/, status/ and batches/.

    ``batch_size``: most records of a flush; None makes a micro-batch one flush.
    """
    sink: str
    checkpoint: str
    flush_interval_ms: int = DEFAULT_FLUSH_INTERVAL_MS
    batch_size: int | None = None
    max_files_per_trigger: int | None = None
    strict: bool = False
    default_source: str | None = None
    extra: dict = field(default_factory=dict)

    def __post_init__(self):
        lo, hi = FLUSH_INTERVAL_MS_BOUNDS
        if not lo <= self.flush_interval_ms <= hi:
            raise ValueError(f"flush interval must be within {lo}-{hi} ms")
        lo, hi = BATCH_SIZE_BOUNDS
        if self.batch_size is not None and not lo <= self.batch_size <= hi:
            raise ValueError(f"batch size must be within {lo}-{hi} records")

    def path(self, name: str) -> str:
        return f"{self.sink.rstrip('/')}/{name}"


def with_new_ids(stream: DataFrame) -> DataFrame:
    """Landed rows, and a row ``is_new`` for each request id that the stream has never carried before."""
    rows = L.land(stream.withColumn("source_ip", F.lit("")))
    fresh = rows.select("request_id").dropDuplicates(["request_id"])
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields if f.name != "request_id"]
    return rows.withColumn("is_new", F.lit(False)).unionByName(
        fresh.select("request_id", *empty).withColumn("is_new", F.lit(True)))


def make_batch_writer(cfg: StreamConfig, registry_loader: Callable[[SparkSession], DataFrame]):
    """The foreachBatch function of the ingest stream (over :func:`with_new_ids`)."""

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        with shuffles_freed(batch.sparkSession):
            settle(batch, batch_id)

    def settle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prepare(spark)
        held = Files(spark, scratch_path(spark, "batch"))
        try:
            batch = _held(batch, held, "rows")                  # the state is asked once
            if not (rows := batch.count()):
                return
            landed = batch.where(~F.col("is_new")).drop("is_new")
            # tasks by rows: the runtime plan would merge them by compressed bytes
            tasks = -(-rows // ROWS_PER_TASK)
            ranges = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
            spark.conf.set(FINEST, ranges)                      # of the batch's own session; small ones are merged
            known = landed.repartition(tasks, "request_id").join(
                batch.where("is_new").select("request_id", "is_new").repartition(tasks, "request_id"), "request_id", "left")
            known = _held(known.select(*landed.columns, "is_new"), held, "known")     # new and late rows come from one join
            landed = known.drop("is_new")
            held.delete("rows")
            run = normalize(known.where("is_new").select(*landed.columns), registry_loader(spark),
                            default_source=cfg.default_source)
            late = known.where("is_new is null").select(
                "raw_id", "request_id", "payload", "received_at", F.lit("duplicate").alias("outcome"),
                F.lit(ERR_DUPLICATE).alias("error"), F.lit(False).alias("fault"))
            results = run.results.unionByName(late, allowMissingColumns=True)
            if cfg.batch_size is None:
                results = results.withColumn("flush", F.lit(0).cast("bigint"))
            else:
                flushes = cut(landed.select("raw_id", "received_at"), cfg.batch_size, "received_at", "raw_id",
                              ranges=ranges, path=f"{held.root}/numbered")
                results = results.join(flushes.select("raw_id", "flush"), "raw_id").hint("rebalance", F.col("flush"))
            results = _held(results, held, "results")
            sizes = {r["flush"]: r for r in results.groupBy("flush").agg(         # a row a flush
                F.count("*").alias("n"), F.count_if(F.col("outcome") == "reject").alias("bad")).collect()}
            if cfg.strict and (n_bad := sum(r["bad"] for r in sizes.values())):
                raise RuntimeError(f"strict mode: {n_bad} rejected payloads in batch {batch_id}")
            L.write_raw(landed, f"{cfg.path('raw')}/batch_id={batch_id}", mode="overwrite")   # S2/S3
            log = Files(spark, cfg.path("batches"))
            begun = set(log.names(f"batch_id={batch_id}"))
            done = [f for f in sizes if f"flush={f}" in begun and any(
                name.startswith("part-") for name in log.names(f"batch_id={batch_id}/flush={f}"))]
            if len(done) < len(sizes):
                if done:
                    results = results.where(~F.col("flush").isin(done))
                _stage(spark, cfg, results, batch_id)
                for flush in sorted(sizes.keys() - set(done)):
                    _write_flush(spark, cfg, results, batch_id, flush, sizes[flush]["n"])
                for name in TABLES:
                    Files(spark, cfg.path(name)).delete(_staged(batch_id))
        finally:
            held.delete("")

    return write_batch


def _held(rows: DataFrame, folder: Files, name: str) -> DataFrame:
    """``rows`` written under ``folder`` and read again, a task a file, so that tasks stay as they were written."""
    spark = rows.sparkSession
    rows.write.option("compression", "zstd").parquet(f"{folder.root}/{name}")
    spark.conf.set("spark.sql.files.openCostInBytes", spark.conf.get("spark.sql.files.maxPartitionBytes"))
    return spark.read.schema(rows.schema).parquet(f"{folder.root}/{name}")


def _staged(batch_id: int) -> str:
    """Where a table's flushes lie until they are moved (hidden from readers of the table)."""
    return f"_staged/batch_id={batch_id}"


def _stage(spark: SparkSession, cfg: StreamConfig, results: DataFrame, batch_id: int) -> None:
    """Write the flushes of ``results`` beside the tables, one job a table however many flushes there are.

    Rows of a flush lie together already (see the rebalance), so no table brings them together again.
    """
    cut_up = cfg.batch_size is not None

    def write(rows: DataFrame, name: str) -> None:
        path = f"{cfg.path(name)}/{_staged(batch_id)}"
        if cut_up:
            rows.sortWithinPartitions("flush").write.mode("overwrite").partitionBy("flush").parquet(path)
        else:
            rows.drop("flush").write.mode("overwrite").parquet(f"{path}/flush=0")
    readings = as_readings(results.where("outcome = 'reading'"), keep=("flush",))
    path = f"{cfg.path('readings')}/{_staged(batch_id)}"
    if cut_up:
        write_readings(readings, path, mode="overwrite", within="flush")
    else:
        write_readings(readings.drop("flush"), f"{path}/flush=0", mode="overwrite")
    rejects = results.where("outcome = 'reject'").select(
        "raw_id", "request_id", "payload", "error", "received_at", "flush")
    write(rejects, "rejects")
    if cut_up and not any(n.startswith("flush=") for n in Files(spark, cfg.path("rejects")).names(_staged(batch_id))):
        first = results.agg(F.min("flush")).first()[0]         # the table has a file, and so its columns, without rows too
        rejects.limit(0).drop("flush").write.parquet(f"{cfg.path('rejects')}/{_staged(batch_id)}/flush={first}")
    write(L.status_entries(results, keep=("flush",)), "status")
    write(M.count_outcomes(results, "flush"), "batches")


def _write_flush(spark: SparkSession, cfg: StreamConfig, results: DataFrame, batch_id: int, flush: int, n: int) -> None:
    """Move the flush of ``n`` rows of ``results``, which :func:`_stage` has written, into the tables."""
    for name in TABLES:
        Files(spark, cfg.path(name)).move(f"{_staged(batch_id)}/flush={flush}", f"batch_id={batch_id}/flush={flush}")


def start_ingest(spark: SparkSession, source_dir: str, cfg: StreamConfig,
                 registry_loader: Callable[[SparkSession], DataFrame], *,
                 available_now: bool = False):
    """Start the ingest stream over parquet files of raw rows."""
    reader = spark.readStream.schema(RAW_INPUT_SCHEMA)
    if cfg.max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", cfg.max_files_per_trigger)
    stream = with_new_ids(reader.parquet(source_dir))
    writer = (stream.writeStream.foreachBatch(make_batch_writer(cfg, registry_loader))
              .option("checkpointLocation", cfg.checkpoint))
    if available_now:
        writer = writer.trigger(availableNow=True)
    else:
        writer = writer.trigger(processingTime=f"{cfg.flush_interval_ms} milliseconds")
    return _start(spark, writer)


def _start(spark: SparkSession, writer):
    """Start a query with the keyed-state settings, which it keeps; the session's own stay as they were."""
    conf = state_conf(spark)
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def dedupe_stream(stream: DataFrame, delay: str | None = "10 minutes") -> DataFrame:
    """Stateful duplicate suppression by request id (T4): within a watermark, or for all time (``delay=None``)."""
    v = F.try_parse_json(F.col("payload"))
    keyed = stream.withColumn("request_id", request_id_of(v, F.col("raw_id")))
    if delay is None:
        return keyed.dropDuplicates(["request_id"])
    return keyed.withWatermark("received_at", delay).dropDuplicatesWithinWatermark(["request_id"])


def stream_ingest_rate(stream: DataFrame, delay: str = "1 minute",
                       seconds: int = RATE_INTERVAL_SECONDS) -> DataFrame:
    """Received payloads per ``seconds`` tumbling window, emitted once final (T5)."""
    return (stream.withWatermark("received_at", delay)
            .groupBy(F.window("received_at", f"{seconds} seconds").alias("w"))
            .agg(F.count("*").alias("received"))
            .select(F.col("w.start").alias("window_start"), "received",
                    (F.col("received") / F.lit(float(seconds))).alias("received_per_sec")))


def start_rate(spark: SparkSession, source_dir: str, sink: str, checkpoint: str, *, delay: str = "1 minute",
               seconds: int = RATE_INTERVAL_SECONDS, available_now: bool = False):
    """Keep the ingest rate in a table: every batch writes the windows it changed into its own folder."""
    stream = spark.readStream.schema(RAW_INPUT_SCHEMA).parquet(source_dir)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    writer = (stream_ingest_rate(stream, delay, seconds).writeStream.outputMode("update").foreachBatch(write)
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{seconds} seconds")
    return _start(spark, writer)


def read_rates(spark: SparkSession, sink: str) -> DataFrame:
    """The windows of :func:`start_rate`, each as last written."""
    return (spark.read.parquet(sink).groupBy("window_start")
            .agg(F.max_by("received", "batch_id").alias("received"),
                 F.max_by("received_per_sec", "batch_id").alias("received_per_sec")))


def batches(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """A row of counters per committed flush."""
    return M.read_batches(spark, cfg.path("batches"))


def batch_stats(spark: SparkSession, cfg: StreamConfig) -> DataFrame:
    """Writer counters over all flushes: batches, records, last flush."""
    return M.batch_stats(batches(spark, cfg))


# ------------------------------------------------------------------ from batches to tables

def finished(spark: SparkSession, cfg: StreamConfig) -> int:
    """The last batch that the stream has finished, by its checkpoint; -1 if there is none."""
    done = Files(spark, cfg.checkpoint).names("commits")
    return max((int(n) for n in done if n.isdigit()), default=-1)


def publish(spark: SparkSession, cfg: StreamConfig, tables) -> int:
    """Move finished batches into the stored tables of a :class:`~gridlake.plans.lake.Lake`; return the last one.

    The stream writes small folders a batch; here many of them become a segment of
    a table, its rows brought together by date.  Each table's version notes the batch
    it has come to, in the same commit that adds the rows, so a job that is lost and
    run again adds no batch twice.  Status entries are added before the note of
    their table and may be added twice, which changes nothing that is read.
    """
    last = finished(spark, cfg)

    def since(folder: str, done: int) -> DataFrame | None:
        names = [n for n in Files(spark, cfg.path(folder)).names("") if n.startswith("batch_id=")
                 and done < int(n.split("=")[1]) <= last]
        return spark.read.option("basePath", cfg.path(folder)).parquet(*[f"{cfg.path(folder)}/{n}" for n in names]) \
            if names else None
    rows = since("status", tables.raw.note().get("through", -1))
    if rows is not None:
        tables.status.append(rows.drop("batch_id", "flush"))
    for folder, table in (("readings", tables.readings), ("raw", tables.raw)):
        rows = since(folder, table.note().get("through", -1))
        if rows is not None:
            table.append(rows, {"through": last})
    return last


# ------------------------------------------------------------------ bounded runs

@dataclass
class Drained:
    """What a bounded run of the stream has left in its sink."""
    spark: SparkSession
    cfg: StreamConfig

    def readings(self) -> DataFrame:
        return self.spark.read.parquet(self.cfg.path("readings")).drop("batch_id", "flush", "ts_date")

    def status(self) -> DataFrame:
        return self.spark.read.parquet(self.cfg.path("status"))

    def batches(self) -> DataFrame:
        return batches(self.spark, self.cfg)


def drain(spark: SparkSession, deliveries: list[DataFrame], registry: DataFrame, *,
          max_files_per_trigger: int | None = None, batch_size: int | None = None) -> Drained:
    """Deliver raw rows one frame after the other to an ingest stream that drains and stops after each.

    The stream goes on from its checkpoint, so what it knows of earlier deliveries
    is in its state alone.
    """
    prepare(spark)
    base = scratch_path(spark, "stream")
    reg_path = f"{base}/registry"
    registry.write.mode("overwrite").parquet(reg_path)
    cfg = StreamConfig(sink=f"{base}/sink", checkpoint=f"{base}/checkpoint", batch_size=batch_size,
                       max_files_per_trigger=max_files_per_trigger)
    for rows in deliveries:
        rows.select("raw_id", "payload", "received_at").write.mode("append").parquet(f"{base}/input")
        _await(start_ingest(spark, f"{base}/input", cfg, lambda s: s.read.parquet(reg_path), available_now=True))
    return Drained(spark, cfg)


def _await(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


def run_available_now(spark: SparkSession, raw_rows: DataFrame, registry: DataFrame,
                      max_files_per_trigger: int = 4) -> DataFrame:
    """Drain ``raw_rows`` with an availableNow stream and return the readings it wrote.

    Input files are split by request id, so every resend sits in the same file as
    its first copy (file order across a stream is not a time order); there are as
    many as the session's shuffle has partitions.
    """
    prepare(spark)
    by_id = L.land(raw_rows).repartition("request_id")
    return drain(spark, [by_id], registry, max_files_per_trigger=max_files_per_trigger).readings()


def run_rate(spark: SparkSession, deliveries: list[DataFrame], *, delay: str = "1 minute",
             seconds: int = RATE_INTERVAL_SECONDS) -> DataFrame:
    """The ingest rate of raw rows delivered one frame after the other."""
    prepare(spark)
    base = scratch_path(spark, "rate")
    for rows in deliveries:
        rows.select("raw_id", "payload", "received_at").write.mode("append").parquet(f"{base}/input")
        _await(start_rate(spark, f"{base}/input", f"{base}/rates", f"{base}/checkpoint", delay=delay,
                          seconds=seconds, available_now=True))
    return read_rates(spark, f"{base}/rates")

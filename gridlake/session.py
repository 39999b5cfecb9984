"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC instants, AQE (runtime coalescing and skew
# splitting), and a broadcast threshold that is a size check, not a guess.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


JIT_FLAGS = "-XX:-DontCompileHugeMethods"


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "gridlake", extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster supplies its own)."""
    builder = (SparkSession.builder.master(master).appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               # generated code for wide mapping projections exceeds the JIT's
               # 8000-byte method limit; let HotSpot compile it anyway
               .config("spark.driver.extraJavaOptions", JIT_FLAGS)
               .config("spark.executor.extraJavaOptions", JIT_FLAGS))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the engine's semantics depend on."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the cluster.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; it is an error if it does not.  Only a local session without it (tests)
    gets a folder here, which its context then keeps.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect has no SparkContext
            current = None
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="gridlake-ckpt-")
    try:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(current)
    except Exception:  # Spark Connect has no SparkContext
        pass
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession):
    """Each query run inside gives its shuffle files back when it ends, not when the driver collects its garbage.

    For writes of tables that are read again in place of their plan.
    """
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE_SHUFFLES, before) if before is not None else spark.conf.unset(FREE_SHUFFLES)


__all__ = ["build_session", "prepare", "ensure_checkpoint_dir", "scratch_path", "shuffles_freed",
           "SESSION_CONF"]

"""Helpers shared by the corpus operators.

Tables are read with Spark's readers only.  Intermediate tables that cut
lineage are written under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never to a machine-local one.
"""

from __future__ import annotations

import os
import tempfile
import zipfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlake.session import scratch_path, shuffles_freed


_shipped: set[str] = set()


#: Rows of an Arrow batch; with texts of a few kilobytes, a few megabytes.
BATCH_ROWS = 1000


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application (as ``--py-files`` would).

    Also keeps Arrow batches small, since rows here are whole texts.
    """
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) != BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="gridlake-py-"), "gridlake.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str, bucket_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (survives lost executors).

    The shuffle files of the write go with its end, so a chain of tables holds those of
    one write at a time.  With ``bucket_by`` the files are bucketed like a shuffle of that column, so
    joins on it leave them in place.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.option("compression", "zstd")
    if bucket_by is None:
        with shuffles_freed(spark):
            writer.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    table_name = path.rsplit("/", 1)[1].replace("-", "_")
    with shuffles_freed(spark):
        (writer.bucketBy(shuffle_partitions(spark), bucket_by).format("parquet").option("path", path)
         .saveAsTable(table_name))
    return spark.table(table_name)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --------------------------------------------------------------- components

def _roots(a: np.ndarray, b: np.ndarray):
    """Smallest member of each connected set of the edges: (nodes, roots)."""
    nodes, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = inv[:len(a)], inv[len(a):]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, root):
            return nodes, nodes[root]
        root = new


EDGES_PER_PASS = 1 << 20
SALTS = 32           # tasks among which the edges of one root are dealt


def _contract(batches):
    """Replace a task's edges by star edges to the smallest member of each set they connect.

    Edges come ordered by ``a``; runs of about ``EDGES_PER_PASS`` are contracted
    at a time, all edges of one ``a`` together.  ``moved`` says whether a run was
    anything but such stars before.
    """
    def flush(a, b):
        nodes, roots = _roots(a, b)
        keep = nodes != roots
        edges = np.unique(np.stack([a, b], axis=1)[a != b], axis=0)
        at = np.searchsorted(nodes, edges[:, 0])
        moved = len(edges) != keep.sum() or not np.array_equal(roots[at], edges[:, 1])
        return pa.RecordBatch.from_arrays(
            [pa.array(nodes[keep]), pa.array(roots[keep]), pa.array(np.full(keep.sum(), moved))],
            names=["a", "b", "moved"])

    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held = []
    for batch in batches:
        if batch.num_rows:
            held.append((batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)))
        if sum(len(h[0]) for h in held) >= EDGES_PER_PASS:
            a, b = (np.concatenate(c) for c in zip(*held))
            cut = int(np.searchsorted(a, a[-1]))          # the last node may go on
            if cut:
                yield flush(a[:cut], b[:cut])
            held = [(a[cut:], b[cut:])]
    if held:
        yield flush(*(np.concatenate(c) for c in zip(*held)))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (first two columns: node ids, bigint).

    Returns ``(id, component)`` for every node that has an edge; ``component``
    is the smallest id reachable.  A round brings the edges of each node together,
    contracts every task's edges to stars, and lets each node follow its root's
    own edge, until nothing moves (about the logarithm of the longest chain).
    After a contraction a node has at most one edge a task, so a hub never
    gathers more edges than there are tasks; nothing goes to the driver but
    two counts a round.  Each round is written to the shared folder.  Edges
    with a null end and self edges are ignored.
    """
    x, y = edges.columns[:2]
    ends = [F.col(c).cast("bigint") for c in (x, y)]
    schema = "a bigint, b bigint, moved boolean"
    current = (edges.select(F.greatest(*ends).alias("a"), F.least(*ends).alias("b"))
               .where(ends[0].isNotNull() & ends[1].isNotNull() & (ends[0] != ends[1])).select("a", "b")
               .sortWithinPartitions("a").mapInArrow(_contract, schema))
    while True:
        stars = stored(current.select("a", "b").repartition("a").sortWithinPartitions("a")
                       .mapInArrow(_contract, schema), "components")
        # one pointer a node, so that the join gives as many rows as there are edges;
        # only roots that have one are looked up, each SALTS times, so that the edges of a
        # root with very many are dealt to that many tasks
        up = stars.groupBy(F.col("a").alias("b")).agg(F.min("b").alias("up"))
        moves = stars.select("b").distinct().join(up, "b")
        moves = moves.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        salted = stars.withColumn("salt", F.pmod(F.xxhash64("a"), F.lit(SALTS)).cast("int"))
        current = stored(salted.join(moves, ["b", "salt"], "left").select(
            "a", F.coalesce("up", "b").alias("b"), (F.col("moved") | F.col("up").isNotNull()).alias("moved")),
            "components")
        if current.where("moved").isEmpty():
            break
    members = current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.union(current.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())

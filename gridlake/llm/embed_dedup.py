"""Embedding near-dedup: sign hashing in several tables, exact cosine check, components.

1. Rows with bit-identical components are one class; a class is compared once
   and its links are multiplied by the sizes of the classes.
2. Random hyperplanes give each vector a sign pattern in each of several tables.
   Vectors that agree on a table's pattern are candidates.  The planes come from
   a fixed seed, so runs agree.  Signs a table grow with the logarithm of the
   number of classes, so that unrelated vectors fill a bucket with about
   ``BUCKET``, and tables with them, so that recall stays.
3. A large bucket is cut into blocks, and a tile is a pair of blocks of one
   bucket.  In a tile, cosines are one matrix product in double precision.  A
   pair that agrees on several tables is counted in the first of them only, so
   tiles return sums per vector and never a list of pairs.
4. For the components a tile returns a spanning forest of its links.

No bucket is capped: a hot one has more tiles, not fewer pairs.  A pair at
cosine c agrees on one sign with probability ``p = 1 - arccos(c) / pi`` and is
found with ``1 - (1 - p ** bits) ** tables``; tables are chosen so that this is at
least ``RECALL`` at the lowest cosine that links, and so more above it.

Cases: a vector that is null, empty, zero or holds a null or non-finite component
links with nothing (n_links 0, kept); vectors of different lengths never link;
each row counts as a vector, rows that repeat a vec_id are one node of the
components; a null vec_id is returned without links; extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, stored

MIN_COSINE = 0.9
RECALL = 0.97
BUCKET = 32
BLOCK = 1024
SEED = 20240229


def plan(n: int, min_cosine: float) -> tuple[int, int]:
    """(tables, bits) for ``n`` classes."""
    bits = min(max(round(math.log2(max(n, 1) / BUCKET)), 4), 40)
    agree = (1 - math.acos(min_cosine) / math.pi) ** bits
    return math.ceil(math.log(1 - RECALL) / math.log(1 - agree)), bits


def planes(dim: int, tables: int, bits: int) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, tables * bits))


def patterns(vectors: np.ndarray, tables: int, bits: int) -> np.ndarray:
    """Sign pattern of each row in each table."""
    signs = (vectors @ planes(vectors.shape[1], tables, bits)) >= 0
    return signs.reshape(len(vectors), tables, bits) @ (1 << np.arange(bits, dtype=np.int64))


def _matrix(column, kind: str) -> np.ndarray:
    """Packed vectors of one length as rows of doubles."""
    rows = list(column)
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, without overflow or underflow on the way."""
    v = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _hash_rows(tables: int, bits: int, kind: str):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, dup = batch["class_id"].to_numpy(), batch["dup"].to_numpy()
            raw = batch["raw"].to_pylist()
            out = [[], [], [], []]
            dims = np.array([len(r) for r in raw])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                pats = patterns(unit(_matrix([raw[i] for i in at], kind)), tables, bits)
                for c, x in zip(out, (np.repeat(ids[at], tables), np.repeat(dup[at], tables),
                                      np.tile(np.arange(tables), len(at)), (pats ^ (int(d) << 41)).ravel())):
                    c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in out],
                                             names=["class_id", "dup", "tab", "pattern"])
    return run


def _join(low: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each set of rows joined by the pairs (a, b), on top of ``low``."""
    while True:
        least = np.minimum(low[a], low[b])
        new = low.copy()
        for x in (a, b, low[a], low[b]):
            np.minimum.at(new, x, least)
        new = np.minimum(new, new[new])
        if np.array_equal(new, low):
            return low
        low = new


def _tile(tables: int, bits: int, limit: float, kind: str):
    """Rows of a tile -> (class_id, dup, links, parent): rows linked, and the smallest class joined."""
    def tile(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("class_id", "ascending"), ("dup", "ascending")])
        x, y, tab = (rows[c][0].as_py() for c in ("x", "y", "tab"))
        side = rows["block"].to_numpy()
        v = unit(_matrix(rows["raw"].to_pylist(), kind))
        pats = patterns(v, tables, bits)
        assert (pats[:, tab] == pats[0, tab]).all()
        ids, weight = rows["class_id"].to_numpy(), rows["weight"].to_numpy()
        left, right = np.flatnonzero(side == x), np.flatnonzero(side == y)
        links, low = np.zeros(len(ids), np.int64), np.arange(len(ids))
        for at in range(0, len(left), 256):         # bounds the working matrices
            l = left[at:at + 256]
            near = v[l] @ v[right].T >= limit
            if x == y:
                near &= l[:, None] != right[None, :]
            r, c = np.nonzero(near)
            a, b = l[r], right[c]
            fresh = (pats[a, :tab] != pats[b, :tab]).all(axis=1)      # not met in an earlier table
            a, b = a[fresh], b[fresh]
            np.add.at(links, a, weight[b])
            if x != y:
                np.add.at(links, b, weight[a])
            low = _join(low, a, b)
        some = links > 0
        return pa.table({"class_id": ids[some], "dup": rows["dup"].to_numpy()[some],
                         "links": links[some], "parent": ids[low[some]]})
    return tile


def near_duplicates(vectors: DataFrame, min_cosine: float = MIN_COSINE) -> DataFrame:
    """Per row of ``vectors(vec_id, embedding)``: vec_id, n_links, component_id, kept."""
    single = vectors.schema["embedding"].dataType.elementType.typeName() == "float"
    kind = "<f4" if single else "<f8"
    values = F.col("embedding").cast("array<double>")
    usable = (F.col("vec_id").isNotNull() & (F.size("embedding") > 0)
              & F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
              & F.exists(values, lambda x: x != 0))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding",
                          F.coalesce(usable, F.lit(False)).alias("usable"))

    def pack(batches):
        for batch in batches:
            raw = [(np.array(v.as_py(), kind) + 0).tobytes() for v in batch["embedding"]]     # -0 becomes 0
            yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(raw, pa.binary())], names=["vec_id", "raw"])

    packed = rows.where("usable").select("vec_id", "embedding").mapInArrow(pack, "vec_id bigint, raw binary")
    packed = stored(packed.withColumn("digest", F.sha2("raw", 256)), "embed-rows")
    # copies are one class, known by their smallest id (and a number, should that id have more vectors)
    classes = stored(packed.groupBy("digest").agg(F.min("vec_id").alias("class_id"), F.count("*").alias("weight"),
                                                  F.first("raw").alias("raw"))
                     .withColumn("dup", F.row_number().over(Window.partitionBy("class_id").orderBy("digest"))),
                     "embed-classes")
    tables, bits = plan(classes.count(), min_cosine)
    hashed = stored(classes.select("class_id", "dup", "raw").mapInArrow(
        _hash_rows(tables, bits, kind), "class_id bigint, dup int, tab bigint, pattern bigint"), "embed-hashes")
    sizes = hashed.groupBy("tab", "pattern").agg(F.count("*").alias("n")).where("n > 1")
    placed = (hashed.join(sizes, ["tab", "pattern"])
              .withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("bigint"))
              .withColumn("block", F.pmod(F.xxhash64("class_id", "dup", "tab"), F.col("blocks"))))
    # a row goes to the tiles of its block with every block of the bucket
    tiles = (placed.select("class_id", "dup", "tab", "pattern", "block",
                           F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other"))
             .select("class_id", "dup", "tab", "pattern", "block", F.least("block", "other").alias("x"),
                     F.greatest("block", "other").alias("y"))
             .join(classes.select("class_id", "dup", "raw", "weight"), ["class_id", "dup"]))
    found = stored(tiles.groupBy("tab", "pattern", "x", "y").applyInArrow(
        _tile(tables, bits, min_cosine, kind), "class_id bigint, dup int, links bigint, parent bigint"), "embed-links")
    links = found.groupBy("class_id", "dup").agg(F.sum("links").alias("links"))
    groups = (components(found.select("class_id", "parent"))
              .withColumnRenamed("id", "class_id"))
    per_class = (classes.select("digest", "class_id", "dup", "weight").join(links, ["class_id", "dup"], "left")
                 .join(groups, "class_id", "left")
                 .select("digest", F.coalesce("component", "class_id").alias("component_id"),
                         (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")))
    per_row = packed.select("vec_id", "digest").join(per_class, "digest").select("vec_id", "n_links", "component_id")
    alone = rows.where("not usable").select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                                            F.col("vec_id").alias("component_id"))
    return per_row.unionByName(alone).select("vec_id", "n_links", "component_id",
                                             (F.col("vec_id") == F.col("component_id")).alias("kept"))

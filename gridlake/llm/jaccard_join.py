"""N-gram Jaccard join: which documents have nearly the same set of word shingles.

Two documents link when the Jaccard similarity of their shingle sets is at least
``num / den``.  The result is each document's connected component, so a group of
copies is never expanded into pairs; no link between different texts is lost.

1. Sets.  Each document's shingles (hashes of ``k`` lower-cased words) give its
   set size and a digest of the set; documents with equal sets are one class.
2. Filter.  A document can only link if enough of its shingles occur elsewhere.
   Counted on the shingles whose hash falls in a fixed part of the range: of
   ``s`` such shingles at most ``(1 - t) * size`` may be missing in a partner, so
   documents with fewer than ``s - (1 - t) * size`` shared ones are done.  Texts
   that only share a passage with others stop here, however common it is.
3. Keys.  With ``m - 1`` the largest possible symmetric difference of two linked
   sets of a size band, dealing the hash range into ``m`` parts leaves at least
   one part equal in both.  A document has the digests of its parts in its own
   band and in the band below as keys; equal keys make candidate groups.
4. Tiles.  Candidate groups are cut into blocks by size; a tile is a pair of
   blocks whose size ranges are compatible.  In a tile a hashed parity bitmap of
   each set bounds the overlap from above (shared <= (|A| + |B| - differing
   bits) / 2), and pairs that pass are decided by exact intersection of the
   sorted shingle arrays.  Pairs that are already connected are skipped, so a
   group of thousands of near copies costs little more than a chain.
5. Verified links and equal sets are joined into components.

Cases: null or empty texts and texts without words have an empty set and link
with nothing; fewer than ``k`` words give one shingle, the whole sequence; rows
that repeat a doc_id are one document with the union of their links (each row
is returned); a null doc_id is returned with its size, a null component and no
links; a text of any length gives all its shingles, in its task; extra columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, stored
from .shared_keys import shared_keys
from .textnum import U64, mix, shingle_hashes, slices, word_hashes

BLOCK = 1 << 18           # shingles of a block of a tile, a document counting as DOC_COST more
DOC_COST = 512
BITS = 1024               # bits of a signature


def sets_of(data: np.ndarray, offsets: np.ndarray, k: int):
    """The sorted distinct shingle hashes of each text of a slice."""
    words, text = word_hashes(data, offsets)
    h, t = shingle_hashes(words, text, k)
    cuts = np.searchsorted(t, np.arange(len(offsets)))
    return [np.unique(h[a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def sampled(k: int, part: int):
    """Extractor of the shingles in one of ``part`` parts of the hash range."""
    limit = U64((1 << 64) // part - 1)

    def extract(data, offsets):
        words, text = word_hashes(data, offsets)
        h, t = shingle_hashes(words, text, k)
        keep = h <= limit
        return mix(h[keep]), t[keep]
    return extract


def band_end(low: int, num: int, den: int) -> int:
    """First size of the next band: a set of size ``low`` has no partner that large.

    Linked sets are therefore in the same or in neighbouring bands.
    """
    return max(low + 1, low * den // num + 1)


def bands(limit: int, num: int, den: int) -> np.ndarray:
    """First sizes of the bands up to ``limit``."""
    out = [1]
    while out[-1] <= limit:
        out.append(band_end(out[-1], num, den))
    return np.array(out)


def part_keys(shingles: np.ndarray, num: int, den: int) -> np.ndarray:
    """Digests of the parts of a set, in its band and in the band below."""
    size = len(shingles)
    starts = bands(size, num, den)
    own = int(np.searchsorted(starts, size, side="right")) - 1
    out = []
    for band in (own, own - 1):
        if band < 0:
            continue
        top = int(starts[band + 1] if band + 1 < len(starts) else band_end(int(starts[band]), num, den)) - 1
        # |A| <= top and |B| <= |A| * den / num, and the difference is at most
        # (|A| + |B|) * (den - num) / (den + num)
        parts = (top + top * den // num) * (den - num) // (den + num) + 1
        # Some more parts than that leave ``spare`` + 1 equal ones, so a set with at most
        # ``spare`` empty parts need not offer those: a partner shares a filled one, too.
        spare = parts // 8 + 1 if parts > 1 else 0
        parts += spare
        where = (mix(shingles + U64(band + 1)) % U64(parts)).astype(np.int64)
        order = np.argsort(where, kind="stable")
        where, hashes = where[order], mix(shingles[order] ^ U64(0x5851F42D4C957F2D))
        first = np.flatnonzero(np.append(True, where[1:] != where[:-1]))
        with np.errstate(over="ignore"):
            sums = np.add.reduceat(hashes, first)
            digest = np.zeros(parts, U64)          # a part without shingles counts as equal, too
            digest[where[first]] = mix(sums)
            label = np.arange(parts, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(band) * U64(0xD1B54A32D192ED03)
            keys = mix(digest + mix(label))
        empty = parts - len(first)
        out.append(keys[where[first]] if empty <= spare else keys)
    return np.concatenate(out)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Parity of the shingles that hash to each bit."""
    counts = np.bincount((mix(shingles) >> U64(54)).astype(np.int64) % BITS, minlength=BITS) & 1
    return np.packbits(counts.astype(np.uint8)).view(np.uint64)


class _Forest:
    def __init__(self, labels):
        index = {}
        self.up = np.array([index.setdefault(x, i) for i, x in enumerate(labels)])

    def root(self, i):
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i, j):
        self.up[max(i, j)] = min(i, j)


def linked_pairs(left: list, right: list, left_ids, right_ids, labels, num: int, den: int, same: bool):
    """Spanning links of a tile: pairs found linked and not connected before.

    ``labels``: of left then right; equal labels are already connected.
    """
    found = []
    sizes_l, sizes_r = np.array([len(x) for x in left]), np.array([len(x) for x in right])
    sig_r = np.stack([signature(x) for x in right])
    base = 0 if same else len(left)
    forest = _Forest(labels)
    for i, a in enumerate(left):
        lo = i + 1 if same else 0
        # size band, then the bitmap's bound
        js = np.arange(lo, len(right))
        total = sizes_l[i] + sizes_r[js]
        small, large = np.minimum(sizes_l[i], sizes_r[js]), np.maximum(sizes_l[i], sizes_r[js])
        js = js[small * den >= large * num]
        if not len(js):
            continue
        total = sizes_l[i] + sizes_r[js]
        differ = np.bitwise_count(sig_r[js] ^ signature(a)).sum(axis=1)
        bound = (total - differ) // 2
        js = js[den * bound >= num * (total - bound)]
        for j in js:
            x, y = forest.root(i), forest.root(base + j)
            if x == y:
                continue
            b = right[j]
            inter = len(np.intersect1d(a, b, assume_unique=True))
            if den * inter >= num * (len(a) + len(b) - inter):
                found.append((left_ids[i], right_ids[j]))
                forest.join(x, y)
    return found


def _text_sets(texts, k):
    out = []
    for _, data, offsets in slices(texts):
        out += sets_of(data, offsets, k)
    return out


def join(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, sample: int = 4) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id.

    ``sample``: the filter counts one shingle hash in so many; ``sample`` times
    (1 - num/den) must be below 1 for it to decide anything.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    plain = plain.withColumn("text_hash", F.xxhash64("text"))     # tells rows of one id apart
    limit = U64((1 << 64) // sample - 1)

    def describe(batches):
        for batch in batches:
            n, s, digest = [], [], []
            for _, data, offsets in slices(batch["text"]):
                for x in sets_of(data, offsets, k):
                    n.append(len(x)), s.append(int(np.searchsorted(x, limit, side="right")))
                    digest.append(hashlib.blake2b(x.tobytes(), digest_size=16).digest())
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], batch["text_hash"], pa.array(n, pa.int64()), pa.array(s, pa.int64()),
                 pa.array(digest, pa.binary())],
                names=["doc_id", "text_hash", "n_shingles", "n_sampled", "digest"])

    sizes = stored(plain.mapInArrow(describe, "doc_id bigint, text_hash bigint, n_shingles bigint, "
                                              "n_sampled bigint, digest binary"), "jaccard-sizes")
    usable = sizes.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    member = usable.join(classes.where("rep < last"), "digest").where("doc_id <> rep").select("doc_id", "rep")

    # documents that can have a partner with another set, one of each class
    counts = stored(shared_keys(plain.where("doc_id is not null"), sampled(k, sample), with_keys=False)
                    .groupBy("doc_id").agg(F.sum("n").alias("n_shared")), "jaccard-counts")
    per_doc = (usable.join(counts, "doc_id", "left")
               .where(f"coalesce(n_shared, 0) * {den} >= n_sampled * {den} - n_shingles * {den - num}"))
    able = (per_doc.join(classes, "digest").where("doc_id = rep")
            .groupBy("doc_id", "text_hash").agg(F.max("n_shingles").alias("size")))
    chosen = stored(able.join(plain.where("doc_id is not null"), ["doc_id", "text_hash"])
                    .dropDuplicates(["doc_id", "text_hash"]), "jaccard-able")

    edges = _candidate_edges(chosen, k, num, den)
    groups = components(edges).withColumnRenamed("id", "doc_id")
    links = _verified(chosen.join(groups, "doc_id"), k, num, den)
    found = components(links.union(member)).withColumnRenamed("id", "doc_id")
    return (sizes.join(found, "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))


def _candidate_edges(chosen: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """(doc, smallest doc of a shared key): connects all documents that share a key."""
    def keys(batches):
        for batch in batches:
            ids, out = batch["doc_id"].to_numpy(zero_copy_only=False), []
            owner = []
            for at, data, offsets in slices(batch["text"]):
                for i, x in enumerate(sets_of(data, offsets, k)):
                    if len(x):
                        p = part_keys(x, num, den)
                        out.append(p), owner.append(np.full(len(p), ids[at + i]))
            if out:
                key, doc = np.concatenate(out), np.concatenate(owner)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(doc)], names=["key", "doc_id"])

    keyed = chosen.select("doc_id", "text").mapInArrow(keys, "key bigint, doc_id bigint")
    low = keyed.groupBy("key").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    return (low.join(keyed, "key").where("doc_id <> low").select("doc_id", "low").distinct())


def _verified(grouped: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """Links of candidate groups ``(doc_id, size, text, component)``, spanning every true component.

    First each block alone, then the pairs of blocks that still hold different components.
    """
    base = stored(grouped.select("doc_id", "size", "text", "component"), "jaccard-groups")
    # Blocks: ranges of size within a group.  Ranks come from counts per size, not from
    # sorting a group in one task.
    cost = F.col("size") + DOC_COST
    counts = base.groupBy("component", "size").agg((F.count("*") * cost).alias("c"))
    totals = base.groupBy("component").agg(F.sum(cost).alias("total"))
    below = F.sum("c").over(Window.partitionBy("component").orderBy("size")) - F.col("c")
    ranked = counts.withColumn("below", below).join(totals, "component")
    placed = (base.join(ranked, ["component", "size"])
              .withColumn("block", ((F.col("below") + F.pmod(F.xxhash64("doc_id"), F.col("c"))) / BLOCK).cast("int")))

    def pairs_of(pairs):
        a, b = zip(*pairs) if pairs else ([], [])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    def alone(rows: pa.Table) -> pa.Table:
        sets, ids = _text_sets(rows["text"], k), rows["doc_id"].to_numpy()
        return pairs_of(linked_pairs(sets, sets, ids, ids, ids, num, den, same=True))

    first = stored(placed.select("component", "block", "doc_id", "size", "text")
                   .groupBy("component", "block").applyInArrow(alone, "a bigint, b bigint"), "jaccard-links")

    # Groups of more than one block: tiles of blocks with compatible sizes.
    wide = placed.where(F.col("total") > BLOCK)
    spans = wide.groupBy("component", "block").agg(F.min("size").alias("lo"), F.max("size").alias("hi"))
    if spans.isEmpty():
        return first
    now = components(first).withColumnRenamed("id", "doc_id").withColumnRenamed("component", "label")
    labelled = wide.join(now, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))
    kinds = labelled.groupBy("component", "block").agg(F.min("label").alias("l0"), F.max("label").alias("l1"))
    spans = spans.join(kinds, ["component", "block"])
    x, y = spans.alias("x"), spans.alias("y")
    tiles = (x.join(y, (F.col("x.component") == F.col("y.component")) & (F.col("x.block") < F.col("y.block"))
                    & (F.col("y.lo") * num <= F.col("x.hi") * den)
                    & ~((F.col("x.l0") == F.col("x.l1")) & (F.col("y.l0") == F.col("y.l1"))
                        & (F.col("x.l0") == F.col("y.l0"))))
             .select(F.col("x.component").alias("component"), F.col("x.block").alias("x"), F.col("y.block").alias("y")))
    sides = (tiles.select("component", "x", "y", F.explode(F.array("x", "y")).alias("block"))
             .join(labelled.select("component", "block", "doc_id", "size", "text", "label"), ["component", "block"]))

    def tile(rows: pa.Table) -> pa.Table:
        side = rows["block"].to_numpy() == rows["x"].to_numpy()
        l, r = rows.filter(pa.array(side)), rows.filter(pa.array(~side))
        labels = np.concatenate([l["label"].to_numpy(), r["label"].to_numpy()])
        if (labels == labels[0]).all():
            return pairs_of([])
        return pairs_of(linked_pairs(_text_sets(l["text"], k), _text_sets(r["text"], k), l["doc_id"].to_numpy(),
                                     r["doc_id"].to_numpy(), labels, num, den, same=False))

    across = sides.groupBy("component", "x", "y").applyInArrow(tile, "a bigint, b bigint")
    return first.union(stored(across, "jaccard-across"))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """``docs`` with one document of each group (the one with the smallest id); all columns stay.

    Rows with a null id, and all rows of the kept id, stay.
    """
    gone = join(docs, **how).where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


# The contract's case (three words, 0.9) in DuckDB SQL, over all pairs that share a shingle.
ORACLE = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
sizes AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM sets),
flat AS (SELECT DISTINCT doc_id, unnest(s) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * common >= 90 * (x.n + y.n - common)),
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM edges UNION SELECT r.a, e.b FROM reach r JOIN edges e ON r.b = e.a)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM sizes LEFT JOIN (SELECT a, min(b) AS low FROM reach GROUP BY a) ON a = doc_id
"""

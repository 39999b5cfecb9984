"""Source divergence audit: how far the wording of each source is from the others of its language.

K-squared quadtree over the group-term count matrix.  A group is a (lang,
source) pair.  Documents are counted into (group, term) cells, terms of fewer
than ``min_docs`` documents of their language go, and the matrix of a language
is dealt out in tiles: a pair of row blocks (sources, by hash) and a share of
the columns (terms, by hash).  A tile's counts become a tree of k x k quadrants
that holds nonzero quadrants only, and the tree is walked for two row quadrants
at a time: where both are zero the walk ends, since every cell there adds the
same constant, which is priced once for all such cells; where one holds
something the walk goes on to the cells.  All arithmetic is on integers.

Cases: null text, lang and source count as ''; a group without (kept) terms
still has its rows, its divergence being that of an even distribution; a
language without kept terms has pairs of value 0 and no term rows; a language of
one source has no pairs; doc_id and other columns are ignored, so repeated rows
are documents of their own; a text of any length is counted whole; ties in rank
go by the item's UTF-8 bytes; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

MIN_DOCS = 10                 # documents of its language that a kept term needs
TOP_TERMS = 10                # ranks of part `term`
PARTS = 1_000_000_000         # shares are in billionths
FLUSH_CELLS = 300_000         # cells that a task holds before it emits them
ROWS_PER_BLOCK = 64           # sources of a row block, about
CELLS_PER_TILE = 100_000      # nonzero cells of a tile, about
STATES = 1 << 17              # pairs of quadrants that the walk expands at a time

# Term bytes are letters and everything from 0x80 on; A-Z are lower-cased.
_TERM = bytes(b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x61 <= b <= 0x7A else 0x20 for b in range(256))

CELLS = "lang string, source string, term binary, count bigint, docs bigint"


def _cells(batches):
    """(lang, source, text) batches -> counts of a term in a group so far, and in how many documents.

    A row with an empty term marks that the group occurs.
    """
    counts, docs = defaultdict(Counter), defaultdict(Counter)

    def flush():
        for (lang, source), terms in counts.items():
            n = len(terms)
            seen = docs[lang, source]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * n, pa.string()), pa.array([source] * n, pa.string()),
                 pa.array(list(terms), pa.binary()), pa.array(list(terms.values()), pa.int64()),
                 pa.array([seen[t] for t in terms], pa.int64())],
                names=["lang", "source", "term", "count", "docs"])
        counts.clear(), docs.clear()

    held = 0
    for batch in batches:
        for lang, source, text in zip(*(c.to_pylist() for c in batch.columns)):
            group = lang, source
            terms = text.translate(_TERM).split()
            of_group = counts[group]
            held -= len(of_group)
            of_group[b""] += 0
            of_group.update(terms)
            docs[group].update(set(terms))
            held += len(of_group)
            if held > FLUSH_CELLS:
                yield from flush()
                held = 0
    yield from flush()


def cells(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, count, docs)`` over all documents; the row of term '' marks the group."""
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"),
                       text.alias("text")).mapInArrow(_cells, CELLS)
    return (rows.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("count").alias("count"), F.sum("docs").alias("docs")))


# ------------------------------------------------------------ exact shares

def div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(PARTS * (count + 2) / (total + 2 * terms))``, three digits at a time so that bigint does."""
    b = F.greatest(total + 2 * terms, F.lit(1))
    rest, out = count + 2, F.lit(0).cast("bigint")
    for _ in range(3):
        out = out * 1000 + div(rest * 1000, b)
        rest = (rest * 1000) % b
    return out + 1


def gap(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / (p + q))``; below 2^63 since shares are at most 10^9 + 1."""
    return div((p - q) * (p - q), p + q)


def shares(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    b = np.maximum(total + 2 * terms, 1)
    rest, out = count + 2, np.zeros(len(count), np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // b
        rest = rest % b
    return out + 1


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    d = p - q
    return d * d // (p + q)


# ------------------------------------------------------------ the tree

class QuadTree:
    """Nonzero quadrants of a matrix, k x k a node, level by level.

    ``masks[d][i]`` has a bit for each nonzero child of node ``i`` at depth
    ``d``; children of a level stand in the order of their parents and bits, so
    a child's number is its parent's ``first`` plus the set bits before its own.
    Nodes of the last depth are the cells, ``order`` gives the entry of each.
    """

    def __init__(self, rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, k: int = 2):
        self.k, self.depth = k, 1
        while k ** self.depth < max(n_rows, n_cols, 1):
            self.depth += 1
        path = np.zeros(len(rows), np.int64)
        for d in range(self.depth - 1, -1, -1):
            path = path * (k * k) + (rows // k ** d % k) * k + cols // k ** d % k
        self.order = np.argsort(path, kind="stable")
        path = path[self.order]
        self.masks, self.first = [], []
        for d in range(self.depth):
            below = path // (k * k) ** (self.depth - d - 1)
            below = below[np.flatnonzero(np.diff(below, prepend=-1))]
            node = below // (k * k)
            starts = np.flatnonzero(np.diff(node, prepend=-1))
            bits = np.left_shift(np.uint64(1), (below % (k * k)).astype(np.uint64))
            self.masks.append(np.bitwise_or.reduceat(bits, starts) if len(bits) else np.zeros(1, np.uint64))
            self.first.append(starts if len(starts) else np.zeros(1, np.int64))

    def child(self, depth: int, node: np.ndarray, bit: int) -> np.ndarray:
        """Number of each node's child, -1 where it is zero (or the node is)."""
        mask = np.where(node >= 0, self.masks[depth][node], np.uint64(0))
        before = np.bitwise_count(mask & np.uint64((1 << bit) - 1)).astype(np.int64)
        there = (mask >> np.uint64(bit)) & np.uint64(1) == 1
        return np.where(there, self.first[depth][node] + before, -1)


def joint_sums(tree: QuadTree, share_of: np.ndarray, zero: np.ndarray, split: int | None):
    """Walk the tree for pairs of rows: sums of gaps over cells where either row holds something.

    ``share_of``: share of each cell in tree order; ``zero``: share of a zero
    cell, by row.  Pairs are all ``g < h`` or, with ``split``, those of a row
    before ``split`` and one from it on.  Returns ``(sums, visited)``, R x R.
    """
    n, k = len(zero), tree.k
    sums, visited = np.zeros(n * n, np.int64), np.zeros(n * n, np.int64)
    one = np.zeros(1, np.int64)
    stack = [(0, one, one, one, one)]               # depth, node and row quadrant of both sides
    while stack:
        depth, x, y, i, j = stack.pop()
        if len(x) > STATES:
            stack += [(depth, x[a:a + STATES], y[a:a + STATES], i[a:a + STATES], j[a:a + STATES])
                      for a in range(0, len(x), STATES)]
            continue
        side = k ** (tree.depth - depth - 1)
        found = []
        for column in range(k):
            xs = [tree.child(depth, x, r * k + column) for r in range(k)]
            ys = [tree.child(depth, y, r * k + column) for r in range(k)]
            for a in range(k):
                for b in range(k):
                    i2, j2 = i * k + a, j * k + b
                    on = ((xs[a] >= 0) | (ys[b] >= 0)) & (i2 * side < n) & (j2 * side < n)
                    if split is None:
                        on &= (i2 < j2) if side == 1 else (i2 <= j2)
                    else:
                        on &= (i2 * side < split) & ((j2 + 1) * side > split)
                    found.append((xs[a][on], ys[b][on], i2[on], j2[on]))
        x, y, i, j = (np.concatenate(c) for c in zip(*found))
        if not len(x):
            continue
        if side > 1:
            stack.append((depth + 1, x, y, i, j))
            continue
        p = np.where(x >= 0, share_of[x], zero[i])
        q = np.where(y >= 0, share_of[y], zero[j])
        np.add.at(sums, i * n + j, gaps(p, q))
        np.add.at(visited, i * n + j, 1)
    return sums.reshape(n, n), visited.reshape(n, n)


PRICED = "lang string, g string, h string, value bigint, visited bigint, flat bigint, v bigint"


def _price(k: int):
    def price(key, tile):
        """Part of the divergence of every pair of the tile's sources (rows without a term name them)."""
        lang, a, b, _ = (x.as_py() for x in key)
        marks = tile.filter(pc.is_null(tile["term"]))
        block, names = marks["block"].to_pylist(), marks["source"].to_pylist()
        at = sorted(range(len(names)), key=lambda r: (block[r], names[r]))
        row_of = {names[r]: n for n, r in enumerate(at)}
        total = marks["n"].to_numpy()[at]
        v = marks["v"][0].as_py() if len(at) else 0
        split = None if a == b else sum(x == a for x in block)
        entries = tile.filter(pc.is_valid(tile["term"]))
        rows = np.array([row_of[s] for s in entries["source"].to_pylist()], np.int64)
        support = defaultdict(list)
        terms = entries["term"].to_pylist()
        for r, t in zip(rows.tolist(), terms):
            support[t].append(r)
        # columns of the same sources side by side, so that zero quadrants are large
        col_of = {t: n for n, t in enumerate(sorted(support, key=lambda t: sorted(support[t])))}
        cols = np.array([col_of[t] for t in terms], np.int64)
        tree = QuadTree(rows, cols, len(at), len(col_of), k)
        share_of = shares(entries["count"].to_numpy(), total[rows], v)[tree.order]
        zero = shares(np.zeros(len(at), np.int64), total, v)
        if len(rows):
            sums, visited = joint_sums(tree, share_of, zero, split)
        else:
            sums = visited = np.zeros((len(at), len(at)), np.int64)
        g, h = np.triu_indices(len(at), 1)
        if split is not None:
            g, h = g[on := (g < split) & (h >= split)], h[on]
        names = pa.array([names[r] for r in at], pa.string())
        return pa.table([pa.array([lang] * len(g), pa.string()), names.take(pa.array(g)), names.take(pa.array(h)),
                         pa.array(sums[g, h]), pa.array(visited[g, h]), pa.array(gaps(zero[g], zero[h])),
                         pa.array(np.full(len(g), v, np.int64))],
                        names=["lang", "g", "h", "value", "visited", "flat", "v"])
    return price


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS, k: int = 2,
          rows_per_block: int = ROWS_PER_BLOCK, cells_per_tile: int = CELLS_PER_TILE) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: divergence from each other source, and the most typical terms."""
    counts = stored(cells(docs), "divergence-cells")
    of_term = Window.partitionBy("lang", "term")
    kept = stored(counts.where("term != ''").select(
        "lang", "source", "term", "count", F.sum("docs").over(of_term).alias("df"),
        F.sum("count").over(of_term).alias("lang_count"),
        (F.min("source").over(of_term) == F.col("source")).alias("first"))
        .where(F.col("df") >= min_docs).drop("df"), "divergence-kept")

    groups = counts.where("term = ''").select("lang", "source")
    of_group = kept.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    of_lang = kept.groupBy("lang").agg(F.sum("count").alias("n_lang"), F.count_if("first").alias("v"),
                                       F.count("*").alias("cells"))
    sizes = groups.groupBy("lang").agg(F.ceil(F.count("*") / rows_per_block).alias("blocks"))
    # cells of a tile: two of `blocks` row blocks, one of `tiles` shares of the columns
    tiles = F.greatest(F.ceil(F.col("cells") * 2 / (F.greatest(F.col("blocks"), F.lit(2)) * cells_per_tile)), F.lit(1))
    info = stored(groups.join(sizes, "lang").join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left")
                  .na.fill(0, ["n", "n_lang", "v", "cells"])
                  .select("lang", "source", "n", "n_lang", "v", "blocks", tiles.alias("tiles"),
                          F.pmod(F.xxhash64("source"), F.col("blocks")).alias("block")), "divergence-groups")
    known = kept.join(info, ["lang", "source"])

    p, q = share(F.col("count"), F.col("n"), F.col("v")), share(F.col("lang_count"), F.col("n_lang"), F.col("v"))
    ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    typical = (known.select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q")).where("p > q")
               .select("lang", "source", F.lit("term").alias("part"), "item", gap(F.col("p"), F.col("q")).alias("value"))
               .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= top))

    other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("other")
    entries = known.select("lang", "source", "term", "count", "n", "v", "block", other,
                           F.pmod(F.xxhash64("term"), F.col("tiles")).alias("tile"))
    marks = info.select("lang", "source", F.lit(None).cast("string").alias("term"), F.lit(0).cast("bigint").alias("count"),
                        "n", "v", "block", other, "tiles").select(
        "lang", "source", "term", "count", "n", "v", "block", "other",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("tile"))
    priced = (entries.unionByName(marks)
              .withColumn("a", F.least("block", "other")).withColumn("b", F.greatest("block", "other"))
              .groupBy("lang", "a", "b", "tile").applyInArrow(_price(k), PRICED))
    # cells that no walk visited are zero on both sides: one constant for all of them
    sums = priced.groupBy("lang", "g", "h").agg(
        (F.sum("value") + (F.max("v") - F.sum("visited")) * F.max("flat")).alias("value"))
    both = F.explode(F.array(F.struct(F.col("g").alias("source"), F.col("h").alias("item")),
                             F.struct(F.col("h").alias("source"), F.col("g").alias("item"))))
    pairs = (sums.select("lang", "value", both.alias("p"))
             .select("lang", "p.source", F.lit("pair").alias("part"), "p.item", "value")
             .withColumn("rank", F.row_number().over(ranked)))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.select(columns).unionByName(typical.select(columns))


ORACLE = """
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (
  SELECT row, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
t AS (
  SELECT lang, term, count(*) AS lang_count FROM w GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
l AS (
  SELECT x.lang, coalesce(sum(lang_count), 0)::HUGEINT AS n_lang, count(t.term)::HUGEINT AS v
  FROM (SELECT DISTINCT lang FROM d) x LEFT JOIN t USING (lang) GROUP BY x.lang),
c AS (
  SELECT lang, source, term, count(*) AS count FROM w JOIN t USING (lang, term) GROUP BY lang, source, term),
g AS (
  SELECT x.lang, x.source, coalesce(sum(c.count), 0)::HUGEINT AS n, any_value(l.v) AS v, any_value(l.n_lang) AS n_lang
  FROM (SELECT DISTINCT lang, source FROM d) x JOIN l USING (lang) LEFT JOIN c USING (lang, source)
  GROUP BY x.lang, x.source),
m AS (
  SELECT g.lang, g.source, t.term, coalesce(c.count, 0) AS count,
         1 + (1000000000::HUGEINT * (coalesce(c.count, 0) + 2)) // (g.n + 2 * g.v) AS p,
         1 + (1000000000::HUGEINT * (t.lang_count + 2)) // (g.n_lang + 2 * g.v) AS q
  FROM g JOIN t USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
         sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN m x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN m y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM m WHERE count > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, coalesce(value, 0)::BIGINT AS value,
         row_number() OVER (PARTITION BY lang, source, part ORDER BY coalesce(value, 0) DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

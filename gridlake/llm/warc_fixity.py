"""WARC fixity: Merkle trees over records and ordered offset ranges, replicas compared from the root.

Pages become WARC records.  An archive file holds the records of a range of
``FILE_IDS`` page ids, in id order; a record's offset is the length of what
stands before it.  The tree of a file is over ranges of ids: the lowest nodes
hash the records of one id (a sum of digests, so rows that repeat an id need no
order and no gathering), and each node above hashes its at most ``FANOUT``
children, each with its offset and length.  Ranges of ids, unlike ranks, do not shift
when a replica lost a record.

To audit, the roots of two replicas are compared per file, and only the children of
nodes that differ are looked at, level by level, down to the ids.

All DataFrame code.  A null html counts as empty, a null url as none; line ends in
a url are written as %0D and %0A, since a header line ends there; a record of any
length is one record; rows
without a page_id are in no archive; rows that repeat an id are records of one
id; empty tables have no files, and against one every record is missing;
extra columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

FANOUT = 16
LEVELS = 3                       # of nodes above the ids of a file
FILE_IDS = FANOUT ** LEVELS


def records(pages: DataFrame) -> DataFrame:
    """``pages(page_id, url, html)`` -> (page_id, file, record): WARC resource records as bytes."""
    body = F.coalesce("html", F.lit("")).cast("binary")
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"), F.col("page_id").cast("string"),
        F.lit(">\r\nWARC-Target-URI: "),
        F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "), F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"))
    return (pages.where("page_id is not null")
            .select(F.col("page_id").cast("bigint").alias("page_id"),
                    F.floor(F.col("page_id") / FILE_IDS).cast("bigint").alias("file"),
                    F.concat(head.cast("binary"), body, F.lit("\r\n\r\n").cast("binary")).alias("record")))


def write(archive: DataFrame, path: str) -> None:
    """Write records as one WARC file for each ``file=``; a folder for each range of ids."""
    # the writer ends each line with the last line end of the record
    (archive.select("file", "page_id", F.expr("cast(substring(record, 1, length(record) - 2) as string)").alias("value"))
     .repartition("file").sortWithinPartitions("file", "page_id").select("file", "value")
     .write.partitionBy("file").option("lineSep", "\r\n").text(path))


def _parse(batches):
    for batch in batches:
        ids, out = [], []
        for content in batch["content"]:
            raw, at = content.as_py(), 0
            while at < len(raw):
                end = raw.index(b"\r\n\r\n", at) + 4
                head = dict(line.split(b": ", 1) for line in raw[at:end].split(b"\r\n") if b": " in line)
                stop = end + int(head[b"Content-Length"]) + 4
                ids.append(int(head[b"WARC-Record-ID"][10:-1])), out.append(raw[at:stop])
                at = stop
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())],
                                         names=["page_id", "record"])


def read(spark, path: str) -> DataFrame:
    """Records of files that ``write`` made: (page_id, file, record)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(path)
    return (files.select("content").mapInArrow(_parse, "page_id bigint, record binary")
            .select("page_id", F.floor(F.col("page_id") / FILE_IDS).cast("bigint").alias("file"), "record"))


def leaves(archive: DataFrame) -> DataFrame:
    """(file, node, hash, start, length, n) for each id: ``node`` is the page id."""
    sha = F.sha2("record", 256)
    # digests of the records of one id are added up, part by part
    parts = [F.sum(F.conv(F.substring(sha, 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)")).alias(f"p{i}") for i in range(4)]
    per_id = archive.groupBy("file", "page_id").agg(F.sum(F.octet_length("record").cast("bigint")).alias("length"),
                                                    F.count("*").alias("n"), *parts)
    before = Window.partitionBy("file").orderBy("page_id").rowsBetween(Window.unboundedPreceding, -1)
    return per_id.select(
        "file", F.col("page_id").alias("node"),
        F.sha2(F.concat_ws(":", "n", "length", "p0", "p1", "p2", "p3"), 256).alias("hash"),
        F.coalesce(F.sum("length").over(before), F.lit(0)).cast("bigint").alias("start"), "length", "n")


def tree(archive: DataFrame, name: str = "merkle") -> DataFrame:
    """All nodes: (level, file, node, hash, start, length, n); level 0 are ids, ``LEVELS`` roots."""
    level = stored(leaves(archive), name)
    nodes = level.select(F.lit(0).alias("level"), "*")
    for depth in range(1, LEVELS + 1):
        child = F.struct("node", "hash", (F.col("start") - F.col("low")).alias("at"), "length")
        low = Window.partitionBy("file", F.floor(F.col("node") / FANOUT))
        level = (level.withColumn("low", F.min("start").over(low))
                 .groupBy("file", F.floor(F.col("node") / FANOUT).cast("bigint").alias("node"))
                 .agg(F.sort_array(F.collect_list(child)).alias("children"), F.min("start").alias("start"),
                      F.sum("length").cast("bigint").alias("length"), F.sum("n").alias("n"))
                 .select("file", "node",
                         F.sha2(F.array_join(F.transform("children", lambda c: F.concat_ws(
                             ":", c["node"], c["hash"], c["at"], c["length"])), ","), 256).alias("hash"),
                         "start", "length", "n"))
        nodes = nodes.unionByName(level.select(F.lit(depth).alias("level"), "*"))
    return stored(nodes, name + "-nodes")


def audit(left: DataFrame, right: DataFrame) -> DataFrame:
    """Ids whose records differ between two trees, found from the roots down.

    Returns page_id, file, kind (changed, missing, extra: in the right one),
    start and length on either side and both hashes.
    """
    def side(nodes, depth, tag):
        return nodes.where(F.col("level") == depth).select(
            "file", "node", *[F.col(c).alias(f"{tag}_{c}") for c in ("hash", "start", "length")])

    suspects = None
    for depth in range(LEVELS, -1, -1):
        a, b = side(left, depth, "left"), side(right, depth, "right")
        if suspects is not None:
            parents = suspects.select("file", F.col("node").alias("parent"))
            key = [F.col("file"), F.floor(F.col("node") / FANOUT).cast("bigint").alias("parent")]
            a = a.select("*", key[1]).join(parents, ["file", "parent"], "left_semi").drop("parent")
            b = b.select("*", key[1]).join(parents, ["file", "parent"], "left_semi").drop("parent")
        suspects = (a.join(b, ["file", "node"], "full")
                    .where(~F.col("left_hash").eqNullSafe(F.col("right_hash"))))
    kind = (F.when(F.col("right_hash").isNull(), "missing").when(F.col("left_hash").isNull(), "extra")
            .otherwise("changed"))
    return suspects.select(F.col("node").alias("page_id"), "file", kind.alias("kind"), "left_start", "left_length",
                           "right_start", "right_length", "left_hash", "right_hash")


def damaged_copy(pages: DataFrame) -> DataFrame:
    """A replica with losses known from the urls: about 1 page in 16 changed by a byte, 1 in 16 gone.

    Stands in for a second store, which the tables do not have.
    """
    mark = F.substring(F.sha2(F.coalesce("url", F.lit("")), 256), 1, 1)
    html = F.when(mark == "0", F.concat(F.lit("?"), F.expr("substring(html, 2)"))).otherwise(F.col("html"))
    return pages.where(mark != "1").select("page_id", "url", html.alias("html"))


def report(pages: DataFrame) -> DataFrame:
    whole = tree(records(pages), "merkle-left")
    copy = tree(records(damaged_copy(pages)), "merkle-right")
    return audit(whole, copy)


# The same result from the pages directly: ids whose records differ, with their offsets.
ORACLE = r"""
WITH base AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html,
                     substr(sha256(coalesce(url, '')), 1, 1) AS mark
              FROM pages WHERE page_id IS NOT NULL),
sides AS (SELECT 'l' AS side, page_id, url, html FROM base
          UNION ALL
          SELECT 'r', page_id, url, CASE WHEN mark = '0' THEN '?' || substr(html, 2) ELSE html END
          FROM base WHERE mark <> '1'),
recs AS (SELECT side, page_id,
                'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10)
                || 'WARC-Record-ID: <urn:page:' || page_id || '>' || chr(13) || chr(10)
                || 'WARC-Target-URI: ' || replace(replace(url, chr(13), '%0D'), chr(10), '%0A') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10)
                || 'Content-Length: ' || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10)
                || html || chr(13) || chr(10) || chr(13) || chr(10) AS rec
         FROM sides),
hashed AS (SELECT side, page_id, strlen(rec) AS len, sha256(rec) AS sha FROM recs),
ids AS (SELECT side, page_id, page_id // 4096 AS file, CAST(sum(len) AS BIGINT) AS len, count(*) AS n,
               sum(CAST(('0x' || substr(sha, 1, 15)) AS HUGEINT)) AS p0,
               sum(CAST(('0x' || substr(sha, 16, 15)) AS HUGEINT)) AS p1,
               sum(CAST(('0x' || substr(sha, 31, 15)) AS HUGEINT)) AS p2,
               sum(CAST(('0x' || substr(sha, 46, 15)) AS HUGEINT)) AS p3
        FROM hashed GROUP BY 1, 2),
leaf AS (SELECT side, page_id, file, len,
                CAST(coalesce(sum(len) OVER (PARTITION BY side, file ORDER BY page_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start,
                sha256(concat_ws(':', n, len, p0, p1, p2, p3)) AS hash
         FROM ids)
SELECT coalesce(a.page_id, b.page_id) AS page_id, coalesce(a.file, b.file) AS file,
       CASE WHEN b.hash IS NULL THEN 'missing' WHEN a.hash IS NULL THEN 'extra' ELSE 'changed' END AS kind,
       a.start AS left_start, a.len AS left_length, b.start AS right_start, b.len AS right_length,
       a.hash AS left_hash, b.hash AS right_hash
FROM (SELECT * FROM leaf WHERE side = 'l') a FULL JOIN (SELECT * FROM leaf WHERE side = 'r') b
     ON a.page_id = b.page_id
WHERE a.hash IS DISTINCT FROM b.hash
"""

"""Byte-level BPE encoding and decoding of whole texts.

Overlapping chunk encoding.  A text is cut into overlapping chunks, which are
spread over the cluster and pre-tokenised on their own.  The split pattern
looks ahead but never back, so two chains of pre-tokens that share one boundary
agree from there on: neighbouring chunks are stitched at their first common
boundary inside the overlap, and each stretch between stitches is encoded where
its chunk is.  Ids of the stretches are put in order per document.  Decoding
concatenates the raw bytes of the ids.

Cases: a null text counts as empty (no ids); repeated rows are encoded each;
ids of documents may be null or repeated; other columns are ignored.  Texts of
one chunk never leave their task.  A text that holds no boundary for a whole
overlap (one endless run of letters) is stitched by scanning on from the last
boundary, so the result is always the one of a single scan.
"""

from __future__ import annotations

import base64
import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK_CHARS = 1 << 16      # characters a chunk owns
OVERLAP_CHARS = 1 << 10    # characters it shares with the next one
LOOKAHEAD = 3              # a match depends on no character further than this from its start, or one past its end


@lru_cache(maxsize=4)
def encoder(ranks_path: str, pattern: str):
    """The rank file as an encoder (one per worker process)."""
    import tiktoken
    with open(ranks_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@lru_cache(maxsize=4)
def _splitter(pattern: str):
    import regex
    return regex.compile(pattern)


def boundaries(text: str, pattern: str, start: int = 0, last: bool = True) -> list[int]:
    """Pre-token boundaries of ``text`` from ``start`` on, ``start`` included.

    Unless ``last``, the text goes on beyond what is given, and only boundaries
    that cannot depend on the unseen rest are returned.
    """
    out, n = [start], len(text)
    for m in _splitter(pattern).finditer(text, start):
        s, e = m.span()
        if not last and (e + 1 >= n or s + LOOKAHEAD > n):
            break
        if s != out[-1]:      # characters that the pattern skips (none for byte BPE patterns)
            out.append(s)
        out.append(e)
    return out


def stitch(chunks: list[tuple[int, np.ndarray]], read, pattern: str) -> list[tuple[int, int]]:
    """The stretch ``[from, to)`` of the text that each chunk encodes.

    ``chunks``: ``(start, boundaries)`` in text order, with positions in the
    whole text.  The first chunk's chain is right; each next chunk takes over at
    the first boundary it shares with the right chain.  ``read(a, b)`` gives
    text, used only where an overlap holds no common boundary.
    """
    spans, at = [], 0
    chain = chunks[0][1]
    end = None
    for i, (start, _) in enumerate(chunks):
        nxt = chunks[i + 1][1] if i + 1 < len(chunks) else None
        if nxt is None:
            spans.append((at, None))
            break
        right = chain[chain >= at]
        common = np.intersect1d(right, nxt, assume_unique=True)
        if len(common):
            end = int(common[0])
            spans.append((at, end))
            at, chain = end, nxt
            continue
        # No common boundary: scan on from the last right boundary until the
        # chain meets the next chunk's, or that chunk is used up.
        pos = int(right[-1]) if len(right) else at
        stop = chunks[i + 2][0] + OVERLAP_CHARS if i + 2 < len(chunks) else None
        text = read(pos, stop)
        own = np.array(boundaries(text, pattern, 0, stop is None), np.int64) + pos
        common = np.intersect1d(own, nxt, assume_unique=True)
        end = int(common[0]) if len(common) else int(own[-1])
        spans.append((at, end))
        at, chain = end, nxt if len(common) else own
    return spans


def _encode_rows(ranks_path: str, pattern: str):
    """(key columns..., text) batches -> key columns, ids as little-endian u32 bytes."""
    def run(batches):
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            ids = [np.array(enc.encode_ordinary(t.as_py() or ""), "<u4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(ids, pa.binary())],
                names=[*batch.schema.names[:-1], "ids"])
    return run


def _pretokenise(pattern: str):
    def run(batches):
        for batch in batches:
            out = []
            for start, text, last in zip(batch["start"], batch["text"], batch["last"]):
                b = np.array(boundaries(text.as_py(), pattern, 0, last.as_py()), np.int64)
                out.append((b + start.as_py()).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch["row"], batch["start"], pa.array(out, pa.binary())],
                names=["row", "start", "bounds"])
    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, chunk_chars: int = CHUNK_CHARS,
           overlap_chars: int = OVERLAP_CHARS) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, ids)``, ids as little-endian u32 bytes, one row per row.

    A row is known by (doc_id, hash of its text), so rows that repeat an id keep
    their own ids.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    short = docs.where(F.length("text") <= chunk_chars)
    done = short.mapInArrow(_encode_rows(ranks_path, pattern), "doc_id bigint, ids binary")

    long = (docs.where(F.length("text") > chunk_chars)
            .withColumn("row", F.struct("doc_id", F.sha2("text", 256).alias("text_hash"))))
    # Copies of one long row are encoded once and counted.
    rows = long.groupBy("row").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    starts = rows.select("row", "text", F.explode(F.sequence(
        F.lit(0), F.length("text") - 1, F.lit(chunk_chars))).alias("start"))
    size = chunk_chars + overlap_chars
    chunks = (starts.select(
        "row", "start", F.expr(f"substring(text, start + 1, {size})").alias("text"),
        (F.col("start") + size >= F.length("text")).alias("last"))
        .withColumn("row", F.to_json("row", {"ignoreNullFields": "false"}))
        .repartition("row", "start"))
    bounds = chunks.mapInArrow(_pretokenise(pattern), "row string, start int, bounds binary")

    per_doc = (bounds.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "bounds"))).alias("chunks"))
               .join(rows.withColumn("row", F.to_json("row", {"ignoreNullFields": "false"})), "row"))

    def stitched(batches):
        for batch in batches:
            keys, froms, tos, pieces = [], [], [], []
            for row, chunks_, text in zip(batch["row"], batch["chunks"], batch["text"]):
                text = text.as_py()
                parts = [(c["start"], np.frombuffer(c["bounds"], "<i8")) for c in chunks_.as_py()]
                parts = parts[:1 + next((i for i, p in enumerate(parts)
                                         if p[0] + size >= len(text)), len(parts))]
                for a, b in stitch(parts, lambda x, y: text[x:y], pattern):
                    b = len(text) if b is None else b
                    keys.append(row.as_py()), froms.append(a), tos.append(b), pieces.append(text[a:b])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(froms, pa.int64()), pa.array(pieces, pa.string())],
                names=["row", "start", "text"])

    stretches = (per_doc.select("row", "chunks", "text")
                 .mapInArrow(stitched, "row string, start bigint, text string")
                 .repartition("row", "start"))
    parts = stretches.mapInArrow(_encode_rows(ranks_path, pattern), "row string, start bigint, ids binary")
    joined = (parts.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("start", "ids"))).alias("p"))
              .select("row", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))").alias("ids")))
    longs = (joined.join(rows.select(F.to_json("row", {"ignoreNullFields": "false"}).alias("row"),
                                     F.col("row.doc_id").alias("doc_id"), "copies"), "row")
             .select("doc_id", "ids", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("i"))
             .select("doc_id", "ids"))
    return done.unionByName(longs)


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """``(doc_id, ids)`` -> ``(doc_id, ids, bytes)``: the raw bytes of the ids, concatenated."""
    def run(batches):
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            raw = [enc.decode_bytes(np.frombuffer(i.as_py(), "<u4").tolist()) for i in batch["ids"]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], pa.array(raw, pa.binary())],
                                             names=["doc_id", "ids", "bytes"])
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, ids binary, bytes binary")


def round_trip_digest(docs: DataFrame, ranks_path: str, pattern: str, **sizes) -> DataFrame:
    """Per row: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return tokenised(docs, ranks_path, pattern, **sizes).drop("ids")


def tokenised(docs: DataFrame, ranks_path: str, pattern: str, **sizes) -> DataFrame:
    """``round_trip_digest`` with the ids themselves (little-endian u32 bytes)."""
    both = decode(encode(docs, ranks_path, pattern, **sizes), ranks_path, pattern)
    return both.select("doc_id", "ids", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
                       F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))

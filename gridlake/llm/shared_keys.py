"""Which hashed keys of a document also occur in another document.

``extract(data, offsets)`` gives the keys of a slice of texts as
``(keys u64, text number)``.  Keys are dealt by hash to buckets as compact
binary rows (6 bytes a key, document ids as differences), a row per task, run of
documents and bucket, so the shuffle moves about 8 bytes a key.  A key that
several documents of one run hold is known to be shared there and leaves the
task once, so a key that a third of all rows hold stays small in its bucket.

Keys are compared by 48 bits; a chance agreement only names a key that is not
shared, which callers must (and do) verify.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import shuffle_partitions
from .textnum import U64, slices

KEY_BYTES = 6
RUN_KEYS = 1_000_000        # keys gathered in a task before they are dealt out
KEY_MASK = U64((1 << 48) - 1)


def pack(keys: np.ndarray) -> bytes:
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]).tobytes()


def unpack(raw: bytes) -> np.ndarray:
    body = np.frombuffer(raw, np.uint8).reshape(-1, KEY_BYTES)
    full = np.zeros((len(body), 8), np.uint8)
    full[:, :KEY_BYTES] = body
    return full.view("<u8").ravel().astype(U64)


def pack_ids(ids: np.ndarray) -> bytes:
    """Ascending ids as a first id, a width and differences."""
    if not len(ids):
        return b""
    step = np.diff(ids)
    width = 2 if not len(step) or step.max() < 1 << 16 else 8
    return (np.array([ids[0]], "<i8").tobytes() + bytes([width])
            + step.astype("<u2" if width == 2 else "<i8").tobytes())


def unpack_ids(raw: bytes) -> np.ndarray:
    if not raw:
        return np.zeros(0, np.int64)
    first = np.frombuffer(raw[:8], "<i8")
    step = np.frombuffer(raw[9:], "<u2" if raw[8] == 2 else "<i8").astype(np.int64)
    return np.concatenate([first, step]).cumsum()


def _by_document(keys, ids):
    """(document, its keys) of pairs, in document order."""
    order = np.argsort(ids, kind="stable")
    keys, ids = keys[order], ids[order]
    cuts = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else []
    for a, b in zip(cuts, [*cuts[1:], len(ids)]):
        yield int(ids[a]), keys[a:b]


COLUMNS = "bucket int, doc_id bigint, n bigint, keys binary, ids binary, known boolean"
DEALT = -1      # n of a row of dealt keys; other rows are results that pass through


def _dealer(extract, buckets: int, with_keys: bool):
    """Rows of keys for a bucket, and rows of a document's keys already known to be shared."""
    names = ["bucket", "doc_id", "n", "keys", "ids", "known"]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.bool_()]

    def rows(keys, ids):
        out = []
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1]))
        keys, ids = keys[new], ids[new]
        first = np.append(True, keys[1:] != keys[:-1])
        many = np.append(~first[1:], False) | ~first          # another document of the run has it
        for doc, own in _by_document(keys[many], ids[many]):
            out.append((doc % buckets, doc, len(own), pack(own) if with_keys else b"", b"", True))
        keys, ids, known = keys[first], ids[first], many[first]
        part = (keys % U64(buckets)).astype(np.int64)
        order = np.lexsort((ids, known, part))
        keys, ids, known, part = keys[order], ids[order], known[order], part[order]
        cut = np.searchsorted(part, np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cut)):
            lo, hi = cut[b], cut[b + 1]
            mid = lo + int(np.searchsorted(known[lo:hi], True))
            for x, y, k in ((lo, mid, False), (mid, hi, True)):
                if y > x:
                    out.append((int(b), 0, DEALT, pack(keys[x:y]), pack_ids(ids[x:y]), k))
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            ids = batch["doc_id"].to_numpy(zero_copy_only=False)
            for at, data, offsets in slices(batch["text"]):
                keys, text = extract(data, offsets)
                held.append((keys & KEY_MASK, ids[at + text]))
                n += len(keys)
                if n >= RUN_KEYS:
                    yield rows(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))
                    held, n = [], 0
        if n:
            yield rows(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]))

    return run


def _matcher(with_keys: bool):
    def match(rows: pa.Table) -> pa.Table:
        n = rows["n"].to_numpy()
        done = rows.filter(pa.array(n != DEALT)).select(["doc_id", "n", "keys"])
        rows = rows.filter(pa.array(n == DEALT))
        if not rows.num_rows:
            return done
        packed = rows["keys"].to_pylist()
        keys = unpack(b"".join(packed))
        ids = np.concatenate([unpack_ids(i) for i in rows["ids"].to_pylist()])
        known = np.repeat(rows["known"].to_numpy().astype(bool), [len(k) // KEY_BYTES for k in packed])
        order = np.argsort(keys, kind="stable")
        keys, ids, known = keys[order], ids[order], known[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        lows, highs = np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)
        size = np.diff(np.append(first, len(keys)))
        shared = np.repeat(lows < highs, size) & ~known
        docs, counts, own = [], [], []
        for doc, k in _by_document(keys[shared], ids[shared]):
            docs.append(doc), counts.append(len(k)), own.append(pack(k) if with_keys else b"")
        more = pa.table([pa.array(docs, pa.int64()), pa.array(counts, pa.int64()), pa.array(own, pa.binary())],
                        names=["doc_id", "n", "keys"])
        return pa.concat_tables([done.cast(more.schema), more])
    return match


def shared_keys(docs: DataFrame, extract, with_keys: bool = True) -> DataFrame:
    """``docs(doc_id bigint, text binary)`` without nulls -> ``(doc_id, n, keys)``.

    A document has a row for each bucket (or run) in which some of its keys are
    shared with another document id: their number, and the keys, packed.  The
    rows of a document are disjoint, so ``n`` may be summed.
    """
    # several buckets a partition even out; both grow with the session's partitions
    buckets = 4 * shuffle_partitions(docs.sparkSession)
    dealt = docs.select("doc_id", "text").mapInArrow(_dealer(extract, buckets, with_keys), COLUMNS)
    return dealt.groupBy("bucket").applyInArrow(_matcher(with_keys), "doc_id bigint, n bigint, keys binary")

"""Fill-in-middle transformation: a part of each text moves to its end, between sentinels.

A text is a row of tokens, runs of A-Z and a-z and single other characters, and
is cut after two of them that the hash of its id names.  Content-defined chunk
memoization: a rolling hash over the last 32 bytes cuts texts into chunks where
its top bits are zero, so equal passages give equal chunks wherever they stand.
A chunk's summary is the number of tokens that start in it (as if nothing
stood before), its characters, and whether its first and last bytes are
letters; summaries are kept by content, found by hash and verified by comparing
the bytes.  A letter run that goes on across a chunk boundary starts once, so
the sum of the counts less the joined runs is the number of tokens, and prefix
sums name the chunk that holds a cut; only that chunk is read to place it.

Cases: a null text counts as empty and stays plain, as do texts that hold a
sentinel; a null doc_id hashes like an empty one; repeated rows give repeated
rows; a text of any length is cut whole, in its task, and characters are never
split; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textnum import mix, slices

# Sentinels, and the shares (in percent) of texts that are transformed and of those in suffix-first order.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = "1:"

WINDOW = 32                   # bytes that the rolling hash sees
CHUNK_BITS = 10               # chunks of about 2^10 bytes
LONGEST_CHUNK = 1 << 14       # a chunk without a cut of its own is cut here
CACHE_BYTES = 24 << 20        # content that a worker keeps, twice (see Memo)

_GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)
_LETTER = np.array([0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A for b in range(256)])
_LEAD = np.array([b & 0xC0 != 0x80 for b in range(256)])          # first byte of a character


def cuts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Chunk boundaries of several texts side by side; text ends are boundaries."""
    h = _GEAR[data]
    width = 1
    while width < WINDOW:                              # h[i] = sum of gear[data[i - j]] << j, j below width
        h[width:] += h[:-width] << np.uint32(width)
        width *= 2
    at = np.flatnonzero(h >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    text = np.searchsorted(offsets, at, side="left") - 1
    at = at[at - offsets[text] >= WINDOW]              # the window must lie in the text
    at = np.unique(np.concatenate([at, offsets]))
    gap = np.diff(at)
    if len(gap) and gap.max() > LONGEST_CHUNK:
        at = np.unique(np.concatenate([at, *(np.arange(a, b, LONGEST_CHUNK) for a, b in zip(at[:-1], at[1:])
                                             if b - a > LONGEST_CHUNK)]))
    return at


def starts(chunk: np.ndarray) -> np.ndarray:
    """Positions where tokens start, taking the chunk's first letter for a start."""
    letter = _LETTER[chunk]
    first = letter.copy()
    first[1:] &= ~letter[:-1]
    return np.flatnonzero(first | (~letter & _LEAD[chunk]))


def summary(chunk: bytes) -> tuple[int, int, bool, bool]:
    """Token starts, characters, whether the first and the last byte are letters."""
    data = np.frombuffer(chunk, np.uint8)
    return len(starts(data)), int(np.count_nonzero(_LEAD[data])), bool(_LETTER[data[0]]), bool(_LETTER[data[-1]])


class Memo:
    """Summaries by content, within twice ``CACHE_BYTES``: a full generation takes the place of the one before."""

    def __init__(self):
        self.now, self.before, self.held, self.hits = {}, {}, 0, 0

    def __call__(self, chunk: bytes):
        found = self.now.get(chunk)                    # a dict compares the bytes when hashes are equal
        if found is not None:
            self.hits += 1
            return found
        found = self.before.get(chunk)
        if found is None:
            found = summary(chunk)
        else:
            self.hits += 1
        if self.held > CACHE_BYTES:
            self.now, self.before, self.held = {}, self.now, 0
        self.now[chunk] = found
        self.held += len(chunk) + 200
        return found


def split(text: bytes, bounds: list[int], memo: Memo, h1: int, h2: int):
    """``(n, prefix end, middle end, characters of the prefix, of the middle)``, ends in bytes.

    ``bounds``: chunk boundaries of the text from 0 to its length.
    """
    firsts, chars, total, letters, before = [], [], 0, 0, False
    joined = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        n, c, first, last = memo(text[a:b])
        join = before and first
        firsts.append(total), chars.append(letters), joined.append(join)
        total, letters, before = total + n - join, letters + c, last
    x, y = sorted((h1 % (total + 1), h2 % (total + 1)))

    def place(k: int) -> tuple[int, int]:
        """Byte and character position at which token ``k`` starts (the end for the token past the last)."""
        if k == total:
            return len(text), letters
        i = int(np.searchsorted(firsts, k, side="right")) - 1
        data = np.frombuffer(text, np.uint8)[bounds[i]:bounds[i + 1]]
        at = int(starts(data)[k - firsts[i] + joined[i]])
        return bounds[i] + at, chars[i] + int(np.count_nonzero(_LEAD[data[:at]]))

    (a, ca), (b, cb) = place(x), place(y)
    return total, a, b, ca, cb - ca


OUT = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def _transform(batches):
    memo = Memo()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    for batch in batches:
        ids, column, h = batch.column(0), batch.column(1), [batch.column(i).to_pylist() for i in range(2, 6)]
        out = []
        for row, data, offsets in slices(column):
            at = cuts(data, offsets)
            ends = np.searchsorted(at, offsets)
            whole = data.tobytes()
            for i in range(len(offsets) - 1):
                a, b = int(offsets[i]), int(offsets[i + 1])
                text = whole[a:b]
                h1, h2, h3, h4 = (x[row + i] for x in h)
                bounds = (at[ends[i]:ends[i + 1] + 1] - a).tolist()
                n, x, y, prefix, middle = split(text, bounds, memo, h1, h2)
                if not text or h3 % 100 >= TRANSFORMED or any(mark in text for mark in marks):
                    out.append((n, "plain", None, None, text))
                elif h4 % 100 < SUFFIX_FIRST:
                    out.append((n, "spm", prefix, middle, s + text[y:] + p + text[:x] + m + text[x:y]))
                else:
                    out.append((n, "psm", prefix, middle, p + text[:x] + s + text[y:] + m + text[x:y]))
        n, form, prefix, middle, text = zip(*out) if out else [()] * 5
        yield pa.RecordBatch.from_arrays(
            [ids, pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(prefix, pa.int64()),
             pa.array(middle, pa.int64()), pa.array(text, pa.binary()).cast(pa.string())],
            names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def transform(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, output)`` per document, ``output`` the transformed text."""
    key = F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    hashes = [F.conv(F.substring(key, 1 + 8 * i, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text")
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text, *hashes).mapInArrow(_transform, OUT)


def restored(form, output):
    """The text that a transformed one was made of, from its form and itself alone."""
    def after(text, mark):
        return F.substring(text, F.position(F.lit(mark), text) + len(mark), F.length(text))

    def until(text, mark):
        return F.substring(text, 1, F.position(F.lit(mark), text) - 1)
    psm = F.concat(until(after(output, PREFIX), SUFFIX), after(output, MIDDLE),
                   until(after(output, SUFFIX), MIDDLE))
    spm = F.concat(until(after(output, PREFIX), MIDDLE), after(output, MIDDLE),
                   until(after(output, SUFFIX), PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def digest(docs: DataFrame, seed: str = SEED) -> DataFrame:
    done = transform(docs, seed)
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                       sha(F.col("output")).alias("output_sha256"),
                       sha(restored(F.col("form"), F.col("output"))).alias("restored_sha256"))


ORACLE = """
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS units FROM documents),
c AS (
  SELECT *, len(units) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM h),
p AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM c),
t AS (
  SELECT *, coalesce(array_to_string(units[1:a], ''), '') AS x, coalesce(array_to_string(units[a + 1:b], ''), '') AS y,
         coalesce(array_to_string(units[b + 1:n], ''), '') AS z FROM p)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y
                        ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM t
"""

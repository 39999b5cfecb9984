"""Text work on numpy arrays, inside tasks.

A batch's texts arrive as one Arrow buffer; they are taken in slices of about
``SLICE_BYTES`` so that working arrays stay small whatever the batch holds.  A
text is never cut: a longer one is a slice of its own.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SLICE_BYTES = 1 << 16      # working arrays of a slice stay in the cache
U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def slices(column, size: int = SLICE_BYTES):
    """``(first row, bytes, offsets)`` of runs of rows of an Arrow binary column without nulls."""
    chunks = column.chunks if hasattr(column, "chunks") else [column]
    base = 0
    for array in chunks:
        n = len(array)
        if n == 0:
            continue
        wide = "large" in str(array.type)
        offs = np.frombuffer(array.buffers()[1], np.int64 if wide else np.int32)[array.offset:array.offset + n + 1]
        data = array.buffers()[2]
        data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        at = 0
        while at < n:
            end = int(np.searchsorted(offs, offs[at] + size, side="right")) - 1
            end = min(max(end, at + 1), n)
            yield base + at, data[offs[at]:offs[end]], (offs[at:end + 1] - offs[at]).astype(np.int64)
            at = end
        base += n


_P = 0x9E3779B97F4A7C55          # odd, so invertible modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)


@lru_cache(maxsize=1)
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))


_powers = [np.ones(1, U64), np.ones(1, U64)]


def _power_tables(n: int):
    """Powers of _P and of its inverse up to n (kept for usual slices only)."""
    if len(_powers[0]) >= n:
        return _powers[0][:n], _powers[1][:n]
    with np.errstate(over="ignore"):
        up = np.full(n, _P, U64)
        down = np.full(n, _P_INV, U64)
        up[0] = down[0] = 1
        up, down = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
    if n <= 2 * SLICE_BYTES:
        _powers[:] = [up, down]
    return up, down


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; equal bytes have equal hashes."""
    up, down = _power_tables(len(data) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, U64)
        np.cumsum(_byte_values()[data] * up[:-1], dtype=U64, out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64))


def runs(kind: np.ndarray, offsets: np.ndarray):
    """Maximal runs of one non-zero kind within a text: ``(starts, ends, text number)``.

    ``kind``: a small integer per byte, 0 for separators.
    """
    n = len(kind)
    if n == 0:
        e = np.zeros(0, np.int64)
        return e, e, e
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    firsts = offsets[:-1][offsets[:-1] < n]
    change[firsts] = True
    at = np.flatnonzero(change)
    ends = np.append(at[1:], n)
    keep = kind[at] != 0
    starts, ends = at[keep], ends[keep]
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


# The white space of the word contracts (space, tab to carriage return).
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


@lru_cache(maxsize=1)
def _word_kind() -> np.ndarray:
    t = np.ones(256, np.uint8)
    t[list(SPACES)] = 0
    return t


@lru_cache(maxsize=1)
def _lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


def word_hashes(data: np.ndarray, offsets: np.ndarray):
    """Words (runs without white space, A-Z lower-cased): ``(hashes, text number)``."""
    low = _lower_table()[data]
    starts, ends, text = runs(_word_kind()[low], offsets)
    return span_hashes(low, starts, ends), text


def shingle_hashes(words: np.ndarray, text: np.ndarray, k: int, whole_if_short: bool = True):
    """Hashes of ``k`` consecutive words of one text: ``(hashes, text number)``.

    With ``whole_if_short`` a text of fewer words has its whole sequence as one shingle.
    """
    odd = mix(np.arange(1, k + 1, dtype=U64)) | U64(1)
    n = len(words) - k + 1
    with np.errstate(over="ignore"):
        if n > 0:
            h = np.full(n, U64(k))
            for i in range(k):
                h = h + words[i:i + n] * odd[i]
            ok = text[:n] == text[k - 1:]
            h, t = mix(h[ok]), text[:n][ok]
        else:
            h, t = np.zeros(0, U64), np.zeros(0, np.int64)
        if whole_if_short and len(words):
            firsts = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
            counts = np.diff(np.append(firsts, len(text)))
            few = counts < k
            if few.any():
                extra, owner = [], []
                for f, c in zip(firsts[few], counts[few]):
                    x = U64(c)
                    for i in range(c):
                        x = x + words[f + i] * odd[i]
                    extra.append(x), owner.append(text[f])
                h = np.concatenate([h, mix(np.array(extra, U64))])
                t = np.concatenate([t, np.array(owner, np.int64)])
                order = np.argsort(t, kind="stable")
                h, t = h[order], t[order]
    return h, t


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    m, have = h, 1
    while 2 * have <= width:
        m = np.minimum(m[:-have], m[have:])
        have *= 2
    rest = width - have
    return np.minimum(m[:n], m[rest:rest + n]) if rest else m[:n]

"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Large-item matching.  A document's ids are cut into pieces of ``capacity``
tokens only where they do not fit one sequence.  Pieces above a third of the
capacity come at most two to a sequence: from the longest down, each takes the
longest remaining partner that fits, which pairs as many as can be paired.
Shorter pieces then go, longest first, into the smallest gap that holds them.

Lengths are whole numbers up to the capacity, so all pieces of one length are
alike: the packing is worked out on their counts, for classes of sequences with
the same content.  A step uses up a length or a class or splits one class, so
the plan has a few classes for each length, whatever the number of documents.
Pieces are numbered within their length (a number within the task when they are
made, plus the counts of the tasks before), and the number says which
sequence and place of the plan is theirs.  Only the counts by length and the
plan pass through the driver.

Cases: a null text counts as empty (its only token is the end id); repeated rows
are packed each; doc_id may be null or repeated; a text of any length is encoded
whole; equal lengths go in any order; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import json
import zlib
from array import array
from bisect import bisect_left, insort
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

CAPACITY = 4096
END_ID = 1
CACHE_WORDS = 300_000         # words a worker keeps the ids of, twice (see Recent)
CACHE_PIECES = 500_000        # and pieces of words
CACHE_CHARS = 64              # longer words are not kept


# ------------------------------------------------------------ ids of a text

# Control characters that Python takes for white space and the vocabulary's pattern does not.
_SEPARATORS = regex.compile("[\x1c-\x1f]")
# Up to here no character composes with another, and lower case is the same everywhere.
_BEYOND = regex.compile("[^\x00-\u024f]")
# Marks that are a piece of their own after letters.
SINGLE = ".,;:!?"


class Recent(dict):
    """Values by key, at most about twice ``size``: a full generation takes the place of the one before."""

    def __init__(self, make, size: int):
        self.make, self.size, self.before = make, size, {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key) or self.make(key)
        if len(key) <= CACHE_CHARS:
            if len(self) >= self.size:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


class WordIds:
    """Ids of whole texts as little-endian u32 bytes, by the tokenizer itself.

    The vocabulary drops white space and no rule of it looks across, so the ids of
    a text are those of its words; words repeat, so most are looked up.  Texts
    of plain and Latin letters are lower-cased, their words split by the tokenizer's
    pattern and passed to its model piece by piece, since punctuation makes many
    words of one piece; words of other texts go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        split = json.loads(self.tokenizer.to_str())["pre_tokenizer"]["pretokenizers"][0]
        self.split = regex.compile(split["pattern"]["Regex"]).findall
        self.spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.model = self.tokenizer.model.tokenize
        self.pieces = Recent(self._piece, CACHE_PIECES)
        self.words, self.others = Recent(self._word, CACHE_WORDS), Recent(self.whole, CACHE_WORDS)

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isalpha():
            return self.pieces[word]
        if word[-1] in SINGLE and word[:-1].isalpha():
            return self.pieces[word[:-1]] + self.pieces[word[-1]]
        return b"".join(map(self.pieces.__getitem__, self.split(word)))

    def _piece(self, piece: str) -> bytes:
        spelled = piece if piece.isascii() and piece.isprintable() else "".join([s for s, _ in self.spell(piece)])
        return array("I", [t.id for t in self.model(spelled)]).tobytes()

    def of(self, text: str) -> bytes:
        if _SEPARATORS.search(text) or any(s in text for s in self.special):
            return self.whole(text)
        if not text.isascii() and _BEYOND.search(text):
            return b"".join(map(self.others.__getitem__, text.split()))
        return b"".join(map(self.words.__getitem__, text.lower().split()))


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


# ------------------------------------------------------------ pieces

ITEM = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint"


def _cut(path: str, capacity: int, end_id: int, with_ids: bool):
    """(doc_id, text) batches -> pieces with the task's number and their number within task and length."""
    def run(batches):
        ids_of = word_ids(path).of
        task = TaskContext.get().partitionId()
        numbers = np.zeros(capacity + 1, np.int64)
        end = array("I", [end_id]).tobytes()
        for batch in batches:
            columns = [[] for _ in range(7 + with_ids)]
            for doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                ids = ids_of(text) + end
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    length = len(part) // 4
                    row = (doc, piece, at // 4, length, zlib.crc32(part), task, int(numbers[length]), part)
                    numbers[length] += 1
                    for column, value in zip(columns, row):
                        column.append(value)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "task", "number", "ids"]
            n = len(columns)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names[:n])
    return run


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
           with_ids: bool = False) -> DataFrame:
    """Pieces of each document's ids and end id, stored; ``with_ids`` keeps the ids (little-endian u32)."""
    rows = docs.select(F.col("doc_id").cast("bigint"), F.coalesce("text", F.lit("")).alias("text"))
    schema = ITEM + ", task int, number bigint" + (", ids binary" if with_ids else "")
    return stored(rows.mapInArrow(_cut(path, capacity, end_id, with_ids), schema), "packing-pieces")


# ------------------------------------------------------------ the plan

def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Where the pieces of each length go: ``(length, first number, per sequence, first sequence, offset)``.

    ``counts``: pieces by length.  From its first number on, so many pieces of
    the length go side by side, from the offset on, into each of the sequences
    from the first on, up to the next entry of the length.
    """
    left = {s: n for s, n in counts.items() if n}
    if any(not 0 < s <= capacity for s in left):
        raise ValueError(f"piece lengths must be within 1-{capacity}")
    # Classes of sequences with one content: gap -> [(sequences, ((length, per sequence), ...)), ...]
    classes: dict[int, list] = {}
    gaps: list[int] = []

    def add(n: int, content: tuple):
        if n:
            gap = capacity - sum(s * k for s, k in content)
            if gap not in classes:
                classes[gap] = []
                insort(gaps, gap)
            classes[gap].append((n, content))

    def take(gap: int):
        n, content = classes[gap].pop()
        if not classes[gap]:
            del classes[gap]
            gaps.pop(bisect_left(gaps, gap))
        return n, content

    large = sorted(s for s in left if 3 * s > capacity)
    while large:                                           # longest first, with the longest partner that fits
        x = large[-1]
        at = bisect_left(large, capacity - x + 1) - 1
        y = large[at] if at >= 0 else None
        if y is None:
            n = left[x]
            add(n, ((x, 1),))
            left[x] = 0
        elif y == x and left[x] > 1:
            add(left[x] // 2, ((x, 2),))
            left[x] %= 2
        elif y == x:                                       # one is left and has no equal
            y = large[at - 1] if at else None
            add(1, ((x, 1), (y, 1)) if y else ((x, 1),))
            left[x] = 0
            if y:
                left[y] -= 1
        else:
            n = min(left[x], left[y])
            add(n, ((x, 1), (y, 1)))
            left[x] -= n
            left[y] -= n
        large = [s for s in large if left[s]] if not left[x] or (y and not left[y]) else large

    for s in sorted((s for s in left if 3 * s <= capacity), reverse=True):
        n = left[s]
        while n:                                           # the smallest gap that holds one more
            at = bisect_left(gaps, s)
            if at == len(gaps):
                k = capacity // s
                add(n // k, ((s, k),))
                add(int(n % k > 0), ((s, n % k),))
                break
            gap = gaps[at]
            m, content = take(gap)
            k = gap // s
            full = min(m, n // k)
            add(full, (*content, (s, k)))
            n -= full * k
            if full < m and n:                             # fewer than k are left
                add(1, (*content, (s, n)))
                full, n = full + 1, 0
            add(m - full, content)

    out, numbers, sequence = [], dict.fromkeys(left, 0), 0
    for gap in gaps:
        for n, content in classes[gap]:
            offset = 0
            for s, k in content:
                out.append((s, numbers[s], k, sequence, offset))
                numbers[s] += n * k
                offset += s * k
            sequence += n
    return sorted(out)


def _place(entries, bits: int = 48):
    steps = np.array(entries, np.int64).reshape(-1, 5)
    keys = (steps[:, 0] << bits) + steps[:, 1]

    def run(batches):
        for batch in batches:
            length = batch["length"].to_numpy().astype(np.int64)
            number = batch["number"].to_numpy()
            step = steps[np.searchsorted(keys, (length << bits) + number, side="right") - 1]
            at, k = number - step[:, 1], step[:, 2]
            names = [n for n in batch.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [*(batch[n] for n in names), pa.array(step[:, 3] + at // k), pa.array(step[:, 4] + at % k * length)],
                names=[*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """Per piece ``doc_id, piece, start, length, ids_crc32, [ids,] sequence_id, offset``."""
    items = pieces(docs, path, capacity, end_id, with_ids)
    by_task = items.groupBy("task", "length").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    by_task = stored(by_task.select("task", "length", "n", F.coalesce(before, F.lit(0)).alias("before")), "packing-counts")
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows
    # rows by task and length grow with the input: never broadcast
    numbered = (items.join(by_task.drop("n").hint("merge"), ["task", "length"])
                .withColumn("number", F.col("number") + F.col("before"))
                .select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []), "number"))
    schema = ITEM + (", ids binary" if with_ids else "") + ", sequence_id bigint, offset bigint"
    return numbered.mapInArrow(_place(plan(counts, capacity)), schema)


def sequences(packed: DataFrame) -> DataFrame:
    """``pack(with_ids=True)`` -> ``(sequence_id, n_tokens, ids, members)``: the sequences themselves."""
    part = F.struct("offset", "ids", "doc_id", "piece", "length")
    members = F.expr("transform(p, x -> struct(x.doc_id, x.piece, x.offset, x.length))")
    return (packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"),
                                              F.sort_array(F.collect_list(part)).alias("p"))
            .select("sequence_id", "n_tokens", F.expr("aggregate(p, cast('' as binary), (a, x) -> concat(a, x.ids))")
                    .alias("ids"), members.alias("members")))


def digest(docs: DataFrame, path: str) -> DataFrame:
    return pack(docs, path).withColumn("length", F.col("length").cast("bigint"))

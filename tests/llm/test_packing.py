"""op12: ids against the tokenizer as called plainly, the packing against its rules and a plain best fit."""
import random
import zlib
from bisect import bisect_left, insort
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from gridlake.llm import packing as P

PATH = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id bigint, text string, length string, sequence_id string"


def ids(text):
    from tokenizers import Tokenizer
    global _T
    try:
        t = _T
    except NameError:
        t = _T = Tokenizer.from_file(PATH)
    return t.encode(text or "", add_special_tokens=False).ids + [1]


def test_ids_are_the_tokenizers():
    w = P.word_ids(PATH)
    texts = ["", "Hello, World's 123!!", "a b c\u0085d", "x\x1cy \x1f z", "<|endoftext|> a<|startoftext|>b",
             "É é é café", "ΟΔΥΣΣΕΥΣ. Σ", "日本語 テスト😀", "İstanbul ǅ", "I'LL don't 'S", "ẞ ŉ ﬁ"]
    texts += ["q" * 3000, "w" * 70 + "."]
    for c in [*range(0x20, 0x250), 0x2028, 0x3000, 0x200b, 0xfeff]:
        texts.append(f"Ab1{chr(c)}cD'S {chr(c)} e.{chr(c)}")
    for t in texts:
        assert np.frombuffer(w.of(t), "<u4").tolist() == ids(t)[:-1], repr(t)


def best_fit(counts, capacity):
    """Sequences of plain best-fit decreasing, item by item."""
    gaps, n = [], 0
    for s in sorted((s for s, k in counts.items() for _ in range(k)), reverse=True):
        at = bisect_left(gaps, s)
        if at == len(gaps):
            n += 1
            insort(gaps, capacity - s)
        else:
            insort(gaps, gaps.pop(at) - s)
    return n


def check_plan(counts, capacity):
    filled, at = defaultdict(list), Counter()
    steps = P.plan(counts, capacity)
    by_length = defaultdict(list)
    for s, first, k, sequence, offset in steps:
        by_length[s].append((first, k, sequence, offset))
    for s, n in counts.items():
        places = by_length[s] + [(n, 0, 0, 0)]
        assert not n or places[0][0] == 0
        for (first, k, sequence, offset), (nxt, *_) in zip(places, places[1:]):
            assert nxt > first and (nxt - first) % k == 0
            for i in range(nxt - first):
                filled[sequence + i // k].append((offset + i % k * s, s))
            at[s] += nxt - first
    assert at == Counter({s: n for s, n in counts.items() if n})
    for content in filled.values():
        end = 0
        for offset, s in sorted(content):
            assert offset == end
            end += s
        assert end <= capacity
        assert sum(3 * s > capacity for _, s in content) <= 2
    return len(filled)


def test_plan_against_plain_best_fit():
    rng = random.Random(5)
    for trial in range(150):
        capacity = rng.choice([7, 30, 100])
        top = rng.choice([capacity, capacity // 2 + 1, max(1, capacity // 3)])
        counts = dict(Counter(rng.randint(1, top) for _ in range(rng.randint(0, 200))))
        n = check_plan(counts, capacity)
        tokens = sum(s * k for s, k in counts.items())
        assert n >= -(-tokens // capacity)
        assert n <= best_fit(counts, capacity) + 1


def test_large_pieces_are_paired_as_often_as_possible():
    rng = random.Random(9)
    for _ in range(60):
        capacity = 12
        items = [rng.randint(5, 12) for _ in range(rng.randint(0, 8))]

        def most(rest):
            if len(rest) < 2:
                return 0
            best = most(rest[1:])
            for i in range(1, len(rest)):
                if rest[0] + rest[i] <= capacity:
                    best = max(best, 1 + most(rest[1:i] + rest[i + 1:]))
            return best
        assert check_plan(dict(Counter(items)), capacity) == len(items) - most(items)


def test_plan_size_does_not_follow_the_documents():
    rng = np.random.default_rng(1)
    sizes, n = np.unique(np.minimum(4096, 1 + rng.exponential(600, 200_000).astype(int)), return_counts=True)
    small = P.plan(dict(zip(sizes.tolist(), n.tolist())))
    large = P.plan(dict(zip(sizes.tolist(), (n * 100_003).tolist())))
    assert len(large) < 3 * len(small) < 200_000
    tokens = int((sizes * n).sum())
    assert check_plan(dict(zip(sizes.tolist(), n.tolist())), 4096) <= 1.01 * -(-tokens // 4096)


def test_lengths_out_of_range():
    assert P.plan({}) == []
    with pytest.raises(ValueError):
        P.plan({5000: 1})


@pytest.mark.parametrize("capacity", [4096, 16])
def test_documents(spark, capacity):
    rng = random.Random(2)
    words = ["Alpha", "beta,", "gamma's", "été", "42", "日本", "…", "don't"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 40))), "x", "y") for i in range(300)]
    rows += [(None, "null id", None, None), (1007, None, None, None), (1008, "", None, None),
             (1009, "same", None, None), (1009, "same", None, None), (1010, "word " * 20_000, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    packed = P.pack(df, PATH, capacity=capacity, with_ids=True)
    got = packed.collect()
    docs = defaultdict(list)
    by_text = Counter((r[0], tuple(ids(r[1]))) for r in rows)
    for r in got:
        assert r["length"] * 4 == len(r["ids"]) and r["ids_crc32"] == zlib.crc32(r["ids"])
        assert 0 < r["length"] <= capacity and r["start"] == r["piece"] * capacity
    for r in got:
        docs[r["doc_id"]].append(r)
    for d in {r[0] for r in rows} - {1009}:
        whole = np.frombuffer(b"".join(r["ids"] for r in sorted(docs[d], key=lambda r: r["piece"])), "<u4").tolist()
        assert by_text[d, tuple(whole)] == 1
    assert len(docs[1009]) == 2 * -(-len(ids("same")) // capacity)
    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for content in places.values():
        end = 0
        for offset, length in sorted(content):
            assert offset == end
            end += length
        assert end <= capacity
    tokens = sum(r["length"] for r in got)
    assert len(places) <= -(-tokens // capacity) * 1.05 + 2
    whole = P.sequences(packed).collect()
    assert len(whole) == len(places) and sum(r["n_tokens"] for r in whole) == tokens
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in whole)


def test_empty_table(spark):
    assert P.pack(spark.createDataFrame([], SCHEMA), PATH).collect() == []

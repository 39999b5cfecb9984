"""op13: against the tokens found by a regular expression, whatever the chunks."""
import hashlib
import random
import re

import numpy as np
import pytest

from gridlake.llm import fill_middle as M

SCHEMA = "doc_id bigint, text string, n string, form string"


def plain(doc_id, text):
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    x, y, z = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(x), len(y), f"<S>{z}<P>{x}<M>{y}"
    return n, "psm", len(x), len(y), f"<P>{x}<S>{z}<M>{y}"


def corpus():
    rng = random.Random(4)
    letters = "abcXYZ"
    shared = "".join(rng.choices("ab C.é\n", k=6000))
    rows = []
    for i in range(150):
        kind = i % 6
        if kind == 0:
            text = "".join(rng.choices(letters + " é日😀\x00\n<>PSM", k=rng.randint(0, 4000)))
        elif kind == 1:
            text = "".join(rng.choices(letters, k=rng.randint(0, 3000)))       # one endless word
        elif kind == 2:
            text = shared[rng.randint(0, 3000):] + str(i)
        elif kind == 3:
            text = "é" * rng.randint(0, 20_000)
        elif kind == 4:
            text = rng.choice(["<", "<P", "<S<S", "ends <"]) + "word " * rng.randint(0, 30) + rng.choice(["<", "<M", "<S"])
        else:
            text = rng.choice(["<P>", "a<S>b", "<M>"]) + shared[:50]
        rows.append((i, text, "x", "y"))
    rows += [(None, "null id of a text", None, None), (200, None, None, None), (201, "", None, None)]
    rows += [(202, "same text here", None, None)] * 3
    rows += [(203 + i, ("Word, " * 200_000) + str(i), None, None) for i in range(2)]
    return rows


def test_against_regular_expression(spark):
    rows = corpus()
    df = spark.createDataFrame(rows, SCHEMA)
    got = M.transform(df).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or 0)
    want = sorted([(r[0], *plain(r[0], r[1])) for r in rows], key=key)
    assert sorted(map(tuple, got), key=key) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    digest = {(r["doc_id"], r["restored_sha256"]) for r in M.digest(df).collect()}
    assert digest == {(r[0], hashlib.sha256((r[1] or "").encode()).hexdigest()) for r in rows}


def test_empty_table(spark):
    assert M.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_chunks_follow_content():
    rng = np.random.default_rng(1)
    passage = rng.integers(97, 123, 20_000).astype(np.uint8)
    sides = []
    for lead in (0, 1, 777):
        data = np.concatenate([rng.integers(97, 123, lead).astype(np.uint8), passage])
        at = M.cuts(data, np.array([0, len(data)]))
        assert np.diff(at).max() <= M.LONGEST_CHUNK
        sides.append({data[a:b].tobytes() for a, b in zip(at[:-1], at[1:])})
    assert len(sides[0] & sides[1] & sides[2]) >= 0.7 * len(sides[0]) > 5


@pytest.mark.parametrize("limit", [0, 1 << 20])
def test_memo_is_verified_and_bounded(monkeypatch, limit):
    monkeypatch.setattr(M, "CACHE_BYTES", limit)
    memo = M.Memo()
    chunks = [bytes([65 + i % 26]) * (i % 7 + 1) + b" x" for i in range(2000)]
    for c in chunks:
        assert memo(c) == M.summary(c)
    assert len(memo.now) <= 26 * 7 and (memo.hits > 1500 if limit else True)


@pytest.mark.parametrize("size", [1, 2, 5, 1000])
def test_any_boundaries_give_the_same_cuts(size):
    text = "ab cdé1 efg😀hij  k".encode()
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text.decode())
    bounds = [*range(0, len(text), size), len(text)]
    bounds = sorted(set(bounds))
    for h1 in range(len(units) + 1):
        for h2 in range(len(units) + 1):
            n, a, b, ca, cb = M.split(text, bounds, M.Memo(), h1, h2)
            x, y = sorted((h1, h2))
            assert n == len(units)
            assert text[:a].decode() == "".join(units[:x]) and text[a:b].decode() == "".join(units[x:y])
            assert (ca, cb) == (len("".join(units[:x])), len("".join(units[x:y])))

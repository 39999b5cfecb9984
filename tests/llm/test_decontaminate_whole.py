"""Benchmark decontamination as the queries call it (``whole``)."""

import sys

import numpy as np

from gridlake.llm import decontaminate

ITEM = "Every morning the farmer called John buys 3 apples and walks 5 km to the market, where John sells them for 12 dollars."


def _caught(spark, docs, bench, **how):
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    return {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(d, b, whole=True, **how).collect()}


def test_case_does_not_hide_a_copy(spark):
    accents = "the élève said that übung and ñandú are öfter seen near the ærø coast"
    docs = [f"we say {ITEM.upper()} here", f"x {ITEM.title()} y", ITEM.lower(), ITEM.upper().replace("12", "13"),
            f"so {accents.upper()} it is", "EVERY MORNING THE FARMER CALLED ON THE MAYOR OF THE TOWN", ITEM]
    got = _caught(spark, docs, [ITEM, accents])
    assert set(got) == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (6, 0)}
    assert got[(0, 0)].changed == 0 and got[(3, 0)].changed == 1
    d = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    b = spark.createDataFrame([(0, ITEM)], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.clean(d, b, whole=True).collect()) == [4, 5]


def test_folding_keeps_the_tokens():
    raw = "".join(f"a {chr(c)} b1" for c in range(32, sys.maxunicode + 1) if not 0xD800 <= c < 0xE000).encode()
    data, offsets = np.frombuffer(raw, np.uint8), np.array([0, len(raw)])
    low, low_offsets = decontaminate.fold(data, offsets)
    assert len(decontaminate._spans(data, offsets)[0]) == len(decontaminate._spans(low, low_offsets)[0])


def test_a_clash_removes_only_its_windows(spark):
    numbers = ("The seller packs 2 apples into each of the small wooden boxes on the long table near the door "
               "and then asks every single visitor for 2 dollars at the end of the day.")
    docs = [ITEM.replace("called John", "called Peter"), "so " + numbers.replace("2 apples", "7 apples").replace("2 dollars", "9 dollars"),
            numbers.replace("2 dollars", "3 dollars"), "The seller packs 4 apples into each of many crates", numbers]
    got = _caught(spark, docs, [ITEM, numbers])
    assert set(got) == {(0, 0), (1, 1), (2, 1), (4, 1)}
    assert got[(4, 1)].changed == 0 and got[(1, 1)].changed == 1


def test_items_with_few_plain_words(spark, monkeypatch):
    bench = ["12 + 34 = 46, 7 * 8 = 56, 90 - 45 = 45, 3 * 9 = 27", "Anna Smith, Carl Brown, Dora White, Emil Black, Fay Green, Gus Gray",
             "What is 12 times 34", "Prime numbers", "小明有三个苹果他又买了五个苹果现在一共有几个", "2 + 2", "ราคาสินค้าทั้งหมดเท่าไร", "?!"]
    docs = ["see 12 + 34 = 46, 7 * 8 = 56, 90 - 45 = 45, 3 * 9 = 27 there", f"friends: {bench[1]} and more", "So: what is 5 times 6?",
            "all PRIME numbers here", "prime and other numbers", "老师说。小明有三个苹果他又买了五个苹果现在一共有几个？请回答",
            "小明有两只猫", "is 2 + 2 four", "และราคาสินค้าทั้งหมดเท่าไรครับ", "see 12 + 34 = 47, 7 * 9 = 63, 80 - 45 = 35, 3 * 8 = 24 there"]
    want = {(0, 0), (1, 1), (2, 2), (3, 3), (5, 4), (7, 5), (8, 6)}
    assert set(_caught(spark, docs, bench, short="anywhere")) == want
    monkeypatch.setattr(decontaminate, "FILTER_BYTES", 0)
    assert set(_caught(spark, docs, bench, short="anywhere")) == want
    assert set(_caught(spark, docs, bench)) == want - {(3, 3), (7, 5)}


def test_short_items_are_whole_lines_or_texts(spark):
    bench = ["Yes", "2 + 2", "Prime numbers"]
    docs = ["yes", "well yes of course", "a line\nYes\nanother", "so\n  YES!  \r\nit is", "is 2 + 2 four\n2 + 2\n", "2 + 2 is", "",
            "prime numbers\n and more", "of prime numbers", "prime\nnumbers", None, "word " * 40_000 + "yes\nyes"]
    assert set(_caught(spark, docs, bench)) == {(0, 0), (2, 0), (3, 0), (4, 1), (7, 2), (9, 2), (11, 0)}
    d = spark.createDataFrame([(None if i in (0, 2) else i, t, i) for i, t in enumerate(docs)], "doc_id long, text string, n int")
    b = spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    kept = decontaminate.clean(d, b, whole=True)
    assert kept.columns == d.columns and sorted(r.n for r in kept.collect()) == [1, 5, 6, 8, 10]


STORY = ("On the first day of spring the baker met {a} near the old stone bridge, and they talked for long about the weather. "
         "Later in the week, while it rained over the harbour, the baker saw {b} walk along the narrow street with a basket. "
         "When summer came and the fields were dry, the baker wrote to {c} and asked about the price of flour there. "
         "At the end of that year, as snow lay on the roofs, the baker sold the last loaf to {d} without any regret.")


def test_names_must_stand_for_the_same_names(spark):
    item = STORY.format(a="Alice", b="Bob", c="Alice", d="Bob")
    docs = [STORY.format(a="Carol", b="Dave", c="Carol", d="Dave"), STORY.format(a="Carol", b="Dave", c="Erin", d="Frank"),
            item, STORY.format(a="Alice", b="Dave", c="Alice", d="Frank")]
    got = _caught(spark, docs, [item])
    counts = [got[(i, 0)].matched for i in range(4)]
    assert counts[0] == counts[2] > counts[3] > counts[1]


def test_an_item_of_clashing_windows_does_not_match(spark):
    item = "take 5 of them and 5 of those but not 5 of these or 5 of any of the 5 we saw"
    values = iter(range(10, 90))
    changed = " ".join(str(next(values)) if w == "5" else w for w in item.split())
    got = _caught(spark, [changed, item.replace("5", "7"), item], [item])
    assert set(got) == {(1, 0), (2, 0)} and got[(1, 0)].changed == 1


def _brute(docs, bench):
    """The rules of the module's text, window by window, for texts of plain words, numbers and no names."""
    import re

    def tokens(t):
        out = []
        for line_no, line in enumerate((t or "").split("\n")):
            out += [(w.lower(), line_no) for w in re.findall(r"[A-Za-z0-9]+", line)]
        return out

    def kinds(ws):
        return ["num" if w[0].isdigit() else "unit" if i and ws[i - 1][0].isdigit() and w in decontaminate.UNITS else None
                for i, w in enumerate(ws)]
    found = {}
    for di, d in enumerate(docs):
        dt = tokens(d)
        dw = [w for w, _ in dt]
        dk = kinds(dw)
        for bi, b in enumerate(bench):
            bw = [w for w, _ in tokens(b)]
            bk = kinds(bw)
            n = min(len(bw), decontaminate.WINDOW)
            least = decontaminate.LITERALS * n // decontaminate.WINDOW
            covered, typed = set(), {}
            for i in range(len(bw) - n + 1 if bw else 0):
                for j in range(len(dw) - n + 1):
                    if dw[j:j + n] == bw[i:i + n]:
                        edge = (j == 0 or dt[j - 1][1] != dt[j][1]) and (j + n == len(dw) or dt[j + n][1] != dt[j + n - 1][1])
                        if n >= decontaminate.SHORTEST or edge:
                            covered |= set(range(i, i + n))
                    if n >= decontaminate.SHORTEST and bk[i:i + n].count(None) >= least and all(
                            x == y and (x or v == w) for x, y, v, w in zip(bk[i:i + n], dk[j:j + n], bw[i:i + n], dw[j:j + n])):
                        pairs = {(v, w) for x, v, w in zip(bk[i:i + n], bw[i:i + n], dw[j:j + n]) if x}
                        if len({v for v, _ in pairs}) == len(pairs):
                            typed.setdefault(j - i, []).append((i, pairs))
            for hits in typed.values():
                votes = {}
                for _, pairs in hits:
                    for v, w in pairs:
                        # the typed and the folded set each give the window
                        votes.setdefault(v, {}).setdefault(w, 0)
                        votes[v][w] += 1
                vote = {v: min(ws, key=lambda w, v=v, ws=ws: (-ws[w], w != v, w)) for v, ws in votes.items()}
                for i, pairs in hits:
                    if all(v == w for v, w in pairs) or all(vote[v] == w for v, w in pairs):
                        covered |= set(range(i, i + n))
            if covered and len(covered) >= min(decontaminate.MATCHED, len(bw)):
                found[di, bi] = len(covered)
    return found


def test_whole_against_brute_force(spark):
    import random
    rng = random.Random(11)
    words = ["take", "apples", "from", "km", "the", "long", "way", "kg", "home", "and", "some", "more"]

    def text(n):
        return " ".join(rng.choice(["2", "3", "5"]) if rng.random() < 0.25 else rng.choice(words) for _ in range(n))
    bench = [text(rng.choice([1, 2, 4, 5, 6, 8, 9, 14, 25, 40])) for _ in range(25)]
    docs = []
    for i in range(60):
        item = rng.choice(bench).split()
        copy = [rng.choice("4567") if w.isdigit() and rng.random() < 0.5 else w for w in item]
        docs.append(rng.choice([" ", "\n"]).join([text(rng.randint(0, 12)), " ".join(copy), text(rng.randint(0, 12))]))
    got = {k: r.matched for k, r in _caught(spark, docs, bench).items()}
    assert got == _brute(docs, bench) and len(got) > 30


def test_unspaced_scripts_are_split():
    raw = "ab漢字、かな𠀀x é1.5".encode()
    starts, ends, _ = decontaminate._spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert [raw[a:b].decode() for a, b in zip(starts, ends)] == ["ab", "漢", "字", "か", "な", "𠀀", "x", "é1.5"]
    for cut in range(len(raw)):
        decontaminate._spans(np.frombuffer(raw[:cut], np.uint8), np.array([0, cut]))

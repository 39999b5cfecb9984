"""Very long texts, line ends in urls and repeated rows in operators whose other tests hold the rules."""
import random

from gridlake.llm import jaccard_join, license_scan, suffix_dedup, url_rules, warc_fixity


def test_line_ends_in_urls_stay_inside_their_header(spark, tmp_path):
    urls = ["http://a.b/\r\n\r\nx", "http://a.b/\nContent-Length: 3", None, "http://c.d/", "\r", "http://e.f/" + "y" * 100_000]
    pages = spark.createDataFrame([(i, u, "<p>\r\n\r\n" * i if i % 2 else None, "c") for i, u in enumerate(urls)],
                                  "page_id long, url string, html string, record string")
    made = warc_fixity.records(pages)
    warc_fixity.write(made, str(tmp_path / "warc"))
    back = warc_fixity.read(spark, str(tmp_path / "warc"))
    assert sorted((r.page_id, bytes(r.record)) for r in back.collect()) == sorted((r.page_id, bytes(r.record)) for r in made.collect())
    assert warc_fixity.audit(warc_fixity.tree(made), warc_fixity.tree(back)).count() == 0


def test_very_long_texts_join_whole(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(5000)]
    long = [rng.choice(words) for _ in range(20_000)]
    changed = long[:10_000] + ["other"] * 50 + long[10_050:]
    far = long[:10_000] + [rng.choice(words) for _ in range(10_000)]
    docs = spark.createDataFrame([(1, " ".join(long)), (2, " ".join(changed)), (3, " ".join(far)), (4, "short text here")],
                                 "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in jaccard_join.join(docs, k=3, num=90, den=100).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_very_long_texts_lose_shared_strings(spark):
    rng = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz "
    a = "".join(rng.choices(letters, k=100_000))
    b = "".join(rng.choices(letters, k=60_000)) + a[70_000:70_400] + "".join(rng.choices(letters, k=20_000))
    docs = spark.createDataFrame([(1, a), (2, b), (2, "tail"), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans) for r in suffix_dedup.report(docs).collect())
    assert [g[:2] for g in got if g[0] == 1] == [(1, 100_000)] and [g[2] for g in got if g[0] == 1] == [0]
    removed = [g for g in got if g[0] == 2 and g[1] > 10]
    assert removed and 400 <= removed[0][2] <= 402 and removed[0][3] == 1


def test_repeated_rows_and_very_long_texts_of_licenses(spark):
    name, notice = license_scan.NOTICES[0][:2]
    rows = [(1, f"x {notice} y", "c")] * 3 + [(None, notice, "c"), (2, "word " * 60_000 + notice, "c"), (3, None, "c")]
    got = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string, license string"), license_scan.NOTICES).collect()
    assert {r.doc_id for r in got if r.license == name} == {1, 2, None}


def test_very_long_urls_are_judged_whole(spark):
    rows = [(1, "http://example.com/de/" + "a/" * 100_000), (2, "http://x.net/" + "?" * 50_000), (3, "h" * 200_000)]
    got = {r.page_id: (r.rule, r.verdict) for r in url_rules.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[1] == ("example.com/de/", "block") and got[2] == ("net/", "block") and got[3][0] is None

"""License scans, benchmark decontamination, URL rules, WARC fixity and the classifier on small fixtures."""

import random
import re

import duckdb
import pytest

from gridlake.llm import decontaminate, license_scan, quality, url_rules, warc_fixity


# ------------------------------------------------------------------ licenses

def _shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[0-9a-z\u0080-\U0010ffff]+", low)
    if not w:
        return []
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)] or [tuple(w)]


def test_licenses_match_direct_containment(spark):
    rnd = random.Random(2)
    vocab = [f"word{i}" for i in range(200)] + ["license", "under", "the", "Licensed"]

    def filler(n):
        return " ".join(rnd.choice(vocab) for _ in range(n))
    rows = [(0, None), (1, ""), (2, "Released under the MIT License."), (3, "released  UNDER\nthe mit license"),
            (4, "under the MIT License"), (5, "Released under the MIT")]
    for i, (name, text) in enumerate(license_scan.TEMPLATES):
        rows.append((10 + i, f"{filler(rnd.randrange(300))} {text} {filler(rnd.randrange(300))}"))
        rows.append((30 + i, text))
        words = text.split()
        if len(words) > 40:
            one = list(words)
            one[len(one) // 2] = "CHANGED"          # 5 shingles of many
            rows.append((50 + i, f"{filler(77)} {' '.join(one)} {filler(5)}"))
            rows.append((70 + i, f"{filler(77)} {' '.join(words[:len(words) // 2])} {filler(50)}"))
    rows += [(90, filler(4000) + " Licensed under CC BY-NC 4.0. " + filler(10)), (None, "Released under the MIT License.")]
    want = set()
    for i, t in rows:
        have = set(_shingles(t))
        for name, template in license_scan.TEMPLATES:
            s = set(_shingles(template))
            if len(s & have) / len(s) >= 0.8:
                want.add((i, name))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    found = license_scan.scan(docs).collect()
    assert {(r.doc_id, r.license) for r in found} == want and len(found) == len(want)
    assert license_scan.scan(docs.where("doc_id = -1")).count() == 0


# ------------------------------------------------------------- decontamination


def test_reparameterised_items_are_caught(spark):
    item = "Every morning the farmer called John buys 3 apples and walks 5 km to the market, where John sells them for 12 dollars."
    changed = item.replace("John", "Peter").replace("3", "40").replace("5 km", "7 miles").replace("12", "9")
    clash = item.replace("called John", "called Peter")
    short = "alpha beta gamma delta epsilon"
    docs = [(0, None), (1, ""), (2, "quite another text about farmers and morning walks " * 5),
            (3, f"intro words here. {item} and more"), (4, f"intro. {changed} outro"), (5, f"x. {clash} y"),
            (6, item.upper()), (7, f"we saw {short} here"), (8, "Every morning the farmer called on the old mayor of the town again"),
            (3, "a second row of document three"), (None, item)]
    bench = [(100, item), (101, short), (102, "too short"), (103, None), (100, item), (None, item)]
    d = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, size string")
    b = spark.createDataFrame([(*r, 1) for r in bench], "item_id long, text string, doc_id int").drop("doc_id")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.contaminated(d, b).collect()}
    assert set(got) == {(3, 100), (4, 100), (7, 101)}
    assert got[(3, 100)].changed == 0 and got[(4, 100)].changed >= 4
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 5, 6, 8]


def test_large_benchmark_takes_the_shuffle(spark, monkeypatch):
    rnd = random.Random(5)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rnd.choice(vocab) for _ in range(rnd.randrange(3, 40)))) for i in range(30)]
    docs = [(i, " ".join(rnd.choice(vocab) for _ in range(80))) for i in range(20)]
    docs += [(100 + i, docs[i % 20][1] + " " + t + " " + docs[(i + 3) % 20][1]) for i, t in items]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    small = sorted(map(tuple, decontaminate.contaminated(d, b).collect()))
    monkeypatch.setattr(decontaminate, "FILTER_BYTES", 0)
    assert sorted(map(tuple, decontaminate.contaminated(d, b).collect())) == small
    assert {(100 + i, i) for i, t in items if len(t.split()) >= 5} <= {(r[0], r[1]) for r in small}
    empty = decontaminate.contaminated(d, b.where("item_id < 0"))
    assert empty.count() == 0 and decontaminate.contaminated(d.where("doc_id < 0"), b).count() == 0


# ------------------------------------------------------------------ url rules

URLS = ["http://a.example.net/en/1", "https://EXAMPLE.net/en/", "http://example.net/en", "http://net/x", "http://xnet/x",
        "http://b.example.com/de/2?x=1", "http://example.com/den/", "http://www.x.org/fr/9#t", "http://x.org/", "ftp://c.net",
        "http://c.net?x", "http://c.net/#x", None, "no scheme", "http://example.net.org/fr/a/b", "://", "x://y://z.net/"]


def _parts(u):
    if u is None or "://" not in u:
        return "", ""
    rest = u[u.index("://") + 3:]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def test_listed_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, URLS[0]), (None, URLS[0])]
    got = url_rules.judge(spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, host string")).collect()
    assert len(got) == len(rows)
    by = {r.page_id: r for r in got}
    for i, u in enumerate(URLS):
        host, path = _parts(u)
        fits = [(len(h + p), h + p, k) for k, h, p in url_rules.LISTED
                if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits, default=None)
        assert (by[i].host, by[i].path) == (host, path)
        assert by[i].rule == (rule and rule[1])
        if rule:
            assert by[i].verdict == rule[2]
    assert by[12].verdict == "allow"


def test_mined_rules_match_direct_search(spark):
    rnd = random.Random(3)
    rows = [(i, f"http://{rnd.choice(['m', 'blog', 'casino-x'])}.example.{rnd.choice(['net', 'com', 'org'])}/"
                f"{rnd.choice(['en', 'de', 'fr'])}/{i}{rnd.choice(['', '.html', '?ref=x'])}") for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    parts = url_rules.split_url(pages).withColumn("tokens", url_rules.tokens())
    rule, verdict = url_rules.listed_rule()
    labelled = parts.withColumn("v", verdict).where("v is not null").select("tokens", "v").collect()
    mined = url_rules.mine(parts.withColumn("verdict", verdict).where("verdict is not null"), 0.02, 0.8).collect()
    assert mined
    for r in mined:
        cover = [x.v for x in labelled if set(r["items"]) <= set(x.tokens)]
        hits = cover.count(r.verdict)
        assert hits / len(labelled) == pytest.approx(r.support) and hits / len(cover) == pytest.approx(r.confidence)
    got = {r.page_id: r for r in url_rules.judge(pages).collect()}
    for x in parts.collect():
        if got[x.page_id].rule is None:
            fits = [r for r in mined if set(r["items"]) <= set(x.tokens)]
            best = max(fits, key=lambda r: (r.confidence, r.support, len(r["items"]), r.verdict), default=None)
            assert got[x.page_id].verdict == (best.verdict if best else "allow")
    assert url_rules.judge(pages.where("page_id < 0")).count() == 0


# ----------------------------------------------------------------------- warc

def test_audit_finds_planted_damage(spark, tmp_path):
    rows = [(i, f"http://x/{i}", f"<p>{i} é</p>" * (i % 7)) for i in range(9000, 13500, 3)]
    rows += [(9000, "http://x/again", "second"), (9003, None, None), (20000, "u", None), (None, "lost", "x")]
    left = spark.createDataFrame(rows, "page_id long, url string, html string")
    other = [r for r in rows if r[0] != 9006]
    other = [(i, u, "broken" if i == 12000 else h) for i, u, h in other] + [(50000, "new", "n"), (9009, "dup", "d")]
    right = spark.createDataFrame(other, "page_id long, url string, html string")
    a, b = (warc_fixity.tree(warc_fixity.records(x)) for x in (left, right))
    got = {r.page_id: r.kind for r in warc_fixity.audit(a, b).collect()}
    assert got == {9006: "missing", 12000: "changed", 50000: "extra", 9009: "changed"}
    assert warc_fixity.audit(a, a).count() == 0
    none = warc_fixity.tree(warc_fixity.records(left.where("page_id < 0")))
    assert warc_fixity.audit(a, none).count() == len({r[0] for r in rows if r[0] is not None})
    path = str(tmp_path / "warc")
    archive = warc_fixity.records(left)
    warc_fixity.write(archive, path)
    back = warc_fixity.tree(warc_fixity.read(spark, path))
    assert warc_fixity.audit(a, back).count() == 0
    # offsets are those of the files
    first = next((tmp_path / "warc").glob("file=2/*.txt")).read_bytes()
    for r in a.where("level = 0 and file = 2").limit(20).collect():
        assert first[r.start:].startswith(b"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:%d>" % r.node)


def test_audit_query_equals_sql(spark):
    sf = "/root/testdata/sf0.01"
    got = sorted(map(tuple, warc_fixity.report(spark.read.parquet(f"{sf}/pages.parquet")).collect()))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf}/pages.parquet')")
    assert got == sorted(con.execute(warc_fixity.ORACLE).fetchall())


# -------------------------------------------------------------------- quality

def _marked(n):
    rnd = random.Random(1)
    good = [f"g{i}" for i in range(50)]
    rows = []
    for i in range(n):
        y = int(rnd.random() < 0.8)
        w = [rnd.choice(good) for _ in range(rnd.randrange(8, 60))]
        rows.append((i, " ".join(w) if y else " | ".join(w), y))
    return rows


def test_classifier_on_held_out_rows(spark):
    rows = _marked(1200)
    docs = spark.createDataFrame([(i, t, y) for i, t, y in rows] + [(5000, None, 0), (5001, "", 1), (None, "g1 g2", 0), (7, rows[7][1], 0)],
                                 "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y, 0) for i, _, y in rows] + [(5000, None, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    got = quality.classify(docs, labels).collect()
    assert len(got) == len(rows) + 4 and all(0 <= r.score <= 1 for r in got)
    truth = {i: y for i, _, y in rows}
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert len(held) > 150 and sum(r.predicted == truth[r.doc_id] for r in held) / len(held) > 0.97
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted for r in got)


def test_classifier_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.classify(docs, labels).collect()] == [0.5, 0.5]
    assert quality.classify(docs.where("doc_id < 0"), labels).count() == 0

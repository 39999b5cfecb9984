"""License scan with the notices of the query."""

from gridlake.llm import license_scan


def _found(spark, texts, templates=license_scan.NOTICES):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = license_scan.scan(docs, templates).collect()
    assert len({(r.doc_id, r.license) for r in rows}) == len(rows)
    return {i: {r.license for r in rows if r.doc_id == i} for i in range(len(texts))}


def test_short_notices_match_inside_texts(spark):
    got = _found(spark, ["some text here. All rights reserved. more text follows", "it is licensed under the MIT License, see there",
                         "all of the rights are reserved", "All rights reserved", "a (CC BY 4.0) picture and a CC BY-NC-SA 4.0 one", ""])
    assert got == {0: {"All-rights-reserved"}, 1: {"MIT"}, 2: set(), 3: {"All-rights-reserved"},
                   4: {"CC-BY-4.0", "CC-BY-NC-SA-4.0"}, 5: set()}


def test_every_notice_is_its_own_license(spark):
    names = [name for name, _ in license_scan.NOTICES]
    got = _found(spark, [f"first words of a file {text} and the words after it" for _, text in license_scan.NOTICES])
    assert [got[i] for i in range(len(names))] == [{n} for n in names]


def test_places_of_several_licenses(spark):
    by = dict(license_scan.NOTICES[:4])
    gpl = next(t for n, t in license_scan.NOTICES if n == "GPL-2.0")
    got = _found(spark, [f"{gpl} {by['MIT']} {gpl} All rights reserved.", gpl.replace("useful", "helpful"),
                         "under the terms of the GNU Lesser General Public License as printed"])
    assert got == {0: {"GPL-2.0", "MIT", "All-rights-reserved"}, 1: {"GPL-2.0"}, 2: {"LGPL"}}


def test_templates_from_a_table(spark):
    table = spark.createDataFrame([("House", "house rules apply"), ("None", None), ("Marks", "?!")], "license string, text string")
    got = _found(spark, ["here house rules apply too", "All rights reserved."], table)
    assert got == {0: {"House"}, 1: set()}

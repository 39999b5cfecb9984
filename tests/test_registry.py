"""Registry: seeds, versioned CRUD, validation, conversion, stats."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gridlake.catalog import SAMPLE_MAPPING, SEED_MAPPINGS
from gridlake.sources import registry as R

T1 = datetime(2025, 1, 1, tzinfo=timezone.utc)
T2 = datetime(2025, 2, 1, tzinfo=timezone.utc)


def test_seed_skips_existing(spark):
    reg = R.registry_frame(spark, [SEED_MAPPINGS[0]])
    seeded = R.seed_registry(spark, reg)
    assert sorted(r["source_id"] for r in seeded.collect()) == ["Inv", "Inv_short", "current_format"]
    assert seeded.where("source_id = 'Inv'").count() == 1


def test_crud_versions_q21(spark, registry):
    reg = R.create_mapping(spark, registry, SAMPLE_MAPPING, at=T1)
    with pytest.raises(ValueError):
        R.create_mapping(spark, reg, SAMPLE_MAPPING, at=T1)
    upd = dict(SAMPLE_MAPPING, description="v2")
    reg = R.update_mapping(spark, reg, upd, at=T2)
    cur = R.by_id(reg, "MyDevice").first()
    assert cur["version"] == 2 and cur["description"] == "v2"
    assert cur["created_at"].replace(tzinfo=None) == T1.replace(tzinfo=None)   # kept
    reg = R.delete_mapping(spark, reg, "MyDevice", at=T2)
    assert R.by_id(reg, "MyDevice").count() == 0
    with pytest.raises(ValueError):
        R.update_mapping(spark, reg, upd)       # unknown / inactive id is an error
    reg = R.create_mapping(spark, reg, SAMPLE_MAPPING, at=T2)   # recreate over inactive
    assert R.by_id(reg, "MyDevice").first()["version"] == 4
    assert R.duplicate_ids(reg).count() == 0


def test_validate_spec_u2_q22():
    bad = {"source_id": "", "rules": [("", "x", "int", "", None, False),
                                      ("a", "b", "decimal", "times:2", None, False),
                                      ("a", "b", "int", "divide:abc", None, False)]}
    msgs = R.validate_spec(bad)
    assert msgs[0] == "source_id is required"
    assert "mapping[0]: source_field is required" in msgs
    assert "mapping[1]: data_type must be one of string int float bool" in msgs
    assert any(m.startswith("mapping[1]: invalid transform operation") for m in msgs)
    assert any(m.startswith("mapping[2]: invalid transform format") for m in msgs)
    assert R.validate_spec({"source_id": "x", "rules": []}) == ["at least one field mapping is required"]
    assert R.validate_spec(SAMPLE_MAPPING) == []


def test_validate_frame_matches_spec(spark):
    bad = {"source_id": "b", "rules": [("a", "b", "decimal", "times:2", None, False),
                                       ("", "c", "int", "divide:1000", None, False)]}
    reg = R.registry_frame(spark, SEED_MAPPINGS + [bad])
    rows = sorted((r["source_id"], r["idx"], r["message"]) for r in R.validate(reg).collect())
    assert [r[0] for r in rows] == ["b", "b", "b"]
    assert set(m for _, _, m in rows) == set(R.validate_spec(bad))


def test_from_requests_u4(spark):
    body = ('{"source_id": "MyDevice", "nested_path": "data", "mappings": ['
            '{"source_field": "sno", "standard_field": "serial_no", "data_type": "string", "required": true},'
            '{"source_field": "p", "standard_field": "power", "data_type": "int", "transform": "divide:1000",'
            ' "default_value": 0}]}')
    reg = R.from_requests(spark.createDataFrame([(body,)], "body string"))
    row = reg.first()
    assert row["active"] is True and row["mappings"][1]["default_json"] == "0"
    m = R.compile_registry(reg)[0]
    assert m.rules[0].required and m.rules[1].transform.op == "divide" and m.rules[1].default == 0


def test_mapping_stats_g4(spark, registry):
    reg = R.delete_mapping(spark, registry, "Inv_short", at=T2)
    s = R.mapping_stats(reg).first()
    assert (s["total_active"], s["total_inactive"]) == (2, 1)
    assert s["total_fields"] == 25 + 8 and s["required_fields"] == 1
    assert s["transformed_fields"] == 19        # Inv: 3 power/energy + 8 pv + 6 grid + temp + freq
    assert s["avg_fields_per_mapping"] == 33 / 2
    empty = R.mapping_stats(R.empty_registry(spark)).first()
    assert empty["total_active"] == 0 and empty["avg_fields_per_mapping"] is None


def test_mapping_exists_j6(spark, registry):
    ids = spark.createDataFrame([("Inv",), ("nope",), ("current_format",)], "source_id string")
    got = sorted(r["source_id"] for r in R.mapping_exists(ids, registry).collect())
    assert got == ["Inv", "current_format"]


def test_compile_size_check(spark, registry):
    m = R.compile_registry(registry.select("*"))      # goes through the Spark path
    assert [x.source_id for x in m] == ["Inv", "Inv_short", "current_format"]
    assert m[0].threshold == 10 and m[1].threshold == 9 and m[2].threshold == 3

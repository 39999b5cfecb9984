"""The automatic plan choice also looks at the number of rules."""

import json

from conftest import raw_frame
from gridlake.plans.normalize import normalize
from gridlake.sources.registry import MAX_COMPILED_RULES, registry_frame


def test_few_sources_with_many_rules_take_the_rules_plan(spark):
    rules = [(f"k{i}", "slave_id", "string", "", None, False) for i in range(MAX_COMPILED_RULES + 1)]
    reg = registry_frame(spark, [{"source_id": "big", "nested_path": "", "rules": rules}])
    raw = raw_frame(spark, [json.dumps({"source_id": "big", "k7": "x"})])
    for registry in (reg, reg.select("*")):          # as made and as the result of a query
        n = normalize(raw, registry)
        assert n.plan == "rules"
    assert [(r["device_type"], r["slave_id"]) for r in n.readings.collect()] == [("big", "x")]
    small = registry_frame(spark, [{"source_id": "s", "nested_path": "", "rules": rules[:1]}])
    assert normalize(raw, small.select("*")).plan == "compiled"

"""Field mapping compiled to column expressions.

For each rule the value is taken from ``payload[nested_path][field]`` when the
nested entry is an object holding the field, else from ``payload[field]``
(root fallback, P1).  A missing value takes the rule's default as is (Q19);
a missing required field without default is a row error naming the first
such rule (P3); a missing optional field is omitted.  Present values are
converted by the rule's data type and numeric transforms are applied (P10).

The whole registry becomes one projection: per canonical column a
``CASE source_id WHEN ...`` over the compiled mappings.  Only the branch of
a row's own source is evaluated, so the per-row cost follows the size of one
mapping, not of the registry.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import (DETAIL_COLUMNS, ERR_INVALID_JSON, ERR_REQUIRED, ERR_UNKNOWN_SOURCE,
                       STANDARD_ALIASES, canonical_type)
from ..functions.transform import apply_transform
from ..functions.variant import number_value, to_bool, to_string
from ..sources.registry import CompiledMapping, Rule
from ..functions.memo import memo
from .common import project_once
from .intake import vget

NATIVE = {"string": "string", "int": "double", "float": "double", "bool": "boolean"}


def native_type(rule: Rule) -> str:
    return NATIVE.get(rule.data_type, "string")


def rule_value(v: Column, mapping: CompiledMapping, rule: Rule) -> Column:
    """The rule's raw variant value with root fallback; NULL when missing."""
    root = vget(v, rule.source_field)
    if mapping.nested_path:
        return F.coalesce(vget(v, mapping.nested_path, rule.source_field), root)
    return root


def _default_literal(rule: Rule) -> Column:
    """The default value as a literal of the rule's native type (stored as is, Q19)."""
    d, t = rule.default, native_type(rule)
    if t == "double":
        if isinstance(d, bool):
            val = 0.0
        elif isinstance(d, (int, float)):
            val = float(d)
        else:
            try:
                val = float(str(d))
            except ValueError:
                val = 0.0
        return F.lit(val).cast("double")
    if t == "boolean":
        if isinstance(d, bool):
            return F.lit(d)
        if isinstance(d, (int, float)):
            return F.lit(d != 0)
        return F.lit(str(d) in ("true", "1"))
    if d is None:
        return F.lit("")
    if isinstance(d, bool):
        return F.lit("true" if d else "false")
    if isinstance(d, float) and d.is_integer():
        return F.lit(str(int(d)))
    return F.lit(d if isinstance(d, str) else str(d))


def convert_present(x: Column, rule: Rule, int_mode: str = "keep") -> Column:
    """Typed value of a present variant ``x`` (P6-P9) with the transform applied (P10)."""
    t = native_type(rule)
    if t == "double":
        num = apply_transform(F.coalesce(number_value(x), F.lit(0.0)), rule.transform)
        if rule.data_type == "int" and int_mode == "truncate":
            num = num.try_cast("bigint").cast("double")
        return num
    if t == "boolean":
        return to_bool(x)
    return to_string(x)


def rule_output(x: Column, rule: Rule, int_mode: str = "keep") -> Column:
    """Native-typed mapped value of raw value ``x``; NULL when missing without default."""
    present = convert_present(x, rule, int_mode)
    if rule.has_default:
        return F.when(x.isNull(), _default_literal(rule)).otherwise(present)
    return F.when(x.isNotNull(), present)


def required_error(values: list[Column], mapping: CompiledMapping) -> Column:
    """``required field missing: <f>`` for the first failing required rule, else NULL."""
    checks = [F.when(x.isNull(), F.lit(ERR_REQUIRED + r.source_field))
              for x, r in zip(values, mapping.rules) if r.required and not r.has_default]
    if not checks:
        return F.lit(None).cast("string")
    return F.coalesce(*checks)


def map_fields(values: list[Column], mapping: CompiledMapping,
               int_mode: str = "keep") -> dict[str, tuple[str, Column]]:
    """standard_field -> (native type, value); a later rule for the same field wins."""
    out: dict[str, list[tuple[str, Column]]] = {}
    for x, r in zip(values, mapping.rules):
        out.setdefault(r.standard_field, []).append((native_type(r), rule_output(x, r, int_mode)))
    return {k: _last_present(vals) for k, vals in out.items()}


def _last_present(vals: list[tuple[str, Column]]) -> tuple[str, Column]:
    if len(vals) == 1:
        return vals[0]
    # mixed types collapse to text; a later present rule overwrites an earlier one
    types = {t for t, _ in vals}
    if len(types) == 1:
        t = vals[0][0]
        return t, F.coalesce(*[c for _, c in reversed(vals)])
    return "string", F.coalesce(*[_render(t, c) for t, c in reversed(vals)])


def _render(t: str, c: Column) -> Column:
    if t == "double":
        return render_double(c)
    if t == "boolean":
        return F.when(c, F.lit("true")).when(~c, F.lit("false"))
    return c


def render_double(c: Column) -> Column:
    """Plain decimal text of a double: integral values without ``.0`` (Q18)."""
    integral = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
    return F.when(integral, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def to_canonical(t: str, c: Column, target: str) -> Column:
    """Typed getter from a mapped value into a canonical column type."""
    want = canonical_type(target)
    if want == "double":
        if t == "double":
            return c
        if t == "string":
            return c.try_cast("double")
        return F.lit(None).cast("double")
    if want == "bigint":
        if t == "double":
            return c.try_cast("bigint")
        return F.lit(None).cast("bigint")
    if t == "double":
        return render_double(c)
    if t == "boolean":
        return _render(t, c)
    return c


def canonical_name(standard_field: str) -> str:
    return STANDARD_ALIASES.get(standard_field, standard_field)


def _raw_struct(v: Column, mapping: CompiledMapping) -> Column:
    """Struct of the rule values (variants, NULL when missing), fields r0, r1, ..."""
    return F.struct(*[rule_value(v, mapping, r).alias(f"r{j}") for j, r in enumerate(mapping.rules)])


def _canonical_values(raw: Column, mapping: CompiledMapping, int_mode: str) -> dict[str, Column]:
    """Canonical column -> typed value of one mapping, from its raw-value struct.

    Of several rules for one column the last whose value is present (or has a
    default) decides, converted by its own type, even if the value cannot be
    read as the column's type.
    """
    values = [raw.getField(f"r{j}") for j in range(len(mapping.rules))]
    by_target: dict[str, list[tuple[Column | None, Column]]] = {}
    for x, r in zip(values, mapping.rules):
        name = canonical_name(r.standard_field)
        if name in DETAIL_COLUMNS:
            value = to_canonical(native_type(r), rule_output(x, r, int_mode), name)
            by_target.setdefault(name, []).append((None if r.has_default else x.isNotNull(), value))
    out = {}
    for name, rules in by_target.items():
        expr = None
        for present, value in rules:            # later rules end up outermost
            if present is None:
                expr = value
            else:
                expr = F.when(present, value) if expr is None else F.when(present, value).otherwise(expr)
        out[name] = expr
    out["_error"] = required_error(values, mapping)
    return out


def map_canonical(df: DataFrame, mappings: list[CompiledMapping], *, v: str = "v",
                  source: str = "source_id", int_mode: str = "keep",
                  valid: str | None = None) -> DataFrame:
    """Add the canonical detail columns (unfilled) and ``error`` to ``df``.

    Two steps keep every variant lookup single and the plan small:

    1. a projection with, per source, a struct of the raw rule values, built
       only when the row's source matches (one lookup per rule);
    2. a generator (``inline`` of a one-element array) that turns the typed
       canonical values into columns.  Predicates on its output cannot be
       pushed below it and projections cannot be merged across it, so Catalyst
       never re-inlines the raw values into later filters or columns.
    """
    raw_cols, generator = memo(("map_canonical", repr(mappings), v, source, int_mode, valid),
                               lambda: _canonical_exprs(mappings, v, source, int_mode, valid))
    keep = [c for c in df.columns if c not in DETAIL_COLUMNS and c != "error"]
    return df.select("*", *raw_cols).select(*keep, generator)


def _canonical_exprs(mappings: list[CompiledMapping], v: str, source: str, int_mode: str,
                     valid: str | None):
    src = F.col(source)
    raw_cols = [F.when(src == F.lit(m.source_id), _raw_struct(F.col(v), m)).alias(f"_x{i}")
                for i, m in enumerate(mappings)]
    per_source = [(i, _canonical_values(F.col(f"_x{i}"), m, int_mode)) for i, m in enumerate(mappings)]
    fields = []
    for name in DETAIL_COLUMNS:
        expr = None
        for i, vals in per_source:
            if name in vals:
                cond = F.col(f"_x{i}").isNotNull()
                expr = F.when(cond, vals[name]) if expr is None else expr.when(cond, vals[name])
        fields.append((expr if expr is not None else F.lit(None)).cast(canonical_type(name)).alias(name))
    error = F.when(src.isNull(), F.lit(ERR_UNKNOWN_SOURCE))
    if valid is not None:
        error = F.when(~F.col(valid), F.lit(ERR_INVALID_JSON)).when(src.isNull(), F.lit(ERR_UNKNOWN_SOURCE))
    for i, vals in per_source:
        error = error.when(F.col(f"_x{i}").isNotNull(), vals["_error"])
    fields.append(error.cast("string").alias("error"))
    return raw_cols, F.inline(F.array(F.struct(*fields)))


FILL = {"string": "", "double": 0.0, "bigint": 0}


def fill_canonical(name: str, c: Column) -> Column:
    t = canonical_type(name)
    return F.coalesce(c, F.lit(FILL[t]).cast(t))


def preview(df: DataFrame, mapping: CompiledMapping, v: str = "v", int_mode: str = "keep",
            keep: list[str] | None = None) -> DataFrame:
    """Dry run of one (unsaved) mapping over sample payloads.

    Output: the ``keep`` columns, one column per standard field (native type)
    and ``error``; nothing is written.
    """
    staged = df.withColumn("_x", _raw_struct(F.col(v), mapping))
    values = [F.col("_x").getField(f"r{j}") for j in range(len(mapping.rules))]
    fields = map_fields(values, mapping, int_mode)
    cols = [F.col(c) for c in (keep or [])]
    cols += [val.alias(std) for std, (_t, val) in fields.items()]
    cols.append(required_error(values, mapping).alias("error"))
    return staged.select(*cols)


# --------------------------------------------------------------- rule-array plan
#
# For large registries: the rules travel with the rows instead of being
# compiled into the plan.  The active registry becomes one row per source with
# an array of typed rules (built by Spark, nothing collected), equi-joined on
# source_id; higher-order functions apply the rules.  Generated code no longer grows with the registry; per row, only the
# rules of the row's own source are touched.

_OPS = ("multiply", "divide", "add", "subtract")


def rule_arrays(registry: DataFrame, as_of: bool = False) -> DataFrame:
    """Active registry -> ``[_epoch,] _rule_source, _nested_path, _rules, _at`` (one row per source).

    ``_at`` holds for each canonical column the places of its rules in ``_rules``.
    """
    from ..catalog import STANDARD_ALIASES
    from ..functions.variant import number_value as _num
    from ..sources.registry import active
    alias_items = []
    for k, val in STANDARD_ALIASES.items():
        alias_items += [F.lit(k), F.lit(val)]
    alias = F.create_map(*alias_items)

    def rule(r):
        parts = F.split(F.coalesce(r["transform"], F.lit("")), ":")
        op = F.trim(parts.getItem(0))
        k = F.trim(F.try_element_at(parts, F.lit(2))).try_cast("double")
        ok = (F.size(parts) == 2) & op.isin(*_OPS) & k.isNotNull() & ~F.isnan(k) \
            & (F.abs(k) != F.lit(float("inf")))
        op = F.when(ok & ~((op == "divide") & (k == 0)), op)
        dflt = F.try_parse_json(r["default_json"])
        dflt = F.when(~F.is_variant_null(dflt), dflt)          # a JSON null is no default
        dtype = F.coalesce(r["data_type"], F.lit(""))
        ntype = (F.when(dtype == "string", "string").when(dtype.isin("int", "float"), "double")
                 .when(dtype == "bool", "boolean").otherwise("string"))
        return F.struct(
            r["source_field"].alias("field"),
            F.coalesce(alias[r["standard_field"]], r["standard_field"]).alias("target"),
            ntype.alias("ntype"), dtype.alias("dtype"), op.alias("op"), k.alias("k"),
            dflt.isNotNull().alias("has_default"),
            F.coalesce(_num(dflt), F.lit(0.0)).alias("def_d"),
            F.when(dflt.isNotNull(), to_string(dflt)).alias("def_s"),
            F.when(dflt.isNotNull(), to_bool(dflt)).alias("def_b"),
            F.coalesce(r["required"], F.lit(False)).alias("required"))

    def places(name):
        return F.array_compact(F.transform("_rules", lambda r, i: F.when(r["target"] == name, i)))

    rows = project_once((registry if as_of else active(registry)).select(
        *(["_epoch"] if as_of else []), F.col("source_id").alias("_rule_source"),
        F.coalesce("nested_path", F.lit("")).alias("_nested_path"), "mappings"),
        F.transform("mappings", rule).alias("_rules"))
    return rows.drop("mappings").withColumn("_at", F.struct(*[places(c).alias(c) for c in DETAIL_COLUMNS]))


def _apply_op(x: Column, op: Column, k: Column) -> Column:
    return (F.when(op == "multiply", x * k).when(op == "divide", x / k)
            .when(op == "add", x + k).when(op == "subtract", x - k).otherwise(x))


def map_by_rules(df: DataFrame, registry: DataFrame, *, v: str = "v", source: str = "source_id",
                 int_mode: str = "keep", valid: str | None = None, as_of: bool = False) -> DataFrame:
    """Same output as :func:`map_canonical`, with the rules joined in as data.

    Spark picks the join by the rules' size in bytes.  With ``as_of`` the rules are those
    of the row's ``_epoch``.  Each rule's value is looked up and converted once a row, and
    a column looks only at its own rules.
    """
    rules = rule_arrays(registry, as_of)
    on = F.col(source) == F.col("_rule_source")
    if as_of:
        rules = rules.withColumnRenamed("_epoch", "_rule_epoch")
        on = on & (F.col("_epoch") == F.col("_rule_epoch"))
    joined = df.join(rules, on, "left")
    root = as_object_col(F.col(v))
    staged = project_once(joined, root.alias("_root"))
    staged = project_once(staged, F.when(F.col("_nested_path") != "",
                                         as_object_col(F.col("_root")[F.col("_nested_path")]))
                          .alias("_nest"))

    staged = project_once(staged, F.transform(
        "_rules", lambda r: F.coalesce(F.col("_nest")[r["field"]], F.col("_root")[r["field"]])).alias("_raws"))

    def value(r, raw):
        missing, ntype = raw.isNull(), r["ntype"]
        num = _apply_op(F.coalesce(number_value(raw), F.lit(0.0)), r["op"], r["k"])
        if int_mode == "truncate":
            num = F.when(r["dtype"] == "int", num.try_cast("bigint").cast("double")).otherwise(num)
        return F.struct(
            r["field"].alias("field"), ntype.alias("ntype"),
            (~missing | r["has_default"]).alias("present"),
            (missing & ~r["has_default"] & r["required"]).alias("fails"),
            F.when(ntype == "double", F.when(missing, F.when(r["has_default"], r["def_d"])).otherwise(num)).alias("d"),
            F.when(ntype == "string", F.when(missing, r["def_s"]).otherwise(to_string(raw))).alias("s"),
            F.when(ntype == "boolean", F.when(missing, r["def_b"]).otherwise(to_bool(raw))).alias("b"))

    def last_present(name):
        own = F.transform(F.col("_at")[name], lambda i: F.get("_vals", i))
        return F.try_element_at(F.filter(own, lambda x: x["present"]), F.lit(-1))

    staged = project_once(staged, F.zip_with("_rules", "_raws", value).alias("_vals"))
    staged = project_once(staged, *[last_present(c).alias(f"_last_{c}") for c in DETAIL_COLUMNS])
    out = []
    for name in DETAIL_COLUMNS:
        e, want = F.col(f"_last_{name}"), canonical_type(name)
        if want == "double":
            val = F.when(e["ntype"] == "double", e["d"]).when(e["ntype"] == "string", e["s"].try_cast("double"))
        elif want == "bigint":
            val = F.when(e["ntype"] == "double", e["d"].try_cast("bigint"))
        else:
            val = (F.when(e["ntype"] == "string", e["s"]).when(e["ntype"] == "double", render_double(e["d"]))
                   .when(e["ntype"] == "boolean", F.when(e["b"], F.lit("true")).otherwise(F.lit("false"))))
        out.append(val.cast(want).alias(name))
    first_fail = F.try_element_at(F.filter("_vals", lambda x: x["fails"]), F.lit(1))["field"]
    error = F.when(F.col(source).isNull(), F.lit(ERR_UNKNOWN_SOURCE))
    if valid is not None:
        error = F.when(~F.col(valid), F.lit(ERR_INVALID_JSON)).when(F.col(source).isNull(),
                                                                     F.lit(ERR_UNKNOWN_SOURCE))
    error = error.when(first_fail.isNotNull(), F.concat(F.lit(ERR_REQUIRED), first_fail))
    out.append(error.cast("string").alias("error"))
    keep = [c for c in df.columns if c not in DETAIL_COLUMNS and c != "error"]
    return staged.select(*keep, F.inline(F.array(F.struct(*out))))


def as_object_col(x: Column) -> Column:
    return x.try_cast("map<string,variant>")

"""Mapping registry: seeds, versioned CRUD, validation, stats (S10-S12, R4-R6,
U2, U4, G4, J6, W9).

The registry is an append-only version log ``mapping_registry`` (schema in
``catalog.REGISTRY_SCHEMA``); the current state of a source is its latest
version (``max_by`` per ``source_id``), and a source is usable when that
version is active.  No row is ever updated in place.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..catalog import (DATA_TYPES, REGISTRY_SCHEMA, SAMPLE_MAPPING, SEED_MAPPINGS)
from ..functions.memo import memo
from ..functions.transform import Transform, parse_transform, transform_error

# A compiled registry becomes column expressions on the driver; this bounds
# how much of it may be pulled there.  Beyond it, use the rule-join plans.
MAX_COMPILED_SOURCES = 256
MAX_COMPILED_RULES = 8192

EPOCH = datetime(2024, 1, 1, tzinfo=timezone.utc)


# ------------------------------------------------------------------ rows

def _rule_row(rule) -> Row:
    src, std, dtype, transform, default, required = rule
    return Row(source_field=src, standard_field=std, data_type=dtype,
               transform=transform or "",
               default_json=None if default is None else json.dumps(default),
               required=bool(required))


def mapping_row(spec: dict, version: int = 1, active: bool = True,
                created_at: datetime = EPOCH, updated_at: datetime | None = None) -> Row:
    return Row(source_id=spec["source_id"], version=int(version),
               description=spec.get("description", ""),
               nested_path=spec.get("nested_path", ""),
               mappings=[_rule_row(r) for r in spec["rules"]],
               active=bool(active), created_at=created_at,
               updated_at=updated_at or created_at)


def registry_frame(spark: SparkSession, specs: list[dict], version: int = 1,
                   at: datetime = EPOCH) -> DataFrame:
    return spark.createDataFrame([mapping_row(s, version, True, at) for s in specs], REGISTRY_SCHEMA)


def empty_registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], REGISTRY_SCHEMA)


def seed_registry(spark: SparkSession, registry: DataFrame | None = None,
                  seeds: list[dict] | None = None) -> DataFrame:
    """Add the seed mappings whose ids are not in the registry yet."""
    seeds_df = registry_frame(spark, seeds if seeds is not None else SEED_MAPPINGS)
    if registry is None:
        return seeds_df
    missing = seeds_df.join(registry.select("source_id").distinct(), "source_id", "left_anti")
    return registry.unionByName(missing)


# ------------------------------------------------------------------ reads

def latest(registry: DataFrame) -> DataFrame:
    """Latest version per source id (W9: one current row per id)."""
    w = Window.partitionBy("source_id").orderBy(F.col("version").desc())
    return (registry.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def active(registry: DataFrame) -> DataFrame:
    """Active mappings."""
    return latest(registry).where(F.col("active"))


def as_of(registry: DataFrame, at: datetime) -> DataFrame:
    """The active mappings at a time: of each id the latest version made until then."""
    return active(registry.where(F.col("updated_at") <= F.lit(at).cast("timestamp")))


def change_times(registry: DataFrame) -> list[datetime]:
    """When the registry changed, oldest first (configuration: a row a change)."""
    return [r[0] for r in registry.select("updated_at").distinct().orderBy("updated_at").collect()]


def in_force(registry: DataFrame) -> DataFrame:
    """Active mappings by epoch: ``_epoch`` n lies between the n-th change of the registry and the next.

    A version is in force from its own change to the one that brings the next
    version of its id.  The epochs of that span are counted out, so that payloads
    are joined on equal epochs and not on ranges of times.
    """
    times = change_times(registry)
    epoch = F.size(F.filter(_times(times), lambda t: t <= F.col("updated_at")))
    following = F.lead("_from", 1, len(times) + 1).over(Window.partitionBy("source_id").orderBy("version"))
    return (registry.withColumn("_from", epoch).withColumn("_until", following)
            .where(F.col("active") & (F.col("_from") < F.col("_until")))
            .withColumn("_epoch", F.explode(F.sequence(F.col("_from"), F.col("_until") - 1)))
            .drop("_from", "_until"))


def with_epoch(payloads: DataFrame, registry: DataFrame) -> DataFrame:
    """Add ``_epoch`` by ``received_at``; 0 before the first change, when no mapping is in force."""
    times = change_times(registry)
    return payloads.withColumn("_epoch", F.size(F.filter(_times(times), lambda t: t <= F.col("received_at"))))


def _times(times: list[datetime]):
    # as microseconds: a collected time has no zone of its own
    return F.array(*[F.timestamp_micros(F.lit(int(t.timestamp() * 1_000_000))) for t in times]) if times \
        else F.array().cast("array<timestamp>")


def by_id(registry: DataFrame, source_id: str) -> DataFrame:
    """One active mapping by id; an empty result means not found."""
    return active(registry).where(F.col("source_id") == F.lit(source_id))


def duplicate_ids(registry: DataFrame) -> DataFrame:
    """Ids with more than one row at the same version (a broken registry)."""
    return (registry.groupBy("source_id", "version").count()
            .where(F.col("count") > 1))


# ------------------------------------------------------------------ DML

def _next_version(registry: DataFrame, source_id: str) -> tuple[int, Row | None]:
    cur = (latest(registry).where(F.col("source_id") == source_id)
           .select("version", "active", "created_at").take(1))
    if not cur:
        return 1, None
    return int(cur[0]["version"]) + 1, cur[0]


def create_mapping(spark: SparkSession, registry: DataFrame, spec: dict,
                   at: datetime | None = None) -> DataFrame:
    """Append an active version; an id whose latest version is active is a conflict."""
    problems = validate_spec(spec)
    if problems:
        raise ValueError(problems[0])
    at = at or datetime.now(timezone.utc)
    version, cur = _next_version(registry, spec["source_id"])
    if cur is not None and cur["active"]:
        raise ValueError(f"mapping already exists: {spec['source_id']}")
    row = mapping_row(spec, version, True, at, at)
    return registry.unionByName(spark.createDataFrame([row], REGISTRY_SCHEMA))


def update_mapping(spark: SparkSession, registry: DataFrame, spec: dict,
                   at: datetime | None = None) -> DataFrame:
    """Append a new version; keeps ``created_at``; unknown id is an error (Q21)."""
    problems = validate_spec(spec)
    if problems:
        raise ValueError(problems[0])
    at = at or datetime.now(timezone.utc)
    version, cur = _next_version(registry, spec["source_id"])
    if cur is None or not cur["active"]:
        raise ValueError(f"mapping not found: {spec['source_id']}")
    row = mapping_row(spec, version, True, cur["created_at"], at)
    return registry.unionByName(spark.createDataFrame([row], REGISTRY_SCHEMA))


def delete_mapping(spark: SparkSession, registry: DataFrame, source_id: str,
                   at: datetime | None = None) -> DataFrame:
    """Soft delete: append the latest version again with ``active = false``."""
    at = at or datetime.now(timezone.utc)
    version, cur = _next_version(registry, source_id)
    if cur is None or not cur["active"]:
        raise ValueError(f"mapping not found: {source_id}")
    w = latest(registry).where(F.col("source_id") == source_id)
    return registry.unionByName(
        w.withColumn("version", F.lit(version).cast("bigint"))
         .withColumn("active", F.lit(False))
         .withColumn("updated_at", F.lit(at).cast("timestamp")))


# ------------------------------------------------------------------ validation

def validate_spec(spec: dict) -> list[str]:
    """Violations of one mapping request, in rule order; empty when valid."""
    out = []
    if not spec.get("source_id"):
        out.append("source_id is required")
    rules = spec.get("rules") or []
    if not rules:
        out.append("at least one field mapping is required")
    for i, r in enumerate(rules):
        src, std, dtype, transform = r[0], r[1], r[2], r[3]
        if not src:
            out.append(f"mapping[{i}]: source_field is required")
        if not std:
            out.append(f"mapping[{i}]: standard_field is required")
        if dtype not in DATA_TYPES:
            out.append(f"mapping[{i}]: data_type must be one of string int float bool")
        msg = transform_error(transform)
        if msg:
            out.append(f"mapping[{i}]: {msg}")
    return out


def validate(registry: DataFrame) -> DataFrame:
    """Violations over a registry DataFrame: source_id, idx, message.

    Runs as a DataFrame job over ``posexplode(mappings)`` so it scales with the
    registry; the transform grammar check is a regular expression.
    """
    num = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
    rules = registry.select("source_id", F.posexplode_outer("mappings").alias("idx", "r"))
    t = F.col("r.transform")
    parts_ok = t.rlike(rf"^[^:]*:\s*{num}\s*$")
    op = F.split(t, ":").getItem(0)
    checks = [
        (F.col("r").isNotNull() & (F.coalesce(F.col("r.source_field"), F.lit("")) == ""),
         "source_field is required"),
        (F.col("r").isNotNull() & (F.coalesce(F.col("r.standard_field"), F.lit("")) == ""),
         "standard_field is required"),
        (F.col("r").isNotNull() & ~F.coalesce(F.col("r.data_type"), F.lit("")).isin(*DATA_TYPES),
         "data_type must be one of string int float bool"),
        (F.col("r").isNotNull() & (F.coalesce(t, F.lit("")) != "") & ~parts_ok,
         "invalid transform format (use 'operation:value', e.g., 'divide:1000')"),
        (F.col("r").isNotNull() & (F.coalesce(t, F.lit("")) != "") & parts_ok
         & ~F.trim(op).isin("multiply", "divide", "add", "subtract"),
         F.format_string("invalid transform operation '%s' (use: multiply, divide, add, subtract)", op)),
    ]
    msgs = F.array(*[F.when(c, F.concat(F.lit("mapping["), F.col("idx").cast("string"),
                                        F.lit("]: "), m if not isinstance(m, str) else F.lit(m)))
                     for c, m in checks])
    per_rule = rules.select("source_id", "idx", F.explode(F.array_compact(msgs)).alias("message"))
    per_mapping = registry.select(
        "source_id", F.lit(-1).alias("idx"),
        F.explode(F.array_compact(F.array(
            F.when(F.coalesce(F.col("source_id"), F.lit("")) == "", F.lit("source_id is required")),
            F.when(F.coalesce(F.size("mappings"), F.lit(0)) <= 0,
                   F.lit("at least one field mapping is required"))))).alias("message"))
    return per_mapping.unionByName(per_rule)


# ------------------------------------------------------------------ request conversion (U4)

REQUEST_SCHEMA = ("struct<source_id:string, description:string, nested_path:string, "
                  "mappings:array<struct<source_field:string, standard_field:string, "
                  "data_type:string, transform:string, default_value:variant, required:boolean>>, "
                  "active:boolean>")


def from_requests(requests: DataFrame, text_col: str = "body",
                  at: datetime = EPOCH) -> DataFrame:
    """JSON mapping requests -> registry rows (active unless stated, U4)."""
    req = requests.select(F.from_json(F.col(text_col), REQUEST_SCHEMA).alias("q"))
    rules = F.transform(F.col("q.mappings"), lambda r: F.struct(
        r["source_field"].alias("source_field"), r["standard_field"].alias("standard_field"),
        r["data_type"].alias("data_type"), F.coalesce(r["transform"], F.lit("")).alias("transform"),
        F.when(~F.is_variant_null(r["default_value"]), F.to_json(r["default_value"])).alias("default_json"),
        F.coalesce(r["required"], F.lit(False)).alias("required")))
    return req.select(
        F.col("q.source_id").alias("source_id"), F.lit(1).cast("bigint").alias("version"),
        F.coalesce(F.col("q.description"), F.lit("")).alias("description"),
        F.coalesce(F.col("q.nested_path"), F.lit("")).alias("nested_path"),
        rules.alias("mappings"),
        F.coalesce(F.col("q.active"), F.lit(True)).alias("active"),
        F.lit(at).cast("timestamp").alias("created_at"),
        F.lit(at).cast("timestamp").alias("updated_at"))


# ------------------------------------------------------------------ stats (G4) and existence

def mapping_stats(registry: DataFrame) -> DataFrame:
    """active, inactive, fields, required, transformed, avg fields per active mapping."""
    cur = latest(registry)
    per = cur.select(
        "active",
        F.size("mappings").alias("n"),
        F.size(F.filter("mappings", lambda r: r["required"])).alias("req"),
        F.size(F.filter("mappings", lambda r: F.coalesce(r["transform"], F.lit("")) != "")).alias("tr"))
    a = F.col("active")
    return per.agg(
        F.count_if(a).alias("total_active"),
        F.count_if(~a).alias("total_inactive"),
        F.coalesce(F.sum(F.when(a, F.col("n"))), F.lit(0)).cast("bigint").alias("total_fields"),
        F.coalesce(F.sum(F.when(a, F.col("req"))), F.lit(0)).cast("bigint").alias("required_fields"),
        F.coalesce(F.sum(F.when(a, F.col("tr"))), F.lit(0)).cast("bigint").alias("transformed_fields"),
        F.try_divide(F.sum(F.when(a, F.col("n"))).cast("double"), F.count_if(a)).alias("avg_fields_per_mapping"))


def mapping_exists(ids: DataFrame, registry: DataFrame, col: str = "source_id") -> DataFrame:
    """Rows of ``ids`` whose ``col`` names an active mapping (left semi join, J6).

    The active registry is tiny next to ``ids`` but its size is not assumed:
    the join strategy is left to the planner's size check.
    """
    act = active(registry).select(F.col("source_id").alias(col))
    return ids.join(act, col, "left_semi")


# ------------------------------------------------------------------ compilation

@dataclass(frozen=True)
class Rule:
    source_field: str
    standard_field: str
    data_type: str
    transform: Transform
    default: object = None          # Python value of the default, None = no default
    has_default: bool = False
    required: bool = False


@dataclass
class CompiledMapping:
    source_id: str
    nested_path: str
    rules: list[Rule] = field(default_factory=list)

    @property
    def threshold(self) -> int:
        from ..catalog import SIGNATURE_THRESHOLD_PERCENT
        return len(self.rules) * SIGNATURE_THRESHOLD_PERCENT // 100

    @property
    def required_fields(self) -> list[str]:
        return [r.source_field for r in self.rules if r.required]


def compile_rows(rows) -> list[CompiledMapping]:
    out = []
    for row in rows:
        rules = []
        for r in row["mappings"] or []:
            dj = r["default_json"]
            default = json.loads(dj) if dj is not None else None
            rules.append(Rule(r["source_field"], r["standard_field"], r["data_type"] or "",
                              parse_transform(r["transform"]), default,
                              default is not None, bool(r["required"])))
        out.append(CompiledMapping(row["source_id"], row["nested_path"] or "", rules))
    return sorted(out, key=lambda m: m.source_id)


def _once(registry: DataFrame, what: str, work):
    """``work()``, kept for a registry that is read from files as it is.

    Files are never changed, so the same ones hold the same mappings, and a
    registry that has been written again consists of others.
    """
    if registry._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        return work()
    return memo((what, tuple(sorted(registry.inputFiles()))), work)


def registry_size(registry: DataFrame) -> tuple[int, int]:
    """Active sources and all their rules."""
    return _once(registry, "registry size", lambda: tuple(
        active(registry).agg(F.count("*"), F.coalesce(F.sum(F.size("mappings")), F.lit(0))).first()))


def compile_registry(registry: DataFrame) -> list[CompiledMapping]:
    """Pull the active registry to the driver, after checking its size."""
    return _once(registry, "compiled registry", lambda: _compile_registry(registry))


def _compile_registry(registry: DataFrame) -> list[CompiledMapping]:
    n, r = registry_size(registry)
    if n > MAX_COMPILED_SOURCES or r > MAX_COMPILED_RULES:
        raise ValueError(
            f"registry too large to compile ({n} sources, {r} rules); "
            "use the rule-join plans of gridlake.operators.detect / mapping")
    return compile_rows(active(registry).select("source_id", "nested_path", "mappings").collect())


def compile_specs(specs: list[dict]) -> list[CompiledMapping]:
    """Compile mapping specs given in Python (dry runs, tests)."""
    return compile_rows([mapping_row(s).asDict(recursive=True) for s in specs])


__all__ = [
    "SAMPLE_MAPPING", "Rule", "CompiledMapping", "active", "by_id", "compile_registry",
    "compile_rows", "compile_specs", "create_mapping", "delete_mapping", "empty_registry",
    "from_requests", "latest", "mapping_exists", "mapping_row", "mapping_stats",
    "registry_frame", "seed_registry", "update_mapping", "validate", "validate_spec",
]

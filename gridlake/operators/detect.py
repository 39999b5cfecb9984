"""Source detection.

Order: an explicit ``source_id`` hint naming an active mapping, then a
``device_type`` hint, then the key-signature score, then (optionally) a
default source.  Signature rule: the score of a mapping is the number of its
rules whose source field is among the payload's keys (root keys plus the keys
of every object-valued root entry); all its required fields must be present;
the score must reach ``floor(n * 40%)`` and be above zero; the best score
wins, ties go to the smallest source id (Q20).

Two physical plans compute the same answer:

* :func:`detect` - one projection, no shuffle.  The compiled registry turns
  into ``array_contains`` terms and an ``array_max`` over candidate structs.
* :func:`detect_by_join` - each distinct key set is equi-joined to the rule
  table and scored once.  Its cost per row does not depend on the registry, so
  it is the plan for very large registries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import SIGNATURE_THRESHOLD_PERCENT
from ..functions.keys import count_present, has_key, key_set
from ..functions.variant import as_object, string_if_string
from ..sources.registry import CompiledMapping, active
from ..functions.memo import memo
from ..session import scratch_path
from .common import project_once
from .intake import vget


def hint(v: Column, active_ids: list[str]) -> Column:
    """Explicit hint (J2): ``source_id`` then ``device_type``, if it names an active mapping."""
    if not active_ids:
        return F.lit(None).cast("string")
    sid = string_if_string(vget(v, "source_id"))
    dtype = string_if_string(vget(v, "device_type"))
    return F.coalesce(F.when(sid.isin(*active_ids), sid), F.when(dtype.isin(*active_ids), dtype))


def with_keys(df: DataFrame, v: str = "v") -> DataFrame:
    """Add ``keys``: the payload's root and one-level nested keys (P13, unordered)."""
    return df.withColumn("keys", key_set(as_object(F.col(v))))


def detect(df: DataFrame, mappings: list[CompiledMapping], *, v: str = "v",
           default_source: str | None = None, use_signature: bool = True,
           out: str = "source_id") -> DataFrame:
    """Add the detected source id as ``out`` (NULL = unknown data source)."""
    mappings = sorted(mappings, key=lambda m: m.source_id)
    stages = memo(("detect", repr(mappings), v, default_source, use_signature),
                  lambda: _detect_stages(mappings, v, default_source, use_signature))
    staged = df
    for cols in stages[:-1]:
        # each stage is evaluated once per row (its columns feed many terms)
        staged = project_once(staged, *cols)
    result = project_once(staged, stages[-1][0].alias(out))
    return result.drop(*[c for c in result.columns if c.startswith("_dt_")])


def _detect_stages(mappings: list[CompiledMapping], v: str, default_source: str | None,
                   use_signature: bool) -> list[list[Column]]:
    """Column lists of the detection projections (hint; keys; scores; pick)."""
    ids = [m.source_id for m in mappings]
    stages = [[hint(F.col(v), ids).alias("_dt_hint")]]
    parts = [F.col("_dt_hint")]
    if use_signature and mappings:
        stages.append([key_set(as_object(F.col(v))).alias("_dt_keys")])
        keys = F.col("_dt_keys")
        score_cols = []
        for i, m in enumerate(mappings):
            fields = [r.source_field for r in m.rules]
            if len(set(fields)) == len(fields):
                # one hash-set intersection per source instead of a scan per field
                score = F.size(F.array_intersect(keys, F.array(*[F.lit(f) for f in fields])))
            else:
                score = count_present(keys, fields)
            req_fields = sorted(set(m.required_fields))
            req = (F.size(F.array_intersect(keys, F.array(*[F.lit(f) for f in req_fields])))
                   == F.lit(len(req_fields))) if req_fields else F.lit(True)
            unhinted = F.col("_dt_hint").isNull()
            score_cols += [F.when(unhinted, score).alias(f"_dt_s{i}"),
                           F.when(unhinted, req).alias(f"_dt_r{i}")]
        stages.append(score_cols)
        cands = []
        for i, m in enumerate(mappings):
            s, r = F.col(f"_dt_s{i}"), F.col(f"_dt_r{i}")
            ok = r & (s >= F.lit(m.threshold)) & (s > 0)
            cands.append(F.when(ok, F.struct(s.alias("score"), F.lit(-i).alias("rank"),
                                             F.lit(m.source_id).alias("sid"))))
        parts.append(F.array_max(F.array(*cands)).getField("sid"))
    if default_source is not None and default_source in ids:
        parts.append(F.lit(default_source))
    stages.append([F.coalesce(*parts) if len(parts) > 1 else parts[0]])
    return stages


# --------------------------------------------------------------- join plan

def rule_table(registry: DataFrame, as_of: bool = False) -> DataFrame:
    """Active rules: [_epoch,] source_id, source_field, required, n_rules, n_required, threshold."""
    epoch = ["_epoch"] if as_of else []
    act = (registry if as_of else active(registry)).select(
        *epoch, "source_id", "mappings",
        F.size("mappings").alias("n_rules"),
        F.size(F.filter("mappings", lambda r: r["required"])).alias("n_required"))
    return act.select(
        *epoch, "source_id", "n_rules", "n_required",
        F.floor(F.col("n_rules") * SIGNATURE_THRESHOLD_PERCENT / 100).cast("int").alias("threshold"),
        F.explode("mappings").alias("r")
    ).select(*epoch, "source_id", "n_rules", "n_required", "threshold",
             F.col("r.source_field").alias("key"), F.col("r.required").alias("required"))


def detect_by_join(df: DataFrame, registry: DataFrame, *, v: str = "v",
                   default_source: str | None = None, use_signature: bool = True,
                   out: str = "source_id", as_of: bool = False, payloads: DataFrame | None = None) -> DataFrame:
    """Same answer as :func:`detect`, as joins whose plan does not grow with the registry.

    With ``as_of`` rows and registry carry ``_epoch`` (see ``registry.in_force``), and
    every join is on the row's epoch as well.

    A signature depends on the payload's keys only, and there are few distinct
    key sets however many payloads: each distinct set is exploded, joined to the
    rule table and scored once, and its source is joined back.  The scored sets are
    written first, so that the join back goes by their size: rows are not brought
    together by key set, of which a few hold them all, unless there are very many.
    ``payloads``: frame that holds all payloads of ``df`` and costs less to read;
    scores of sets that ``df`` does not have are not looked up.
    """
    epoch = ["_epoch"] if as_of else []
    rules = rule_table(registry, as_of)
    ids = (registry if as_of else active(registry)).select(*epoch, "source_id")
    sid = string_if_string(vget(F.col(v), "source_id"))
    dtype = string_if_string(vget(F.col(v), "device_type"))
    def hinted(rows):
        rows = project_once(rows, sid.alias("_sid"), dtype.alias("_dt"),
                            F.array_sort(F.array_distinct(key_set(as_object(F.col(v))))).alias("_keys"))
        return (rows.join(ids.select(*epoch, F.col("source_id").alias("_sid"), F.col("source_id").alias("_h1")),
                          [*epoch, "_sid"], "left")
                    .join(ids.select(*epoch, F.col("source_id").alias("_dt"), F.col("source_id").alias("_h2")),
                          [*epoch, "_dt"], "left"))
    base = hinted(df)
    parts = [F.col("_h1"), F.col("_h2")]
    if use_signature:
        sets = (hinted(df if payloads is None else payloads)
                .where("_h1 is null and _h2 is null and _keys is not null").select(*epoch, "_keys").distinct())
        hits = sets.select(*epoch, "_keys", F.explode("_keys").alias("key")).join(rules, [*epoch, "key"])
        scores = hits.groupBy(*epoch, "_keys", "source_id").agg(
            F.count("*").alias("score"), F.count_if("required").alias("req_hit"),
            F.first("n_required").alias("n_required"), F.first("threshold").alias("threshold"))
        best = (scores.where("req_hit = n_required and score >= threshold and score > 0")
                .groupBy(*epoch, "_keys").agg(F.min(F.struct((-F.col("score")).alias("low"), "source_id"))
                                      .getField("source_id").alias("_sig")))
        path = scratch_path(df.sparkSession, "key-sets")
        best.write.parquet(path)
        base = base.join(df.sparkSession.read.schema(best.schema).parquet(path), [*epoch, "_keys"], "left")
        parts.append(F.col("_sig"))
    if default_source is not None and ids.where(F.col("source_id") == default_source).take(1):
        parts.append(F.lit(default_source))
    return (base.withColumn(out, F.coalesce(*parts))
            .drop("_h1", "_h2", "_sig", "_sid", "_dt", "_keys"))

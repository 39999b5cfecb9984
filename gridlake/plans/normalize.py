"""Payload -> canonical readings plan (L1: S1, P1-P4, P17, P19-P20, J2-J5, W8).

One logical plan per batch, one scan and one parse of the input::

    raw text -> try_parse_json (once) -> is_object, request_id
             -> first row per request_id (partial WindowGroupLimit, one shuffle)
             -> detect source -> mapped columns + error ("invalid JSON",
                "unknown data source", "required field missing: <f>")
             -> readings (error IS NULL) / rejects (error IS NOT NULL)

``results`` is the same plan for all rows: instead of leaving out the losers it
flags them by a lookup in the contested request ids and carries them through
with outcome ``duplicate``.  Outcomes and duplicates are columns and rows of it,
and a run that writes several sinks stores or caches it once.

Rows in = readings + rejects + duplicates.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import DETAIL_COLUMNS, ERR_DUPLICATE, READING_COLUMNS, REJECTS_COLUMNS
from ..functions.timefn import event_time
from ..functions.variant import string_if_string, to_string
from ..operators.detect import detect, detect_by_join
from ..operators.intake import first_per_request, flag_first, parse, vget
from ..operators.mapping import fill_canonical, map_by_rules, map_canonical
from ..sources.registry import (MAX_COMPILED_RULES, CompiledMapping, compile_registry, in_force, registry_size,
                                with_epoch)

# Above this many active sources the rules travel as data (rule-array plan):
# the compiled plan's generated code grows with every source.
COMPILED_PLAN_MAX_SOURCES = 8


def meta_string(v: Column, key: str, default: str) -> Column:
    """Envelope string getter: missing -> default, non-string -> its text."""
    x = vget(v, key)
    return F.when(x.isNull(), F.lit(default)).otherwise(to_string(x))


@dataclass
class Normalized:
    """Lazy frames of one normalisation run (nothing is computed until used)."""
    parsed: DataFrame
    mappings: list[CompiledMapping]
    default_source: str | None = None
    int_mode: str = "keep"
    use_signature: bool = True
    plan: str = "compiled"              # "compiled" | "rules"
    registry: DataFrame | None = None
    raw: DataFrame | None = None
    as_of: bool = False                 # each row by the registry in force when it was received

    @cached_property
    def objects(self) -> DataFrame:
        return self.parsed.where(F.col("is_object"))

    @cached_property
    def firsts_all(self) -> DataFrame:
        """First row per request id, JSON objects and invalid text alike.

        Invalid text carries its raw id as request id, so it is never merged;
        it flows through the same plan and leaves as a reject, which keeps the
        whole run to one scan and one parse of the input.
        """
        return first_per_request(self.parsed)

    @cached_property
    def firsts(self) -> DataFrame:
        """Deduplicated JSON objects."""
        return self.firsts_all.where(F.col("is_object"))

    def _detect(self, rows: DataFrame) -> DataFrame:
        if self.plan == "rules":
            return detect_by_join(rows, self.registry, default_source=self.default_source,
                                  use_signature=self.use_signature, as_of=self.as_of, payloads=self.parsed)
        return detect(rows, self.mappings, default_source=self.default_source,
                      use_signature=self.use_signature)

    def _map(self, detected: DataFrame, *keep: str) -> DataFrame:
        v, src = F.col("v"), F.col("source_id")
        base = detected.select(
            "raw_id", "request_id", "payload", "received_at", "source_id", "v", "is_object",
            *(["_epoch"] if self.as_of else []), *keep, src.alias("device_type"),
            meta_string(v, "device_name", "unknown").alias("device_name"),
            meta_string(v, "device_id", "unknown").alias("device_id"),
            meta_string(v, "signal_strength", "").alias("signal_strength"),
            event_time(string_if_string(vget(v, "device_timestamp")), F.col("received_at")).alias("ts"))
        if self.plan == "rules":
            out = map_by_rules(base, self.registry, int_mode=self.int_mode, valid="is_object", as_of=self.as_of)
        else:
            out = map_canonical(base, self.mappings, int_mode=self.int_mode, valid="is_object")
        return out.drop("v", "is_object", "_epoch")

    @cached_property
    def detected_all(self) -> DataFrame:
        return self._detect(self.firsts_all)

    @cached_property
    def detected(self) -> DataFrame:
        """Deduplicated objects with their detected ``source_id`` (NULL = unknown)."""
        return self.detected_all.where(F.col("is_object"))

    @cached_property
    def mapped(self) -> DataFrame:
        """Every first row with source_id, error and unfilled canonical columns."""
        return self._map(self.detected_all)

    @cached_property
    def results(self) -> DataFrame:
        """Every input row once, mapped, with ``outcome`` (reading / reject / duplicate), ``error`` and ``fault``.

        ``fault`` is true for readings with any alarm or fault code above zero.
        The keys that decide on duplicates are read from the landed raw rows, which
        carry the request id, so only the payload scan parses.
        """
        keys = self.raw if self.raw is not None and "request_id" in self.raw.columns else self.parsed
        flagged = flag_first(self.parsed, keys.select("raw_id", "request_id", "received_at"))
        # a loser's payload is not looked at: its columns stay empty whatever it holds
        losers = flagged.withColumn("v", F.when(F.col("is_first"), F.col("v")))
        out = self._map(self._detect(losers), "is_first")
        error = F.when(F.col("is_first"), F.col("error")).otherwise(F.lit(ERR_DUPLICATE))
        outcome = (F.when(~F.col("is_first"), F.lit("duplicate")).when(F.col("error").isNull(), F.lit("reading"))
                   .otherwise(F.lit("reject")))
        alarms = [F.coalesce(F.col(c), F.lit(0)) > 0 for c in ("alarm_1", "alarm_2", "alarm_3", "fault_code")]
        fault = F.col("is_first") & F.col("error").isNull() & (alarms[0] | alarms[1] | alarms[2] | alarms[3])
        columns = [c for c in out.columns if c not in ("is_first", "error")]
        return out.select(*columns, outcome.alias("outcome"), error.alias("error"), fault.alias("fault"))

    def _settled(self, outcome: str) -> DataFrame:
        """Rows of one outcome: of the results if they are at hand, else of the plan without losers."""
        if "results" in self.__dict__:
            return self.results.where(F.col("outcome") == outcome)
        return self.mapped.where(F.col("error").isNull() if outcome == "reading" else F.col("error").isNotNull())

    @property
    def readings(self) -> DataFrame:
        """Canonical readings, missing values filled with 0 / ""."""
        return as_readings(self._settled("reading"))

    @property
    def rejects(self) -> DataFrame:
        """Invalid JSON, unknown source and missing required fields."""
        return self._settled("reject").select(*REJECTS_COLUMNS)

    @property
    def duplicates(self) -> DataFrame:
        """Rows that lost the dedupe."""
        return (self.results.where(F.col("outcome") == "duplicate")
                .select("raw_id", "request_id", "payload", "received_at", "error"))

    @property
    def outcomes(self) -> DataFrame:
        """One row per input row: raw_id, request_id, received_at, outcome, error, fault."""
        return self.results.select("raw_id", "request_id", "received_at", "error", "outcome", "fault")

    def persist(self) -> "Normalized":
        """Cache the results of a run written to several sinks.

        Readings, rejects, status entries and counters then read the cached
        rows instead of re-running parse, dedupe, detection and mapping once
        per sink.  Lost cached blocks are recomputed from lineage.
        """
        from pyspark import StorageLevel
        self.__dict__["results"] = self.results.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def unpersist(self) -> None:
        if "results" in self.__dict__:
            self.results.unpersist()


def as_readings(mapped: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Reading columns of mapped rows, missing values filled with 0 / "", and the ``keep`` columns."""
    cols = [F.col(c) for c in READING_COLUMNS[:7]]
    cols += [fill_canonical(c, F.col(c)).alias(c) for c in DETAIL_COLUMNS]
    return mapped.select(*cols, *keep)


def normalize(raw: DataFrame, registry: DataFrame | None = None, *,
              mappings: list[CompiledMapping] | None = None,
              default_source: str | None = None, int_mode: str = "keep",
              use_signature: bool = True, plan: str = "auto", as_of: bool = False) -> Normalized:
    """Build the lazy normalisation plan over raw rows (raw_id, payload, received_at[, request_id]).

    ``plan``: ``"compiled"`` turns the registry into column expressions (fast
    for a few sources), ``"rules"`` joins the rules in as data (constant plan
    size for any registry), ``"auto"`` picks by the number of active sources and
    of their rules.  With ``as_of`` every row is detected and mapped by the registry
    in force at its ``received_at`` (rule-array plan), so a replay gives what
    the first run gave whatever has been changed since.
    """
    if as_of:
        if registry is None:
            raise ValueError("the registry as of a time needs the registry DataFrame")
        return Normalized(with_epoch(parse(raw), registry), [], default_source, int_mode, use_signature,
                          "rules", in_force(registry), raw, True)
    if mappings is None:
        if registry is None:
            raise ValueError("registry or mappings required")
        if plan == "auto":
            n_sources, n_rules = registry_size(registry)
            fits = n_sources <= COMPILED_PLAN_MAX_SOURCES and n_rules <= MAX_COMPILED_RULES
            plan = "compiled" if fits else "rules"
        if plan == "compiled":
            mappings = compile_registry(registry)
    else:
        if plan == "auto":
            plan = "compiled" if len(mappings) <= COMPILED_PLAN_MAX_SOURCES else "rules"
        if plan == "rules" and registry is None:
            raise ValueError("the rule-array plan needs the registry DataFrame")
    return Normalized(parse(raw), mappings or [], default_source, int_mode, use_signature,
                      plan, registry, raw)

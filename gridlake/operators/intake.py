"""Payload intake: parse (S1), request ids (P20), duplicate suppression.

The JSON text is parsed exactly once per row into a VARIANT column ``v``;
every later lookup is a ``try_variant_get`` on it (binary search in the
variant's sorted field dictionary), never a re-parse.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.variant import as_object, string_if_string
from .common import project_once


def path(*keys: str) -> str:
    """Variant path for nested keys, each in brackets and the kind of quotes it does not hold."""
    return "$" + "".join(f'["{k}"]' if "'" in k else f"['{k}']" for k in keys)


def _plain(key: str) -> bool:
    """Whether a variant path can name the key."""
    return key != "" and "?" not in key and not ("'" in key and '"' in key) and "\\" not in key


def vget(v: Column, *keys: str) -> Column:
    """Sub-variant at a key path; SQL NULL when a key is missing.

    Keys that no variant path can name are looked up in the object's map.
    """
    if all(map(_plain, keys)):
        return F.try_variant_get(v, path(*keys), "variant")
    for k in keys:
        v = F.try_variant_get(v, path(k), "variant") if _plain(k) else as_object(v)[k]
    return v


def request_id_of(v: Column, raw_id: Column) -> Column:
    """A non-empty string ``request_id`` of the payload, else the raw id (P20).

    The raw id is fixed at landing, so a recompute or a retry yields the same
    id; nothing downstream calls a nondeterministic id generator.
    """
    rid = string_if_string(vget(v, "request_id"))
    return F.coalesce(F.nullif(rid, F.lit("")), raw_id)


def parse(raw: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """raw rows -> raw_id, request_id, payload, received_at, v, is_object.

    ``v`` is the parsed payload (NULL for text that is not JSON); ``is_object``
    is true only for a JSON object (arrays, scalars and ``null`` are not).
    The text is parsed once; both derived columns come from a generator so a
    later ``where(is_object)`` cannot re-inline the parse into the predicate.
    Rows that ``land(..., keep_parsed=True)`` has parsed are taken as they are.
    """
    if {"v", "is_object", "request_id"} <= set(raw.columns):
        return raw.select("raw_id", "request_id", "payload", "received_at", "v", "is_object")
    rid_in = [F.col("request_id").alias("_rid")] if "request_id" in raw.columns else []
    staged = project_once(raw.select("raw_id", "payload", "received_at", *keep, *rid_in),
                          F.try_parse_json(F.col("payload")).alias("v"))
    obj = as_object(F.col("v")).isNotNull()
    rid = request_id_of(F.col("v"), F.col("raw_id"))
    if rid_in:
        rid = F.coalesce(F.col("_rid"), rid)
    staged = project_once(staged, obj.alias("is_object"),
                          F.when(obj, rid).otherwise(F.col("raw_id")).alias("request_id"))
    return staged.select("raw_id", "request_id", "payload", "received_at", *keep, "v", "is_object")


def first_per_request(objects: DataFrame) -> DataFrame:
    """Keep the first row per ``request_id`` by ``(received_at, raw_id)``.

    Written as ``row_number() = 1`` so the planner inserts a partial
    WindowGroupLimit before the shuffle: each map task keeps one row per id,
    so a hot request id cannot pile up in one reducer.
    """
    w = Window.partitionBy("request_id").orderBy("received_at", "raw_id")
    return (objects.withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def contested(keys: DataFrame) -> DataFrame:
    """Request ids of several rows with the raw id of the first: ``(request_id, _winner)``.

    ``keys``: ``(raw_id, request_id, received_at)`` of all rows.  A partial
    aggregation, so a request id that a third of all rows carry leaves each task as
    one row; usually few ids are contested and the result is small.
    """
    return (keys.groupBy("request_id")
            .agg(F.min(F.struct("received_at", "raw_id"))["raw_id"].alias("_winner"), F.count("*").alias("_n"))
            .where("_n > 1").drop("_n"))


def flag_first(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """All ``rows`` with ``is_first``: whether the row is the first of its request id.

    One decision for winners and losers alike.  Rows are only looked up in the
    contested ids: a hash join over those, which the runtime plan splits for a hot
    id, so that rows with their payloads are never sorted (and do not spill).
    """
    return (rows.join(contested(keys).hint("shuffle_hash"), "request_id", "left")
            .withColumn("is_first", F.col("_winner").isNull() | (F.col("_winner") == F.col("raw_id")))
            .drop("_winner"))

"""Payload key sets and key renames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..catalog import SHORT_KEYS


def key_set(root: Column) -> Column:
    """Top-level keys plus the keys of every object-valued entry (one level).

    ``root`` is the payload as ``map<string,variant>``.  Unordered: membership
    tests (``array_contains``) need no sort.
    """
    nested = F.flatten(F.transform(
        F.map_values(root),
        lambda v: F.coalesce(F.map_keys(v.try_cast("map<string,variant>")),
                             F.array().cast("array<string>"))))
    return F.concat(F.map_keys(root), nested)


def payload_keys(root: Column) -> Column:
    """The key set sorted, as the key-extraction operator returns it."""
    return F.array_sort(key_set(root))


def has_key(keys: Column, key: str) -> Column:
    return F.array_contains(keys, F.lit(key))


def count_present(keys: Column, fields: list[str]) -> Column:
    """Number of ``fields`` (with repetition) found in ``keys``."""
    if not fields:
        return F.lit(0)
    total = None
    for f in fields:
        term = has_key(keys, f).cast("int")
        total = term if total is None else total + term
    return total


def short_key_lookup() -> Column:
    """Literal map standard name -> short key."""
    items = []
    for k, v in SHORT_KEYS.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def rename_short_keys(m: Column) -> Column:
    """Rename known standard names to short keys, other keys unchanged."""
    lookup = short_key_lookup()
    return F.transform_keys(m, lambda k, _v: F.coalesce(lookup[k], k))

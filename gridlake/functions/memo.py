"""Per-session memo for column expressions.

Column expressions are unresolved trees that do not depend on a DataFrame, so
an expression compiled from a registry can be reused by every job of the
same Spark application.  Entries are keyed by the application's id, so a new
application never sees columns of a stopped one.
"""

from __future__ import annotations

from typing import Callable, TypeVar

from pyspark import SparkContext

T = TypeVar("T")
_CACHE: dict = {}


def memo(key, build: Callable[[], T]) -> T:
    sc = SparkContext._active_spark_context
    full = (sc.applicationId if sc is not None else None, key)
    if full not in _CACHE:
        if len(_CACHE) > 512:
            _CACHE.clear()
        _CACHE[full] = build()
    return _CACHE[full]

"""Expected-format projection.

A rename-only view of a payload: 13 envelope strings (a non-string counts as
absent), ``valid = true``, and the ``data`` object's fields renamed by the
layout table of the payload's ``device_type`` (the short-key table for
unknown types), without scaling.  Strings only come from JSON strings, numbers
from numbers or the leading numeric prefix of a string; JSON null is skipped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..catalog import (DOUBLE_DETAILS, ERR_NO_DATA, EXPECTED_DETAILS, EXPECTED_ENVELOPE,
                       EXPECTED_FALLBACK_LAYOUT, EXPECTED_RENAMES, RECORD_ALIASES, STRING_DETAILS)
from ..functions.variant import (as_object, get_int, is_integer, is_number, is_string, number_value,
                                 raw_double, string_if_string, to_string)
from .intake import vget

NUMERIC_PREFIX = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"
INT_PREFIX = r"^[+-]?\d+"


def _float_of(x: Column) -> Column:
    prefix = F.regexp_extract(F.variant_get(x, "$", "string"), NUMERIC_PREFIX, 0)
    return (F.when(is_number(x), raw_double(x))
            .when(is_string(x) & (prefix != ""), prefix.try_cast("double")))


def _int_of(x: Column) -> Column:
    prefix = F.regexp_extract(F.variant_get(x, "$", "string"), INT_PREFIX, 0)
    return (F.when(is_integer(x), F.try_variant_get(x, "$", "bigint"))
            .when(is_number(x), raw_double(x).try_cast("bigint"))
            .when(is_string(x) & (prefix != ""), prefix.try_cast("bigint")))


def _target_value(x: Column, target: str) -> Column:
    if target in STRING_DETAILS:
        return string_if_string(x)
    if target in DOUBLE_DETAILS:
        return _float_of(x)
    return _int_of(x)


def expected_format(df: DataFrame, v: str = "v", keep: list[str] | None = None) -> DataFrame:
    """Expected-format columns and ``error`` ("no data object found in payload")."""
    vc = F.col(v)
    env = [F.coalesce(string_if_string(vget(vc, key)), F.lit(default)).alias(key)
           for key, default in EXPECTED_ENVELOPE]
    staged = df.select(*[F.col(c) for c in (keep or [])], *env,
                       F.lit(True).alias("valid"),
                       as_object(vget(vc, "data")).isNotNull().alias("_has_data"),
                       vc.alias("_v"))
    layout = (F.when(F.col("device_type").isin(*EXPECTED_RENAMES.keys()), F.col("device_type"))
              .otherwise(F.lit(EXPECTED_FALLBACK_LAYOUT)))
    details = []
    for target in EXPECTED_DETAILS:
        expr = None
        for name, table in EXPECTED_RENAMES.items():
            keys = [k for k, t in table.items() if t == target]
            if not keys:
                continue
            # of several source keys the first that is there gives the value
            val = _target_value(F.coalesce(*[vget(F.col("_v"), "data", k) for k in keys]), target)
            expr = F.when(layout == name, val) if expr is None else expr.when(layout == name, val)
        zero = F.lit("") if target in STRING_DETAILS else (
            F.lit(0.0) if target in DOUBLE_DETAILS else F.lit(0).cast("bigint"))
        details.append(F.coalesce(expr, zero).alias(target) if expr is not None else zero.alias(target))
    error = F.when(~F.col("_has_data"), F.lit(ERR_NO_DATA))
    return staged.select(*[c for c in staged.columns if c not in ("_v", "_has_data")],
                         *details, error.alias("error"))


def to_document(df: DataFrame, columns: list[str], out: str = "document") -> DataFrame:
    """JSON document with empty fields omitted (0, "" and NULL are left out, P24)."""
    fields = []
    for c in columns:
        t = dict(df.dtypes)[c]
        if t == "string":
            fields.append(F.nullif(F.col(c), F.lit("")).alias(c))
        elif t in ("double", "bigint", "int"):
            fields.append(F.nullif(F.col(c), F.lit(0)).alias(c))
        else:
            fields.append(F.col(c))
    return df.withColumn(out, F.to_json(F.struct(*fields)))


def coalesce_aliases(df: DataFrame, v: str = "v", keep: list[str] | None = None) -> DataFrame:
    """The canonical columns of payloads with a ``data`` object, short key before long key.

    A column is the first of its keys whose value can be read as the column's
    type, else 0 or "".  Rows without a ``data`` object have no canonical columns
    and are left out.
    """
    rows = df.select(*[F.col(c) for c in (keep or [])], as_object(vget(F.col(v), "data")).alias("_d")) \
             .where(F.col("_d").isNotNull())
    def read(key: str, target: str) -> Column:
        x = F.col("_d").getItem(key)
        if target in STRING_DETAILS:
            return F.when(x.isNotNull(), to_string(x))
        if target in DOUBLE_DETAILS:
            return number_value(x)
        return F.when(x.isNotNull(), get_int(F.col("_d"), key, 0)).cast("bigint")

    zero = {"s": F.lit(""), "d": F.lit(0.0), "l": F.lit(0).cast("bigint")}
    out = [F.coalesce(*[read(k, target) for k in keys],
                      zero["s" if target in STRING_DETAILS else "d" if target in DOUBLE_DETAILS else "l"]).alias(target)
           for target, keys in RECORD_ALIASES.items()]
    return rows.select(*(keep or []), *out)

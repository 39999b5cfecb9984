"""Type-gated conversions of VARIANT values.

Variant casts in Spark are more lenient than the gateway's conversions
(``"12"`` casts to 12.0, ``true`` to 1.0), so every converter first looks at
the variant's own type with ``schema_of_variant`` and only then casts.  All of
these are plain column expressions: they stay inside whole-stage codegen
stages with no Python on the row path.

Conventions: ``x`` is a VARIANT column that is SQL NULL when the key is
missing; a JSON ``null`` is a non-NULL variant whose type is ``VOID``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGER_TYPES = ("BIGINT", "INT", "SMALLINT", "TINYINT")
FLOAT_TYPES = ("DOUBLE", "FLOAT")


def vtype(x: Column) -> Column:
    """Variant type name: STRING, BIGINT, DECIMAL(p,s), DOUBLE, BOOLEAN, VOID, OBJECT<..>, ARRAY<..>."""
    return F.schema_of_variant(x)


def is_string(x: Column) -> Column:
    return vtype(x) == F.lit("STRING")


def is_bool(x: Column) -> Column:
    return vtype(x) == F.lit("BOOLEAN")


def is_json_null(x: Column) -> Column:
    return F.is_variant_null(x)


def is_number(x: Column) -> Column:
    t = vtype(x)
    return t.isin(*INTEGER_TYPES, *FLOAT_TYPES) | t.startswith("DECIMAL")


def is_integer(x: Column) -> Column:
    return vtype(x).isin(*INTEGER_TYPES)


def raw_string(x: Column) -> Column:
    """The variant rendered as text (numbers as plain decimals, strings unquoted)."""
    return F.try_variant_get(x, "$", "string")


def raw_double(x: Column) -> Column:
    return F.try_variant_get(x, "$", "double")


def as_object(x: Column) -> Column:
    """The variant as ``map<string,variant>`` when it is a JSON object, else NULL."""
    return x.try_cast("map<string,variant>")


def string_if_string(x: Column) -> Column:
    """The string value when the variant is a JSON string, else NULL."""
    return F.when(is_string(x), raw_string(x))


def number_value(x: Column) -> Column:
    """Numeric value of a JSON number; a numeric string is parsed (Q16).

    Booleans, JSON null, objects, arrays and unparsable strings give NULL.
    The variant cast to double already parses numeric strings and rejects
    objects, so only booleans (which it would turn into 1.0/0.0) need a gate.
    """
    return F.when(vtype(x) != F.lit("BOOLEAN"), raw_double(x))


def to_double(x: Column) -> Column:
    """``float`` conversion: numbers and numeric strings, anything else 0.0."""
    return F.coalesce(number_value(x), F.lit(0.0))


def to_long(x: Column) -> Column:
    """``int`` conversion: truncation toward zero; anything else 0."""
    exact = F.when(is_integer(x), F.try_variant_get(x, "$", "bigint"))
    return F.coalesce(exact, number_value(x).try_cast("bigint"), F.lit(0).cast("bigint"))


def to_string(x: Column) -> Column:
    """``string`` conversion: strings as is, JSON null as "", others as text (Q18)."""
    return (F.when(is_json_null(x), F.lit(""))
            .otherwise(F.coalesce(raw_string(x), F.to_json(x))))


def to_bool(x: Column) -> Column:
    """``bool`` conversion: true/false, "true"/"1", non-zero numbers (Q17)."""
    return (F.when(is_bool(x), F.try_variant_get(x, "$", "boolean"))
            .when(is_string(x), raw_string(x).isin("true", "1"))
            .when(is_number(x), raw_double(x) != 0)
            .otherwise(F.lit(False)))


# ---------------------------------------------------------------- getters

def get_string(m: Column, key: str, default: str = "") -> Column:
    """String getter: missing key -> default, present non-string -> its text."""
    x = m.getItem(key)
    return F.when(x.isNull(), F.lit(default)).otherwise(to_string(x))


def get_string_strict(m: Column, key: str, default: str = "") -> Column:
    """String getter that only accepts JSON strings (others -> default)."""
    return F.coalesce(string_if_string(m.getItem(key)), F.lit(default))


def get_float(m: Column, key: str, default: float = 0.0) -> Column:
    """Float getter: numbers, parsable strings; anything else -> default."""
    return F.coalesce(number_value(m.getItem(key)), F.lit(float(default)))


def get_int(m: Column, key: str, default: int = 0) -> Column:
    """Int getter: numbers truncated toward zero; strings are not parsed."""
    x = m.getItem(key)
    exact = F.when(is_integer(x), F.try_variant_get(x, "$", "bigint"))
    trunc = F.when(is_number(x), raw_double(x).try_cast("bigint"))
    return F.coalesce(exact, trunc, F.lit(int(default)).cast("bigint"))


CONVERTERS = {
    "int": to_long,
    "float": to_double,
    "string": to_string,
    "bool": to_bool,
}


def convert(x: Column, data_type: str) -> Column:
    """Type dispatch (P9); an unknown type name passes the value through as text."""
    fn = CONVERTERS.get(data_type)
    if fn is None:
        return to_string(x)
    return fn(x)

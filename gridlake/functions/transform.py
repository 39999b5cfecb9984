"""Numeric transforms of mapping rules.

A rule's transform is text ``op:value``.  It is parsed once, on the driver,
when the registry is compiled; the result is a plain arithmetic column
expression, so constants fold and the work stays in generated code.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..catalog import TRANSFORM_OPS, UNIT_SCALES


@dataclass(frozen=True)
class Transform:
    op: str | None       # multiply / divide / add / subtract, None = no-op
    value: float = 0.0

    @property
    def is_identity(self) -> bool:
        return self.op is None or (self.op == "divide" and self.value == 0)


IDENTITY = Transform(None)


def parse_number(text: str) -> float | None:
    try:
        value = float(text.strip())
    except (ValueError, AttributeError):
        return None
    if math.isnan(value) or math.isinf(value):
        return None
    return value


def parse_transform(text: str | None) -> Transform:
    """Split ``op:value`` on ``:``; a wrong part count, unknown op or
    non-numeric value leaves the value unchanged (identity)."""
    if not text:
        return IDENTITY
    parts = text.split(":")
    if len(parts) != 2:
        return IDENTITY
    op, raw = parts[0].strip(), parts[1]
    value = parse_number(raw)
    if op not in TRANSFORM_OPS or value is None:
        return IDENTITY
    return Transform(op, value)


def transform_error(text: str | None) -> str | None:
    """Validation message for a transform text, None when valid."""
    if not text:
        return None
    parts = text.split(":")
    if len(parts) != 2 or parse_number(parts[1]) is None:
        return "invalid transform format (use 'operation:value', e.g., 'divide:1000')"
    if parts[0].strip() not in TRANSFORM_OPS:
        return (f"invalid transform operation '{parts[0]}' "
                "(use: multiply, divide, add, subtract)")
    return None


def apply_transform(value: Column, t: Transform) -> Column:
    """Apply a parsed transform to a double column (true division, Q13)."""
    if t.is_identity:
        return value
    k = F.lit(float(t.value))
    if t.op == "multiply":
        return value * k
    if t.op == "divide":
        return value / k
    if t.op == "add":
        return value + k
    return value - k


def scale(value: Column, unit: str) -> Column:
    """Multiply by a named unit constant (power, energy, voltage, current,
    temperature, frequency)."""
    return value * F.lit(UNIT_SCALES[unit])

"""Scalar column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_SECONDS = 86400


def sigmoid(z: Column) -> Column:
    """Logistic function that never exponentiates a positive number."""
    e = F.exp(-F.abs(z))
    return F.when(z >= 0, 1.0 / (1.0 + e)).otherwise(e / (1.0 + e))


def hour_sin(hour: str) -> str:
    """SQL text of the hour as a position on the circle of a day."""
    return f"sin(2 * pi() * {hour} / 24)"


def hour_cos(hour: str) -> str:
    return f"cos(2 * pi() * {hour} / 24)"


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL counts as not holding)."""
    return F.when(condition, F.lit(1).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def hash32(key: Column, salt: str = "") -> Column:
    """First 32 bits of md5 as a bigint: the same on any engine and any partitioning."""
    text = key.cast("string")
    if salt:
        text = F.concat(text, F.lit(salt))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_unit(key: Column, salt: str = "") -> Column:
    """Hash of the key spread evenly over [0, 1)."""
    return hash32(key, salt) / F.lit(float(2**32))


def sql_double(x: float) -> str:
    """A finite number as SQL text that parses back to the same double."""
    if not math.isfinite(x):
        raise ValueError(f"not a finite number: {x}")
    return f"({float(x)!r}D)"

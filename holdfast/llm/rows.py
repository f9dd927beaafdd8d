"""Carrying whole rows past columns of any name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct named ``row``; ``select("row.*")`` gives them back."""
    quoted = [c.replace("`", "``") for c in df.columns]
    return F.struct(*[F.col(f"`{c}`") for c in quoted]).alias("row")

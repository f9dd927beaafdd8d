"""Running sums over partitions too large for one task.

A window over one hot key, or over no key at all, puts all of its rows in one task. Here
the order is cut into slices instead: ``slice_col`` must never decrease along the order.
Rows are summed inside their slice, and each slice is shifted by the total of the slices
before it. Only the totals, one row per key and slice, meet in a per-key window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_sum(
    rows: DataFrame,
    keys: list[str],
    slice_col: str,
    order_by: list[Column],
    value: Column,
    out: str,
    inclusive: bool = True,
) -> DataFrame:
    """Add ``out``: the sum of ``value`` up to this row (without it if not inclusive)."""
    rows = rows.withColumn("_value", value)
    before = (
        Window.partitionBy(*keys)
        .orderBy(slice_col)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        rows.groupBy(*keys, slice_col)
        .agg(F.sum("_value").alias("_total"))
        .select(
            *keys,
            slice_col,
            F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"),
        )
    )
    inside = (
        Window.partitionBy(*keys, slice_col)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    local = F.sum("_value").over(inside)
    if not inclusive:
        local = local - F.col("_value")
    return (
        rows.withColumn("_local", local)
        .join(offsets, [*keys, slice_col])
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop("_value", "_local", "_offset")
    )

"""Vectors of whole numbers: which rows take part, and their components as arrays."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither NULL nor with a NULL or non-finite component; an empty vector is usable."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite


def floored(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component x, as double; beyond 64 bits the nearest integer."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def extent(rows: DataFrame, vector: str = "v") -> tuple[int, int, int]:
    """Number of rows, greatest length, and greatest magnitude of a component (as x, or -x-1)."""
    sizes = F.transform(vector, lambda x: F.when(x < 0, F.bitwise_not(x)).otherwise(x))
    found = rows.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size(vector)), F.max(F.array_max(sizes))
    ).first()
    return found[0], found[1] or 0, found[2] or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers; shorter vectors end with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if (lengths == width).all():
        return values.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = values
    return out


def stretches(table: pa.Table, *names: str):
    """Runs of rows that agree in some columns: the values of these, then the rows."""
    columns = [table.column(c).to_numpy() for c in names]
    new = np.zeros(table.num_rows, bool)
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    bounds = [0, *np.flatnonzero(new).tolist(), table.num_rows]
    for a, z in zip(bounds, bounds[1:]):
        if a < z:
            yield *(c[a] for c in columns), table.slice(a, z - a)


def best(owner: np.ndarray, score: np.ndarray, name: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` first entries of each owner: higher scores, then smaller names."""
    order = np.lexsort((name, -score, owner))
    owner = owner[order]
    first = np.searchsorted(owner, owner)
    return order[np.arange(len(owner)) - first < k]

"""Splitting, sampling and standardising feature rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast import schema
from holdfast.functions.scalars import hash32, sql_double

KEY = "event_user_id"


def in_train(key: str = KEY, share: float = 0.8, seed: int = 0) -> Column:
    """A ``share`` of the keys (in thousandths), picked by hash; another one for every seed.

    The choice depends on the key alone, so it survives repartitioning and recomputation,
    which a random split does not.
    """
    return hash32(F.col(key), f":split {seed}") % 1000 < round(share * 1000)


def train_test_split(
    df: DataFrame, key: str = KEY, share: float = 0.8, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    picked = in_train(key, share, seed)
    return df.filter(picked), df.filter(~picked)


_SLOTS = 2**32


def slot(key: str, seed: int) -> Column:
    """A row's place in a random order of all rows, from 0 to 2^32 - 1."""
    return hash32(F.col(key), f":{seed}")


def in_turn(slot: Column, fraction: float, turn: int) -> Column:
    """True for the given share of the order, another stretch of it every turn.

    Successive turns go through all rows before one comes again.
    """
    size = int(fraction * _SLOTS)
    low = turn * size % _SLOTS
    high = low + size
    if high <= _SLOTS:
        return (slot >= low) & (slot < high)
    return (slot >= low) | (slot < high - _SLOTS)


def sample_rows(
    df: DataFrame, fraction: float, seed: int, turn: int = 0, key: str = KEY
) -> DataFrame:
    if fraction >= 1.0:
        return df
    return df.filter(in_turn(slot(key, seed), fraction, turn))


def pick_rows(df: DataFrame, n: int, seed: int, key: str = KEY) -> DataFrame:
    """``n`` different rows in an order that depends on the key and the seed alone."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


@dataclass(frozen=True)
class Scaler:
    features: list[str]
    means: list[float]
    stds: list[float]
    count: int

    def sql(self) -> dict[str, str]:
        """SQL text of each standardised feature; a missing value counts as 0.

        The outer coalesce changes no value. It marks the column as never NULL, which
        keeps null checks out of the code generated for every step of a fit.
        """
        return {
            f: f"coalesce((coalesce({f}, 0D) - {sql_double(m)}) / {sql_double(s)}, 0D)"
            for f, m, s in zip(self.features, self.means, self.stds)
        }

    def columns(self) -> list[Column]:
        return [F.expr(text).alias(f) for f, text in self.sql().items()]


def _moments(features: list[str]) -> list[Column]:
    """Mean and population deviation in one pass; a constant feature has deviation 1.

    Merging partial results leaves a tiny deviation even if all values are equal, so that
    is decided by the smallest and largest value.
    """
    out = []
    for f in features:
        varies = f"min({f}) < max({f})"
        out.append(F.expr(f"if({varies}, avg({f}), max({f})) AS mean_{f}"))
        out.append(F.expr(f"if({varies}, stddev_pop({f}), 1D) AS std_{f}"))
    return out


def fit_scaler(df: DataFrame, features: list[str] = schema.FEATURE_COLS) -> Scaler:
    row = df.agg(F.count(F.lit(1)).alias("n"), *_moments(features)).first()
    if row["n"] == 0:
        raise ValueError("no rows to standardise on")
    return Scaler(
        list(features),
        [row[f"mean_{f}"] for f in features],
        [row[f"std_{f}"] for f in features],
        row["n"],
    )


def standardize_stats(df: DataFrame, features: list[str] = schema.FEATURE_COLS) -> DataFrame:
    """One row per feature: ``feature, mean, std, n``."""
    wide = df.agg(F.count(F.lit(1)).alias("n"), *_moments(features))
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(f).alias("feature"),
                        F.col(f"mean_{f}").alias("mean"),
                        F.col(f"std_{f}").alias("std"),
                        F.col("n"),
                    )
                    for f in features
                ]
            )
        )
    )


def scaled_features(df: DataFrame, scaler: Scaler, keep: list[str]) -> DataFrame:
    return df.select(*keep, *scaler.columns())

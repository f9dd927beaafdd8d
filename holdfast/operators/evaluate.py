"""Binary classification metrics over every scored row."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.scalars import flag
from holdfast.operators.prefix import running_sum
from holdfast.workspace import stored

THRESHOLD = 0.5
#: Slices of the score axis: as many tasks share the distinct scores, whatever their number.
SLICES = 64


def predicted(score: str = "score", threshold: float = THRESHOLD):
    return F.when(F.col(score) >= threshold, 1).otherwise(0)


def score_counts(scored: DataFrame, label: str = "dropout", score: str = "score") -> DataFrame:
    """Rows of each class per distinct score. All metrics below follow from this.

    A missing score (NULL or NaN) is the lowest of all: predicted 0, ranked below every
    other score, tied with other missing ones. So the cells add up to all labelled rows.
    """
    lowest = F.lit(-math.inf)
    known = F.coalesce(F.nanvl(F.col(score).cast("double"), lowest), lowest)
    return scored.groupBy(known.alias("score")).agg(
        F.sum(flag(F.col(label) == 1)).alias("pos"),
        F.sum(flag(F.col(label) == 0)).alias("neg"),
    )


def confusion_matrix(counts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    hit = F.col("score") >= threshold

    def total(cls: str, condition) -> F.Column:
        in_cell = F.when(condition, F.col(cls)).otherwise(F.lit(0).cast("bigint"))
        return F.coalesce(F.sum(in_cell), F.lit(0).cast("bigint"))

    return counts.agg(
        total("pos", hit).alias("tp"),
        total("neg", hit).alias("fp"),
        total("neg", ~hit).alias("tn"),
        total("pos", ~hit).alias("fn"),
    )


def with_rates(confusion: DataFrame) -> DataFrame:
    """Add precision, recall, f1 and accuracy; an empty denominator gives 0."""
    tp, fp, tn, fn = (F.col(c).cast("double") for c in ("tp", "fp", "tn", "fn"))
    one = F.lit(1.0)
    rates = confusion.withColumns(
        {
            "precision": tp / F.greatest(one, tp + fp),
            "recall": tp / F.greatest(one, tp + fn),
            "accuracy": (tp + tn) / F.greatest(one, tp + fp + tn + fn),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return rates.withColumn("f1", 2.0 * p * r / F.greatest(F.lit(1e-9), p + r))


def _with_slice(counts: DataFrame, slices: int) -> DataFrame:
    """Cut the score axis into about equally full slices.

    Any cut gives the same result, so approximate quantiles will do.
    """
    at = [i / slices for i in range(1, slices)]
    cuts = counts.agg(F.percentile_approx("score", at, 10000)).first()[0] if at else []
    # At least one cut, as the bucketizer wants it.
    inner = sorted(set(cuts or []) - {-math.inf, math.inf}) or [0.0]
    edges = [-math.inf, *inner, math.inf]
    return Bucketizer(splits=edges, inputCol="score", outputCol="slice").transform(counts)


def auc_roc(counts: DataFrame, slices: int = SLICES) -> DataFrame:
    """Exact area under the ROC curve: the share of pairs ranked right, ties counting half.

    A positive beats the negatives with a lower score, a running sum over the distinct
    scores. With only one class the area is NaN. ``counts`` must be a stored table.
    """
    below = running_sum(
        _with_slice(counts, slices),
        [],
        "slice",
        [F.col("score")],
        F.col("neg"),
        "below",
        inclusive=False,
    )
    pos, neg = F.col("pos").cast("double"), F.col("neg").cast("double")
    sums = below.agg(
        F.sum(pos * (F.col("below") + neg / 2.0)).alias("won"),
        (F.sum(pos) * F.sum(neg)).alias("pairs"),
    )
    return sums.select(
        F.when(F.col("pairs") > 0, F.col("won") / F.col("pairs"))
        .otherwise(F.lit(float("nan")))
        .alias("auc_roc")
    )


def evaluate_binary(
    scored: DataFrame, label: str = "dropout", score: str = "score"
) -> DataFrame:
    """One row: tp, fp, tn, fn, precision, recall, f1, accuracy, auc_roc."""
    with stored(score_counts(scored, label, score), "score_counts") as counts:
        one = F.lit(1).alias("_one")
        rates = with_rates(confusion_matrix(counts)).withColumn("_one", one)
        both = rates.join(auc_roc(counts).withColumn("_one", one), "_one").drop("_one")
        return scored.sparkSession.createDataFrame(both.collect(), both.schema)

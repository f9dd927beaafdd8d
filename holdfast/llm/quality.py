"""Quality scores: a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm import words
from holdfast.shipping import ship_package

#: Classes of bytes whose shares of a text are statistics.
_CLASSES = ("blank", "newline", "lower", "upper", "digit", "stop", "mark", "beyond_ascii")
STATISTICS = (
    "log_words",
    "log_word_length",
    "log_longest_word",
    "word_length_deviation",
    *(f"share_{c}" for c in _CLASSES),
    "distinct_words",
    "commonest_word",
    "distinct_triples",
    "doubled_words",
    "one_byte_words",
    "marked_words",
)


def _byte_classes() -> np.ndarray:
    out = np.full(256, _CLASSES.index("mark"))
    for b in range(256):
        c = chr(b)
        if b >= 128:
            out[b] = _CLASSES.index("beyond_ascii")
        elif c == "\n":
            out[b] = _CLASSES.index("newline")
        elif c.isspace():
            out[b] = _CLASSES.index("blank")
        elif c.islower():
            out[b] = _CLASSES.index("lower")
        elif c.isupper():
            out[b] = _CLASSES.index("upper")
        elif c.isdigit():
            out[b] = _CLASSES.index("digit")
        elif c in ".,":
            out[b] = _CLASSES.index("stop")
    return out


_CLASS_OF = _byte_classes()
_TABLE = words.byte_table(lower=True)


def _distinct(owner: np.ndarray, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per text: how many different hashes, and how often the commonest occurs."""
    order = np.lexsort((hashes, owner))
    o, h = owner[order], hashes[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (h[1:] != h[:-1])
    at = np.flatnonzero(new)
    runs = np.diff(at, append=len(o))
    most = np.zeros(size)
    np.maximum.at(most, o[at], runs)
    return np.bincount(o[at], minlength=size), most


def block_statistics(block: words.Block) -> np.ndarray:
    """One row of ``STATISTICS`` per text; zeros for an empty text.

    Sizes enter as logarithms and shares as the arcsine of their root, which brings both
    nearer to a normal distribution.
    """
    size, owner = block.size, block.owner
    n_bytes, n_words = np.diff(block.bounds), np.diff(block.first)
    per_byte, per_word = np.maximum(n_bytes, 1), np.maximum(n_words, 1)
    text_of = np.repeat(np.arange(size), n_bytes)
    counts = np.bincount(text_of * len(_CLASSES) + _CLASS_OF[block.data], minlength=size * 8)
    shares = counts.reshape(size, len(_CLASSES)) / per_byte[:, None]

    length = (block.ends - block.starts).astype(float)
    mean = np.bincount(owner, length, size) / per_word
    square = np.bincount(owner, length**2, size) / per_word
    longest = np.zeros(size)
    np.maximum.at(longest, owner, length)

    different, commonest = _distinct(owner, block.hashes, size)
    at, triples = block.windows(3)
    n_triples = np.bincount(owner[at], minlength=size)
    different_triples, _ = _distinct(owner[at], triples, size)
    doubled = np.zeros(len(owner))
    doubled[1:] = (block.hashes[1:] == block.hashes[:-1]) & (owner[1:] == owner[:-1])
    marked = _CLASS_OF[block.data[block.ends - 1]] == _CLASSES.index("mark")
    of_words = np.column_stack(
        [
            different / per_word,
            commonest / per_word,
            np.where(n_triples, different_triples / np.maximum(n_triples, 1), n_words > 0),
            np.bincount(owner, doubled, size) / per_word,
            np.bincount(owner, length == 1, size) / per_word,
            np.bincount(owner, marked, size) / per_word,
        ]
    )
    sizes = [
        np.log1p(n_words),
        np.log1p(mean),
        np.log1p(longest),
        np.sqrt(np.maximum(square - mean**2, 0)) / np.maximum(mean, 1),
    ]
    angle = np.arcsin(np.sqrt(np.clip(np.column_stack([shares, of_words]), 0, 1)))
    return np.column_stack([*sizes, angle])


def statistics(df: DataFrame, text_column: str = "text") -> Column:
    """The statistics of a text column as array<double>; NULL counts as empty. No shuffle."""
    ship_package(df.sparkSession)

    @F.arrow_udf("array<double>")
    def measured(texts: pa.Array) -> pa.Array:
        rows = [block_statistics(b) for _, b in words.blocks(texts, _TABLE)]
        flat = np.concatenate(rows).ravel() if rows else np.zeros(0)
        offsets = np.arange(len(texts) + 1, dtype=np.int32) * len(STATISTICS)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))

    return measured(F.coalesce(text_column, F.lit("")))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _moments(batches):
    """Per class: count, sums and sums of products of the statistics, summed over a task."""
    d = len(STATISTICS)
    sums = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        x = _matrix(batch.column("x"))
        y = np.asarray(batch.column("y"))
        for label in (0, 1):
            own = x[y == label]
            if len(own):
                products = own.T @ own
                sums[label] += np.concatenate([[len(own)], own.sum(0), products.ravel()])
    width = sums.shape[1]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.repeat([0, 1], width)),
            pa.array(np.tile(np.arange(width), 2)),
            pa.array(sums.ravel()),
        ],
        names=["y", "i", "value"],
    )


@dataclass
class Discriminant:
    """Two normal densities. ``whiten`` holds the inverted Cholesky factors of their
    covariances, ``offset`` what does not depend on the document."""

    means: np.ndarray
    whiten: np.ndarray
    offset: np.ndarray
    constant: float | None = None

    @classmethod
    def from_moments(cls, moments: np.ndarray, shrinkage: float) -> Discriminant:
        """Covariances are drawn towards the diagonal of the pooled one by ``shrinkage``."""
        d = len(STATISTICS)
        counts = moments[:, 0]
        if not counts.all():
            return cls(
                np.zeros((2, d)),
                np.zeros((2, d, d)),
                np.zeros(2),
                float(counts[1] / counts.sum()) if counts.any() else 0.5,
            )
        means = moments[:, 1 : d + 1] / counts[:, None]
        products = moments[:, d + 1 :].reshape(2, d, d) / counts[:, None, None]
        within = products - means[:, :, None] * means[:, None, :]
        pooled = np.tensordot(counts / counts.sum(), within, 1)
        target = np.diag(np.maximum(np.diag(pooled), 1e-6))
        factors = np.linalg.cholesky((1 - shrinkage) * within + shrinkage * target)
        log_scale = np.log(np.diagonal(factors, axis1=1, axis2=2)).sum(1)
        return cls(means, np.linalg.inv(factors), np.log(counts / counts.sum()) - log_scale)

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 from the difference of the log-densities."""
        if self.constant is not None:
            return np.full(len(x), self.constant)
        log_density = [
            self.offset[c] - 0.5 * (((x - self.means[c]) @ self.whiten[c].T) ** 2).sum(1)
            for c in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(log_density[0] - log_density[1], -500, 500)))


def held_out(id_column: Column) -> Column:
    """The quarter of documents whose labels no fit sees."""
    rest = F.crc32(id_column.cast("string").cast("binary")) % 4
    return F.coalesce(rest == 2, F.lit(False))


def fit(measured: DataFrame, labels: DataFrame, shrinkage: float = 0.1) -> Discriminant:
    """From (doc_id, x) and (doc_id, label) by one distributed sum over all labelled rows.

    Held-out ids and NULL labels are left out; an id that occurs several times counts as
    often. What reaches the driver has a fixed size. Without rows of one label the score is
    the share of label 1, without any label 0.5.
    """
    d = len(STATISTICS)
    known = labels.where(~held_out(F.col("doc_id"))).where("label IN (0, 1)")
    pairs = measured.join(known, "doc_id").select("x", F.col("label").cast("int").alias("y"))
    sums = (
        pairs.mapInArrow(_moments, "y bigint, i bigint, value double")
        .groupBy("y", "i")
        .agg(F.sum("value").alias("value"))
    )
    moments = np.zeros((2, 1 + d + d * d))
    for row in sums.collect():
        moments[row.y, row.i] = row.value
    return Discriminant.from_moments(moments, shrinkage)


def score(df: DataFrame, model: Discriminant, x: Column) -> Column:
    """Score between 0 and 1 from statistics; higher where label 1 is likelier."""
    ship_package(df.sparkSession)

    @F.arrow_udf("double")
    def scored(column: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(column)) if len(column) else np.zeros(0))

    return scored(x)

"""Quality classifier: regularised quadratic discriminant analysis over transformed text statistics.

Each class has its mean and a covariance that is shrunk to the pooled one and then to its diagonal.
A score is the difference of the classes' Gaussian log-densities, from Mahalanobis distances by
Cholesky factors that are computed once, cooled by the number of statistics and turned into (0, 1).
Means and covariances come from sums over all labelled rows; documents are read once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialise, ship
from . import words as W

SHRINK_TO_POOLED, SHRINK_TO_DIAGONAL, RIDGE = 0.3, 0.1, 1e-3
STATISTICS = (
    "log_bytes", "log_words", "word_length", "word_length_spread", "upper", "digits", "stops", "symbols",
    "non_ascii", "breaks", "distinct_words", "commonest_word", "distinct_pairs", "repeated_lines", "capitalised",
)

_KINDS = np.zeros(256, np.int8)
_KINDS[65:91] = 1
_KINDS[48:58] = 2
_KINDS[[ord(c) for c in ".,;:?'\"-()"]] = 3
_KINDS[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 4
_KINDS[128:] = 5
_KINDS[10] = 6


def _per_doc(flag: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])[at])


def _distinct(bounds: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many different values each document has, and how often its commonest occurs."""
    n = len(bounds) - 1
    if not len(value):
        return np.zeros(n, np.int64), np.zeros(n, np.int64)
    v = W.sort_within(value, bounds)
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    new[bounds[:-1][bounds[:-1] < len(v)]] = True
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(v)))
    # one part of first for each document that has values
    at = np.searchsorted(first, bounds)
    some = np.flatnonzero(np.diff(at))
    most = np.zeros(n, np.int64)
    most[some] = np.maximum.reduceat(count, at[:-1][some])
    return np.diff(at), most


def statistics(texts: pa.Array) -> np.ndarray:
    """One row of STATISTICS for each text; all finite, also for empty texts."""
    out = []
    for w in W.split(texts):
        n, doc = w.docs, w.doc_of_word()
        size = np.diff(w.text_at).astype(float)
        kind = _KINDS[w.data]
        share = [_per_doc(kind == k, w.text_at) / np.maximum(size, 1) for k in range(1, 7)]
        words = np.diff(w.bounds).astype(float)
        length = (w.ends - w.starts).astype(float)
        total, square = np.bincount(doc, length, n), np.bincount(doc, length**2, n)
        mean = total / np.maximum(words, 1)
        spread = np.sqrt(np.maximum(square / np.maximum(words, 1) - mean**2, 0))
        different, most = _distinct(w.bounds, w.hashes)
        pair_doc, _, pair = W.runs(w, 2)
        pairs = np.bincount(pair_doc, minlength=n)
        different_pairs, _ = _distinct(np.concatenate([[0], np.cumsum(pairs)]), pair)
        # lines, as sums of their words' hashes
        line = np.concatenate([[0], np.cumsum(w.data == 10)])[w.starts]
        lines = repeated = np.zeros(n)
        if len(doc):
            first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])]))
            sums = np.add.reduceat(w.hashes, first)
            lines = np.bincount(doc[first], minlength=n).astype(float)
            repeated = lines - _distinct(np.searchsorted(doc[first], np.arange(n + 1)), sums)[0]
        capital = np.bincount(doc, (kind[w.starts] == 1).astype(float), n) if len(doc) else np.zeros(n)
        logit = lambda x: np.log((x + 0.01) / (1.01 - np.clip(x, 0, 1)))
        out.append(
            np.stack(
                [
                    np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(spread),
                    *(np.sqrt(x) for x in share),
                    logit(different / np.maximum(words, 1)), logit(most / np.maximum(words, 1)),
                    logit(different_pairs / np.maximum(pairs, 1)), np.sqrt(repeated / np.maximum(lines, 1)),
                    np.sqrt(capital / np.maximum(words, 1)),
                ],
                axis=1,
            )
        )
    return np.concatenate(out) if out else np.zeros((0, len(STATISTICS)))


def text_statistics(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id and its statistics, for every row."""

    def rows(batches):
        for batch in batches:
            x = statistics(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["doc_id", "x"])

    return df.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(rows, "doc_id long, x array<double>")


@dataclass(frozen=True)
class Discriminant:
    """A fitted model; factors are inverses of the Cholesky factors of the classes' covariances."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray
    prior: float | None = None  # the score of all texts if a class has no rows

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.prior is not None:
            return np.full(len(x), self.prior)
        density = [c - 0.5 * (((x - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        apart = (density[1] - density[0]) / np.sqrt(x.shape[1])
        return 1 / (1 + np.exp(-np.clip(apart, -500, 500)))


def fit(counts: np.ndarray, sums: np.ndarray, squares: np.ndarray) -> Discriminant:
    """From each class's number of rows, sums and sums of outer products."""
    d = sums.shape[1]
    if counts.min() < 2:
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), float((counts[1] + 1) / (counts.sum() + 2)))
    means = sums / counts[:, None]
    scatter = squares - counts[:, None, None] * means[:, :, None] * means[:, None, :]
    pooled = scatter.sum(axis=0) / max(1, counts.sum() - 2)
    factors, constants = [], []
    for k in (0, 1):
        own = scatter[k] / max(1, counts[k] - 1)
        cov = (1 - SHRINK_TO_POOLED) * own + SHRINK_TO_POOLED * pooled
        cov = (1 - SHRINK_TO_DIAGONAL) * cov + SHRINK_TO_DIAGONAL * np.diag(np.diag(cov)) + RIDGE * np.eye(d)
        lower = np.linalg.cholesky(cov)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(counts[k] / counts.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(means, np.array(factors), np.array(constants))


def _moments(labelled: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row counts, sums and sums of outer products of both classes of rows (x, label): what the driver gets is of fixed size."""
    d = len(STATISTICS)

    def add(batches):
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            for k in (0, 1):
                own = x[y == k]
                total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        n = total.shape[1]
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat([0, 1], n), pa.int32()), pa.array(np.tile(np.arange(n), 2), pa.int32()), pa.array(total.ravel())], ["k", "i", "v"])

    total = np.zeros((2, 1 + d + d * d))
    for row in labelled.select("x", "label").mapInArrow(add, "k int, i int, v double").groupBy("k", "i").agg(F.sum("v").alias("v")).collect():
        total[row.k, row.i] = row.v
    return total[:, 0], total[:, 1 : 1 + d], total[:, 1 + d :].reshape(2, d, d)


def _held(doc_id: Column, folds: int, held: int) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == held, F.lit(False))


def _taught(known: DataFrame, labels: DataFrame, folds: int, held: int, doc_id: str, label: str) -> Discriminant:
    taught = labels.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where(F.col("label").isin(0, 1))
    return fit(*_moments(known.where(~_held(F.col("doc_id"), folds, held)).join(taught, "doc_id")))


def learn_quality(df: DataFrame, labels: DataFrame, *, folds: int = 4, held: int = 2, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Discriminant:
    """The model that classify_quality() learns, for use with quality_score().

    Statistics are made where the texts are, and only they are joined with the labels. Rows of the held fold,
    null ids, null labels and labels but 0 and 1 teach nothing; null and empty texts teach what an empty text
    is like, long ones are read whole; rows and labels that repeat count each. If a class has fewer than two
    rows, or a table is empty, the model gives every text the smoothed share of class 1. Other columns are
    ignored.
    """
    ship(df.sparkSession)
    some = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where(~_held(F.col("doc_id"), folds, held))
    return _taught(text_statistics(some, "doc_id", "text"), labels, folds, held, doc_id, label)


def quality_score(model: Discriminant, text: Column) -> Column:
    """The score (0 to 1, higher: class 1 is likelier) of a text column.

    Null texts are scored as empty ones, which have a score like any other; long texts are read whole. Equal
    texts have equal scores, whatever else is in their rows; an empty table gives no rows.
    """

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(statistics(texts)))

    return score(text)


def classify_quality(df: DataFrame, labels: DataFrame, *, threshold: float = 0.7, folds: int = 4, held: int = 2, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of df.

    Learns only from labelled rows whose crc32(doc_id as text) mod folds is not held. Only the text
    is an input of a score. predicted is 1 if score >= threshold.

    Null and empty texts have the statistics of an empty text; long texts count whole. Rows that repeat,
    like all ties, get equal scores, and each counts where it is labelled, once for each of its labels; null labels or ids, and labels but
    0 and 1, teach nothing. If a class has fewer than two rows, every score is the smoothed share of
    class 1. Empty tables give no rows; other columns are ignored.
    """
    ship(df.sparkSession)
    known = materialise(text_statistics(df, doc_id, text), "statistics")
    model = df.sparkSession.sparkContext.broadcast(_taught(known, labels, folds, held, doc_id, label))

    @F.arrow_udf("double")
    def score(x: pa.Array) -> pa.Array:
        return pa.array(model.value.score(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)))

    out = known.select("doc_id", _held(F.col("doc_id"), folds, held).alias("held_out"), score("x").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))

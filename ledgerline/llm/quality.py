"""Text quality by a regularised quadratic discriminant over document statistics."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import fold, in_slices, table, utf8, written
from ledgerline.operators.relational import join_lookup

FOLDS, HELD = 4, 2
STATISTICS = (
    "words", "word_length", "upper", "marks", "symbols", "bars", "digits", "beyond_ascii",
    "distinct_words", "repeated_lines", "line_length", "stops",
)
# Shares of the class covariance that are replaced by the pooled one, and of the result by its diagonal.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05

_UPPER = bytes(range(0x41, 0x5B))
_DIGIT = b"0123456789"
_SYMBOL = b"#$%&*@^~<>{}[]\\/=+_`"
_BEYOND = bytes(range(0x80, 0x100))


def statistics(text: bytes) -> list[float]:
    """Transformed statistics of a whole text; counts as logarithms, shares by arcsine root."""
    size = max(len(text), 1)

    def share(part: float, whole: float) -> float:
        return float(np.arcsin(np.sqrt(min(1.0, part / whole)))) if whole else 0.0

    def count(of: bytes) -> int:
        return len(text) - len(text.translate(None, of))

    words = text.split()
    lines = [x for x in text.split(b"\n") if x]
    n = len(words)
    return [
        np.log1p(n), np.log1p(sum(map(len, words)) / n if n else 0.0), share(count(_UPPER), size),
        share(text.count(b"!") + text.count(b"?"), size), share(count(_SYMBOL), size), share(text.count(b"|"), size),
        share(count(_DIGIT), size), share(count(_BEYOND), size), share(len(set(words)), n),
        share(len(lines) - len(set(lines)), len(lines)), np.log1p(size / (len(lines) + 1)),
        share(text.count(b".") + text.count(b","), size),
    ]


def document_statistics(documents: DataFrame) -> DataFrame:
    """doc_id and one double per statistic, for every row; no shuffle."""
    schema = "doc_id long, " + ", ".join(f"{s} double" for s in STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            found = np.array([statistics(t) for t in utf8(batch)], float).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(found[:, i]) for i in range(len(STATISTICS)))], names=["doc_id", *STATISTICS]
            )

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


@dataclass(frozen=True)
class Discriminant:
    """Per class (0, 1): log prior, mean, inverse of the Cholesky factor, log determinant."""

    prior: tuple[float, float]
    mean: np.ndarray
    inverse: np.ndarray
    log_det: tuple[float, float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Chance of class 1 from the Mahalanobis log-density difference."""
        density = []
        for c in (0, 1):
            y = (x - self.mean[c]) @ self.inverse[c].T
            density.append(self.prior[c] - 0.5 * (y * y).sum(1) - 0.5 * self.log_det[c])
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0], -700, 700)))


def fit(found: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant | None:
    """Discriminant from the moments of all labelled rows outside the held-out fold.

    Sums and products are added up by Spark, map-side first; two rows reach the driver.
    None without rows of both classes.
    """
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).filter(
        "doc_id is not null and y in (0, 1)"
    ).groupBy("doc_id").agg(F.max("y").alias("y")).filter(fold("doc_id", FOLDS) != HELD)
    rows = join_lookup(found, marked, ["doc_id"], "inner")
    pairs = list(combinations_with_replacement(range(len(STATISTICS)), 2))
    sums = [F.sum(s).alias(f"s{i}") for i, s in enumerate(STATISTICS)]
    products = [F.sum(F.col(STATISTICS[i]) * F.col(STATISTICS[j])).alias(f"p{i}_{j}") for i, j in pairs]
    moments = {r["y"]: r for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n"), *sums, *products).collect()}
    if set(moments) != {0, 1}:
        return None
    d = len(STATISTICS)
    means, covariances, counts = [], [], []
    for c in (0, 1):
        r, n = moments[c], moments[c]["n"]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / n
        cov = np.zeros((d, d))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = r[f"p{i}_{j}"] / n - mean[i] * mean[j]
        means.append(mean)
        covariances.append(cov)
        counts.append(n)
    pooled = (counts[0] * covariances[0] + counts[1] * covariances[1]) / sum(counts)
    inverse, log_det = [], []
    for cov in covariances:
        mixed = (1 - TO_POOLED) * cov + TO_POOLED * pooled
        mixed = (1 - TO_DIAGONAL) * mixed + TO_DIAGONAL * np.diag(np.diag(mixed)) + 1e-6 * np.eye(d)
        factor = np.linalg.cholesky(mixed)
        inverse.append(np.linalg.inv(factor))
        log_det.append(2 * float(np.log(np.diag(factor)).sum()))
    prior = tuple(float(np.log(n / sum(counts))) for n in counts)
    return Discriminant(prior, np.array(means), np.array(inverse), tuple(log_det))


def quality(found: DataFrame, model: Discriminant | None) -> DataFrame:
    """doc_id, score of every row of the statistics; 0.5 for all without a model."""
    schema = "doc_id long, score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[1:]], axis=1)
            scores = model.scores(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=["doc_id", "score"])

    return found.select("doc_id", *STATISTICS).mapInArrow(run, schema)


def score_quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, score (0 to 1, higher: better) of every row of ``documents``.

    NULL text is empty text and is scored like any other; repeated rows are scored each, a
    missing doc_id stays NULL; NULL labels and those of unknown documents are ignored, of
    several labels of a document the highest counts. Extra columns are not read.
    """
    found = written(document_statistics(documents), "statistics")
    return quality(found, fit(found, labels))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document; labels only from outside the held-out fold."""
    scored = score_quality(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return scored.select(
        "doc_id", (fold("doc_id", FOLDS) == HELD).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
    )

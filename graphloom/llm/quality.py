"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class has a mean and a covariance that is shrunk towards the pooled one and towards its own mean variance. A
score is the logistic of the difference of the two log densities (half Mahalanobis distances, log determinants and
priors), from Cholesky factors that are computed once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType

from graphloom.llm.common import map_batches, texts

FEATURES = (
    "words", "word_length", "distinct", "repeated", "top_word", "upper", "digit", "symbol", "period", "comma", "bang",
    "bar", "line", "letters", "short", "capital",
)
#: Share of the pooled covariance in each class covariance, and share of the mean variance on the diagonal.
POOLED, RIDGE = 0.3, 0.02


def _table(characters: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(characters)] = 1
    return table


_UPPER, _DIGIT = _table(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table(b"0123456789")
_SYMBOL = _table(b"#$%&*+/<=>@[\\]^_`{|}~")
_LETTER = _table(bytes(c for c in range(256) if chr(c).isalpha() and c < 128) + bytes(range(128, 256)))


def statistics(text: str) -> list[float]:
    """Transformed statistics of one whole text; an empty one gives zeros."""
    data = text.encode()
    words = data.split()
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    counts: dict[bytes, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    histogram = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = max(1, len(data) - n)  # without the spaces between words
    share = lambda table: float(histogram @ table) / size
    root = lambda count: (count / size) ** 0.5
    repeated = sum(map(bytes.__eq__, words, words[1:]))
    top = max(counts.values())
    firsts = sum(1 for word in words if 65 <= word[0] <= 90)
    return [
        np.log1p(n), np.log(size / n), np.log((len(counts) + 1) / (n + 1)), np.log((repeated + 0.5) / (n + 1)),
        np.log((top + 1) / (n + 2)), share(_UPPER) ** 0.5, share(_DIGIT) ** 0.5, share(_SYMBOL) ** 0.5,
        root(histogram[46]), root(histogram[44]), root(histogram[33]), root(histogram[124]), root(histogram[10]),
        share(_LETTER), sum(1 for word in words if len(word) < 3) / n, (firsts / n) ** 0.5,
    ]


def document_statistics(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` and ``statistics``; null texts count as empty."""
    fields = ", ".join(f"{name} {docs.schema[name].dataType.simpleString().replace('bigint', 'long')}" for name in keep)

    def run(batch: pa.RecordBatch) -> dict:
        return {name: batch.column(name) for name in keep} | {"statistics": [statistics(value) for value in texts(batch, "_text")]}

    return map_batches(docs.select(*keep, docs[text].alias("_text")), run, f"{fields}, statistics array<double>")


@dataclass
class Model:
    """Class log priors, means and inverse Cholesky factors; the bias holds priors and log determinants."""

    means: np.ndarray
    inverse: np.ndarray
    bias: np.ndarray
    centre: np.ndarray
    scale: np.ndarray

    def scores(self, rows: np.ndarray) -> np.ndarray:
        x = (rows - self.centre) / self.scale
        density = []
        for k in (0, 1):
            z = (x - self.means[k]) @ self.inverse[k].T
            density.append(self.bias[k] - 0.5 * (z * z).sum(axis=1))
        return 1.0 / (1.0 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def fit(labelled: DataFrame, pooled: float = POOLED, ridge: float = RIDGE) -> Model:
    """Learn from ``(statistics, quality)`` rows; rows whose quality is not 0 or 1 teach nothing.

    A row that repeats counts as often. Each task sends sums of outer products only. With a class missing, all scores are that of the other class; with
    neither they are one half.
    """
    width = len(FEATURES)
    cells = 1 + width + width * width

    def run(batches):
        sums = np.zeros((2, cells))
        for batch in batches:
            y = np.array(batch.column("quality").to_pylist(), np.int64)
            x = np.array(batch.column("statistics").to_pylist(), float).reshape(len(y), width)
            for k in (0, 1):
                rows = x[y == k]
                sums[k] += np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).ravel()])
        yield pa.RecordBatch.from_pydict({"quality": pa.array([0, 1], pa.int32()), "sums": sums.tolist()})

    rows = labelled.where(F.col("quality").isin(0, 1)).select(F.col("quality").cast("int").alias("quality"), "statistics")
    partial = rows.mapInArrow(run, "quality int, sums array<double>")
    parts = partial.select("quality", F.posexplode("sums").alias("place", "value")).groupBy("quality", "place").agg(F.sum("value").alias("value"))
    sums = np.zeros((2, cells))
    for row in parts.collect():  # a few hundred sums, whatever the input
        sums[row["quality"], row["place"]] = row["value"]
    return solve(sums, pooled, ridge)


def solve(sums: np.ndarray, pooled: float = POOLED, ridge: float = RIDGE) -> Model:
    width = len(FEATURES)
    counts = sums[:, 0]
    total = counts.sum()
    if not counts.all():
        bias = np.where(counts > 0, 0.0, -700.0) if total else np.zeros(2)
        return Model(np.zeros((2, width)), np.zeros((2, width, width)), bias, np.zeros(width), np.ones(width))
    centre = sums[:, 1 : 1 + width].sum(axis=0) / total
    second = sums[:, 1 + width :].sum(axis=0).reshape(width, width) / total - np.outer(centre, centre)
    scale = np.sqrt(np.maximum(np.diag(second), 1e-12))
    means, covariances = [], []
    for k in (0, 1):
        mean = sums[k, 1 : 1 + width] / counts[k]
        spread = sums[k, 1 + width :].reshape(width, width) / counts[k] - np.outer(mean, mean)
        means.append((mean - centre) / scale)
        covariances.append(spread / np.outer(scale, scale))
    shared = (counts[0] * covariances[0] + counts[1] * covariances[1]) / total
    inverse, bias = [], []
    for k in (0, 1):
        mixed = (1 - pooled) * covariances[k] + pooled * shared
        mixed = (1 - ridge) * mixed + ridge * max(np.trace(mixed) / width, 1e-6) * np.eye(width)
        factor = np.linalg.cholesky(mixed)
        inverse.append(np.linalg.inv(factor))
        bias.append(np.log(counts[k] / total) - np.log(np.diag(factor)).sum())
    return Model(np.array(means), np.array(inverse), np.array(bias), centre, scale)


def score(table: DataFrame, model: Model, *keep: str) -> DataFrame:
    """Columns ``keep`` with ``score`` (0 to 1) and ``predicted`` for rows that hold ``statistics``.

    A score of one half is predicted 1. Repeated rows are scored alike; an empty table gives none.
    """
    fields = ", ".join(f"{name} {table.schema[name].dataType.simpleString().replace('bigint', 'long')}" for name in keep)

    def run(batch: pa.RecordBatch) -> dict:
        rows = np.array(batch.column("statistics").to_pylist(), float).reshape(batch.num_rows, len(FEATURES))
        found = model.scores(rows)
        return {name: batch.column(name) for name in keep} | {"score": found, "predicted": (found >= 0.5).astype(np.int32)}

    return map_batches(table.select(*keep, "statistics"), run, f"{fields}, score double, predicted int")


def with_statistics(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """``docs`` with its statistics in the array column ``name``; other columns, of any type, are passed on unread."""

    def run(batch: pa.RecordBatch) -> dict:
        found = {c: batch.column(c) for c in batch.schema.names}
        return found | {name: [statistics(value) for value in texts(batch, text)]}

    return map_batches(docs, run, StructType([*docs.schema.fields, StructField(name, ArrayType(DoubleType()))]))


def accepted(model: Model, statistics_column: str) -> Column:
    """Whether rows score at least one half, as a column expression over their statistics.

    The difference of the two log densities is a quadratic form of the statistics. Empty texts have statistics and are
    judged like any other; a row that ties is kept.
    """
    x = F.col(f"`{statistics_column}`")
    terms = []
    for k in (0, 1):
        # z = A x - b, one row of the inverse factor at a time
        a = model.inverse[k] / model.scale
        b = model.inverse[k] @ (model.centre / model.scale + model.means[k])
        z = [
            F.aggregate(F.zip_with(x, F.array(*[F.lit(float(v)) for v in row]), lambda p, q: p * q), F.lit(-float(c)), lambda s, v: s + v)
            for row, c in zip(a, b)
        ]
        squares = F.aggregate(F.array(*z), F.lit(0.0), lambda s, v: s + v * v)
        terms.append(F.lit(float(model.bias[k])) - squares / 2)
    return terms[1] >= terms[0]

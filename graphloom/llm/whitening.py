"""Whitening of embeddings from the exact spectrum of their integer scatter.

Vectors become integers; each distinct one counts once. Tasks add up exact sums and products, so that n times the sum
of products less the product of sums, n**2 times the covariance, is known as an integer matrix. Its characteristic
polynomial is found modulo primes in Spark tasks, one prime at a time; see :mod:`spectrum` for the rest.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm import spectrum
from graphloom.session import materialize

SCALE, SHIFT = 64, 1_000_000
#: Scaled entries beyond this size are cut to it, so that they fit a long.
LARGEST = float(2**61)
#: Bits of one digit of a sum that travels, and of a factor: products of factors over a block are exact in doubles.
DIGIT_BITS, FACTOR_BITS, BLOCK_ROWS = 40, 20, 4096

OUTPUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_vectors(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` with x = floor(64 * c) + 1000000; null vectors and those with null or non-finite entries leave."""
    broken = F.exists(
        F.col(embedding), lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == float("inf"))
    )

    def entry(c: Column) -> Column:
        cut = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c.cast("double") * SCALE))
        return F.floor(cut).cast("long") + F.lit(SHIFT).cast("long")

    return vectors.where(F.col(embedding).isNotNull() & ~broken).select(
        F.col(key).cast("long").alias("vec_id"), F.transform(F.col(embedding), entry).alias("x")
    )


def _matrices(batches: Iterator[pa.RecordBatch], d: int, column: int = 0) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their vectors, less the shift, as rows of a matrix of longs."""
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(start, BLOCK_ROWS)
            yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) - SHIFT


def _products(y: np.ndarray) -> np.ndarray:
    """The transposed matrix times itself as exact integers, from factors small enough for doubles."""
    factors, rest = [], y
    while len(factors) < 4 and (not factors or rest.any()):
        low = rest & ((1 << FACTOR_BITS) - 1) if len(factors) < 3 else rest
        # Small negative numbers stay one small factor instead of a carry through all of them.
        if not factors and np.abs(rest).max(initial=0) < 1 << FACTOR_BITS:
            low = rest
        factors.append(low.astype(np.float64))
        rest = (rest - low) >> FACTOR_BITS
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for i, a in enumerate(factors):
        for j, b in enumerate(factors):
            total = total + ((a.T @ b).astype(np.int64).astype(object) << (FACTOR_BITS * (i + j)))
    return total


def exact_sums(fit: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """Rows, sums and products of the distinct vectors less the shift. Tasks add up first; the driver gets d**2 sums."""
    upper = np.triu_indices(d)
    cells = 1 + d + len(upper[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, object)
        for _, y in _matrices(batches, d):
            sums = [int(s) for s in y.sum(axis=0, dtype=object)] if np.abs(y).max(initial=0) >= 2**40 else y.sum(axis=0).tolist()
            total = total + np.array([len(y), *sums, *_products(y)[upper]], dtype=object)
        out = [[], [], []]
        for cell in np.flatnonzero(total):
            value, place = abs(int(total[cell])), 0
            sign = 1 if total[cell] > 0 else -1
            while value:
                for column, item in zip(out, (cell, place, sign * (value & ((1 << DIGIT_BITS) - 1)))):
                    column.append(int(item))
                value, place = value >> DIGIT_BITS, place + 1
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["cell", "place", "value"])

    digits = fit.select("x").mapInArrow(run, "cell long, place long, value long")
    found: dict[int, int] = defaultdict(int)
    for row in digits.groupBy("cell", "place").agg(F.sum("value").alias("value")).collect():
        found[row.cell] += row.value << DIGIT_BITS * row.place
    products = [[0] * d for _ in range(d)]
    for at, (i, j) in enumerate(zip(*upper)):
        products[i][j] = products[j][i] = found[1 + d + at]
    return found[0], [found[1 + i] for i in range(d)], products


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Exact coefficients, constant first; residues modulo each prime are computed by Spark tasks."""
    primes = spectrum.primes_for(matrix)
    d = len(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in batch.column(0).to_pylist():
                p = primes[at]
                reduced = np.array([[v % p for v in row] for row in matrix], np.int64)
                values = spectrum.polynomial_modulo(reduced, p)
                yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), pa.array([values.tolist()], pa.list_(pa.int64()))], names=["p", "c"])

    tasks = min(len(primes), spark.sparkContext.defaultParallelism)
    rows = spark.range(0, len(primes), 1, tasks).mapInArrow(run, "p long, c array<long>").collect()
    assert d + 1 == len(rows[0].c)
    return spectrum.from_residues({row.p: row.c for row in rows})


def principal_components(spark, n: int, sums: list[int], products: list[list[int]], count: int) -> tuple[list[float], np.ndarray]:
    """Explained shares and, as columns, unit vectors over the root of the eigenvalue of n**2 times the covariance."""
    d = len(sums)
    scatter = [[n * products[i][j] - sums[i] * sums[j] for j in range(d)] for i in range(d)]
    trace = sum(scatter[i][i] for i in range(d))
    if trace == 0:
        return [], np.zeros((d, 0))
    poly = characteristic_polynomial(spark, scatter)
    pairs = spectrum.eigenvectors(scatter, spectrum.largest_roots(poly, count, trace))[:count]
    explained = [float(root / trace) for root, _ in pairs]
    return explained, np.array([[float(v / root.sqrt()) for v in vector] for root, vector in pairs]).T


def _centred(y: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n times the vectors less the sums: longs where they fit, Python integers otherwise."""
    bound = n * int(np.abs(y).max(initial=0)) + max(map(abs, sums))
    if bound < 2**62:
        return n * y - np.array(sums, np.int64)
    return n * y.astype(object) - np.array(sums, object)


def _deviations(z: np.ndarray) -> list[int | None]:
    """Exact sums of squares; null beyond a long."""
    if z.dtype != object and float(np.abs(z).max(initial=0)) ** 2 * z.shape[1] < 2.0**62:
        return (z * z).sum(axis=1).tolist()
    return [s if s < 2**63 else None for s in (sum(int(v) * int(v) for v in row) for row in z)]


def identity_error(fit: DataFrame, n: int, sums: list[int], axes: np.ndarray) -> float:
    """Largest entry by which the covariance of the whitened distinct vectors, measured on them, misses the identity."""
    d, k = axes.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for _, y in _matrices(batches, d):
            w = _centred(y, n, sums).astype(float) @ axes
            total += np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], names=["cell", "value"])

    measured = np.zeros(k + k * k)
    for row in fit.select("x").mapInArrow(run, "cell long, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect():
        measured[row.cell] = row.value / n
    mean = measured[:k]
    return float(np.abs(measured[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def whiten(vectors: DataFrame, components: int = 16, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per vector and component (see ``OUTPUT``); components are numbered from 1 by falling eigenvalue.

    Null vectors and vectors with null or non-finite entries take no part, nor do vectors of another length than the
    commonest among the distinct ones (the longer where two are equally common). Repeated vectors count once in the fit
    and get their own rows, as do repeated and null ids. Directions without any variance are no components: fewer than
    ``components`` come back where the rank is smaller, and no row at all for an empty table or a single distinct vector.
    Entries beyond 2**61 after scaling are cut to that; ``deviation`` is null beyond a long. Other columns are not read.
    The cost of the spectrum grows with the fourth power of the dimension and not with the table.
    """
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, key, embedding)
    fit = materialize(rows.select("x").distinct())
    common = fit.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).head()
    if common is None or common.d == 0 or common.n < 2:
        return spark.createDataFrame([], OUTPUT)
    d = common.d
    fit = fit.where(F.size("x") == d)
    n, sums, products = exact_sums(fit, d)
    explained, axes = principal_components(spark, n, sums, products, min(components, d))
    k = len(explained)
    error = identity_error(fit, n, sums, axes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, y in _matrices(batches, d, 1):
            z = _centred(y, n, sums)
            rows_here = len(z)
            ids = part.column(0).take(pa.array(np.repeat(np.arange(rows_here), k)))
            deviations = pa.array(_deviations(z), pa.int64()).take(pa.array(np.repeat(np.arange(rows_here), k)))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_here)), pa.array(np.full(rows_here * k, n)),
                    deviations, pa.array((z.astype(float) @ axes).ravel()), pa.array(np.tile(explained, rows_here)),
                    pa.array(np.full(rows_here * k, error)),
                ],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return rows.where(F.size("x") == d).mapInArrow(run, OUTPUT)

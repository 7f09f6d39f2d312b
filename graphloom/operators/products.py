"""Most similar pages through products of blocks of pages, for terms so common that lists of page pairs would not fit on disk.

Pages are dealt to blocks of a bounded size. A block is one row: its postings in the order of their terms. Every block of targets
meets every block of pages in a task, which adds up all their products in one matrix and hands on the best pages only.
What is written grows with the postings, not with the pairs; their number sets the time. Results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.session import materialize

#: Pages of a block, on average. Two blocks make a matrix of some four million scores.
BLOCK_PAGES = 2048
#: A term that makes more than this share of a matrix's cells is multiplied as a dense column, at most so many at once.
DENSE_SHARE, DENSE_TERMS = 1 / 1024, 2048
#: Products of the other terms that a task holds at once.
PRODUCTS_AT_ONCE = 262_144
SCORE_DIGITS = 9
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_terms(scores: DataFrame, target_side: DataFrame) -> DataFrame:
    """Written table ``(term, number, products)`` of the terms that several pages and a target have."""
    pages = scores.groupBy("term").agg(F.count(F.lit(1)).alias("_pages")).where("_pages > 1")
    targets = target_side.groupBy("term").agg(F.count(F.lit(1)).alias("_targets"))
    both = pages.join(targets, "term").select("term", F.monotonically_increasing_id().alias("number"), (F.col("_pages") * F.col("_targets")).alias("products"))
    return materialize(both)


def packed(postings: DataFrame, terms: DataFrame) -> DataFrame:
    """``(page, term, score)`` as a written table of one row a block; pages without a shared term leave.

    ``pages`` are in their order, ``terms`` are numbers in theirs, a term's postings are ``places`` of pages and ``scores`` from its
    ``starts`` on.
    """
    blocks = max(1, -(-postings.select("page").distinct().count() // BLOCK_PAGES))
    known = postings.where("page IS NOT NULL").join(terms.select("term", "number"), "term").select(
        F.pmod(F.xxhash64("page"), F.lit(blocks)).cast("int").alias("block"), "page", "number", "score"
    )

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        pages, places = np.unique(rows["page"].to_numpy(), return_inverse=True)
        numbers = rows["number"].to_numpy()
        order = np.argsort(numbers, kind="stable")
        found, starts = np.unique(numbers[order], return_index=True)
        held = {"pages": list(pages), "terms": found, "starts": np.append(starts, len(order)).astype("int32"), "places": places[order].astype("int32"), "scores": rows["score"].to_numpy()[order]}
        return pd.DataFrame({name: [values] for name, values in held.items()})

    kind = postings.schema["page"].dataType.simpleString()
    # As many tasks as blocks: the block that a task packs is all it holds.
    return materialize(known.repartition(blocks, "block").groupBy("block").applyInPandas(
        pack, f"pages array<{kind}>, terms array<bigint>, starts array<int>, places array<int>, scores array<double>"
    ))


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as its length says, one after the other."""
    return np.repeat(starts - (np.cumsum(lengths) - lengths), lengths) + np.arange(lengths.sum())


def _matrix(block: dict, at: np.ndarray, rows: int) -> np.ndarray:
    """Dense columns of a block's terms at the given places of its term list."""
    lengths = block["starts"][at + 1] - block["starts"][at]
    held, out = _ranges(block["starts"][at], lengths), np.zeros((rows, len(at)))
    out[block["places"][held], np.repeat(np.arange(len(at)), lengths)] = block["scores"][held]
    return out


def block_scores(left: dict, right: dict) -> np.ndarray:
    """Sums of products over common terms, one row a page of the left block, one column a page of the right one."""
    rows, columns = len(left["pages"]), len(right["pages"])
    _, at_left, at_right = np.intersect1d(left["terms"], right["terms"], assume_unique=True, return_indices=True)
    work = (left["starts"][at_left + 1] - left["starts"][at_left]).astype("int64") * (right["starts"][at_right + 1] - right["starts"][at_right])
    order = np.argsort(-work, kind="stable")
    dense = order[: min(DENSE_TERMS, np.count_nonzero(work > rows * columns * DENSE_SHARE))]
    scores = _matrix(left, at_left[dense], rows) @ _matrix(right, at_right[dense], columns).T
    rest, flat = order[len(dense) :], scores.reshape(-1)
    cuts = np.searchsorted(np.cumsum(work[rest]), np.arange(PRODUCTS_AT_ONCE, work[rest].sum(), PRODUCTS_AT_ONCE))
    for some in np.split(rest, cuts):
        a, b = at_left[some], at_right[some]
        many_a, many_b = (side["starts"][at + 1] - side["starts"][at] for side, at in ((left, a), (right, b)))
        reach = np.repeat(many_b, many_a)
        own = np.repeat(_ranges(left["starts"][a], many_a), reach)
        other = _ranges(np.repeat(right["starts"][b], many_a), reach)
        cell = left["places"][own].astype("int64") * columns + right["places"][other]
        np.add.at(flat, cell, left["scores"][own] * right["scores"][other])
    return scores


def _best(left: dict, right: dict, n: int, bar: np.ndarray) -> pd.DataFrame:
    """The best ``n`` pages of each target that reach its bar, which is raised to what they reach."""
    exact = block_scores(left, right)
    _, own, other = np.intersect1d(left["pages"], right["pages"], assume_unique=True, return_indices=True)
    exact[own, other] = 0
    scores = np.where(exact > 0, np.round(exact, SCORE_DIGITS), -1.0)
    if scores.shape[1] > n:
        np.maximum(bar, np.partition(scores, -n, axis=1)[:, -n], out=bar)
    row, column = np.nonzero((scores >= bar[:, None]) & (scores >= 0))
    value = scores[row, column]
    # Columns are in page order: equal scores keep the smaller page first.
    order = np.lexsort((column, -value, row))
    place = np.arange(len(order)) - np.searchsorted(row, row[order])
    kept = order[place < n]
    return pd.DataFrame({"target": left["pages"][row[kept]], "page": right["pages"][column[kept]], "score": value[kept]})


def best_pages(scores: DataFrame, target_side: DataFrame | None, key: str, n: int, terms: DataFrame) -> DataFrame:
    """``(target, page, score)``: a set of pages that holds the ``n`` best of every target, and more, with rounded scores.

    ``scores`` holds positive scores, ``target_side`` the rows ``(target, term, weight)``, or None where every page is a target,
    ``terms`` are those of :func:`shared_terms`. A page is never its own candidate.
    """
    pages = packed(scores.select(F.col(key).alias("page"), "term", "score"), terms)
    targets = pages if target_side is None else packed(target_side.toDF("page", "term", "score"), terms)
    names, kind = pages.columns, scores.schema[key].dataType.simpleString()

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # A task takes one block of targets after the other, each with all its blocks of pages.
        last, bar = None, np.zeros(0)
        for batch in batches:
            for row in batch.to_dict("records"):
                left, right = {c: row[f"_{c}"] for c in names}, {c: row[c] for c in names}
                if last is None or not np.array_equal(last, left["pages"]):
                    last, bar = left["pages"], np.full(len(left["pages"]), -1.0)
                yield _best(left, right, n, bar)

    spark = scores.sparkSession
    met = targets.select(*[F.col(c).alias(f"_{c}") for c in names]).hint("shuffle_replicate_nl").crossJoin(pages)
    # A row is two blocks, so rows go to Python one by one.
    records = spark.conf.get(RECORDS)
    spark.conf.set(RECORDS, "1")
    try:
        return materialize(met.mapInPandas(compare, f"target {kind}, page {kind}, score double"))
    finally:
        spark.conf.set(RECORDS, records)

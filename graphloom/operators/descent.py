"""Approximate nearest neighbours by neighbour-of-neighbour descent.

A first graph comes from leaves of a bounded size, cut by random planes several times over. Then neighbours of a vector
are compared with one another: whoever is close to the same vector is likely close to each other. Lists are looked at in
both directions, only pairs with a link that is new since the last round are compared, and only those are sent on that beat
the worst of a list. It ends when few lists still change. Lists are dealt in blocks of a bounded number of centres, mostly
near ones, and a vector is sent once to each block that needs it. Each comparison is a product of small matrices in a task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators import vectors as exact
from graphloom.session import materialize, shuffle_width

LEAF, TABLES, ROUNDS = 128, 6, 12
#: Centres of a block (at most; there are as many blocks as cores), and found pairs that wait until the best are kept.
CENTRES, PAIRS_AT_ONCE = 65_536, 4_194_304
#: Rounds end when fewer than this share of all list places changed.
CHANGED = 0.002


def _leaf_pairs(units: DataFrame, size: int, pool: int, leaf: int, tables: int, seed: int) -> DataFrame:
    """``(id, other, score)``: the best others of each vector within its leaf of every table."""
    id_type = units.schema["id"].dataType.simpleString()
    bits = max(0, int(np.ceil(np.log2(max(1.0, size / leaf)))))
    placed = exact._plane_cells(units, tables, bits, seed).drop("home")
    # A crowded cell is dealt to leaves by a hash: the descent joins what this parts.
    sizes = placed.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / leaf).cast("int").alias("_leaves"))
    placed = placed.join(sizes, "cell").withColumn("leaf", F.pmod(F.xxhash64("id", "cell"), F.col("_leaves")))

    def best(block: pd.DataFrame) -> pd.DataFrame:
        ids, matrix = block["id"].to_numpy(), np.stack(block["v"].to_numpy())
        scores = matrix @ matrix.T
        np.fill_diagonal(scores, -np.inf)
        take = min(pool, len(ids) - 1)
        near = np.argpartition(-scores, take - 1, axis=1)[:, :take] if take > 0 else np.empty((len(ids), 0), int)
        own = np.repeat(np.arange(len(ids)), take)
        return pd.DataFrame({"id": ids[own], "other": ids[near.ravel()], "score": scores[own, near.ravel()]})

    return placed.groupBy("cell", "leaf").applyInPandas(best, f"id {id_type}, other {id_type}, score double")


def _best(pairs: DataFrame, pool: int) -> DataFrame:
    """The ``pool`` best distinct others of each vector; ``fresh`` stays for pairs that were not there before."""
    # Dealt by the vector once: both steps below keep that deal.
    dealt = pairs.repartition(shuffle_width(pairs.sparkSession), "id")
    single = dealt.groupBy("id", "other").agg(F.max("score").alias("score"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("id").orderBy(F.col("score").desc(), F.col("other"))
    return single.withColumn("place", F.row_number().over(order)).where(F.col("place") <= pool)


def _numbered(units: DataFrame, size: int, leaf: int, seed: int) -> DataFrame:
    """``(id, v, no)``: numbers whose upper bits are a block of about equal size, near vectors mostly in the same one."""
    cores = units.sparkSession.sparkContext.defaultParallelism
    bits = max(0, int(np.ceil(np.log2(max(1.0, size / leaf)))))
    placed = exact._plane_cells(units, 1, bits, seed).repartitionByRange(max(cores, -(-size // CENTRES)), "cell", "id")
    return materialize(placed.select("id", "v", F.monotonically_increasing_id().alias("no")))


def _block(number: str) -> Column:
    """A number's block: the partition that ``monotonically_increasing_id`` made it in."""
    return F.shiftright(number, 33)


def _lists(graph: DataFrame, pool: int) -> DataFrame:
    """``(block, centre, members, fresh)``: neighbours in both directions of each vector, where one is fresh."""
    width = shuffle_width(graph.sparkSession)
    back = graph.select(F.col("other").alias("centre"), F.col("id").alias("member"), "score", "fresh").repartition(width, "centre")
    first = Window.partitionBy("centre").orderBy(F.col("score").desc(), F.col("member"))
    back = back.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= pool)
    own = graph.select(F.col("id").alias("centre"), F.col("other").alias("member"), "fresh").repartition(width, "centre")
    # Twice ``pool`` members at most are gathered.
    lists = own.union(back.select("centre", "member", "fresh")).groupBy("centre").agg(F.collect_list(F.struct("member", "fresh")).alias("m"))
    lists = lists.where(F.exists("m", lambda x: x["fresh"]))
    return lists.select(_block("centre").alias("block"), "centre", F.col("m.member").alias("members"), F.col("m.fresh").alias("fresh"))


def _held(needed: DataFrame, held: DataFrame) -> DataFrame:
    """Vectors sent once to every block that needs them."""
    return needed.select(F.col("block").alias("to"), "member").distinct().join(held, "member")


def _sorted_rows(right: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers in order, their places in the table and their vectors."""
    numbers = right.column("member").to_numpy()
    order = np.argsort(numbers)
    column = right.column("v").combine_chunks()
    return numbers[order], order, column.flatten().to_numpy().reshape(len(numbers), -1)[order]


def _leaders(one: np.ndarray, two: np.ndarray, score: np.ndarray, bar: np.ndarray, pool: int) -> tuple[np.ndarray, ...]:
    """The ``pool`` best distinct pairs of each first one; bars rise to the worst of a full list."""
    _, kept = np.unique(one.astype(np.int64) * len(bar) + two, return_index=True)
    kept = kept[np.lexsort((-score[kept], one[kept]))]
    starts = np.flatnonzero(np.diff(one[kept], prepend=-1))
    place = np.arange(len(kept)) - np.repeat(starts, np.diff(starts, append=len(kept)))
    last = kept[place == pool - 1]
    bar[one[last]] = np.maximum(bar[one[last]], score[last])
    kept = kept[place < pool]
    return one[kept], two[kept], score[kept]


def _compared(left: pa.Table, right: pa.Table, pool: int) -> pa.Table:
    """Members of the lists of one block that beat each other's bars: ``(id, other, score)``, ``pool`` a vector at most."""
    numbers, order, matrix = _sorted_rows(right)
    bar = right.column("bar").to_numpy()[order].copy()
    members, marks = left.column("members").combine_chunks(), left.column("fresh").combine_chunks()
    edges = np.concatenate([[0], np.cumsum(members.value_lengths().to_numpy())])
    places = np.searchsorted(numbers, members.flatten().to_numpy()).astype(np.int32)
    marks = marks.flatten().to_numpy(zero_copy_only=False)
    kept = [np.empty(0, np.int32), np.empty(0, np.int32), np.empty(0, np.float32)]
    new, waiting = [], 0
    for lo, hi in zip(edges, edges[1:]):
        # A member of both directions stands twice; it is fresh if either row is.
        at, where = np.unique(places[lo:hi], return_inverse=True)
        fresh = np.bincount(where, marks[lo:hi]) > 0
        scores = matrix[at] @ matrix[at].T
        asked = fresh[:, None] | fresh[None, :]
        np.fill_diagonal(asked, False)
        i, j = np.nonzero(asked & (scores > bar[at][:, None]))
        new.append((at[i], at[j], scores[i, j]))
        waiting += len(i)
        if waiting > max(PAIRS_AT_ONCE, len(kept[0])):
            kept = _leaders(*(np.concatenate([old, *part]) for old, part in zip(kept, zip(*new))), bar, pool)
            new, waiting = [], 0
    if new:
        kept = _leaders(*(np.concatenate([old, *part]) for old, part in zip(kept, zip(*new))), bar, pool)
    return pa.table({"id": numbers[kept[0]], "other": numbers[kept[1]], "score": kept[2]})


def _met(lists: DataFrame, graph: DataFrame, vectors: DataFrame, pool: int) -> DataFrame:
    """``(id, other, score)`` of members of common lists that beat the worst of the first one's list."""
    bars = graph.groupBy("id").agg(F.when(F.count(F.lit(1)) >= pool, F.min("score")).otherwise(-2.0).cast("float").alias("bar"))
    held = vectors.join(bars, "id").select(F.col("id").alias("member"), "v", "bar")
    sent = _held(lists.select("block", F.explode("members").alias("member")), held)
    return lists.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(
        lambda left, right: _compared(left, right, pool), "id long, other long, score float"
    )


def _rescored(graph: DataFrame, numbered: DataFrame) -> DataFrame:
    """The pairs of the graph with their scores in double precision."""
    pairs = graph.select(_block("id").alias("block"), "id", "other")
    needed = pairs.select("block", F.col("other").alias("member")).union(pairs.select("block", "id"))
    sent = _held(needed, numbered.select(F.col("no").alias("member"), "v"))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        numbers, _, matrix = _sorted_rows(right)
        one, two = (np.searchsorted(numbers, left.column(name).to_numpy()) for name in ("id", "other"))
        score = np.empty(len(one))
        for at in range(0, len(one), 65_536):
            some = slice(at, at + 65_536)
            score[some] = np.einsum("ij,ij->i", matrix[one[some]], matrix[two[some]])
        return pa.table({"id": numbers[one], "other": numbers[two], "score": score})

    return pairs.groupBy("block").cogroup(sent.groupBy("to")).applyInArrow(run, "id long, other long, score double")


def descend(
    units: DataFrame, pool: int, leaf: int = LEAF, tables: int = TABLES, rounds: int = ROUNDS, seed: int = 7,
) -> tuple[DataFrame, list[int]]:
    """The graph ``(id, other, score, place)`` of ``(id, v)`` unit vectors, and the pairs compared in each round.

    Lists are searched in single precision by numbers for ids; the scores of the outcome are in double precision.
    """
    size = units.count()
    numbered = _numbered(units, size, leaf, seed)
    vectors = numbered.select(F.col("no").alias("id"), F.col("v").cast("array<float>").alias("v"))
    leaves = _leaf_pairs(numbered.select(F.col("no").alias("id"), "v"), size, pool, leaf, tables, seed)
    graph = materialize(_best(leaves.select("id", "other", F.col("score").cast("float").alias("score"), F.lit(True).alias("fresh")), pool))
    compared = [size * min(leaf, size) * tables // 2]
    for _ in range(rounds):
        lists = materialize(_lists(graph, pool))
        # Pairs with a fresh one: all pairs of a list but those of members seen before.
        sizes = lists.select(F.size(F.array_distinct("members")).alias("n"), F.size(F.array_distinct(
            F.filter(F.arrays_zip("members", "fresh"), lambda x: x["fresh"])["members"])).alias("new"))
        asked = sizes.agg(F.sum(F.expr("new * (new - 1) / 2 + new * (n - new)")).cast("long").alias("n"))
        compared.append(asked.head().n or 0)
        known = graph.select("id", "other", "score", F.lit(False).alias("fresh"))
        found = _met(lists, graph, vectors, pool).withColumn("fresh", F.lit(True))
        graph = materialize(_best(known.union(found), pool))
        if graph.where("fresh").count() <= CHANGED * size * pool:
            break
    scored = materialize(_rescored(graph, numbered))
    names = numbered.select("id", "no")
    one = names.select(F.col("id").alias("_id"), F.col("no").alias("id"))
    two = names.select(F.col("id").alias("_other"), F.col("no").alias("other"))
    named = scored.join(one, "id").join(two, "other").select(F.col("_id").alias("id"), F.col("_other").alias("other"), "score")
    order = Window.partitionBy("id").orderBy(F.col("score").desc(), F.col("other"))
    return named.withColumn("place", F.row_number().over(order)), compared


def knn_descent(
    vectors: DataFrame, key: str = "id", embedding: str = "embedding", k: int = 10, cutoff: float = 0.95, pool: int | None = None,
    leaf: int = LEAF, tables: int = TABLES, rounds: int = ROUNDS, seed: int = 7,
) -> DataFrame:
    """Approximate ``k`` nearest neighbours by cosine at or above the cut-off: ``(id, other, score, rank)``.

    Scores are exact, some neighbours may be missed; longer lists (``pool``, by default three times k) miss fewer. Equal
    vectors are one vector in the search and share the outcome. Zero and null vectors take no part; an empty table gives none.
    """
    units = materialize(exact.unit_vectors(vectors, key, embedding))
    groups = materialize(units.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")))
    graph, _ = descend(groups.select("id", "v"), pool or 3 * k, leaf, tables, rounds, seed)
    near = graph.select("id", "other", F.round("score", exact.SCORE_DIGITS).alias("score")).where(F.col("score") >= cutoff)
    near = materialize(exact._top_k(near, k).drop("rank"))
    if groups.where("copies > 1").limit(1).count():
        near = exact._expand_copies(units, groups, near, k, cutoff)
    return exact._top_k(near, k)

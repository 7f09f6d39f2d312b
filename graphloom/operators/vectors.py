"""Dense vectors: pooling, entity text vectors, nearest neighbours.

Neighbour search never joins all vectors with all vectors. Rows are placed in cells, each cell is cut into blocks of a
bounded number of rows, and a task compares one block with another by a matrix product, keeping only its best ``k``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.operators.components import connected_components
from graphloom.operators.tagging import word_terms
from graphloom.operators.tfidf import fit_transform
from graphloom.session import materialize

#: Rows of a block: as many as leave ``BLOCKS`` of them, within these bounds. Larger blocks send each vector less often.
BLOCK_ROWS, MAX_BLOCK_ROWS, BLOCKS = 4_096, 65_536, 12
#: Scores that a task holds at once, and rows that a task hands on at once.
SCORES_AT_ONCE, PLACED_ROWS = 1_048_576, 16_384
#: Probes whose scores a task makes together, and what rounding may add to a score at most.
PROBE_ROWS, ROUNDING = 256, 1e-9
MAX_CELLS = 1_024
SCORE_DIGITS = 9


# --- pooling ----------------------------------------------------------------------------------------------------


def mean_pool(
    tokens: DataFrame, key: str, mask: str, embedding: str, position: str | None = None, max_length: int = 256,
    dims: int | None = None,
) -> DataFrame:
    """Masked mean of token vectors per key; an all-zero mask gives a zero vector.

    One running sum per dimension, so partial results leave each task as one row per key. Rows at or beyond
    ``max_length`` are cut off when a position column is given. Vectors of different widths are refused; null vectors
    add nothing to the sums, but their masks count.
    """
    if position is not None:
        tokens = tokens.where(F.col(position) < max_length)
    if dims is None:
        widths = tokens.where(F.col(embedding).isNotNull()).agg(F.min(F.size(embedding)).alias("lo"), F.max(F.size(embedding)).alias("hi")).head()
        if widths.lo != widths.hi:
            raise ValueError(f"vectors of {widths.lo} to {widths.hi} components can't be averaged")
        dims = widths.hi or 0
    weight = F.col(mask).cast("double")
    sums = [F.coalesce(F.sum(F.col(embedding)[i].cast("double") * weight), F.lit(0.0)).alias(f"_s{i}") for i in range(dims)]
    pooled = tokens.groupBy(key).agg(F.sum(weight).alias("_mask"), *sums)
    divisor = F.greatest(F.col("_mask"), F.lit(1e-9))
    return pooled.select(key, F.array(*[F.col(f"_s{i}") / divisor for i in range(dims)]).alias("embedding"))


# --- entity text ------------------------------------------------------------------------------------------------


def term_bucket(term: Column, dims: int) -> Column:
    """Bucket of a term from the first four hex digits of its MD5."""
    return F.conv(F.substring(F.md5(term), 1, 4), 16, 10).cast("int") % dims


def entity_text_vectors(entities: DataFrame, dims: int = 64) -> DataFrame:
    """``(id, embedding)``: unit-length hashed TF-IDF of id and description. Entities without a word are absent."""
    text = entities.select("id", F.concat_ws(" ", "id", "description").alias("text"))
    scores = fit_transform(word_terms(text, "id", "text"), text, "id", max_df=1.0, stop_words=None)
    buckets = scores.groupBy("id", term_bucket(F.col("term"), dims).alias("bucket")).agg(F.sum("score").alias("v"))
    # At most ``dims`` entries per entity are gathered.
    gathered = buckets.groupBy("id").agg(
        F.map_from_entries(F.collect_list(F.struct("bucket", "v"))).alias("m"),
        F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"),
    )
    dense = _once(
        F.struct("m", "norm"),
        lambda e: F.transform(
            F.sequence(F.lit(0), F.lit(dims - 1)), lambda b: F.coalesce(F.try_element_at(e["m"], b), F.lit(0.0)) / e["norm"]
        ),
    )
    return gathered.select("id", dense.alias("embedding"))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value made once a row.

    A column that a list's function names only once is made anew for every item of the list, as the optimizer puts its
    expression there; a variable is not.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


# --- neighbours -------------------------------------------------------------------------------------------------


def unit_vectors(vectors: DataFrame, key: str, embedding: str) -> DataFrame:
    """``(id, v)`` scaled to length one; zero vectors have no direction and leave."""
    as_double = F.transform(embedding, lambda x: x.cast("double"))

    def scaled(v: Column) -> Column:
        norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x))
        return _once(norm, lambda n: F.when(n > 0, F.transform(v, lambda x: x / n)))

    return vectors.select(F.col(key).alias("id"), _once(as_double, scaled).alias("v")).where("v IS NOT NULL")


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy())


def _block_rows(assigned: DataFrame, block_rows: int) -> DataFrame:
    """Cut each cell into home blocks and probe blocks and give every pair of blocks its own key.

    Block membership is by hash of the id, so a cell that holds most rows becomes many tasks of the same size.
    """
    sizes = assigned.groupBy("cell").agg(
        F.ceil(F.sum(F.col("home").cast("long")) / block_rows).cast("int").alias("_homes"),
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_probes"),
    ).where(F.col("_homes") > 0)
    placed = assigned.join(sizes, "cell")
    own_home = F.pmod(F.xxhash64("id"), F.col("_homes")).cast("int")
    own_probe = F.pmod(F.xxhash64("id"), F.col("_probes")).cast("int")
    as_probe = placed.select(
        "cell", "id", "v", F.lit(False).alias("home"), own_probe.alias("probe_block"),
        F.explode(F.sequence(F.lit(0), F.col("_homes") - 1)).alias("home_block"),
    )
    as_home = placed.where("home").select(
        "cell", "id", "v", F.lit(True).alias("home"),
        F.explode(F.sequence(F.lit(0), F.col("_probes") - 1)).alias("probe_block"), own_home.alias("home_block"),
    )
    return as_probe.unionByName(as_home)


def block_size(rows: int) -> int:
    return min(MAX_BLOCK_ROWS, max(BLOCK_ROWS, -(-rows // BLOCKS)))


def _best_of_block(block: pd.DataFrame, k: int, cutoff: float) -> pd.DataFrame:
    """The best ``k`` homes of each probe, from the scores of a bounded number of pairs at a time."""
    homes = block[block["home"]].sort_values("id")
    probes = block[~block["home"]]
    if not len(homes) or not len(probes):
        return pd.DataFrame({"id": [], "other": [], "score": []})
    home_ids, probe_ids = homes["id"].to_numpy(), probes["id"].to_numpy()
    right, left = np.ascontiguousarray(_matrix(homes["v"]).T), _matrix(probes["v"])
    parts = [_best_of_rows(left[at : at + PROBE_ROWS], right, probe_ids[at : at + PROBE_ROWS], home_ids, k, cutoff) for at in range(0, len(left), PROBE_ROWS)]
    return pd.concat(parts, ignore_index=True)


def _best_of_rows(left: np.ndarray, right: np.ndarray, probe_ids: np.ndarray, home_ids: np.ndarray, k: int, cutoff: float) -> pd.DataFrame:
    """The best ``k`` homes of each of some probes. Only scores that can still be among them are rounded and ranked."""
    bar = np.full((len(left), 1), cutoff - ROUNDING)
    row, near, score = np.zeros(0, "int64"), np.zeros(0, "int64"), np.zeros(0)
    step = max(1, SCORES_AT_ONCE // len(left))
    for at in range(0, right.shape[1], step):
        scores = left @ right[:, at : at + step]
        found = np.flatnonzero(scores >= bar)
        own, other = np.divmod(found, scores.shape[1])
        value = np.round(scores.reshape(-1)[found], SCORE_DIGITS)
        kept = (value >= cutoff) & (home_ids[other + at] != probe_ids[own])
        row, near, score = np.append(row, own[kept]), np.append(near, other[kept] + at), np.append(score, value[kept])
        # Homes are in id order: equal scores keep the smaller id first.
        order = np.lexsort((near, -score, row))
        place = np.arange(len(order)) - np.searchsorted(row[order], row[order])
        bar[row[order][place == k - 1], 0] = score[order][place == k - 1] - ROUNDING
        order = order[place < k]
        row, near, score = row[order], near[order], score[order]
    return pd.DataFrame({"id": probe_ids[row], "other": home_ids[near], "score": score})


def _compare_blocks(assigned: DataFrame, k: int, cutoff: float, block_rows: int) -> DataFrame:
    """``(id, other, score)``: per probe row and block the best ``k`` others at or above the cut-off."""
    id_type = assigned.schema["id"].dataType.simpleString()

    def best(block: pd.DataFrame) -> pd.DataFrame:
        return _best_of_block(block, k, cutoff)

    keyed = _block_rows(assigned, block_rows)
    return keyed.groupBy("cell", "probe_block", "home_block").applyInPandas(
        best, f"id {id_type}, other {id_type}, score double"
    )


def _top_k(pairs: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("id").orderBy(F.col("score").desc(), F.col("other"))
    return pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _pivot_cells(units: DataFrame, cells: int, cutoff: float) -> DataFrame:
    """Home cell (nearest pivot) of each vector, and every other cell that can hold a vector within the cut-off.

    With ``c`` the cut-off two such unit vectors are at most ``r = sqrt(2 - 2c)`` apart. A vector whose distance to the
    plane between its own pivot and another one exceeds ``r`` has no partner behind that plane. Hence no pair is lost.
    """
    rows = units.orderBy(F.xxhash64("id"), "id").limit(cells).select("v").collect()
    pivots = np.array([row.v for row in rows])
    radius = float(np.sqrt(max(0.0, 2.0 - 2.0 * cutoff))) + 1e-6
    gaps = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * pivots @ pivots.T))
    id_type = units.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _reached_cells(batches, pivots, gaps, radius)

    return units.mapInPandas(place, f"cell long, home boolean, id {id_type}, v array<double>")


def _reached_cells(
    batches: Iterator[pd.DataFrame], pivots: np.ndarray, gaps: np.ndarray, radius: float
) -> Iterator[pd.DataFrame]:
    """Rows once per cell they reach; a batch is taken in slices that yield at most ``PLACED_ROWS`` rows each."""
    step = max(1, PLACED_ROWS // len(pivots)) if len(pivots) else 1
    for batch in batches:
        for at in range(0, len(batch), step):
            part = batch.iloc[at : at + step]
            squared = np.maximum(0.0, 2.0 - 2.0 * _matrix(part["v"]) @ pivots.T)
            home = squared.argmin(axis=1)
            excess = squared - squared[np.arange(len(home)), home][:, None]
            reach = excess <= 2.0 * radius * gaps[home] + 1e-9
            row, cell = np.nonzero(reach)
            yield pd.DataFrame(
                {
                    "cell": cell.astype("int64"),
                    "home": cell == home[row],
                    "id": part["id"].to_numpy()[row],
                    "v": part["v"].to_numpy()[row],
                }
            )


def knn(
    vectors: DataFrame, key: str = "id", embedding: str = "embedding", k: int = 10, cutoff: float = 0.95,
    block_rows: int | None = None, max_cells: int = MAX_CELLS,
) -> DataFrame:
    """Exact ``k`` nearest neighbours by cosine at or above the cut-off: ``(id, other, score, rank)``.

    Equal vectors are compared once, through their smallest id, and share the outcome. The number of pivots follows
    the number of distinct vectors; the higher the cut-off, the fewer cells a vector visits.
    """
    units = materialize(unit_vectors(vectors, key, embedding))
    groups = materialize(units.groupBy("v").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")))
    distinct = groups.count()
    if distinct == 0:
        return _top_k(units.select("id", F.col("id").alias("other"), F.lit(0.0).alias("score")), 0)
    reps = groups.select("id", "v")
    block_rows = block_rows or block_size(distinct)
    cells = max(1, min(max_cells, distinct // block_rows))
    assigned = materialize(_pivot_cells(reps, cells, cutoff))
    near = _top_k(_compare_blocks(assigned, k, cutoff, block_rows), k).drop("rank")
    if distinct == units.count():
        return _top_k(near, k)
    return _top_k(_expand_copies(units, groups, near, k, cutoff), k)


def _expand_copies(units: DataFrame, groups: DataFrame, near: DataFrame, k: int, cutoff: float) -> DataFrame:
    """Neighbours of vectors from those of their group's smallest member.

    The best ``k`` of a vector lie within its own group's first ``k + 1`` members and the first ``k`` members of its
    group's ``k`` nearest groups, so a group of copies of any size stays linear.
    """
    members = units.join(groups.select("v", F.col("id").alias("rep"), "copies"), "v").select("id", "rep", "copies")
    members = materialize(members)
    first = members.withColumn("_n", F.row_number().over(Window.partitionBy("rep").orderBy("id")))
    first = materialize(first.where(F.col("_n") <= k + 1).select(F.col("rep").alias("other_rep"), F.col("id").alias("other")))
    hops = near.select(F.col("id").alias("rep"), F.col("other").alias("other_rep"), "score")
    if cutoff <= 1.0:
        own = groups.where(F.col("copies") > 1).select(
            F.col("id").alias("rep"), F.col("id").alias("other_rep"), F.lit(1.0).alias("score")
        )
        hops = hops.union(own)
    # Per group at most k + 1 candidates in all: its members then join a bounded list.
    candidates = hops.join(first, "other_rep").select("rep", "other", "score")
    order = Window.partitionBy("rep").orderBy(F.col("score").desc(), F.col("other"))
    candidates = candidates.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    return (
        members.join(candidates, "rep").where(F.col("id") != F.col("other")).select("id", "other", "score")
    )


def _plane_cells(units: DataFrame, tables: int, bits: int, seed: int) -> DataFrame:
    """Cell of each vector in every hash table: the side it takes of ``bits`` random planes."""
    id_type = units.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers = 1 << np.arange(bits, dtype="int64")
        for batch in batches:
            if not len(batch):
                continue
            matrix = _matrix(batch["v"])
            planes = np.random.default_rng(seed).standard_normal((tables, matrix.shape[1], bits))
            for table in range(tables):
                cell = ((matrix @ planes[table]) > 0) @ powers + (np.int64(table) << np.int64(bits))
                yield pd.DataFrame({"cell": cell, "home": True, "id": batch["id"], "v": batch["v"]})

    return units.mapInPandas(place, f"cell long, home boolean, id {id_type}, v array<double>")


def knn_lsh(
    vectors: DataFrame, key: str = "id", embedding: str = "embedding", k: int = 10, cutoff: float = 0.95,
    recall: float = 0.99, bits: int = 12, seed: int = 7, block_rows: int | None = None,
) -> DataFrame:
    """Approximate neighbours: only vectors that share a cell in one of the hash tables are compared.

    Scores are exact; a neighbour that shares no cell is missed. Two vectors at angle ``a`` share a cell of one table
    with probability ``(1 - a / pi) ** bits``; the number of tables is what ``recall`` asks for at the cut-off. More
    bits mean smaller cells and more tables.
    """
    share = (1.0 - np.arccos(min(1.0, max(-1.0, cutoff))) / np.pi) ** bits
    tables = 1 if share >= 1.0 else max(1, int(np.ceil(np.log(1.0 - recall) / np.log(1.0 - share))))
    units = materialize(unit_vectors(vectors, key, embedding))
    assigned = materialize(_plane_cells(units, tables, bits, seed))
    pairs = _compare_blocks(assigned, k, cutoff, block_rows or block_size(units.count())).distinct()
    return _top_k(pairs, k)


def similar_components(vectors: DataFrame, similar: DataFrame, key: str = "id") -> DataFrame:
    """``(id, component)`` over the neighbour pairs; vectors without neighbours are alone."""
    nodes = vectors.select(F.col(key).alias("id"))
    return connected_components(similar, nodes, "id", "other")

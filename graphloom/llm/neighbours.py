"""Nearest neighbours by inner product in a block matrix join.

Queries and candidates are packed into blocks, every query block meets every candidate block once, and one product of
int8 tiles scores a pair of blocks. Quantisation errors bound each product from both sides: only candidates whose upper
bound reaches the query's k-th lower bound are computed again in double precision. Heaps merge the blocks' bests.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import materialize, shuffle_width

#: Vectors of a block at most. A block is one row: 8 bytes for each component, and the ids.
BLOCK_ROWS = 8192
#: Largest components between which norms and products of rows are far from the ends of double precision.
TRUSTED = (1e-100, 1e100)
#: Candidate blocks are not made smaller than this for the sake of more tasks.
LEAST_ROWS = 1024
#: Queries that meet a candidate block at once inside a task.
TILE_ROWS = 256


def quantise(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scales, norms of the rounded vectors and of what rounding took, and whether bounds can be trusted.

    Rows whose largest component lies outside ``TRUSTED`` might overflow or vanish in norms and products; they are
    written as zeros here and must be compared exactly.
    """
    largest = np.abs(rows).max(axis=1)
    trusted = (largest >= TRUSTED[0]) & (largest <= TRUSTED[1])
    scale = np.where(trusted, largest, 1.0) / 127.0
    calm = np.where(trusted[:, None], rows, 0.0)
    whole = np.rint(calm / scale[:, None]).astype(np.int8)
    rounded = whole * scale[:, None]
    return whole, scale, np.linalg.norm(rounded, axis=1), np.linalg.norm(calm - rounded, axis=1), trusted


def exact(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Inner products of matching rows, added from the first component to the last in double precision."""
    total = np.zeros(len(queries))
    with np.errstate(over="ignore", invalid="ignore"):
        for d in range(queries.shape[1]):
            total += queries[:, d] * candidates[:, d]
    return total


def block_best(q: np.ndarray, c: np.ndarray, c_ids: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query row, scores, candidate rows)`` of the k best candidates of each query in one pair of blocks."""
    q_whole, q_scale, q_round, q_lost, q_trusted = quantise(q)
    c_whole, c_scale, c_round, c_lost, c_trusted = quantise(c)
    # integers below 2**24 are exact in float32 up to 1,040 components; beyond, double precision takes them
    kind = np.float32 if q.shape[1] <= 1040 else np.float64
    right = c_whole.T.astype(kind)
    for at in range(0, len(q), TILE_ROWS):
        some = slice(at, min(at + TILE_ROWS, len(q)))
        near = (q_whole[some].astype(kind) @ right).astype(np.float64) * (q_scale[some, None] * c_scale)
        # <q, c> = rounded part + <q's loss, c rounded> + <q, c's loss>
        loss = q_lost[some, None] * c_round + (q_round[some] + q_lost[some])[:, None] * c_lost
        loss += 1e-9 * (q_round[some, None] * c_round + 1e-300)
        loss[~q_trusted[some]] = np.inf
        loss[:, ~c_trusted] = np.inf
        if near.shape[1] > k:
            bar = np.partition(near - loss, near.shape[1] - k, axis=1)[:, near.shape[1] - k]
        else:
            bar = np.full(near.shape[0], -np.inf)
        rows, columns = np.nonzero(near + loss >= bar[:, None])
        starts = np.searchsorted(rows, np.arange(near.shape[0] + 1))
        for i in range(near.shape[0]):
            left = columns[starts[i] : starts[i + 1]]
            scores = exact(np.broadcast_to(q[at + i], (len(left), q.shape[1])), c[left])
            best = np.lexsort((c_ids[left], -scores, ~np.isnan(scores)))[:k]
            yield at + i, scores[best], left[best]


def _blocks(vectors: DataFrame, blocks: int, name: str) -> DataFrame:
    """One row for each hashed block: ids and components as binaries."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        data = np.array(frame["vector"].tolist(), np.float64)
        return pd.DataFrame({
            name: [int(frame["block"].iloc[0])], f"{name}_ids": [frame["id"].to_numpy(np.int64).tobytes()],
            f"{name}_data": [data.tobytes()], f"{name}_width": [data.shape[1]],
        })

    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(run, f"{name} int, {name}_ids binary, {name}_data binary, {name}_width int")


def nearest(
    vectors: DataFrame, is_query, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest other rows by inner product of every row where ``is_query`` holds.

    All rows are candidates of all queries, in blocks; ties go to the smaller id. Vectors that are null, zero, or hold
    null or non-finite components take no part, nor do rows without an id; all others must have one width. Equal
    vectors are compared once: each vector stands for its k + 1 smallest ids, more can't be among any k nearest. Rows
    that repeat an id and vector count once; an id with several vectors counts with each of them. With fewer than k
    candidates all are given; an empty table gives none.

    A block pair holds at most ``block_rows`` rows of either side, whatever the table's size; blocks are smaller while
    the table would give fewer pairs than shuffle partitions. Pairs are dealt by both numbers, so the products of one
    query block are spread over tasks; the traffic is either side's bytes times the number of the other's blocks.
    Vectors travel whole with their block: a near copy of a query can't be told from its fellows by int8 bounds, and
    its group's pairs are to be settled where they are found, not sent on. A score that overflows to no number ranks first.
    """
    own = vectors.select(
        vectors[vec_id].cast("long").alias("id"), vectors[embedding].cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = own.where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
    # -0.0 and 0.0 are one value; ids of equal vectors are few in a group or pre-aggregated to k + 1
    valid = valid.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0))).dropDuplicates(["id", "vector"])
    valid = valid.withColumn("same", F.sha2(F.array_join(F.transform("vector", lambda x: x.cast("string")), ","), 256))
    valid = materialize(valid)
    low = valid.withColumn("place", F.row_number().over(Window.partitionBy("same").orderBy("id"))).where(F.col("place") <= k + 1)
    members = materialize(low.select("same", "id", "place", "vector"))
    heads = members.where("place = 1").select("id", "vector", "same")
    asking = valid.where("asks").select("same").distinct().join(heads, "same").select("id", "vector")
    total, asked = heads.count(), valid.where("asks").count()
    width = shuffle_width(vectors.sparkSession)
    n_q = max(1, -(-asked // block_rows))
    n_c = max(1, -(-total // block_rows), min(-(-width // n_q), -(-total // LEAST_ROWS)))
    c_blocks = _blocks(heads.select("id", "vector"), n_c, "c")
    q_blocks = _blocks(asking, n_q, "q")
    each = lambda n, name: F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias(name)
    # A stated number of partitions keeps the few large rows from being put together by their bytes.
    c_side = c_blocks.select("*", each(n_q, "q")).repartition(width, "q", "c")
    q_side = q_blocks.select("*", each(n_c, "c")).repartition(width, "q", "c")
    pairs = c_side.join(q_side.hint("merge"), ["q", "c"])
    out = pa.schema([("query", pa.int64()), ("head", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["q_width"] != row["c_width"]:
                    raise ValueError("vectors differ in width")
                c_ids, q_ids = np.frombuffer(row["c_ids"], np.int64), np.frombuffer(row["q_ids"], np.int64)
                c = np.frombuffer(row["c_data"]).reshape(len(c_ids), -1)
                q = np.frombuffer(row["q_data"]).reshape(len(q_ids), -1)
                found = list(block_best(q, c, c_ids, k + 1))
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([np.full(len(s), q_ids[i]) for i, s, _ in found])),
                    pa.array(np.concatenate([c_ids[r] for _, _, r in found])),
                    pa.array(np.concatenate([s for _, s, _ in found])),
                ], schema=out)

    partial = pairs.mapInArrow(run, "query long, head long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps: dict[int, list[tuple[bool, float, int]]] = {}  # of the queries dealt to this task, k + 1 entries each
        for batch in batches:
            for query, head, score in zip(*(batch.column(c).to_pylist() for c in ("query", "head", "score"))):
                heap = heaps.setdefault(query, [])
                entry = (score != score, 0.0 if score != score else score, -head)
                if len(heap) <= k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
        rows = [(query, -head, float("nan") if lost else score) for query, heap in heaps.items() for lost, score, head in heap]
        yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, out)], schema=out)

    merged = partial.repartition(width, "query").mapInArrow(merge, "query long, head long, score double")
    same_of = heads.select(F.col("id").alias("head"), "same")
    asks = valid.where("asks").select(F.col("id").alias("query_id"), F.col("same").alias("q_same"))
    per_vector = merged.join(same_of, "head").join(members.select("same", F.col("id").alias("vec_id")), "same").select("query", "vec_id", "score")
    first = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    # of the k + 1 vectors' up to (k + 1)**2 ids the first k + 1 by score and id
    per_vector = per_vector.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    heads_of = asks.join(same_of, asks.q_same == same_of.same).select("query_id", F.col("head").alias("query"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = heads_of.join(per_vector.drop("place"), "query").where("vec_id != query_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

import numpy as np
import pandas as pd
import pytest

from graphloom.operators import vectors


def frame(spark, matrix, ids=None):
    ids = ids if ids is not None else range(len(matrix))
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, matrix)], "id long, embedding array<float>")


def brute(matrix, k, cutoff):
    matrix = np.asarray(matrix, dtype="float32").astype("float64")
    norms = np.linalg.norm(matrix, axis=1)
    out = {}
    for i in range(len(matrix)):
        if norms[i] == 0:
            continue
        near = []
        for j in range(len(matrix)):
            if i != j and norms[j] > 0:
                s = round(float(matrix[i] @ matrix[j] / norms[i] / norms[j]), 9)
                if s >= cutoff:
                    near.append((-s, j))
        for rank, (s, j) in enumerate(sorted(near)[:k], 1):
            out[(i, rank)] = (j, pytest.approx(-s, abs=1e-7))
    return out


def found(df):
    return {(r.id, r["rank"]): (r.other, r.score) for r in df.collect()}


def clustered(seed, n=240, dims=16):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((12, dims))
    return centres[rng.integers(0, 12, n)] + 0.25 * rng.standard_normal((n, dims))


@pytest.mark.parametrize("cutoff,cells,block", [(0.95, 8, 20), (0.8, 16, 7), (0.3, 4, 50), (0.9, 1, 1000)])
def test_knn_is_exact(spark, cutoff, cells, block):
    matrix = clustered(3)
    df = vectors.knn(frame(spark, matrix), k=5, cutoff=cutoff, block_rows=block, max_cells=cells)
    assert found(df) == brute(matrix, 5, cutoff)


def test_high_cutoff_visits_few_cells(spark):
    units = vectors.unit_vectors(frame(spark, clustered(4)), "id", "embedding")
    placed = vectors._pivot_cells(units, 12, 0.99)
    assert placed.count() < 240 * 6 and placed.where("home").count() == 240


def test_knn_with_copies_and_zero_vector(spark):
    matrix = np.vstack([np.tile([1.0, 0.0], (9, 1)), [[0.99, 0.1]], [[0.0, 0.0]], np.tile([0.98, 0.2], (3, 1)), [[0.0, 1.0]]])
    df = vectors.knn(frame(spark, matrix), k=4, cutoff=0.9, block_rows=2)
    assert found(df) == brute(matrix, 4, 0.9)


def test_pair_on_the_cutoff_counts(spark):
    df = vectors.knn(frame(spark, [[1, 0], [0.6, 0.8], [0, 1]]), k=2, cutoff=0.6)
    assert (0, 1) in found(df) and found(df)[(0, 1)][0] == 1


def test_no_vectors(spark):
    assert vectors.knn(frame(spark, [[0.0, 0.0]])).count() == 0


def test_lsh_recall(spark):
    matrix = clustered(5)
    exact = brute(matrix, 5, 0.9)
    near = found(vectors.knn_lsh(frame(spark, matrix), k=5, cutoff=0.9, recall=0.99, bits=6))
    hits = {(i, j) for (i, _), (j, _) in near.items()} & {(i, j) for (i, _), (j, _) in exact.items()}
    assert len(hits) >= 0.95 * len(exact)
    assert all(score >= 0.9 for _, score in near.values())


def test_mean_pool(spark, rows):
    df = spark.createDataFrame(
        [(1, 0, 1, [1.0, 2.0]), (1, 1, 1, [3.0, 4.0]), (1, 2, 0, [100.0, 100.0]), (1, 300, 1, [100.0, 100.0]), (2, 0, 0, [5.0, 5.0])],
        "sent int, pos int, mask int, embedding array<float>",
    )
    assert rows(vectors.mean_pool(df, "sent", "mask", "embedding", "pos", 256)) == [(1, [2.0, 3.0]), (2, [0.0, 0.0])]


def test_entity_text_vectors(spark):
    df = spark.createDataFrame([("a b", "c"), ("a b", None), ("!", None)], "id string, description string").limit(3)
    found_rows = {r.id: r.embedding for r in vectors.entity_text_vectors(df.where("description is not null or id = '!'"), 16).collect()}
    assert set(found_rows) == {"a b"}
    assert np.isclose(np.linalg.norm(found_rows["a b"]), 1.0) and len(found_rows["a b"]) == 16


def test_similar_components(spark, rows):
    df = frame(spark, [[1, 0], [0.99, 0.05], [0, 1]])
    assert rows(vectors.similar_components(df, vectors.knn(df))) == [(0, 0), (1, 0), (2, 2)]


def test_a_task_holds_a_bounded_number_of_scores_and_rows():
    import tracemalloc

    units = np.random.default_rng(5).standard_normal((4096, 8))
    units /= np.linalg.norm(units, axis=1)[:, None]
    rows = pd.DataFrame({"id": np.arange(4096), "v": list(units)})
    block = pd.concat([rows.assign(home=True), rows.assign(home=False)])
    tracemalloc.start()
    near = vectors._best_of_block(block, 3, 0.9)
    assert tracemalloc.get_traced_memory()[1] < 100e6
    tracemalloc.stop()
    scores = np.round(units @ units.T, 9)
    np.fill_diagonal(scores, -1)
    assert len(near) == sum(min(3, n) for n in (scores >= 0.9).sum(axis=1))
    pivots = units[:600]
    gaps = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * pivots @ pivots.T))
    parts = list(vectors._reached_cells(iter([rows]), pivots, gaps, 2.0))
    assert max(map(len, parts)) <= vectors.PLACED_ROWS and sum(p["home"].sum() for p in parts) == 4096


def test_blocks_of_large_tables_stay_few():
    # 600,000 vectors meet in 12 by 12 pairs of blocks: each is sent 24 times, not 74.
    assert -(-600_000 // vectors.block_size(600_000)) == vectors.BLOCKS
    assert vectors.block_size(100) == vectors.BLOCK_ROWS and vectors.block_size(10**9) == vectors.MAX_BLOCK_ROWS

"""Neighbour descent: recall and comparisons on curved data, copies and odd rows."""

import math

import numpy as np

from graphloom.operators import descent, vectors
from graphloom.session import materialize


def test_recall_with_few_comparisons(spark):
    rng = np.random.default_rng(1)
    points = rng.standard_normal((6000, 6)) @ rng.standard_normal((6, 24)) + 0.05 * rng.standard_normal((6000, 24))
    points /= np.linalg.norm(points, axis=1)[:, None]
    scores = points @ points.T
    np.fill_diagonal(scores, -9)
    wanted = {(i, int(j)) for i, row in enumerate(np.argsort(-scores, axis=1)[:, :10]) for j in row}
    units = materialize(spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(points)], "id long, v array<double>"))
    graph, compared = descent.descend(units, pool=20, leaf=64, tables=3)
    rows = graph.where("place <= 10").collect()
    assert len({(r.id, r.other) for r in rows} & wanted) >= 0.95 * len(wanted)
    assert all(abs(r.score - scores[r.id, r.other]) < 1e-9 for r in rows)
    assert sum(compared) < 0.25 * 6000 * 5999 / 2
    # The leaves alone find far less.
    leaves = descent._best(descent._leaf_pairs(units, 6000, 20, 64, 3, 7).selectExpr("*", "true AS fresh"), 10).collect()
    assert len({(r.id, r.other) for r in leaves} & wanted) < 0.8 * len(wanted)


def test_small_tables_copies_and_odd_rows(spark):
    rows = [(i, [math.cos(i % 20), math.sin(i % 20)]) for i in range(60)] + [(100, [0.0, 0.0]), (101, None)]
    frame = spark.createDataFrame(rows, "id long, embedding array<double>")
    pick = lambda found: sorted(tuple(r) for r in found.select("id", "other", "score", "rank").collect())
    exact = pick(vectors.knn(frame.where("id <> 101"), k=4, cutoff=0.5))
    assert pick(descent.knn_descent(frame, k=4, cutoff=0.5, leaf=16, tables=3)) == exact and len(exact) == 240
    names = spark.createDataFrame([(f"n{i}", v) for i, v in rows[:20]], "id string, embedding array<double>")
    assert descent.knn_descent(names, k=3, cutoff=0.2).where("rank = 1").count() > 0
    assert descent.knn_descent(frame.where("false"), k=3).count() == 0
    assert descent.knn_descent(frame.where("id = 5"), k=3).count() == 0


def test_a_vector_is_sent_once_to_each_block(spark, monkeypatch):
    rng = np.random.default_rng(2)
    units = [(i, (x / np.linalg.norm(x)).tolist()) for i, x in enumerate(rng.standard_normal((1500, 12)))]
    sent, held = [], descent._held
    monkeypatch.setattr(descent, "_held", lambda *sides: sent.append(held(*sides)) or sent[-1])
    descent.descend(spark.createDataFrame(units, "id long, v array<double>"), pool=20, leaf=64, tables=2, rounds=2)
    assert len(sent) == 3
    for rows in sent:
        assert rows.count() == rows.select("to", "member").distinct().count() <= 1500 * spark.sparkContext.defaultParallelism


def test_leaders_are_distinct_and_raise_the_bar():
    rng = np.random.default_rng(3)
    one, two = rng.integers(0, 9, 400).astype(np.int32), rng.integers(0, 9, 400).astype(np.int32)
    score = ((one * 31 + two * 17) % 23 / 23).astype(np.float32)
    bar = np.full(9, -2.0, np.float32)
    found = sorted(zip(*(x.tolist() for x in descent._leaders(one, two, score, bar, 3))))
    ranked = {i: sorted({(float(s), int(j)) for a, j, s in zip(one, two, score) if a == i}, reverse=True)[:3] for i in range(9)}
    assert [s for i, _, s in found] and all(sorted((s for a, _, s in found if a == i), reverse=True) == [s for s, _ in ranked[i]] for i in range(9))
    assert [float(x) for x in bar] == [ranked[i][2][0] for i in range(9)]

"""Stored graph tables: equal to the full merge, files of untouched buckets unchanged."""

import os

import pytest

from graphloom.operators import graph, stored


def _files(folder):
    return {os.path.join(at, f): os.stat(os.path.join(at, f)).st_mtime_ns for at, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


@pytest.fixture
def batches(spark):
    def batch(nodes, edges, documents, mentions):
        return {
            "nodes": spark.createDataFrame(nodes, "id string, type string, description string"),
            "edges": spark.createDataFrame(edges, "src string, type string, dst string, description string"),
            "documents": spark.createDataFrame(documents, "doc_id long, text string"),
            "mentions": spark.createDataFrame(mentions, "doc_id long, entity_id string"),
        }

    first = batch(
        [(f"n{i}", "T", None if i % 2 else f"d{i}") for i in range(60)] + [("n1", "U", None), (None, "T", "no id")],
        [(f"n{i}", "R", f"n{i + 1}", None) for i in range(59)], [(i, f"text {i}") for i in range(40)] + [(3, "other")],
        [(i, f"n{i}") for i in range(40)] + [(2, "n2")],
    )
    second = batch([("n1", "X", "filled"), ("new", "X", "")], [("n3", "R", "n4", "why")], [(99, None), (3, "later")], [(99, "n1")])
    return first, second, batch([], [], [], [])


def test_equals_the_full_merge(spark, batches, rows, tmp_path):
    first, second, none = batches
    path = f"{tmp_path}/g"
    written = stored.upsert_stored(spark, path, first, buckets=16)
    assert max(written.values()) <= 16
    before = _files(f"{path}/nodes")
    written = stored.upsert_stored(spark, path, second, buckets=5)  # the founding number stays
    whole = graph.upsert_graph(graph.upsert_graph(None, first), second)
    for name, frame in whole.items():
        assert rows(stored.read_stored(spark, path, name), *frame.columns) == rows(frame)
    after = _files(f"{path}/nodes")
    assert written["nodes"] in (1, 2) and len({f for f in before if after.get(f) == before[f]}) == len(before) - written["nodes"]
    assert stored.upsert_stored(spark, path, none) == {"nodes": 0, "edges": 0, "documents": 0, "mentions": 0}
    assert _files(f"{path}/nodes") == after
    stored.upsert_stored(spark, path, second)  # again: nothing changes
    assert rows(stored.read_stored(spark, path, "nodes"), "id", "type", "description") == rows(whole["nodes"])


def test_without_sources_and_cut_off_founding(spark, batches, rows, tmp_path):
    first, second, none = batches
    path = f"{tmp_path}/g"
    spark.createDataFrame([("left", "T", None, 0)], "id string, type string, description string, _bucket int").write.partitionBy("_bucket").parquet(f"{path}/nodes")
    assert set(stored.upsert_stored(spark, path, first, include_source=False)) == {"nodes", "edges"}
    assert rows(stored.read_stored(spark, path, "nodes"), "id") == rows(graph.upsert_nodes(None, first["nodes"]), "id")
    empty = f"{tmp_path}/e"
    stored.upsert_stored(spark, empty, none, include_source=False)
    stored.upsert_stored(spark, empty, second, include_source=False)
    assert rows(stored.read_stored(spark, empty, "nodes"), "id") == [("n1",), ("new",)]

import random

import pytest

from graphloom.operators import components, graph


@pytest.fixture
def edges(spark):
    data = [("a", "R", "b", None), ("a", "R", "b", "x"), ("b", "R", "c", ""), ("c", "R", "c", "loop"), ("d1", "MENTIONS", "a", None)]
    return spark.createDataFrame(data, "src string, type string, dst string, description string")


@pytest.fixture
def nodes(spark):
    data = [("a", "T", "first"), ("b", "T", None), ("c", "U", None), ("e", "U", None)]
    return spark.createDataFrame(data, "id string, type string, description string")


def test_degree(nodes, edges, rows):
    assert rows(graph.node_degree(nodes, edges)) == [("a", 2), ("b", 3), ("c", 2), ("e", 0)]


def test_coverage(nodes, edges, rows):
    assert rows(graph.description_coverage(nodes, edges)) == [("node", 4, 1), ("relationship", 4, 3)]


def test_upsert(spark, nodes, edges, rows):
    newer = spark.createDataFrame([("a", "X", "second"), ("b", "X", "filled"), ("f", "X", None)], nodes.schema)
    merged = graph.upsert_nodes(graph.upsert_nodes(None, nodes), newer)
    assert rows(merged) == [("a", "T", "first"), ("b", "T", "filled"), ("c", "U", None), ("e", "U", None), ("f", "X", None)]
    assert rows(graph.upsert_edges(None, edges).where("src = 'a'")) == [("a", "R", "b", "x")]


def test_upsert_sources(spark, nodes, edges, tmp_path):
    documents = spark.createDataFrame([(1, "t")], "doc_id int, text string")
    mentions = spark.createDataFrame([(1, "a"), (1, "a")], "doc_id int, entity_id string")
    new = {"nodes": nodes, "edges": edges, "documents": documents, "mentions": mentions}
    assert set(graph.upsert_graph(None, new, include_source=False)) == {"nodes", "edges"}
    graph.write_graph(graph.upsert_graph(None, new), f"{tmp_path}/g")
    again = graph.upsert_graph({n: spark.read.parquet(f"{tmp_path}/g/{n}") for n in new}, new)
    assert again["mentions"].count() == 1 and again["nodes"].count() == 4 and again["documents"].count() == 1


def test_write_property(spark, rows):
    nodes = spark.createDataFrame([("a", "old"), ("b", "old")], "id string, summary string")
    values = spark.createDataFrame([("a", "new"), ("z", "new")], "id string, summary string")
    assert rows(graph.write_property(nodes, values, "id", "summary")) == [("a", "new"), ("b", "old")]
    assert rows(graph.write_property(nodes, values, "id", "summary", insert=True)) == [("a", "new"), ("b", "old"), ("z", "new")]


def test_unique(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "id string")
    with pytest.raises(ValueError):
        graph.require_unique(df, "id")
    assert graph.require_unique(df.distinct(), "id").count() == 2


def test_histogram(spark, rows):
    constant = spark.createDataFrame([(3,), (3,)], "x int")
    assert rows(graph.histogram(constant, "x", 2), "bin", "n") == [(0, 2), (1, 0)]
    spread = spark.createDataFrame([(i,) for i in range(11)], "x int")
    assert rows(graph.histogram(spread, "x", 5), "bin", "low", "high", "n") == [
        (0, 0.0, 2.0, 2), (1, 2.0, 4.0, 2), (2, 4.0, 6.0, 2), (3, 6.0, 8.0, 2), (4, 8.0, 10.0, 3)
    ]


def test_entities_per_document_keeps_empty_ones(spark, rows):
    documents = spark.createDataFrame([(1,), (2,)], "doc_id int")
    mentions = spark.createDataFrame([(1, "a"), (1, "b")], "doc_id int, entity_id string")
    assert rows(graph.entities_per_document(documents, mentions)) == [(1, 2), (2, 0)]


def test_extraction(spark, rows):
    docs = spark.createDataFrame([(1, "Red fox met a dog. Dog slept\nRed fox red fox."), (2, "nothing")], "doc_id int, text string")
    names = spark.createDataFrame([("red fox", "A", None), ("Dog", "A", None), ("cat", "A", None)], "id string, type string, description string")
    found = graph.extract_graph(docs, names, "doc_id", "text", max_words=2)
    assert rows(found["nodes"], "id") == [("Dog",), ("red fox",)]
    assert rows(found["edges"], "src", "dst") == [("Dog", "red fox")]
    assert rows(found["mentions"]) == [(1, "Dog"), (1, "red fox")]
    mentions = graph.entity_mentions(docs, names, "doc_id", "text", 2)
    assert rows(mentions) == [(1, 0, 0, "red fox"), (1, 0, 4, "Dog"), (1, 1, 0, "Dog"), (1, 2, 0, "red fox"), (1, 2, 2, "red fox")]


def union_find(edges, nodes):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_union_find(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(300))
    pairs = [(rng.choice(nodes), rng.choice(nodes)) for _ in range(180)] + [(7, n) for n in range(100, 140)]
    chain = [(1000 + i, 1001 + i) for i in range(60)]
    edges = spark.createDataFrame(pairs + chain, "src int, dst int")
    everything = nodes + list(range(1000, 1061))
    frame = spark.createDataFrame([(n,) for n in everything], "id int")
    found = {r.id: r.component for r in components.connected_components(edges, frame).collect()}
    assert found == union_find(pairs + chain, everything)


def test_components_without_edges(spark, rows):
    edges = spark.createDataFrame([("a", "a")], "src string, dst string")
    assert rows(components.connected_components(edges)) == [("a", "a")]

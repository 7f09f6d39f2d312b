from graphloom.operators import graph
from graphloom.plans import community_queries


def test_terms_meet_as_numbers_and_leave_as_names(spark, rows, tmp_path, monkeypatch):
    texts = [(1, "The red fox. A red, red fox-den and no more"), (2, "fox"), (3, None), (4, "no more red fox\nred fox den"), (1, "more")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    names = spark.createDataFrame([(n,) for n in ("red fox", "red", "Red-Fox", "fox den", "no more red", "more", "é more", "!")], "id string")
    seen, pairs_of = [], graph.cooccurrence_edges
    monkeypatch.setattr(graph, "cooccurrence_edges", lambda mentions, key: seen.append(mentions) or pairs_of(mentions, key))
    edges, _ = community_queries._term_graph(spark, str(tmp_path), names, 3)
    assert dict(seen[0].dtypes)["id"] == "bigint"
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    found = graph.entity_mentions(documents, names, "doc_id", "text", max_words=3)
    assert rows(edges) == rows(pairs_of(found, "doc_id")) and edges.columns == ["src", "type", "dst", "weight"]


def test_runs_end_with_their_sentence(spark, rows):
    docs = spark.createDataFrame([(1, "a b c. d"), (2, ""), (3, "a")], "k long, text string")
    names = spark.createDataFrame([(n,) for n in ("a", "a b c", "b c", "c d", "d", "a b c d")], "id string")
    assert rows(graph.entity_mentions(docs, names, "k", "text", max_words=3)) == [
        (1, 0, 0, "a"), (1, 0, 0, "a b c"), (1, 0, 1, "b c"), (1, 1, 0, "d"), (3, 0, 0, "a"),
    ]

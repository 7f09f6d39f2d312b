"""Cases in which results used to be cut or faulty."""

import pytest

import __spark_entry__ as entry_points
from graphloom.operators import graph, modelio, tagging, vectors
from graphloom.sources import tables


def test_every_pair_of_a_sentence_and_names_with_punctuation(spark, rows):
    docs = spark.createDataFrame([(1, "AT&T hired Jean-Luc in New York."), (2, "alpha beta gamma alpha")], "doc long, text string")
    names = spark.createDataFrame([(n,) for n in ("AT&T", "Jean-Luc", "New York", "alpha", "beta", "gamma", "?!")], "id string")
    mentions = graph.entity_mentions(docs, names, "doc", "text", max_words=2)
    assert {r.id for r in mentions.where("doc = 1").collect()} == {"AT&T", "Jean-Luc", "New York"}
    found = rows(graph.cooccurrence_edges(mentions.where("doc = 2"), "doc"), "src", "dst", "weight")
    assert found == [("alpha", "beta", 1), ("alpha", "gamma", 1), ("beta", "gamma", 1)]


def test_written_property_never_repeats_a_node(spark, rows):
    nodes = spark.createDataFrame([("a",), ("b",)], "id string")
    values = spark.createDataFrame([("a", "y"), ("a", "x"), ("c", "z")], "id string, summary string")
    assert rows(graph.write_property(nodes, values, "id", "summary", insert=True)) == [("a", "x"), ("b", None), ("c", "z")]


def test_pooling_refuses_mixed_widths(spark):
    mixed = spark.createDataFrame([(1, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0, 3.0])], "k long, m int, e array<double>")
    with pytest.raises(ValueError):
        vectors.mean_pool(mixed, "k", "m", "e")
    first_null = spark.createDataFrame([(1, 1, None), (1, 1, [1.0, 2.0])], "k long, m int, e array<double>")
    assert vectors.mean_pool(first_null, "k", "m", "e").collect()[0].embedding == [0.5, 1.0]


def test_fine_sweeps_have_distinct_runs(spark):
    asked = spark.createDataFrame([("r", "p")], "request_id string, prompt string")
    assert modelio.parameter_sweep(asked, (0.601, 0.604), (1.0,)).select("run_id").distinct().count() == 2


def test_triples_with_parentheses_and_blank_tabs(spark, rows):
    reply = spark.createDataFrame([(1, "(Acme (UK), OWNS, Beta)\n\t\n(a, b)")], "k long, response string")
    good, bad = modelio.parse_triples(reply, "k")
    assert rows(good, "head", "relation", "tail") == [("Acme (UK)", "OWNS", "Beta")] and rows(bad, "line") == [("(a, b)",)]


def test_lexicon_size_never_changes_tags(spark, rows, monkeypatch):
    words = spark.createDataFrame([(1, ["run", "well"]), (None, ["run"])], "k long, tokens array<string>")
    lexicon = spark.createDataFrame([("run", "VB"), ("run", "NN"), (None, "XX")], "word string, tag string")
    small = rows(tagging.tag_tokens(words, "k", "tokens", lexicon))
    monkeypatch.setattr(tagging, "INLINE_LEXICON_ROWS", 0)
    assert rows(tagging.tag_tokens(words, "k", "tokens", lexicon)) == small


def test_sql_views_are_put_back(spark, rows):
    spark.range(2).createOrReplaceTempView("numbers")
    assert rows(tables.read_sql(spark, "SELECT count(*) AS n FROM numbers", {"numbers": spark.range(5)})) == [(5,)]
    assert spark.table("numbers").count() == 2
    spark.catalog.dropTempView("numbers")


def _tables(spark, tmp_path, **texts):
    for name, (rows, schema) in texts.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def test_phrases_of_three_words_on_every_page(spark, rows, tmp_path):
    docs = [(1, "en", "12 houses old"), (2, "de", "12 houses old"), (3, "de", "12 houses old")]
    sf_dir = _tables(spark, tmp_path, documents=(docs, "doc_id long, lang string, text string"))
    queries = entry_points.queries()
    judged = {(r.doc_id, r.sequence): r.final_cd for r in queries["final_cd_check_pages"](spark, sf_dir).collect()}
    assert len(judged) == 18 and [judged[i, "12 houses"] for i in (1, 2, 3)] == [True, False, False]
    for name in ("pos_filters_three_words", "noun_phrases_three_words"):
        assert "12 houses old" in {r.sequence for r in queries[name](spark, sf_dir).collect()}, name


def test_mentions_of_short_names_and_of_several_words(spark, rows, tmp_path):
    sf_dir = _tables(
        spark, tmp_path, documents=([(1, "Red oak, old tree. oak")], "doc_id long, text string"),
        benchmark=([(1, "a red oak tree")], "item_id long, text string"),
    )
    queries = entry_points.queries()
    found = rows(queries["entity_mentions_names"](spark, sf_dir), "sentence", "position", "id")
    assert found == [(0, 0, "red"), (0, 0, "red oak"), (0, 1, "oak"), (0, 3, "tree"), (1, 0, "oak")]
    assert queries["cooccurrence_edges_names"](spark, sf_dir).count() == 6

"""Terms are counted and made distinct in a document's own row; rows that share an id still meet."""

import pytest

import __spark_entry__ as entry_points
from graphloom.functions import text
from graphloom.operators import tfidf
from graphloom.plans import check
from graphloom.session import shuffle_width
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [
    (1, "12 houses old. 12 houses old the red red red house 7", "de"), (1, "12 houses old", "en"), (1, "12 houses old", "en"),
    (2, "12 houses old a house a house", "de"), (3, "", "de"), (4, None, "en"), (None, "old houses 3 red", "en"), (None, "old houses", "en"),
    (5, "red", "en"),
]


@pytest.fixture(scope="module")
def repeated_ids(spark, tmp_path_factory):
    sf_dir = tmp_path_factory.mktemp("sf")
    rows = [(i, t, lang, "s", len(t or "")) for i, t, lang in TEXTS]
    spark.createDataFrame(rows, DOCUMENTS).coalesce(1).write.parquet(f"{sf_dir}/documents.parquet")
    return str(sf_dir)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _sql(sf_dir, name):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet/*.parquet')")
    return check.fingerprint(*check.sql_result(connection, entry_points.oracle_sql()[name]))


def test_counts_of_a_list(spark, rows):
    lists = spark.createDataFrame([(1, ["b", "a", "b"]), (2, []), (3, None), (4, ["c"])], "k long, l array<string>")
    assert rows(text.counted(lists, ["k"], F.col("l"), "x", "n")) == [(1, "a", 1), (1, "b", 2), (4, "c", 1)]


SCORED = ["tfidf_scores", "tfidf_renormalised", "noun_tfidf", "phrase_feature_names", "phrase_retain_terms", "phrase_scores_tagged"]


@pytest.mark.parametrize("name", ["final_cd_check_pages", "ngrams", "noun_ngrams", "noun_ngrams_ungated", *SCORED])
def test_phrases_of_rows_that_share_an_id(spark, repeated_ids, name):
    assert check.fingerprint(*check.spark_result(entry_points.queries()[name](spark, repeated_ids))) == _sql(repeated_ids, name)


@pytest.mark.parametrize("name", ["final_cd_check_pages", "ngrams", "noun_ngrams", "noun_ngrams_ungated"])
def test_phrases_stay_in_their_row(spark, name):
    plan = _plan(entry_points.queries()[name](spark, "/root/testdata/sf0.001"))
    assert "Aggregate" not in plan and "sequence" not in "".join(x for x in plan.splitlines() if "Exchange" in x)


def test_scored_counts_are_made_in_their_row(spark):
    plan = _plan(entry_points.queries()["tfidf_scores"](spark, "/root/testdata/sf0.001"))
    assert not [x for x in plan.splitlines() if "HashAggregate" in x and "doc_id" in x]


def test_runs_that_can_be_terms(spark):
    from graphloom.operators import tagging

    docs = spark.createDataFrame([(1, "the red house of 3 quickly old houses was 12 run runs tree tree")], "d long, text string")
    everything = {r.term for r in tagging.phrase_counts(docs, "d", "text").collect()}
    kept = {r.term for r in tagging.noun_run_counts(docs, "d", "text").collect()}
    terms = {r.term for r in tagging.document_terms(docs, "d", "text", number_factor=None).collect()}
    assert everything & terms <= kept < everything


def test_postings_are_sorted_in_more_shares_than_the_session_has(spark):
    counts = spark.createDataFrame([(d, f"t{t}", 1) for d in range(40) for t in range(20)], "doc_id long, term string, tf long")
    scores = tfidf.score(counts, tfidf.fit_idf(counts, counts.select("doc_id").distinct(), 1.0), "doc_id")
    assert scores.rdd.getNumPartitions() == tfidf.SHARES * shuffle_width(spark) > shuffle_width(spark)
    assert scores.count() == 800

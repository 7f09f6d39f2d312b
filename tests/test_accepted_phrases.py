"""Runs are judged by the list of their tags, which is tested once, not once a run."""

import __spark_entry__ as entry_points
from graphloom.functions import pos, text
from graphloom.operators import tagging
from pyspark.sql import functions as F

TEXTS = [
    "The red houses of 3 nations were quickly seen and 12 houses old houses stood", "house", "two houses", "7 8 houses", "", None,
    "not houses", "seen house seen", "is old house", "old houses old houses", "Über Straße_1 café nations",
]


def test_accepted_phrases_are_those_of_the_test(spark, rows):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "k long, text string")
    tokens = docs.select("k", text.words(F.col("text")).alias("tokens"))
    every = text.unroll(tokens, ["k"], F.array_distinct(text.all_ngrams(F.col("tokens"), 3)), "sequence")
    for accept in (pos.is_noun_phrase, pos.ends_with_noun, lambda tags: F.size(tags) == 3, pos.starts_with_verb):
        wanted = every.where(accept(tagging.tags_of(F.split("sequence", " "))))
        assert rows(tagging.accepted_phrases(docs, ["k"], "text", accept)) == rows(wanted)
    assert tagging.accepted_phrases(docs, ["k"], "text", pos.is_noun_phrase).count() > 15


def test_runs_that_are_not_accepted_are_not_made(spark):
    plan = entry_points.queries()["noun_phrases_three_words"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange hashpartitioning(sequence"):]
    assert "split(sequence" not in below and "_codes" in below

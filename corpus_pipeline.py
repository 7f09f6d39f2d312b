"""From raw documents to packed sequences, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.llm import neardup, packing, pii, quality, substrings
from graphloom.llm.common import unused
from graphloom.session import materialize


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from ``labels``, does not reject.

    Statistics are computed once and written beside the rows; only they, not the texts, meet the labels. Null and empty
    texts are judged like others, also rows without an id; without any label all rows stay. An empty table stays so.
    """
    own, label, column = unused(docs.columns, "_id", "_quality", "_statistics")
    rows = materialize(quality.with_statistics(docs, column))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select(F.col("doc_id").alias(own), F.col("quality").alias(label))
    known = rows.select(F.col("doc_id").alias(own), F.col(f"`{column}`").alias("statistics")).join(labels, own)
    model = quality.fit(known.select("statistics", F.col(label).alias("quality")))
    return rows.where(quality.accepted(model, column)).drop(column)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of the smallest id of each group of near-duplicates, and the rows without an id.

    Of rows that repeat an id, the one with the greatest text stays, which is the one that is compared; where equal texts
    repeat, any of them. Null and empty texts are duplicates of nothing.
    """
    judged = neardup.near_duplicates(docs, hundredths=80)
    dropped = materialize(judged.where("NOT kept").select(F.col("doc_id").alias("id")))
    if docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        names = docs.columns
        (row,) = unused(names, "_row")
        own = F.struct(F.col("text").isNotNull(), F.col("text"))
        one = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max_by(F.struct(*[f"`{c}`" for c in names]), own).alias(row))
        docs = one.select(f"`{row}`.*").unionByName(docs.where("doc_id IS NULL"))
    return neardup.picked(docs, dropped, "doc_id", "left_anti")


def strip_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the words of windows of 50 words that a document with a smaller id holds too; no row leaves."""
    return _with_length(substrings.strip_repeats(docs, width=50))


def hide_persons(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with pseudonyms for personal values, under the session's key or else one of this run; no row leaves."""
    return _with_length(pii.pseudonymise(docs, key=spark.conf.get("spark.graphloom.pseudonymKey", None)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, "word_bpe_49k.json", 2048)


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", keep_good), ("near duplicates", keep_one_of_each), ("substring dedup", strip_repeats),
    ("pii", hide_persons), ("packing", pack),
]
#: Tokens and a learned classifier can't be stated in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)

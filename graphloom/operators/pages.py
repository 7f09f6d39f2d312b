"""Page table: latest version per key and first row per cleaned key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import clean_page, has_text
from graphloom.session import materialize


def first_per_key(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key in a stated order.

    Spark keeps each partition's best row per key before the shuffle, so a key that holds a large share of the rows
    sends one row per partition.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    return ranked.where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, key: str, date: str, tie: str, text: str | None = None) -> DataFrame:
    """Newest row per key, the smallest ``tie`` among equal dates; rows without text are dropped first."""
    if text is not None:
        df = df.where(has_text(F.col(text)))
    return first_per_key(df, [key], [F.col(date).desc(), F.col(tie)])


def dedup_clean_pages(df: DataFrame, url: str, order: str) -> DataFrame:
    """Replace URLs by their cleaned form, then keep the first row of each."""
    return first_per_key(df.withColumn(url, clean_page(F.col(url))), [url], [F.col(order)])


def apart(documents: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows whose key no other row has, and the others, or None if there are none.

    What is made of the former needs no shuffle to meet by key; null is a key like others.
    """
    repeated = documents.groupBy(F.col(key).alias("_repeated")).count().where("count > 1").select("_repeated")
    repeated = materialize(repeated)
    if not repeated.limit(1).count():
        return documents, None
    same = F.col(key).eqNullSafe(F.col("_repeated"))
    return documents.join(repeated, same, "left_anti"), documents.join(repeated, same, "left_semi")

"""Scans: warehouse tables, CSV articles and stacked tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ARTICLE_SCHEMA = T.StructType(
    [T.StructField("title", T.StringType()), T.StructField("text", T.StringType())]
)


def read_table(
    spark: SparkSession,
    location: str,
    limit: float = float("inf"),
    source_format: str = "parquet",
    options: dict[str, str] | None = None,
    order_by: list[str] | None = None,
) -> DataFrame:
    """Whole table, or its first ``limit`` rows when the limit is finite.

    The format is the caller's: a warehouse connector is named here, not bundled. With ``order_by`` the capped rows
    are the same on every run.
    """
    df = spark.read.format(source_format).options(**(options or {})).load(location)
    if limit == float("inf"):
        return df
    if order_by:
        df = df.orderBy(*order_by)
    return df.limit(int(limit))


def read_sql(spark: SparkSession, query: str, views: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text over named frames. The names hold for this query only; views of the session are put back."""
    before: dict[str, DataFrame] = {}
    temporary = {table.name for table in spark.catalog.listTables() if table.isTemporary} if views else set()
    try:
        for name, frame in (views or {}).items():
            if name.lower() in temporary:
                before[name] = spark.table(name)
            frame.createOrReplaceTempView(name)
        return spark.sql(query)  # resolved here, so later changes of the names don't reach it
    finally:
        for name in views or {}:
            spark.catalog.dropTempView(name)
        for name, frame in before.items():
            frame.createOrReplaceTempView(name)


def read_articles_csv(spark: SparkSession, path: str, schema: T.StructType = ARTICLE_SCHEMA) -> DataFrame:
    """CSV with a header and quoted text that may span lines."""
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("multiLine", True)
        .option("escape", '"')
        .csv(path)
    )


def union_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """Stack tables by column name, missing columns null, with the table of origin in ``source_table``."""
    tagged = [frame.withColumn("source_table", F.lit(name)) for name, frame in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def literal_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A small frame given in code."""
    return spark.createDataFrame(rows, schema)

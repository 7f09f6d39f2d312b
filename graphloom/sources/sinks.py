"""Sinks: relational tables, capped exports and artifacts that are built once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, properties: dict[str, str] | None = None, batch_rows: int = 10_000) -> dict:
    """Arguments for :func:`write_jdbc`; credentials come from the caller, never from code."""
    if not url.startswith("jdbc:"):
        raise ValueError(f"not a JDBC url: {url}")
    return {"url": url, "table": table, "properties": {"batchsize": str(batch_rows), **(properties or {})}}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    max_connections: int = 32,
) -> None:
    """Replace ``table``. Each partition opens a connection, so the partition count is bounded for the database's
    sake; errors reach the caller."""
    options = jdbc_options(url, table, properties)
    # a shuffle, so that what comes before keeps its own width
    df.repartition(max_connections).write.mode("overwrite").jdbc(**options)


def write_replace(df: DataFrame, path: str) -> None:
    """The same replace semantics on files."""
    df.write.mode("overwrite").parquet(path)


def head_rows(df: DataFrame, order_by: list[str], n: int = 10_000) -> DataFrame:
    """First ``n`` rows in a stated order: a top-k per partition, then a merge of those."""
    return df.orderBy(*order_by).limit(n)


def export_head(df: DataFrame, path: str, order_by: list[str], n: int = 10_000) -> None:
    """Write the first ``n`` rows as one CSV file with a header."""
    head_rows(df, order_by, n).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def artifact_exists(spark: SparkSession, path: str) -> bool:
    """True when a finished write left its success marker at ``path``."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")
    return marker.getFileSystem(spark._jsc.hadoopConfiguration()).exists(marker)


def get_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Load the artifact at ``path``, or build it once and load what was written."""
    if not artifact_exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)

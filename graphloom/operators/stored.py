"""Graph tables kept in buckets of their keys, so that an upsert reads and writes only the buckets it touches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import graph
from graphloom.session import materialize
from graphloom.sources.sinks import artifact_exists

BUCKET = "_bucket"
#: Key columns and merging function of each table.
TABLES = {
    "nodes": (["id"], graph.upsert_nodes),
    "edges": (["src", "type", "dst"], graph.upsert_edges),
    "documents": (["doc_id"], graph.upsert_documents),
    "mentions": (["doc_id", "entity_id"], graph.upsert_mentions),
}


def _bucketed(frame: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return frame.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def _buckets_of(spark: SparkSession, path: str) -> int:
    """The number of buckets a table was founded with."""
    return spark.read.parquet(f"{path}_layout").first()["buckets"]


def read_stored(spark: SparkSession, path: str, name: str) -> DataFrame:
    """One stored table without its bucket numbers."""
    return spark.read.parquet(f"{path}/{name}").drop(BUCKET)


def upsert_stored(spark: SparkSession, path: str, new: dict[str, DataFrame], buckets: int = 64, include_source: bool = True) -> dict[str, int]:
    """Merge extracted tables into those under ``path`` as :func:`graph.upsert_graph` does; buckets written, by table.

    ``buckets`` holds for tables founded by this call; tables that exist keep their own number. One bucket is one task's
    work, so the number is to be chosen by the size the table will have. Only the numbers of touched buckets come to the
    driver. Merged buckets are written to the shared folder first, since they replace files they were read from. Each table
    is replaced in one commit; a run that ends between tables is made good by the same call again, which changes nothing
    where it was done before. Tables not in ``new`` and empty ones touch nothing. Null keys are one key like any other.
    """
    wanted = [name for name in TABLES if name in new and (include_source or name in ("nodes", "edges"))]
    return {name: _upsert_table(spark, f"{path}/{name}", new[name], *TABLES[name], buckets) for name in wanted}


def _upsert_table(spark: SparkSession, path: str, new: DataFrame, keys: list[str], merge, buckets: int) -> int:
    founded = artifact_exists(spark, f"{path}_layout")
    if founded:
        buckets = _buckets_of(spark, path)
    # written once: it tells the buckets, and is merged into them
    newer = materialize(_bucketed(merge(None, new), keys, buckets))
    touched = [row[BUCKET] for row in newer.select(BUCKET).distinct().collect()]  # at most one number a bucket
    if founded and not touched:
        return 0
    merged = newer
    if founded:
        old = spark.read.schema(newer.schema).parquet(path).where(F.col(BUCKET).isin(touched)).drop(BUCKET)
        merged = materialize(_bucketed(merge(old, newer.drop(BUCKET)), keys, buckets))
    writer = merged.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET)
    writer.option("partitionOverwriteMode", "dynamic" if founded else "static").parquet(path)
    if not founded:  # last, so that a founding that was cut off begins anew
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.mode("overwrite").parquet(f"{path}_layout")
    return len(touched)

"""Gapless numbers for the rows of a table of any size, without a window over a whole group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import materialize


def numbered(df: DataFrame, group: list[str], order: list[Column], name: str) -> DataFrame:
    """``df`` and the place of each row, from 0 and gapless, within its group and in the given order.

    Rows are dealt out by ranges of group and order, sorted inside a range and written. A row's place is then its place
    in its file plus the rows of its group in the files before, so no task holds a group. Rows that tie in everything
    are told apart by a running number only to spread them over ranges. ``df`` is best a written table: it is read
    twice, once for the ranges. Nulls of a group column are one group; an empty table stays empty.

    The table of counts has at most one row per file plus one per group. Files are as many as shuffle partitions, so it
    is small enough to be sent to every task.
    """
    group_cols = [F.col(c) for c in group]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id())
    keys = [*group_cols, *order, F.col("_tie")]
    written = materialize(ranged.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("_tie"))
    part = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("long")
    placed = written.select("*", part.alias("_part"), F.col("_metadata.row_index").alias("_row"))
    spans = placed.groupBy("_part", *[c.alias(f"_g{i}") for i, c in enumerate(group_cols)]).agg(
        F.min("_row").alias("_lo"), F.count(F.lit(1)).alias("_n")
    )
    before = Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select(
        F.col("_part").alias("_file"), *[f"_g{i}" for i in range(len(group))],
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_lo")).alias("_shift"),
    )
    same = F.col("_part") == F.col("_file")
    for i, column in enumerate(group_cols):
        same = same & column.eqNullSafe(F.col(f"_g{i}"))
    return placed.join(F.broadcast(spans), same).select(*df.columns, (F.col("_row") + F.col("_shift")).alias(name))

"""Exact percentiles of columns with many distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.session import materialize, shuffle_width


def percentiles(rows: DataFrame, group: list[str], value: str, points: tuple[float, ...]) -> DataFrame:
    """``(*group, n, p25, ..., max)``: exact percentiles with linear interpolation, no group's values in one task.

    Values are counted, dealt to ranges of group and value, and the ranges' totals tell which of them hold a wanted rank;
    only in those the values are numbered. A range holds few values whatever the group's size, and a value that many rows
    share is one row. Null and NaN values are left out, as are groups without others; null groups are a group. ``points`` lie
    between 0 and 1. An empty table gives none.
    """
    own = [f"_g{i}" for i in range(len(group))]
    kept = rows.select(*[F.col(f"`{g}`").alias(o) for g, o in zip(group, own)], F.col(f"`{value}`").cast("double").alias("_v"))
    counted = kept.where("_v IS NOT NULL AND NOT isnan(_v)").groupBy(*own, "_v").agg(F.count(F.lit(1)).alias("_n"))
    ranged = counted.repartitionByRange(shuffle_width(rows.sparkSession), *own, "_v").withColumn("_range", F.spark_partition_id())
    ranged = materialize(ranged)  # the ranges' borders are drawn from a sample, so they are fixed by writing
    totals = ranged.groupBy(*own, "_range").agg(F.sum("_n").alias("_held"), F.max("_v").alias("_top"))
    whole = Window.partitionBy(*own)
    earlier = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        *own, "_range", "_held", F.coalesce(F.sum("_held").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_held").over(whole).alias("_all"), F.max("_top").over(whole).alias("_max"),
    )
    ranks = F.explode(F.array(*[F.struct(F.lit(i).alias("_point"), F.lit(float(p)).alias("_q")) for i, p in enumerate(points)])).alias("_p")
    place = F.col("_p._q") * (F.col("_all") - 1)
    wanted = totals.select("*", ranks).select("*", place.alias("_place"), F.explode(F.array(F.floor(place), F.ceil(place))).alias("_rank"))
    wanted = wanted.where("_rank >= _before AND _rank < _before + _held").select(
        *own, "_range", "_all", "_max", "_before", "_place", "_rank", F.col("_p._point").alias("_point")
    ).distinct()
    listed = materialize(wanted.groupBy(*own, "_range", "_before", "_all", "_max").agg(F.collect_list(F.struct("_point", "_place", "_rank")).alias("_picks")))
    upto = Window.partitionBy(*own, "_range").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    a, b = ranged.alias("a"), listed.alias("b")
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*own, "_range"]]
    met = a.join(b, same).select("a.*", "b._before", "b._all", "b._max", "b._picks")
    met = met.withColumn("_end", F.col("_before") + F.sum("_n").over(upto))
    here = F.filter("_picks", lambda p: (p["_rank"] < F.col("_end")) & (p["_rank"] >= F.col("_end") - F.col("_n")))
    found = met.select(*own, "_all", "_max", "_v", F.explode(here).alias("_pick")).select(*own, "_all", "_max", "_v", "_pick.*")
    pairs = found.groupBy(*own, "_all", "_max", "_point", "_place").agg(F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    pairs = pairs.withColumn("_value", F.col("_low") + (F.col("_high") - F.col("_low")) * (F.col("_place") - F.floor("_place")))
    out = pairs.groupBy(*own, "_all", "_max").agg(
        *[F.max(F.when(F.col("_point") == i, F.col("_value"))).alias(f"_p{i}") for i in range(len(points))]
    )
    return out.select(
        *[F.col(o).alias(g) for g, o in zip(group, own)], F.col("_all").alias("n"),
        *[F.col(f"_p{i}").alias(f"p{p * 100:g}".replace(".", "_")) for i, p in enumerate(points)], F.col("_max").alias("max"),
    )

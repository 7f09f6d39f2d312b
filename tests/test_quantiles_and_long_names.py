"""Exact percentiles over ranges, and names of any number of words."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from graphloom.operators import graph, quantiles

POINTS = (0.0, 0.25, 0.5, 0.9, 0.999, 1.0)


@pytest.mark.parametrize("partitions", [1, 4, 7])
def test_percentiles_equal_numpy(spark, partitions):
    rng = random.Random(3)
    rows = [("a", rng.gauss(0, 1)) for _ in range(2000)] + [("a", 0.25)] * 1500
    rows += [("b", float(i // 7)) for i in range(300)] + [("c", 5.0), ("d", None), ("d", math.nan), (None, 1.0), (None, 2.0)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        frame = spark.createDataFrame(rows, "_v string, x double").withColumn("_n", F.lit(1))
        found = {r["_v"]: tuple(r)[1:] for r in quantiles.percentiles(frame, ["_v"], "x", POINTS).collect()}
        empty = quantiles.percentiles(frame.where("false"), ["_v"], "x", POINTS)
        assert empty.count() == 0 and empty.columns == ["_v", "n", "p0", "p25", "p50", "p90", "p99_9", "p100", "max"]
        (whole,) = quantiles.percentiles(frame, [], "x", (0.5,)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert set(found) == {"a", "b", "c", None}
    for name, got in found.items():
        own = [x for n, x in rows if n == name and x is not None and not math.isnan(x)]
        assert got[0] == len(own) and got[-1] == max(own)
        assert np.allclose(got[1:-1], np.quantile(own, POINTS), rtol=0, atol=1e-12)
    own = [x for _, x in rows if x is not None and not math.isnan(x)]
    assert whole.n == len(own) and abs(whole.p50 - np.quantile(own, 0.5)) < 1e-12


def test_long_names_equal_all_runs(spark, rows):
    rng = random.Random(5)
    texts = [" ".join(rng.choice("aa bb cc dd".split()) for _ in range(rng.randrange(40))) + rng.choice([".", "! x", ""]) for _ in range(60)]
    docs = [(i % 50, text) for i, text in enumerate(texts)] + [(0, texts[0]), (99, None), (98, ""), (97, "..")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("_row", F.lit(1))
    names = {" ".join(rng.choice("aa bb cc dd".split()) for _ in range(rng.randrange(1, 9))) for _ in range(300)}
    gazetteer = spark.createDataFrame([(n,) for n in sorted(names)] + [("Aa-Bb, cc dd!",), ("...",)], "id string")
    wanted = graph.entity_mentions(frame, gazetteer, "doc_id", "text", max_words=8)
    assert rows(graph.entity_mentions_long(frame, gazetteer, "doc_id", "text")) == rows(wanted)
    assert graph.entity_mentions_long(frame.where("false"), gazetteer, "doc_id", "text").count() == 0
    assert graph.entity_mentions_long(frame, gazetteer.where("false"), "doc_id", "text").count() == 0

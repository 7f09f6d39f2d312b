"""Components updated by new links against a run from scratch."""

import random

import pytest
from pyspark.sql import functions as F

from graphloom.operators import components


@pytest.mark.parametrize("seed", [1, 2])
def test_updates_equal_a_run_from_scratch(spark, rows, seed):
    rng = random.Random(seed)
    old = [(rng.randrange(0, 200, 2), rng.randrange(0, 200, 2)) for _ in range(70)]
    new = [(rng.randrange(200), rng.randrange(230)) for _ in range(40)] + [(500, 500), (501, None), (None, 3), (0, 0), old[0], old[0]]
    make = lambda pairs: spark.createDataFrame(pairs, "src long, dst long").withColumn("component", F.lit("x"))
    stored = components.connected_components(make(old))
    whole = components.connected_components(make([p for p in old + new if None not in p]))
    changes = components.component_changes(stored, make(new)).collect()
    assert rows(components.updated_components(stored, make(new))) == rows(whole)
    before = {r.id: r.component for r in stored.collect()}
    after = {r.id: r.component for r in whole.collect()}
    assert sorted(map(tuple, changes)) == sorted((i, c) for i, c in after.items() if before.get(i) != c)


def test_nothing_new_and_nothing_stored(spark, rows):
    links = spark.createDataFrame([("a", "b"), ("c", "b")], "src string, dst string")
    stored = components.connected_components(links)
    assert components.component_changes(stored, links).count() == 0
    assert components.component_changes(stored, links.where("false")).count() == 0
    assert rows(components.updated_components(stored.where("false"), links)) == rows(stored)

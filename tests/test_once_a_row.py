"""What belongs to a whole row is made once a row, not once for every item of its lists."""

from graphloom.operators import vectors


def test_a_norm_is_made_once_a_vector(spark):
    wide = spark.range(8).selectExpr("id", "transform(sequence(1, 6000), i -> cast(i + id as double)) AS embedding")
    units = vectors.unit_vectors(wide, "id", "embedding")
    assert "/ SQRT(" not in units._jdf.queryExecution().optimizedPlan().toString()


def test_an_entitys_buckets_are_gathered_once(spark):
    names = spark.createDataFrame([("a b", None), ("c", None)], "id string, description string")
    plan = vectors.entity_text_vectors(names, 16)._jdf.queryExecution().optimizedPlan().toString()
    assert "element_at(map_from_entries" not in plan


def test_vectors_without_a_length_leave(spark, rows):
    found = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, None), (4, [1.0, None]), (5, [])], "id long, embedding array<double>")
    assert rows(vectors.unit_vectors(found, "id", "embedding")) == [(1, [0.6, 0.8])]

import pytest

from graphloom.sources import sinks, tables

USERS = [("ann", "ann@example.org"), ("bob", "bob@example.org")]


def test_read_table_limit(spark, tmp_path, rows):
    tables.literal_frame(spark, USERS, "username string, email string").write.parquet(f"{tmp_path}/t")
    assert tables.read_table(spark, f"{tmp_path}/t").count() == 2
    assert rows(tables.read_table(spark, f"{tmp_path}/t", 1, order_by=["username"])) == [USERS[0]]


def test_union_aligns_by_name(spark, rows):
    a = spark.createDataFrame([("x", 1)], "page string, n int")
    b = spark.createDataFrame([(2, "y")], "extra int, page string")
    found = tables.union_tables({"a": a, "b": b})
    assert rows(found, "page", "n", "extra", "source_table") == [("x", 1, None, "a"), ("y", None, 2, "b")]


def test_csv_with_quotes_and_lines(spark, tmp_path, rows):
    (tmp_path / "in.csv").write_text('title,text\n"A ""b""","one\ntwo, three"\nC,\n')
    assert rows(tables.read_articles_csv(spark, f"{tmp_path}/in.csv")) == [('A "b"', "one\ntwo, three"), ("C", None)]


def test_jdbc_options():
    options = sinks.jdbc_options("jdbc:postgresql://host/db", "users", {"user": "u"})
    assert options == {
        "url": "jdbc:postgresql://host/db", "table": "users", "properties": {"batchsize": "10000", "user": "u"}
    }
    with pytest.raises(ValueError):
        sinks.jdbc_options("postgresql://host", "users")


def test_jdbc_errors_reach_the_caller(spark):
    df = spark.createDataFrame(USERS, "username string, email string")
    with pytest.raises(Exception):
        sinks.write_jdbc(df, "jdbc:nothing:here", "users")


def test_replace(spark, tmp_path):
    df = spark.createDataFrame(USERS, "username string, email string")
    sinks.write_replace(df, f"{tmp_path}/u")
    sinks.write_replace(df.limit(1), f"{tmp_path}/u")
    assert spark.read.parquet(f"{tmp_path}/u").count() == 1


def test_artifact_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(3)

    for _ in range(2):
        assert sinks.get_or_build(spark, f"{tmp_path}/a", build).count() == 3
    assert len(calls) == 1


def test_read_sql(spark, rows):
    frame = spark.createDataFrame([(1,), (2,)], "n int")
    assert rows(tables.read_sql(spark, "SELECT sum(n) AS s FROM numbers", {"numbers": frame})) == [(3,)]

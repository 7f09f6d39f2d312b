"""Frames that the registered queries share, each derived from whole driver tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions.text import SENTENCE_END, all_ngrams, ngrams, strip_markup, unroll, words


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key(prefix: str, column: str):
    return F.concat(F.lit(f"{prefix}-"), F.col(column).cast("string"))


# --- pages ------------------------------------------------------------------------------------------------------


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page"), strip_markup(F.col("html")).alias("page_text"))


# --- supply graph: parts and suppliers, one edge per order line ----------------------------------------------------


def supply_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part").select(
        key("P", "p_partkey").alias("id"), F.lit("Part").alias("type"),
        F.when(F.col("p_size") > 25, F.col("p_name")).alias("description"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        key("S", "s_suppkey").alias("id"), F.lit("Supplier").alias("type"), F.col("s_name").alias("description")
    )
    return parts.union(suppliers)


SUPPLY_NODES = """
SELECT 'P-' || p_partkey AS id, 'Part' AS type, CASE WHEN p_size > 25 THEN p_name END AS description FROM part
UNION ALL SELECT 'S-' || s_suppkey, 'Supplier', s_name FROM supplier
"""


def supply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        key("P", "l_partkey").alias("src"), F.lit("SUPPLIED_BY").alias("type"), key("S", "l_suppkey").alias("dst"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("description"),
    )


SUPPLY_EDGES = """
SELECT 'P-' || l_partkey AS src, 'SUPPLIED_BY' AS type, 'S-' || l_suppkey AS dst,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS description
FROM lineitem
"""


def supply_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), F.concat_ws(" ", "o_orderstatus", "o_orderpriority").alias("text")
    )


def supply_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), key("P", "l_partkey").alias("entity_id")
    )


# --- trade graph: customers and suppliers, nations and regions as its two community levels ---------------------------


def trade_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        key("C", "c_custkey").alias("id"), F.col("c_mktsegment").alias("type"),
        F.when(F.col("c_acctbal") < 0, F.lit("")).when(F.col("c_acctbal") > 1000, F.col("c_name")).alias("description"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        key("S", "s_suppkey").alias("id"), F.lit("Supplier").alias("type"), F.col("s_name").alias("description")
    )
    return customers.union(suppliers)


TRADE_NODES = """
SELECT 'C-' || c_custkey AS id, c_mktsegment AS type,
       CASE WHEN c_acctbal < 0 THEN '' WHEN c_acctbal > 1000 THEN c_name END AS description
FROM customer
UNION ALL SELECT 'S-' || s_suppkey, 'Supplier', s_name FROM supplier
"""


def trade_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        key("C", "o_custkey").alias("src"), F.lit("BUYS_FROM").alias("type"), key("S", "l_suppkey").alias("dst"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("description"),
    )


TRADE_EDGES = """
SELECT 'C-' || o_custkey AS src, 'BUYS_FROM' AS type, 'S-' || l_suppkey AS dst,
       CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS description
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


def trade_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("doc_id"), key("C", "o_custkey").alias("entity_id")
    )


TRADE_MENTIONS = "SELECT o_orderkey AS doc_id, 'C-' || o_custkey AS entity_id FROM orders"


def trade_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    homes = table(spark, sf_dir, "customer").select(key("C", "c_custkey").alias("entity"), F.col("c_nationkey").alias("nation"))
    homes = homes.union(
        table(spark, sf_dir, "supplier").select(key("S", "s_suppkey").alias("entity"), F.col("s_nationkey").alias("nation"))
    )
    placed = homes.join(nation, F.col("nation") == F.col("n_nationkey"))
    return placed.select(
        "entity", F.posexplode(F.array(F.col("n_nationkey").cast("long"), F.col("n_regionkey").cast("long"))).alias("level", "community")
    )


TRADE_MEMBERSHIP = """
SELECT entity, level, CASE WHEN level = 0 THEN n_nationkey ELSE n_regionkey END AS community
FROM (SELECT 'C-' || c_custkey AS entity, c_nationkey AS nation FROM customer
      UNION ALL SELECT 'S-' || s_suppkey, s_nationkey FROM supplier) h
JOIN nation ON nation = n_nationkey, (SELECT 0 AS level UNION ALL SELECT 1) l
"""


# --- names with variants: duplicates to find and to merge ----------------------------------------------------------


def named_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as written and hyphenated, customer and supplier names; ``block`` stands for the component."""
    parts = table(spark, sf_dir, "part").select("p_name").distinct()
    named = parts.select(
        F.explode(F.array("p_name", F.replace("p_name", F.lit(" "), F.lit("-")))).alias("id"),
        F.lit("Part").alias("type"), F.lit("P").alias("block"),
    ).distinct()
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("id"), F.lit("Customer").alias("type"), key("C", "c_nationkey").alias("block")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("id"), F.lit("Supplier").alias("type"), key("S", "s_nationkey").alias("block")
    )
    return named.union(customers).union(suppliers)


NAMED_ENTITIES = """
SELECT DISTINCT unnest([p_name, replace(p_name, ' ', '-')]) AS id, 'Part' AS type, 'P' AS block FROM part
UNION ALL SELECT c_name, 'Customer', 'C-' || c_nationkey FROM customer
UNION ALL SELECT s_name, 'Supplier', 'S-' || s_nationkey FROM supplier
"""


def _variant():
    return F.when(F.col("l_linestatus") == "O", F.col("p_name")).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))


def named_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_linestatus")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(_variant().alias("src"), F.lit("SUPPLIED_BY").alias("type"), F.col("s_name").alias("dst"))
    )


NAMED_EDGES = """
SELECT CASE WHEN l_linestatus = 'O' THEN p_name ELSE replace(p_name, ' ', '-') END AS src, 'SUPPLIED_BY' AS type,
       s_name AS dst
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
"""


def named_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("doc_id"), _variant().alias("entity_id")
    )


NAMED_MENTIONS = """
SELECT l_orderkey AS doc_id,
       CASE WHEN l_linestatus = 'O' THEN p_name ELSE replace(p_name, ' ', '-') END AS entity_id
FROM lineitem JOIN part ON l_partkey = p_partkey
"""


# --- conversation threads: turns tied to the turn before and to their text ------------------------------------------


def thread_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    turn = F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    before = F.concat_ws("-", F.lit("c"), F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    ends = F.when(F.col("turn") > 0, F.array(before, F.md5("text"))).otherwise(F.array(F.md5("text")))
    return table(spark, sf_dir, "conversations").select(turn.alias("src"), F.explode(ends).alias("dst"))


THREAD_EDGES = """
SELECT 'c-' || conv_id || '-' || turn AS src, md5(text) AS dst FROM conversations
UNION ALL SELECT 'c-' || conv_id || '-' || turn, 'c-' || conv_id || '-' || (turn - 1) FROM conversations WHERE turn > 0
"""


# --- gazetteer: longer words of the benchmark passages --------------------------------------------------------------


def gazetteer(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = table(spark, sf_dir, "benchmark").select(F.explode(words(F.col("text"))).alias("id"))
    return found.where(F.length("id") >= 6).distinct().select(
        "id", F.lit("Term").alias("type"), F.lit(None).cast("string").alias("description")
    )


GAZETTEER = r"""
SELECT DISTINCT id FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')) AS id FROM benchmark)
WHERE length(id) >= 6
"""


# --- names: all runs of one to three words of the benchmark passages ------------------------------------------------


def passage_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of any length; the gazetteer above has single words of six letters or more only."""
    tokens = table(spark, sf_dir, "benchmark").select(words(F.col("text")).alias("tokens"))
    return unroll(tokens, [], all_ngrams(F.col("tokens"), 3), "id").distinct().select(
        "id", F.lit("Term").alias("type"), F.lit(None).cast("string").alias("description")
    )


PASSAGE_NAMES = r"""
SELECT DISTINCT unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
       list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS id
FROM (SELECT regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS w FROM benchmark)
"""


def long_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole sentences of passages, however long, and their runs of one and of five words."""
    parts = unroll(table(spark, sf_dir, "benchmark"), [], F.split("text", SENTENCE_END), "part")
    tokens = parts.select(words(F.col("part")).alias("tokens")).where(F.size("tokens") > 0)
    names = F.concat(F.array(F.array_join("tokens", " ")), F.col("tokens"), ngrams(F.col("tokens"), 5))
    return unroll(tokens, [], names, "id").distinct()


LONG_NAMES = r"""
SELECT DISTINCT unnest(list_concat([array_to_string(w, ' ')], w,
       list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) AS id
FROM (SELECT regexp_extract_all(lower(part), '[\p{L}\p{N}_]+') AS w
      FROM (SELECT unnest(regexp_split_to_array(text, '[.!?\n]+')) AS part FROM benchmark)) WHERE len(w) > 0
"""


# --- documents and benchmark passages as one page set ----------------------------------------------------------------


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select(key("d", "doc_id").alias("page"), "text")
    return documents.union(table(spark, sf_dir, "benchmark").select(key("b", "item_id").alias("page"), "text"))


CORPUS = "SELECT 'd-' || doc_id AS page, text FROM documents UNION ALL SELECT 'b-' || item_id, text FROM benchmark"

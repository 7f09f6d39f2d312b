"""Queries over the entity graph: extraction, stored tables, statistics, components, neighbours, resolution."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from graphloom.functions import text
from graphloom.operators import components, descent, graph, modelio, quantiles, resolve, stored, vectors
from graphloom.plans import frames
from graphloom.plans.frames import (
    GAZETTEER, NAMED_EDGES, NAMED_ENTITIES, NAMED_MENTIONS, LONG_NAMES, PASSAGE_NAMES, SUPPLY_EDGES, SUPPLY_NODES, THREAD_EDGES, table,
)
from graphloom.session import materialize, spread, work_dir

#: Buckets of the stored tables in queries.
STORED_BUCKETS = 16

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


# --- extraction -------------------------------------------------------------------------------------------------

MENTIONS_SQL = rf"""
SELECT doc_id, sentence, position, id FROM (
  SELECT doc_id, sentence, unnest(range(len(w)))::INT AS position, unnest(w) AS word FROM (
    SELECT doc_id, sentence, regexp_extract_all(lower(part), '[\p{{L}}\p{{N}}_]+') AS w FROM (
      SELECT doc_id, unnest(range(len(p)))::INT AS sentence, unnest(p) AS part
      FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?\n]+') AS p FROM documents))))
JOIN ({GAZETTEER}) ON word = id
"""

COOCCUR_SQL = f"""
SELECT a.id AS src, 'CO_OCCURS' AS type, b.id AS dst, count(*) AS weight
FROM (SELECT DISTINCT doc_id, sentence, id FROM ({MENTIONS_SQL})) a
JOIN (SELECT DISTINCT doc_id, sentence, id FROM ({MENTIONS_SQL})) b
  ON a.doc_id = b.doc_id AND a.sentence = b.sentence AND a.id < b.id
GROUP BY ALL
"""


def _mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return graph.entity_mentions(documents, frames.gazetteer(spark, sf_dir), "doc_id", "text")


@query("entity_mentions", MENTIONS_SQL)
def entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mentions(spark, sf_dir)


@query("cooccurrence_edges", COOCCUR_SQL)
def cooccurrence_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.cooccurrence_edges(_mentions(spark, sf_dir), "doc_id")


# The same over names of one to three words of any length.
NAME_MENTIONS_SQL = rf"""
SELECT doc_id, sentence, position, id FROM (
  SELECT doc_id, sentence, position, array_to_string(w[position + 1:position + n], ' ') AS phrase FROM (
    SELECT doc_id, sentence, w, n, unnest(range(len(w) - n + 1))::INT AS position FROM (
      SELECT doc_id, sentence, regexp_extract_all(lower(part), '[\p{{L}}\p{{N}}_]+') AS w FROM (
        SELECT doc_id, unnest(range(len(p)))::INT AS sentence, unnest(p) AS part
        FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?\n]+') AS p FROM documents))),
      (SELECT unnest([1, 2, 3]) AS n) WHERE len(w) >= n))
JOIN ({PASSAGE_NAMES}) ON phrase = id
"""


def _name_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return graph.entity_mentions(documents, frames.passage_names(spark, sf_dir), "doc_id", "text", max_words=3)


@query("entity_mentions_names", NAME_MENTIONS_SQL)
def entity_mentions_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_mentions(spark, sf_dir)


# Every run whose first words begin a name, and the name itself.
LONG_MENTIONS_SQL = rf"""
WITH sentences AS (
  SELECT doc_id, sentence, regexp_extract_all(lower(part), '[\p{{L}}\p{{N}}_]+') AS w FROM (
    SELECT doc_id, unnest(range(len(p)))::INT AS sentence, unnest(p) AS part
    FROM (SELECT doc_id, regexp_split_to_array(text, '[.!?\n]+') AS p FROM documents))),
names AS (
  SELECT id, len(w) AS n, array_to_string(w[1:4], ' ') AS head
  FROM (SELECT id, string_split(id, ' ') AS w FROM ({LONG_NAMES}))),
heads AS (
  SELECT doc_id, sentence, position, w, array_to_string(w[position + 1:position + k], ' ') AS head
  FROM (SELECT *, unnest(range(len(w) - k + 1))::INT AS position FROM sentences, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k))
SELECT doc_id, sentence, position, id FROM heads JOIN names USING (head)
WHERE array_to_string(w[position + 1:position + n], ' ') = id
"""


@query("entity_mentions_long", LONG_MENTIONS_SQL)
def entity_mentions_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of any number of words, whole sentences among them."""
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    return graph.entity_mentions_long(documents, frames.long_names(spark, sf_dir), "doc_id", "text")


PERCENTILE_POINTS = (0.01, 0.25, 0.5, 0.75, 0.9, 0.99)


@query(
    "price_percentiles",
    f"""
    SELECT l_returnflag, l_linestatus, count(*) AS n, {', '.join(
        f'round(quantile_cont(l_extendedprice::DOUBLE, {q}), 6) AS p{int(q * 100)}' for q in PERCENTILE_POINTS)},
        max(l_extendedprice::DOUBLE) AS max
    FROM lineitem GROUP BY ALL
    """,
)
def price_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact percentiles of a column with almost as many values as rows."""
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    found = quantiles.percentiles(rows, ["l_returnflag", "l_linestatus"], "l_extendedprice", PERCENTILE_POINTS)
    return found.select(*[F.round(c, 6).alias(c) if c.startswith("p") else c for c in found.columns])


@query("cooccurrence_edges_names", COOCCUR_SQL.replace(MENTIONS_SQL, NAME_MENTIONS_SQL))
def cooccurrence_edges_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.cooccurrence_edges(_name_mentions(spark, sf_dir), "doc_id")


# --- stored graph -----------------------------------------------------------------------------------------------


def _supply_graph(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Two loads of the supply tables merged: suppliers and parts first, then parts again with other descriptions."""
    first = {
        "nodes": frames.supply_nodes(spark, sf_dir), "edges": frames.supply_edges(spark, sf_dir),
        "documents": frames.supply_documents(spark, sf_dir), "mentions": frames.supply_mentions(spark, sf_dir),
    }
    again = table(spark, sf_dir, "part").select(
        frames.key("P", "p_partkey").alias("id"), F.lit("Item").alias("type"), F.col("p_name").alias("description")
    )
    before = graph.upsert_graph(None, first)
    return graph.upsert_graph(before, {**first, "nodes": again})


@query(
    "graph_nodes",
    f"""
    SELECT id, type, description FROM (
      SELECT n.id, n.type, coalesce(n.description, p_name) AS description
      FROM ({SUPPLY_NODES}) n LEFT JOIN part ON n.id = 'P-' || p_partkey)
    """,
)
def graph_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supply_graph(spark, sf_dir)["nodes"]


@query("graph_edges", f"SELECT src, type, dst, min(description) AS description FROM ({SUPPLY_EDGES}) GROUP BY src, type, dst")
def graph_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supply_graph(spark, sf_dir)["edges"]


@query("graph_mentions", "SELECT DISTINCT l_orderkey AS doc_id, 'P-' || l_partkey AS entity_id FROM lineitem")
def graph_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supply_graph(spark, sf_dir)["mentions"]


@query("graph_documents", "SELECT o_orderkey AS doc_id, concat_ws(' ', o_orderstatus, o_orderpriority) AS text FROM orders")
def graph_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _supply_graph(spark, sf_dir)["documents"]


@query("stored_nodes", ORACLE["graph_nodes"])
def stored_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two loads into bucketed tables, read back."""
    path = f"{work_dir(spark)}/graphloom-{uuid.uuid4().hex}"
    again = table(spark, sf_dir, "part").select(
        frames.key("P", "p_partkey").alias("id"), F.lit("Item").alias("type"), F.col("p_name").alias("description")
    )
    for load in (frames.supply_nodes(spark, sf_dir), again):
        stored.upsert_stored(spark, path, {"nodes": load}, STORED_BUCKETS)
    return stored.read_stored(spark, path, "nodes").select("id", "type", "description")


@query("stored_edges", ORACLE["graph_edges"])
def stored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges without a description, then those with one, and all of them once more."""
    path = f"{work_dir(spark)}/graphloom-{uuid.uuid4().hex}"
    edges = frames.supply_edges(spark, sf_dir)
    for load in (edges.where("description IS NULL"), edges.where("description IS NOT NULL"), edges):
        stored.upsert_stored(spark, path, {"edges": load}, STORED_BUCKETS)
    return stored.read_stored(spark, path, "edges").select("src", "type", "dst", "description")


# --- statistics -------------------------------------------------------------------------------------------------

COUNTS_SQL = """
SELECT o_orderkey AS doc_id, coalesce(n, 0) AS entity_count
FROM orders LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_partkey) AS n FROM lineitem GROUP BY 1) ON o_orderkey = l_orderkey
"""


@query("entities_per_document", COUNTS_SQL)
def entities_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    mentions = graph.upsert_mentions(None, frames.supply_mentions(spark, sf_dir))
    return graph.entities_per_document(frames.supply_documents(spark, sf_dir), mentions)


REGRESSION_SQL = rf"""
    SELECT round(regr_slope(entities, tokens), 6) AS slope, round(regr_intercept(entities, tokens), 6) AS intercept,
           round(regr_r2(entities, tokens), 6) AS r2, count(*) AS n
    FROM (SELECT d.doc_id, len(regexp_extract_all(text, '[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_\s]')) AS tokens,
                 coalesce(entities, 0) AS entities
          FROM documents d LEFT JOIN
            (SELECT doc_id, count(DISTINCT id) AS entities FROM ({MENTIONS_SQL}) GROUP BY 1) m ON d.doc_id = m.doc_id)
    """


def _regression(spark: SparkSession, sf_dir: str, mentions: DataFrame) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    pairs = mentions.select("doc_id", F.col("id").alias("entity_id")).distinct()
    counts = graph.entities_per_document(documents, pairs)
    sized = documents.select("doc_id", text.token_count(F.col("text")).alias("tokens")).join(counts, "doc_id")
    fit = graph.linear_fit(sized, "entity_count", "tokens")
    return fit.select(*[F.round(c, 6).alias(c) for c in ("slope", "intercept", "r2")], "n")


@query("entity_token_regression", REGRESSION_SQL)
def entity_token_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regression(spark, sf_dir, _mentions(spark, sf_dir))


@query("entity_token_regression_names", REGRESSION_SQL.replace(MENTIONS_SQL, NAME_MENTIONS_SQL))
def entity_token_regression_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _regression(spark, sf_dir, _name_mentions(spark, sf_dir))


DEGREE_SQL = f"""
SELECT n.id, count(e.id) AS degree FROM ({SUPPLY_NODES}) n
LEFT JOIN (SELECT src AS id FROM ({SUPPLY_EDGES}) UNION ALL SELECT dst FROM ({SUPPLY_EDGES}) WHERE src <> dst) e
ON n.id = e.id GROUP BY n.id
"""


def _degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.node_degree(frames.supply_nodes(spark, sf_dir), frames.supply_edges(spark, sf_dir))


@query("node_degree", DEGREE_SQL)
def node_degree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _degree(spark, sf_dir)


@query(
    "degree_stats",
    f"""
    SELECT round(avg(degree), 6) AS mean, round(quantile_cont(degree, 0.25), 6) AS p25, round(quantile_cont(degree, 0.5), 6) AS p50,
           round(quantile_cont(degree, 0.75), 6) AS p75, round(quantile_cont(degree, 0.9), 6) AS p90 FROM ({DEGREE_SQL})
    """,
)
def degree_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = graph.distribution(_degree(spark, sf_dir), "degree")
    return stats.select(*[F.round(c, 6).alias(c) for c in stats.columns])


def histogram_sql(values: str, bins: int) -> str:
    return f"""
    WITH v AS (SELECT x::DOUBLE AS x FROM ({values})), l AS (SELECT min(x) AS lo, (max(x) - min(x)) / {bins}.0 AS w FROM v)
    SELECT b AS bin, round(lo + b * w, 6) AS low, round(lo + (b + 1) * w, 6) AS high, coalesce(n, 0) AS n
    FROM l, (SELECT unnest(range({bins}))::INT AS b) LEFT JOIN (
      SELECT CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), {bins - 1}) END::INT AS bin, count(*) AS n
      FROM v, l GROUP BY 1) ON b = bin
    """


def _rounded(bins: DataFrame) -> DataFrame:
    return bins.select("bin", F.round("low", 6).alias("low"), F.round("high", 6).alias("high"), "n")


@query("degree_histogram", histogram_sql(f"SELECT degree AS x FROM ({DEGREE_SQL})", 50))
def degree_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(graph.histogram(_degree(spark, sf_dir), "degree", 50))


@query(
    "token_histogram",
    histogram_sql(r"SELECT len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]')) AS x FROM documents", 20),
)
def token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "documents").select(text.token_count(F.col("text")).alias("tokens"))
    return _rounded(graph.histogram(tokens, "tokens", 20))


@query(
    "description_coverage",
    f"""
    SELECT 'node' AS type, count(*) AS total_count, count(description) AS non_null_descriptions FROM ({SUPPLY_NODES})
    UNION ALL SELECT 'relationship', count(*), count(description) FROM ({SUPPLY_EDGES})
    """,
)
def description_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.description_coverage(frames.supply_nodes(spark, sf_dir), frames.supply_edges(spark, sf_dir))


@query(
    "undirected_weights",
    f"SELECT least(src, dst) AS src, greatest(src, dst) AS dst, count(*) AS weight FROM ({SUPPLY_EDGES}) GROUP BY ALL",
)
def undirected_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.undirected_weights(frames.supply_edges(spark, sf_dir))


# --- components -------------------------------------------------------------------------------------------------


def closure_sql(edges: str, nodes: str = "") -> str:
    """Smallest reachable id per node: labels spread along edges until none shrinks."""
    extra = f" UNION SELECT id, id FROM ({nodes})" if nodes else ""
    return f"""
    WITH RECURSIVE e AS MATERIALIZED (SELECT src, dst FROM ({edges}) UNION SELECT dst, src FROM ({edges})),
    reach(id, label) AS (
      SELECT src, src FROM e{extra}
      UNION
      SELECT e.dst, reach.label FROM reach JOIN e ON e.src = reach.id)
    SELECT id, min(label) AS component FROM reach GROUP BY id
    """


THREAD_COMPONENTS = closure_sql(THREAD_EDGES)


@query("connected_components", THREAD_COMPONENTS)
def connected_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return components.connected_components(frames.thread_edges(spark, sf_dir))


@query("components_updated", THREAD_COMPONENTS)
def components_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations' own components are stored; then the links between turns of equal text come."""
    links = frames.thread_edges(spark, sf_dir)
    follows = F.col("dst").startswith("c-")
    stored = materialize(components.connected_components(links.where(follows)))
    return components.updated_components(stored, links.where(~follows))


@query(
    "component_stats",
    f"""
    SELECT count(*) AS component_count, min(size) AS min_size, round(avg(size), 6) AS mean_size, {', '.join(
        f'round(quantile_cont(size, {q}), 6) AS p{int(q * 100)}' for q in (0.5, 0.75, 0.9, 0.95, 0.99))}, max(size) AS max_size
    FROM (SELECT component, count(*) AS size FROM ({THREAD_COMPONENTS}) GROUP BY component)
    """,
)
def component_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = components.component_stats(connected_components(spark, sf_dir))
    whole = ("component_count", "min_size", "max_size")
    return stats.select(*[c if c in whole else F.round(c, 6).alias(c) for c in stats.columns])


@query(
    "term_components",
    closure_sql(f"SELECT src, dst FROM ({COOCCUR_SQL})", GAZETTEER),
)
def term_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of the extracted term graph, terms without a neighbour included."""
    edges = graph.cooccurrence_edges(_mentions(spark, sf_dir), "doc_id")
    return components.connected_components(edges, frames.gazetteer(spark, sf_dir))


NAME_EDGES = f"SELECT src, dst FROM ({COOCCUR_SQL.replace(MENTIONS_SQL, NAME_MENTIONS_SQL)})"


@query(
    "term_components_names",
    f"""
    WITH RECURSIVE e AS MATERIALIZED (SELECT src AS a, dst AS b FROM ({NAME_EDGES}) UNION SELECT dst, src FROM ({NAME_EDGES})),
    c(id, component) USING KEY (id) AS (
      SELECT id, id FROM ({PASSAGE_NAMES})
      UNION
      SELECT u.id, min(v.component) FROM recurring.c u JOIN e ON e.a = u.id JOIN recurring.c v ON v.id = e.b
      GROUP BY u.id, u.component HAVING min(v.component) < u.component)
    SELECT id, component FROM c
    """,
)
def term_components_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components over names of one to three words, names without a neighbour included."""
    edges = graph.cooccurrence_edges(_name_mentions(spark, sf_dir), "doc_id")
    return components.connected_components(materialize(edges), frames.passage_names(spark, sf_dir))


# --- vectors ----------------------------------------------------------------------------------------------------


@query(
    "mean_pool",
    """
    SELECT label, dim, round(sum(x * mask) / greatest(sum(mask), 1e-9), 6) AS value FROM (
      SELECT label, (CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END)::DOUBLE AS mask,
             unnest(range(len(embedding)))::INT AS dim, unnest(embedding)::DOUBLE AS x FROM embeddings)
    GROUP BY label, dim
    """,
)
def mean_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = table(spark, sf_dir, "embeddings").withColumn("mask", (F.col("embedding")[0] > 0).cast("int"))
    pooled = vectors.mean_pool(tokens, "label", "mask", "embedding")
    long = pooled.select("label", F.posexplode("embedding").alias("dim", "value"))
    return long.withColumn("value", F.round("value", 6))


@query(
    "mean_pool_truncated",
    """
    SELECT label, dim, round(sum(x * mask) / greatest(sum(mask), 1e-9), 6) AS value FROM (
      SELECT label, (CASE WHEN embedding[1] > 0 THEN 1 ELSE 0 END)::DOUBLE AS mask,
             unnest(range(len(embedding)))::INT AS dim, unnest(embedding)::DOUBLE AS x
      FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS token_pos FROM embeddings)
      WHERE token_pos < 32)
    GROUP BY label, dim
    """,
)
def mean_pool_truncated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length limit is the operator's feature: a sequence is cut off after its first 32 tokens."""
    tokens = table(spark, sf_dir, "embeddings").withColumn("mask", (F.col("embedding")[0] > 0).cast("int"))
    place = F.row_number().over(Window.partitionBy("label").orderBy("vec_id"))
    tokens = tokens.withColumn("token_pos", place - 1)
    pooled = vectors.mean_pool(tokens, "label", "mask", "embedding", position="token_pos", max_length=32)
    long = pooled.select("label", F.posexplode("embedding").alias("dim", "value"))
    return long.withColumn("value", F.round("value", 6))


def _entity_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frames.trade_nodes(spark, sf_dir)


@query(
    "entity_text_vectors",
    rf"""
    WITH src AS (SELECT id, concat_ws(' ', id, description) AS text FROM ({frames.TRADE_NODES})),
    counts AS (SELECT id, term, count(*) AS tf
               FROM (SELECT id, unnest(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS term FROM src) GROUP BY ALL),
    idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM src)) / (1.0 + count(*))) + 1 AS idf FROM counts GROUP BY term),
    raw AS (SELECT id, term, tf * idf AS w FROM counts JOIN idf USING (term)),
    scores AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS score FROM raw),
    buckets AS (SELECT id, ('0x' || substr(md5(term), 1, 4))::INT % 64 AS dim, sum(score) AS v FROM scores GROUP BY ALL)
    SELECT id, dim, round(v / sqrt(sum(v * v) OVER (PARTITION BY id)), 6) AS value FROM buckets
    """,
)
def entity_text_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    dense = vectors.entity_text_vectors(_entity_texts(spark, sf_dir), 64)
    long = dense.select("id", F.posexplode("embedding").alias("dim", "value")).where(F.col("value") != 0)
    return long.withColumn("value", F.round("value", 6))


KNN_SQL = """
SELECT id, other, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, other)::INT AS rank FROM (
    SELECT a.vec_id AS id, b.vec_id AS other,
           round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 9) AS score
    FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id) WHERE score >= 0.3) WHERE rank <= 10
"""


def _knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.knn(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=10, cutoff=0.3)


@query("knn_exact", KNN_SQL)
def knn_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _knn(spark, sf_dir).withColumn("score", F.round("score", 6))


@query("knn_lsh")
def knn_lsh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.knn_lsh(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", k=10, cutoff=0.3, bits=4)


@query("knn_descent")
def knn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return descent.knn_descent(rows, "vec_id", "embedding", k=10, cutoff=0.3, pool=40, leaf=64, tables=4)


RECALL_SQL = f"SELECT count(*) AS exact_rows, true AS recall_reached, 0::BIGINT AS wrong_scores FROM ({KNN_SQL})"


def _recall(found: DataFrame, wanted: DataFrame, share: float) -> DataFrame:
    """One row: the exact neighbours, whether the wanted share of them was found, and how many have another score."""
    named = found.select("id", "other", F.col("score").alias("own"))
    both = wanted.join(named, ["id", "other"], "left").agg(
        F.count(F.lit(1)).alias("exact_rows"), F.count("own").alias("_found"),
        F.count_if(F.abs(F.col("own") - F.col("score")) > 1e-6).alias("wrong_scores"),
    )
    return both.select("exact_rows", (F.col("_found") >= F.col("exact_rows") * share).alias("recall_reached"), "wrong_scores")


@query("knn_descent_recall", RECALL_SQL)
def knn_descent_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At least 0.95 of the exact neighbours, with their scores."""
    return _recall(knn_descent(spark, sf_dir), _knn(spark, sf_dir), 0.95)


@query("knn_lsh_recall", RECALL_SQL)
def knn_lsh_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """At least 0.95 of the exact neighbours, with their scores."""
    return _recall(knn_lsh(spark, sf_dir), _knn(spark, sf_dir), 0.95)


@query(
    "similar_components",
    closure_sql(f"SELECT id AS src, other AS dst FROM ({KNN_SQL})", "SELECT vec_id AS id FROM embeddings"),
)
def similar_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return vectors.similar_components(rows, materialize(_knn(spark, sf_dir)), "vec_id")


# --- resolution -------------------------------------------------------------------------------------------------

FORMS_SQL = f"SELECT DISTINCT block, lower(id) AS low FROM ({NAMED_ENTITIES}) WHERE length(id) > 4"
PAIRS_SQL = f"""
SELECT x.block, x.low AS a, y.low AS b, levenshtein(x.low, y.low)::INT AS distance
FROM ({FORMS_SQL}) x JOIN ({FORMS_SQL}) y ON x.block = y.block AND x.low < y.low
WHERE levenshtein(x.low, y.low) < 3
"""
# Ids of these tables differ in more than case, so lowered pairs name the entities.
LINKS_SQL = f"""
SELECT n.id AS src, m.id AS dst FROM ({PAIRS_SQL}) p
JOIN ({NAMED_ENTITIES}) n ON n.block = p.block AND lower(n.id) = p.a
JOIN ({NAMED_ENTITIES}) m ON m.block = p.block AND lower(m.id) = p.b
"""
GROUPS_SQL = f"SELECT component AS group_id, id AS entity_id FROM ({closure_sql(LINKS_SQL)})"
MERGES_SQL = rf"""
SELECT min(entity_id) OVER w AS group_id, entity_id FROM (
  SELECT group_id, entity_id, regexp_replace(lower(entity_id), '[^\p{{L}}\p{{N}}]', '', 'g') AS form,
         array_to_string(regexp_extract_all(entity_id, '[0-9]+'), ',') AS digits FROM ({GROUPS_SQL}))
WINDOW w AS (PARTITION BY group_id, form, digits)
QUALIFY count(*) OVER w > 1
"""
MAPPING_SQL = f"SELECT entity_id AS id, group_id AS survivor FROM ({MERGES_SQL}) WHERE entity_id <> group_id"


@query("duplicate_pairs", PAIRS_SQL)
def duplicate_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.duplicate_pairs(frames.named_entities(spark, sf_dir), "block")


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.duplicate_groups(frames.named_entities(spark, sf_dir), "block")


@query("duplicate_groups", GROUPS_SQL)
def duplicate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(spark, sf_dir)


# The chain: text vectors of all names, their nearest neighbours, components, and groups inside the components.
ENTITY_KNN_SQL = rf"""
WITH counts AS (SELECT id, term, count(*) AS tf
                FROM (SELECT id, unnest(regexp_extract_all(lower(id), '[\p{{L}}\p{{N}}_]+')) AS term FROM ({NAMED_ENTITIES})) GROUP BY ALL),
idf AS (SELECT term, ln((1.0 + (SELECT count(*) FROM ({NAMED_ENTITIES}))) / (1.0 + count(*))) + 1 AS idf FROM counts GROUP BY term),
raw AS (SELECT id, term, tf * idf AS w FROM counts JOIN idf USING (term)),
scores AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS score FROM raw),
buckets AS (SELECT id, ('0x' || substr(md5(term), 1, 4))::INT % 256 AS dim, sum(score) AS v FROM scores GROUP BY ALL),
unit AS (SELECT id, dim, v / sqrt(sum(v * v) OVER (PARTITION BY id)) AS v FROM buckets),
pairs AS (SELECT a.id, b.id AS other, round(sum(a.v * b.v), 9) AS score FROM unit a JOIN unit b USING (dim) WHERE a.id <> b.id GROUP BY ALL)
SELECT id AS src, other AS dst FROM pairs WHERE score >= 0.95
QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, other) <= 10
"""
FOUND_BLOCKS_SQL = f"SELECT id, component AS block FROM ({closure_sql(ENTITY_KNN_SQL, f'SELECT id FROM ({NAMED_ENTITIES})')})"
FOUND_PAIRS_SQL = PAIRS_SQL.replace(NAMED_ENTITIES, FOUND_BLOCKS_SQL)
FOUND_LINKS_SQL = f"""
SELECT n.id AS src, m.id AS dst FROM ({FOUND_PAIRS_SQL}) p
JOIN (SELECT id, lower(id) AS low FROM ({NAMED_ENTITIES})) n ON n.low = p.a
JOIN (SELECT id, lower(id) AS low FROM ({NAMED_ENTITIES})) m ON m.low = p.b
"""


def _found_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name with the component of its text vector's neighbours."""
    names = frames.named_entities(spark, sf_dir).select("id", F.lit(None).cast("string").alias("description"))
    embedded = materialize(vectors.entity_text_vectors(names, 256))
    similar = materialize(vectors.knn(embedded, "id", "embedding", k=10, cutoff=0.95))
    return materialize(vectors.similar_components(embedded, similar, "id"))


@query("similar_names_groups", f"SELECT component AS group_id, id AS entity_id FROM ({closure_sql(FOUND_LINKS_SQL)})")
def similar_names_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate groups inside computed components, from the names themselves."""
    return resolve.duplicate_groups(_found_blocks(spark, sf_dir), "component")


@query("entity_resolution", MERGES_SQL)
def entity_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.entity_resolution(_groups(spark, sf_dir))


REPLIED_SQL = f"""
SELECT group_id, entity_id, min(entity_id) OVER (PARTITION BY group_id, regexp_replace(lower(entity_id), '[^\\p{{L}}\\p{{N}}]', '', 'g')) AS survivor
FROM ({GROUPS_SQL}) WHERE length(group_id) % 4 <> 0
"""


def _replies(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Stands in for a model's replies: lists by normal form in prose; groups by the length of their name get no usable one."""
    form = resolve.normal_form(F.col("entity_id"))
    lists = groups.groupBy("group_id", form.alias("form")).agg(F.array_sort(F.collect_list("entity_id")).alias("names"))
    body = lists.groupBy("group_id").agg(F.to_json(F.array_sort(F.collect_list("names"))).alias("json"))
    usable = F.concat(F.lit("Here are the lists:\n"), "json", F.lit("\nDone."))
    text_of = F.when(F.length("group_id") % 4 == 0, F.lit("I can't tell.")).otherwise(usable)
    return links.join(body, "group_id").select("request_id", "group_id", text_of.alias("response"))


@query("resolution_replies", f"SELECT entity_id AS id, survivor FROM ({REPLIED_SQL}) WHERE entity_id <> survivor")
def resolution_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One request per candidate group, replies, decisions, and the entities that they merge into others."""
    groups = materialize(_groups(spark, sf_dir))
    _, links = modelio.resolution_requests(groups, max_names=10**6)
    decisions, _ = modelio.parse_resolution(_replies(links, groups), groups)
    merges = materialize(resolve.entity_resolution(groups, decisions))
    return resolve.survivors(frames.named_entities(spark, sf_dir), merges)


@query(
    "resolution_rejects",
    f"SELECT DISTINCT group_id FROM ({GROUPS_SQL}) WHERE length(group_id) % 4 = 0",
)
def resolution_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidate groups whose reply could not be read."""
    groups = materialize(_groups(spark, sf_dir))
    _, links = modelio.resolution_requests(groups, max_names=10**6)
    return modelio.parse_resolution(_replies(links, groups), groups)[1].select("group_id").distinct()


def _mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges = materialize(entity_resolution(spark, sf_dir))
    return resolve.survivors(frames.named_entities(spark, sf_dir), merges)


@query(
    "merged_entities",
    f"SELECT id, type, block FROM ({NAMED_ENTITIES}) WHERE id NOT IN (SELECT id FROM ({MAPPING_SQL}))",
)
def merged_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.merge_entities(frames.named_entities(spark, sf_dir), _mapping(spark, sf_dir))


@query(
    "merged_edges",
    f"""
    SELECT src, type, dst, src = dst AS is_loop, count(*) AS parallel FROM (
      SELECT coalesce(a.survivor, e.src) AS src, e.type, coalesce(b.survivor, e.dst) AS dst FROM ({NAMED_EDGES}) e
      LEFT JOIN ({MAPPING_SQL}) a ON e.src = a.id LEFT JOIN ({MAPPING_SQL}) b ON e.dst = b.id)
    GROUP BY ALL
    """,
)
def merged_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = resolve.merge_edges(frames.named_edges(spark, sf_dir), _mapping(spark, sf_dir))
    return moved.groupBy("src", "type", "dst", "is_loop").agg(F.count(F.lit(1)).alias("parallel"))


@query(
    "merged_mentions",
    f"""
    SELECT DISTINCT doc_id, coalesce(survivor, entity_id) AS entity_id
    FROM ({NAMED_MENTIONS}) LEFT JOIN ({MAPPING_SQL}) ON entity_id = id
    """,
)
def merged_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.merge_mentions(frames.named_mentions(spark, sf_dir), _mapping(spark, sf_dir))

"""Queries over communities: detection, hierarchy, ranks, sizes, contents, text, summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import community, graph, modelio
from graphloom.operators.components import connected_components
from graphloom.plans import frames
from graphloom.session import materialize, spread
from graphloom.plans.frames import GAZETTEER, PASSAGE_NAMES, TRADE_EDGES, TRADE_MEMBERSHIP, TRADE_MENTIONS, TRADE_NODES

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


NAMED_MEMBERS = f"SELECT entity, level, level || '-' || community AS community FROM ({TRADE_MEMBERSHIP})"


def _term_graph(spark: SparkSession, sf_dir: str, names: DataFrame, max_words: int) -> tuple[DataFrame, DataFrame]:
    """Terms that share sentences of all documents, and the terms."""
    documents = spread(frames.table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    numbered = graph.numbered(names)
    mentions = graph.entity_mentions(documents, numbered, "doc_id", "text", max_words=max_words, name="name")
    return graph.named_edges(graph.cooccurrence_edges(mentions, "doc_id"), numbered), names


@query("communities")
def communities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected communities of the term graph extracted from all documents."""
    edges, terms = _term_graph(spark, sf_dir, frames.gazetteer(spark, sf_dir), 1)
    return community.detect_communities(materialize(edges), terms)


def _checked(edges: DataFrame, nodes: DataFrame, found: DataFrame) -> DataFrame:
    """One row of what must hold for detected communities, each counted or compared over all rows."""
    counts = found.groupBy("entity").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("level").alias("levels"), F.max("level").alias("top"))
    counts = nodes.select(F.col("id").alias("entity")).join(counts, "entity", "left").agg(
        F.count(F.lit(1)).alias("entities"), F.count_if(F.expr("n IS NULL OR n <> levels OR n <> top + 1")).alias("not_once_per_level")
    )
    above = found.select("entity", (F.col("level") - 1).alias("level"), F.col("community").alias("parent"))
    torn = found.join(above, ["entity", "level"]).groupBy("level", "community").agg(F.count_distinct("parent").alias("n")).where("n > 1")
    named = found.groupBy("level", "community").agg(F.min("entity").alias("least")).where("least <> community")
    values, apart = [], []
    for level in range(found.agg(F.max("level").alias("top")).head().top + 1):
        own = found.where(F.col("level") == level).select(F.col("entity").alias("id"), "community")
        values.append(community.modularity(edges, own).head().modularity)
        src, dst = own.toDF("src", "cs"), own.toDF("dst", "cd")
        inner = edges.join(src, "src").join(dst, "dst").where("cs = cd").select("src", "dst")
        parts = connected_components(inner, own).select("component").distinct().count()
        apart.append(parts - own.select("community").distinct().count())
    rises = all(b >= a - 1e-9 for a, b in zip(values, values[1:]))
    alone = nodes.select("id", F.col("id").alias("community"))
    better = values[-1] > community.modularity(edges, alone).head().modularity
    return counts.crossJoin(torn.agg(F.count(F.lit(1)).alias("not_nested"))).crossJoin(named.agg(F.count(F.lit(1)).alias("not_smallest"))).select(
        "*", F.lit(sum(apart)).cast("long").alias("not_connected"), F.lit(rises).alias("modularity_rises"), F.lit(better).alias("better_than_alone")
    )


def _checked_sql(nodes: str) -> str:
    return f"""
    SELECT count(*) AS entities, 0::BIGINT AS not_once_per_level, 0::BIGINT AS not_nested, 0::BIGINT AS not_smallest,
           0::BIGINT AS not_connected, true AS modularity_rises, true AS better_than_alone FROM ({nodes})
    """


@query("communities_checked", _checked_sql(GAZETTEER))
def communities_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every term once per level, levels nested, communities connected and named by their smallest term, rising modularity."""
    edges, terms = (materialize(frame) for frame in _term_graph(spark, sf_dir, frames.gazetteer(spark, sf_dir), 1))
    return _checked(edges, terms, materialize(community.detect_communities(edges, terms)))


@query("communities_names")
def communities_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Detected communities of all names of one to three words."""
    edges, names = _term_graph(spark, sf_dir, frames.passage_names(spark, sf_dir), 3)
    return community.detect_communities(materialize(edges), names)


@query("communities_names_checked", _checked_sql(PASSAGE_NAMES))
def communities_names_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for names of one to three words."""
    edges, names = (materialize(frame) for frame in _term_graph(spark, sf_dir, frames.passage_names(spark, sf_dir), 3))
    return _checked(edges, names, materialize(community.detect_communities(edges, names)))


@query(
    "community_nodes", f"SELECT DISTINCT community AS id, level FROM ({NAMED_MEMBERS})"
)
def community_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_nodes(frames.trade_membership(spark, sf_dir))


@query(
    "community_edges",
    f"""
    SELECT entity AS child, community AS parent, -1 AS child_level FROM ({NAMED_MEMBERS}) WHERE level = 0
    UNION SELECT a.community, b.community, a.level
    FROM ({NAMED_MEMBERS}) a JOIN ({NAMED_MEMBERS}) b ON a.entity = b.entity AND b.level = a.level + 1
    """,
)
def community_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_edges(frames.trade_membership(spark, sf_dir))


@query(
    "community_rank",
    f"""
    SELECT community, count(DISTINCT doc_id) AS community_rank
    FROM ({NAMED_MEMBERS}) JOIN ({TRADE_MENTIONS}) ON entity = entity_id GROUP BY community
    """,
)
def community_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_rank(frames.trade_membership(spark, sf_dir), frames.trade_mentions(spark, sf_dir))


SIZE_SQL = f"""
SELECT community, split_part(community, '-', 1) AS level, count(DISTINCT entity) AS entities
FROM ({NAMED_MEMBERS}) GROUP BY community
"""


@query("community_size", SIZE_SQL)
def community_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_size(frames.trade_membership(spark, sf_dir))


@query(
    "community_percentiles",
    f"""
    SELECT level, count(*) AS communities, {', '.join(
        f'round(quantile_cont(entities, {q}), 6) AS p{int(q * 100)}' for q in (0.25, 0.5, 0.75, 0.9, 0.99))}, max(entities) AS max
    FROM ({SIZE_SQL}) GROUP BY level
    """,
)
def community_percentiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = community.community_percentiles(community.community_size(frames.trade_membership(spark, sf_dir)))
    return found.select(*[F.round(c, 6).alias(c) if c.startswith("p") else c for c in found.columns])


REPORTED = f"""
SELECT entity, level, community FROM ({NAMED_MEMBERS})
WHERE level IN (0, 1, 4) QUALIFY count(*) OVER (PARTITION BY community) > 1
"""
CONTENT_NODES = f"SELECT community, id, description, type FROM ({REPORTED}) JOIN ({TRADE_NODES}) ON entity = id"
CONTENT_RELS = f"""
SELECT a.community, e.src AS "start", e.type, e.dst AS "end", e.description
FROM ({TRADE_EDGES}) e JOIN ({REPORTED}) a ON e.src = a.entity
JOIN ({REPORTED}) b ON e.dst = b.entity AND a.community = b.community
"""


def _nodes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_nodes_of(frames.trade_membership(spark, sf_dir), frames.trade_nodes(spark, sf_dir))


def _rels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_rels_of(frames.trade_membership(spark, sf_dir), frames.trade_edges(spark, sf_dir))


@query("community_nodes_of", CONTENT_NODES)
def community_nodes_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _nodes_of(spark, sf_dir)


@query("community_rels_of", CONTENT_RELS)
def community_rels_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rels_of(spark, sf_dir)


def described(line: str) -> str:
    return f"{line} || CASE WHEN description IS NOT NULL AND description <> '' THEN ', description: ' || description ELSE '' END"


LINES_SQL = f"""
WITH lines AS (
  SELECT community, 0 AS section, {described("'id: ' || id || ', type: ' || coalesce(type, 'None')")} AS line FROM ({CONTENT_NODES})
  UNION ALL
  SELECT community, 1, {described("'(' || \"start\" || ')-[:' || type || ']->(' || \"end\" || ')'")} FROM ({CONTENT_RELS}))
SELECT community, section, line, count(*) AS copies FROM lines GROUP BY ALL
"""

TEXT_SQL = f"""
SELECT community, 0::BIGINT AS part, 'Nodes are:' || chr(10)
  || coalesce(string_agg(repeat(line || chr(10), copies), '' ORDER BY line) FILTER (WHERE section = 0), '')
  || chr(10) || 'Relationships are:' || chr(10)
  || coalesce(string_agg(repeat(line || chr(10), copies), '' ORDER BY line) FILTER (WHERE section = 1), '') AS text
FROM ({LINES_SQL}) GROUP BY community
"""


@query("community_lines", LINES_SQL)
def community_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_lines(_nodes_of(spark, sf_dir), _rels_of(spark, sf_dir))


def _text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return community.community_text(_nodes_of(spark, sf_dir), _rels_of(spark, sf_dir))


@query("community_text", TEXT_SQL)
def community_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _text(spark, sf_dir)


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def filled_sql(template: str, column: str) -> str:
    before, after = template.split(modelio.TEXT_SLOT, 1)
    return f"{sql_text(before)} || {column} || {sql_text(after)}"


@query(
    "summary_requests",
    f"""
    SELECT sha256({sql_text(modelio.SUMMARY_SYSTEM)} || chr(10) || prompt) AS request_id, prompt, count(*) AS n_sources
    FROM (SELECT {filled_sql(modelio.SUMMARY_TEMPLATE, 'text')} AS prompt FROM ({TEXT_SQL})) GROUP BY ALL
    """,
)
def summary_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _text(spark, sf_dir).withColumn("source", F.concat_ws("/", "community", F.col("part").cast("string")))
    requests, _ = modelio.prompt_requests(texts, "source", "text", modelio.SUMMARY_TEMPLATE, modelio.SUMMARY_SYSTEM)
    return requests.select("request_id", "prompt", "n_sources")


PART_BUDGET, TREE_BUDGET = 1024, 256
PARTS_SQL = f"""
WITH rows AS (
  SELECT community, section || '|' || line || '|' || c AS place, regexp_extract_all(line, '{modelio.UNIT}') AS u
  FROM (SELECT community, section, line, unnest(range(copies)) AS c FROM ({LINES_SQL}))),
pieces AS (
  SELECT community, place, i // {PART_BUDGET // 4} AS piece, array_to_string(u[i + 1 : i + {PART_BUDGET // 4}], '') AS text,
         least({PART_BUDGET // 4}, len(u) - i) AS n
  FROM (SELECT community, place, u, unnest(range(0, len(u), {PART_BUDGET // 4})) AS i FROM rows)),
placed AS (
  SELECT p.*, ('0x' || substr(md5(place || '|' || piece), 1, 8))::BIGINT % blocks AS block
  FROM pieces p JOIN (SELECT community, ceil(sum(n) / {modelio.PARTS_TOGETHER * PART_BUDGET})::BIGINT AS blocks FROM pieces GROUP BY community)
  USING (community)),
started AS (
  SELECT *, sum(n) OVER (PARTITION BY community, block ORDER BY place, piece, text ROWS UNBOUNDED PRECEDING) - n AS start FROM placed)
SELECT community, block * 4294967296 + floor(start / {PART_BUDGET - PART_BUDGET // 4})::BIGINT AS part,
       string_agg(text, chr(10) ORDER BY place, piece, text) AS text
FROM started GROUP BY ALL
"""


def _line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each report line as often as its community has it."""
    lines = community.community_lines(_nodes_of(spark, sf_dir), _rels_of(spark, sf_dir))
    rows = lines.select("community", "section", "line", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    return rows.withColumn("place", F.concat_ws("|", F.col("section").cast("string"), "line", F.col("copy").cast("string")))


@query("summary_parts", PARTS_SQL)
def summary_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The report text of every community in parts that a model can take."""
    return modelio.budgeted_parts(_line_rows(spark, sf_dir), "community", "place", "line", PART_BUDGET)


def _counting_reply(requests: DataFrame) -> DataFrame:
    """A rule in a model's place: the reply tells how many units of the report its prompt stands for, itself or by earlier replies."""
    before, after = modelio.SUMMARY_TEMPLATE.split(modelio.TEXT_SLOT, 1)
    body = F.substring(F.col("prompt"), F.lit(len(before) + 1), F.length("prompt") - len(before) - len(after))

    def stands_for(line):
        told = F.regexp_extract(line, r"^units (\d+)$", 1)
        return F.when(told != "", told.cast("long")).otherwise(F.size(modelio.units(line)).cast("long"))

    total = F.aggregate(F.split(body, "\n"), F.lit(0).cast("long"), lambda n, line: n + stands_for(line))
    return requests.select("request_id", F.concat(F.lit("units "), total.cast("string")).alias("response"))


@query(
    "summary_texts",
    f"""
    SELECT community, 'units ' || sum(copies * len(regexp_extract_all(line, '{modelio.UNIT}'))) AS summary
    FROM ({LINES_SQL}) GROUP BY community
    """,
)
def summary_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One summary of every community through rounds of requests; what the replies count shows that no part is lost."""
    rows = _line_rows(spark, sf_dir)
    return modelio.reduce_texts(rows, "community", "place", "line", TREE_BUDGET, _counting_reply).select("community", "summary")


@query(
    "upsert_summary",
    f"""
    SELECT coalesce(c.id, s.id) AS id, level, s.summary
    FROM (SELECT DISTINCT community AS id, level FROM ({NAMED_MEMBERS})) c FULL JOIN (
      SELECT '0-' || n_nationkey AS id, 'Summary of ' || n_name AS summary FROM nation
      UNION ALL SELECT '2-' || r_regionkey, 'Summary of ' || r_name FROM region) s ON c.id = s.id
    """,
)
def upsert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation communities get a summary, region communities keep none, unknown ids become new rows."""
    nodes = community.community_nodes(frames.trade_membership(spark, sf_dir))
    nodes = nodes.withColumn("summary", F.lit(None).cast("string"))

    def told(name: str, level: int, number: str, label: str) -> DataFrame:
        rows = frames.table(spark, sf_dir, name)
        return rows.select(
            community.community_id(F.lit(level), F.col(number)).alias("id"),
            F.concat(F.lit("Summary of "), F.col(label)).alias("summary"),
        )

    summaries = told("nation", 0, "n_nationkey", "n_name").union(told("region", 2, "r_regionkey", "r_name"))
    return graph.write_property(nodes, summaries, "id", "summary", insert=True).select("id", "level", "summary")


@query(
    "write_rank",
    f"""
    SELECT id, level, community_rank FROM (SELECT DISTINCT community AS id, level FROM ({NAMED_MEMBERS}))
    LEFT JOIN (SELECT community, count(DISTINCT doc_id) AS community_rank
               FROM ({NAMED_MEMBERS}) JOIN ({TRADE_MENTIONS}) ON entity = entity_id GROUP BY community) ON id = community
    """,
)
def write_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes = community.community_nodes(frames.trade_membership(spark, sf_dir))
    ranks = community_rank(spark, sf_dir).withColumnRenamed("community", "id")
    return graph.write_property(nodes, ranks, "id", "community_rank")


@query(
    "community_key_violations",
    "SELECT id, count(*) AS n FROM (SELECT source AS id FROM documents) GROUP BY id HAVING count(*) > 1",
)
def community_key_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.key_violations(frames.table(spark, sf_dir, "documents").select(F.col("source").alias("id")), "id")

"""Queries around model calls: requests, replies, parsing, sweeps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.operators import modelio
from graphloom.plans.community_queries import filled_sql
from graphloom.plans.frames import table

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


REQUESTS_SQL = f"""
SELECT sha256(chr(10) || prompt) AS request_id, prompt, count(*) AS n_sources
FROM (SELECT {filled_sql(modelio.TRIPLE_TEMPLATE, 'text')} AS prompt FROM documents) GROUP BY ALL
"""


def _requests(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return modelio.prompt_requests(
        table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id", "text", modelio.TRIPLE_TEMPLATE
    )


@query("prompt_requests", REQUESTS_SQL)
def prompt_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, _ = _requests(spark, sf_dir)
    return requests.select("request_id", "prompt", "n_sources")


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reply per part: lead-in, blank line, two rows, a tuple of two, a row whose last part has commas."""
    name, brand, kind = F.col("p_name"), F.col("p_brand"), F.col("p_type")
    lines = F.array(
        F.lit("Here are the rows:"), F.lit(""),
        F.concat(F.lit("("), name, F.lit(", MADE_BY, "), brand, F.lit(")")),
        F.concat(F.lit("  ("), name, F.lit(",HAS_TYPE,"), kind, F.lit(")  ")),
        F.concat(F.lit("("), name, F.lit(", "), brand, F.lit(")")),
        F.concat(F.lit("("), name, F.lit(", DESCRIBED_AS, "), kind, F.lit(", "), brand, F.lit(")")),
        F.concat(F.lit("("), name, F.lit(", MADE_BY, "), brand, F.lit(")")),
    )
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(lines, "\n").alias("response"))


RESPONSE_LINES = """
SELECT p_partkey, unnest(['Here are the rows:', '', '(' || p_name || ', MADE_BY, ' || p_brand || ')',
  '  (' || p_name || ',HAS_TYPE,' || p_type || ')  ', '(' || p_name || ', ' || p_brand || ')',
  '(' || p_name || ', DESCRIBED_AS, ' || p_type || ', ' || p_brand || ')', '(' || p_name || ', MADE_BY, ' || p_brand || ')']) AS line
FROM part
"""
SQL_TRIPLE = r"'^\s*\(([^,]+),([^,]+),(.+)\)\s*$'"


@query(
    "parse_triples",
    f"""
    SELECT p_partkey, trim(regexp_extract(line, {SQL_TRIPLE}, 1)) AS head, trim(regexp_extract(line, {SQL_TRIPLE}, 2)) AS relation,
           trim(regexp_extract(line, {SQL_TRIPLE}, 3)) AS tail, count(*) AS n
    FROM ({RESPONSE_LINES}) WHERE regexp_matches(line, {SQL_TRIPLE}) GROUP BY ALL
    """,
)
def parse_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelio.parse_triples(_responses(spark, sf_dir), "p_partkey")[0]


@query(
    "rejected_triples",
    f"SELECT p_partkey, line FROM ({RESPONSE_LINES}) WHERE trim(line) <> '' AND NOT regexp_matches(line, {SQL_TRIPLE})",
)
def rejected_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelio.parse_triples(_responses(spark, sf_dir), "p_partkey")[1]


@query(
    "contact_fields",
    f"""
    SELECT doc_id, name, array_to_string(emails, '|') AS emails, array_to_string(phones, '|') AS phones FROM (
      SELECT doc_id, nullif(regexp_extract(text, '{modelio.NAME_PATTERN}', 1), '') AS name,
             regexp_extract_all(text, '{modelio.EMAIL_PATTERN}') AS emails,
             regexp_extract_all(text, '{modelio.PHONE_PATTERN}') AS phones FROM documents)
    WHERE name IS NOT NULL OR len(emails) > 0 OR len(phones) > 0
    """,
)
def contact_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = modelio.contact_fields(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select(
        "doc_id", "name", F.array_join("emails", "|").alias("emails"), F.array_join("phones", "|").alias("phones")
    )


@query(
    "parameter_sweep",
    f"""
    SELECT sha256(request_id || '|' || t::DOUBLE::VARCHAR || '|' || p::DOUBLE::VARCHAR) AS run_id, request_id,
           t AS temperature, p AS repeat_penalty
    FROM (SELECT DISTINCT request_id FROM ({REQUESTS_SQL})),
         (SELECT unnest([{', '.join(map(str, modelio.SWEEP_TEMPERATURES))}])::DOUBLE AS t),
         (SELECT unnest([{', '.join(map(str, modelio.SWEEP_REPEAT_PENALTIES))}])::DOUBLE AS p)
    """,
)
def parameter_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests, _ = _requests(spark, sf_dir)
    return modelio.parameter_sweep(requests).select("run_id", "request_id", "temperature", "repeat_penalty")


@query(
    "attach_responses",
    f"""
    WITH asked AS (SELECT conv_id, turn, sha256(chr(10) || {filled_sql(modelio.TRIPLE_TEMPLATE, 'text')}) AS request_id
                   FROM conversations WHERE role = 'user'),
    replies AS (SELECT request_id, arg_min(c.text, lpad(c.conv_id::VARCHAR, 12, '0') || lpad(c.turn::VARCHAR, 12, '0')) AS response
                FROM asked a JOIN conversations c ON a.conv_id = c.conv_id AND c.turn = a.turn + 1 AND c.role = 'assistant'
                GROUP BY request_id)
    SELECT conv_id || '-' || turn AS source, request_id, response FROM asked LEFT JOIN replies USING (request_id)
    """,
)
def attach_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns are the requests; the first assistant turn after any turn with that prompt is the reply."""
    turns = table(spark, sf_dir, "conversations")
    source = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    asked = turns.where(F.col("role") == "user").withColumn("source", source)
    _, links = modelio.prompt_requests(asked, "source", "text", modelio.TRIPLE_TEMPLATE)
    before = F.concat_ws("-", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string"))
    answers = turns.where(F.col("role") == "assistant").select(before.alias("source"), "conv_id", "turn", "text")
    replies = (
        links.join(answers, "source").groupBy("request_id")
        .agg(F.min_by("text", F.struct("conv_id", "turn")).alias("response"))
    )
    return modelio.attach_responses(links, replies)

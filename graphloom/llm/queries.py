"""The registered queries of this package over whole tables, and SQL where it can state the result."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm import (
    bpe, fingerprint, language, licenses, neardup, neighbours, packing, pii, quality, resampling, sharding, substrings,
    whitening,
)
from graphloom.llm.common import documents
from graphloom.session import materialize

BPE_VOCABULARY, WORD_VOCABULARY = "byte_bpe_multi_50k.tiktoken", "word_bpe_49k.json"


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = documents(spark, sf_dir, "embeddings")
    return neighbours.nearest(vectors, F.col("vec_id") % 20 == 0, k=20)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_spans(documents(spark, sf_dir))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = spark.conf.get("spark.graphloom.pseudonymKey", None)
    return pii.pseudonymise(documents(spark, sf_dir).select("doc_id", "text"), key=key, count="n_pseudonyms")


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digests(documents(spark, sf_dir), width=50)


def op5_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(documents(spark, sf_dir), hundredths=85)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(documents(spark, sf_dir), BPE_VOCABULARY, keep_ids=False)


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edited_fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    table = materialize(quality.document_statistics(docs.select("doc_id", "text"), "doc_id"))
    table = table.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    model = quality.fit(table.where("NOT held_out").join(labels, "doc_id"))
    return quality.score(table, model, "doc_id", "held_out")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    bucket = F.crc32(F.col("doc_id").cast("string")) % 5
    names, prototypes = language.fit(docs.where(bucket != 0))
    found = language.predict(docs, names, prototypes)
    return found.select("doc_id", F.coalesce(bucket == 0, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORD_VOCABULARY, 2048)


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(spark.read.parquet(f"{sf_dir}/documents.parquet"), shards=8)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), components=16)


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    drawn = resampling.resample(documents(spark, sf_dir), target, n_buckets=10_000, share=25, min_words=20, seed=7)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    query.__name__: query
    for query in (
        op1_neighbours, op2_licenses, op3_pii, op4_substrings, op5_neardup, op6_bpe, op7_fingerprints, op8_quality,
        op9_language, op10_packing, op11_sharding, op12_whitening, op13_resampling, pipeline,
    )
}

ORACLE = {
    "op1_neighbours": """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
""",
    "op4_substrings": """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, unnest(generate_series(1, len(words) - 49)) AS pos, words FROM w WHERE len(words) >= 50
), x AS (
  SELECT doc_id, pos, array_to_string(words[pos:pos + 49], ' ') AS window_text FROM s
), f AS (
  SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY window_text) AS first_doc FROM x
), c AS (
  SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 49)) AS place FROM f WHERE first_doc < doc_id
), t AS (
  SELECT doc_id, unnest(generate_series(1, len(words))) AS place, words FROM w WHERE len(words) > 0
), k AS (
  SELECT t.doc_id, count(*) AS kept, string_agg(t.words[t.place], ' ' ORDER BY t.place) AS kept_text
  FROM t LEFT JOIN c ON t.doc_id = c.doc_id AND t.place = c.place WHERE c.place IS NULL GROUP BY t.doc_id
)
SELECT w.doc_id, CAST(len(w.words) AS BIGINT) AS n_words, CAST(len(w.words) - coalesce(k.kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept_text, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
""",
    "op5_neardup": """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(words[pos:pos + 4], ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 4, 1))) AS pos FROM w WHERE len(words) > 0)
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 85 * (na.n + nb.n - count(*))
), r AS (
  SELECT doc_id, doc_id AS reached FROM w UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reached
)
SELECT r.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, min(reached) AS component_id, r.doc_id = min(reached) AS kept
FROM r LEFT JOIN n ON n.doc_id = r.doc_id GROUP BY r.doc_id, n.n
""",
    "op11_sharding": """
WITH RECURSIVE tree AS (
  SELECT t AS shards, 'region ' || CASE WHEN s < 8 THEN s // 4 ELSE s - 6 END AS region,
         'rack ' || CASE WHEN s < 8 THEN s // 2 ELSE s - 4 END AS rack, 'shard ' || s AS leaf, s AS shard
  FROM (VALUES (8), (9)) a(t), range(9) b(s) WHERE s < t
), nodes AS (
  SELECT shards, 1 AS level, '' AS above, region AS name, count(*) AS weight FROM tree GROUP BY ALL
  UNION ALL SELECT shards, 2, region, rack, count(*) FROM tree GROUP BY ALL
  UNION ALL SELECT shards, 3, rack, leaf, 1 FROM tree
), d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(CAST(doc_id AS VARCHAR), '') AS k, coalesce(text, '') AS text FROM documents
), clocks AS (
  SELECT r, shards, level, above, name,
         -ln((CAST('0x' || substr(md5('shard:' || name || ':' || k), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0) / weight AS clock
  FROM d, nodes
), winners AS (
  SELECT r, shards, level, above, arg_min(name, clock) AS name FROM clocks GROUP BY r, shards, level, above
), placed AS (
  SELECT a.r, a.shards, CAST(substr(c.name, 7) AS INTEGER) AS shard
  FROM winners a JOIN winners b ON b.r = a.r AND b.shards = a.shards AND b.level = 2 AND b.above = a.name
  JOIN winners c ON c.r = a.r AND c.shards = a.shards AND c.level = 3 AND c.above = b.name WHERE a.level = 1
), powers AS (
  SELECT 0 AS b, list_transform(range(32), lambda j: CASE WHEN j = 0 THEN 3988292384 ELSE CAST(1 AS BIGINT) << (j - 1) END) AS m
  UNION ALL
  SELECT b + 1, list_transform(m, lambda v: list_reduce(list_transform(range(32),
    lambda j: CASE WHEN (v >> j) & 1 = 1 THEN m[j + 1] ELSE 0 END), lambda x, y: xor(x, y))) FROM powers WHERE b < 30
), chunks AS (
  SELECT r, i, substr(h, 2 * greatest(n - 64 * (i + 1), 0) + 1, 2 * least(64, n - 64 * i)) AS h
  FROM (SELECT r, n, h, unnest(range((n + 63) // 64)) AS i FROM (SELECT r, strlen(text) AS n, hex(text) AS h FROM d))
), bits AS (
  SELECT r, i, flatten(list_transform(range(len(h) // 2), lambda k: list_transform(range(8),
    lambda j: (CAST('0x' || substr(h, 2 * k + 1, 2) AS BIGINT) >> j) & 1))) AS b FROM chunks
), moved AS (
  SELECT r, i, 9 AS b, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) AS c FROM bits
  UNION ALL
  SELECT r, i, moved.b + 1, CASE WHEN (i >> (moved.b - 9)) & 1 = 1 THEN list_reduce(list_transform(range(32),
    lambda j: CASE WHEN (c >> j) & 1 = 1 THEN m[j + 1] ELSE 0 END), lambda x, y: xor(x, y)) ELSE c END
  FROM moved JOIN powers ON powers.b = moved.b WHERE moved.b < 31
), crc AS (
  SELECT r, bit_xor(c) AS crc FROM moved WHERE b = 31 GROUP BY r
), t AS (
  SELECT d.doc_id, CAST(strlen(text) + 1 AS BIGINT) AS size, CAST(coalesce(crc, 0) AS BIGINT) AS text_crc32, 'key' AS law,
         p.shard, g.shard AS grown_shard
  FROM d JOIN placed p ON p.r = d.r AND p.shards = 8 JOIN placed g ON g.r = d.r AND g.shards = 9 LEFT JOIN crc ON crc.r = d.r
)
SELECT *, row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS slot FROM t
""",
    "op13_resampling": """
WITH w AS (
  SELECT 0 AS side, row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words FROM documents
  UNION ALL
  SELECT 1, row_number() OVER (), NULL, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM benchmark
), f AS (
  SELECT side, r, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature FROM w
), n AS (
  SELECT side, r, feature, count(*) AS n FROM f GROUP BY ALL
), bits AS (
  SELECT feature, flatten(list_transform(range(strlen(feature)), lambda i: list_transform(range(8),
    lambda j: (CAST('0x' || substr(hex(feature), 2 * i + 1, 2) AS BIGINT) >> j) & 1))) AS b FROM (SELECT DISTINCT feature FROM n)
), crc AS (
  SELECT feature, xor(list_reduce(list_prepend(4294967295, b),
    lambda c, x: CASE WHEN xor(c, x) & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END), 4294967295) % 10000 AS bucket FROM bits
), counts AS (
  SELECT bucket, coalesce(sum(n) FILTER (side = 0), 0) AS s, coalesce(sum(n) FILTER (side = 1), 0) AS t
  FROM n JOIN crc USING (feature) GROUP BY bucket
), totals AS (
  SELECT CAST(sum(s) AS DOUBLE) + 10000 AS all_s, CAST(sum(t) AS DOUBLE) + 10000 AS all_t FROM counts
), gains AS (
  SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * all_s / ((CAST(s AS DOUBLE) + 1) * all_t))) AS BIGINT) AS gain
  FROM counts, totals
), weights AS (
  SELECT r, CAST(sum(n) AS BIGINT) AS n_features, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / CAST(sum(n) AS DOUBLE)) AS BIGINT) AS weight
  FROM n JOIN crc USING (feature) JOIN gains USING (bucket) WHERE side = 0 GROUP BY r
), scored AS (
  SELECT doc_id, len(words) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000.0 * ln(-ln((CAST('0x' || substr(sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)
      AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score
  FROM w LEFT JOIN weights ON weights.r = w.r WHERE side = 0
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS LAST, weight DESC, n_features DESC) AS place,
         25 * (count(*) OVER (PARTITION BY n_words >= 20)) // 100 AS wanted FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= wanted THEN CAST(place AS BIGINT) END AS rank FROM ranked
""",
}

"""Queries over pages and documents: scans, text functions, tagging, TF-IDF, similar pages."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graphloom.functions import pos, text
from graphloom.functions.wordlists import CLOSED_CLASS_TAGS, ENGLISH_STOP_WORDS, SUFFIX_TAGS
from graphloom.operators import pages, tagging, tfidf
from graphloom.plans.frames import CORPUS, corpus, page_text, table
from graphloom.session import materialize, spread, work_dir
from graphloom.sources import sinks, tables

QUERIES = {}
ORACLE = {}


def query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLE[name] = sql
        return build

    return register


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")


WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"
STOP = _quoted(ENGLISH_STOP_WORDS)


def tag_case(word: str) -> str:
    """The default tagger as a SQL CASE over a word expression."""
    arms = [f"WHEN {word} IN ({_quoted(members)}) THEN '{tag}'" for tag, members in CLOSED_CLASS_TAGS.items()]
    arms.append(f"WHEN regexp_matches({word}, '^[0-9]+$') THEN 'CD'")
    arms += [f"WHEN ends_with({word}, '{suffix}') THEN '{tag}'" for suffix, tag in SUFFIX_TAGS]
    return "CASE " + " ".join(arms) + " ELSE 'NN' END"


# --- scans and sinks --------------------------------------------------------------------------------------------


@query("scan_table", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, f"{sf_dir}/documents.parquet")


@query("csv_roundtrip", "SELECT 'Document ' || doc_id AS title, text FROM documents")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/articles-{uuid.uuid4().hex}"
    articles = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), "text"
    )
    (
        articles.write.option("header", True).option("quoteAll", True).option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    )
    return tables.read_articles_csv(spark, path)


@query(
    "union_tables",
    """
    SELECT 'documents' AS source_table, * FROM documents
    UNION ALL BY NAME SELECT 'benchmark' AS source_table, * FROM benchmark
    UNION ALL BY NAME SELECT 'labels' AS source_table, * FROM labels
    """,
)
def union_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("documents", "benchmark", "labels")
    return tables.union_tables({name: table(spark, sf_dir, name) for name in names})


# --- page functions ---------------------------------------------------------------------------------------------


@query("clean_page", "SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) AS page FROM pages")
def clean_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.clean_page(F.col("url")).alias("page"))


@query("suffix_filter", "SELECT page_id, url FROM pages WHERE coalesce(ends_with(url, '/'), false)")
def suffix_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").where(text.has_suffix(F.col("url"), "/")).select("page_id", "url")


@query("concat_text", "SELECT doc_id, concat_ws(' ', source, text) AS content FROM documents")
def concat_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.title_and_text(F.col("source"), F.col("text")).alias("content")
    )


@query(
    "token_count",
    r"SELECT doc_id, len(regexp_extract_all(text, '[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]'))::INT AS tokens FROM documents",
)
def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).select("doc_id", text.token_count(F.col("text")).alias("tokens"))


@query("head_n", "SELECT doc_id, source, text FROM documents ORDER BY doc_id LIMIT 250")
def head_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.head_rows(table(spark, sf_dir, "documents"), ["doc_id"], 250).select("doc_id", "source", "text")


@query(
    "explode_tokens",
    f"""
    SELECT doc_id, unnest(range(len(w)))::INT AS position, unnest(w) AS word
    FROM (SELECT doc_id, {WORDS} AS w FROM documents)
    """,
)
def explode_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = text.unroll(_documents(spark, sf_dir), ["doc_id"], text.words(F.col("text")), "word", "position")
    return rows.select("doc_id", "position", "word")


@query(
    "array_ops",
    r"""
    SELECT page_id, len(a)::INT AS n_a, len(list_distinct(b))::INT AS distinct_b,
           array_to_string(list_sort(list_intersect(a, b)), ' ') AS shared,
           len(list_distinct(list_concat(a, b)))::INT AS n_union,
           list_has_all(b, a) AS contains_all,
           len(list_filter(a, lambda x: regexp_matches(x, '^[0-9]+$'))) > 0 AS any_number,
           coalesce(list_sum(list_transform(a, lambda x: length(x))), 0)::INT AS total_length,
           array_to_string(list_sort(list_distinct(a)), ' ') AS sorted_a
    FROM (SELECT page_id, regexp_extract_all(lower(url), '[\p{L}\p{N}_]+') AS a,
                 regexp_extract_all(lower(html), '[\p{L}\p{N}_]+') AS b FROM pages)
    """,
)
def array_ops(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = table(spark, sf_dir, "pages").select(
        "page_id", text.words(F.col("url")).alias("a"), text.words(F.col("html")).alias("b")
    )
    return lists.select(
        "page_id",
        F.size("a").alias("n_a"),
        F.size(F.array_distinct("b")).alias("distinct_b"),
        F.array_join(F.array_sort(F.array_intersect("a", "b")), " ").alias("shared"),
        F.size(F.array_union("a", "b")).alias("n_union"),
        (F.size(F.array_except("a", "b")) == 0).alias("contains_all"),
        F.exists("a", lambda x: x.rlike("^[0-9]+$")).alias("any_number"),
        F.aggregate("a", F.lit(0), lambda acc, x: acc + F.length(x)).alias("total_length"),
        F.array_join(F.array_sort(F.array_distinct("a")), " ").alias("sorted_a"),
    )


@query("feature_names", f"SELECT DISTINCT unnest({WORDS}) AS term FROM documents")
def feature_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagging.word_terms(_documents(spark, sf_dir), "doc_id", "text").select("term").distinct()


@query(
    "latest_page",
    """
    SELECT user_id, event_id, ts, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS r FROM events
      WHERE length(props) > 0) WHERE r = 1
    """,
)
def latest_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = pages.latest_per_key(table(spark, sf_dir, "events"), "user_id", "ts", "event_id", text="props")
    return latest.select("user_id", "event_id", "ts", "event_type")


@query("latest_page_sql", ORACLE["latest_page"])
def latest_page_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as SQL text at the source."""
    statement = """
        SELECT user_id, event_id, ts, event_type
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS place FROM visits WHERE LENGTH(props) > 0)
        WHERE place = 1
    """
    return tables.read_sql(spark, statement, {"visits": table(spark, sf_dir, "events")})


@query(
    "dedup_clean_page",
    """
    SELECT page_id, page FROM (
      SELECT *, row_number() OVER (PARTITION BY page ORDER BY page_id) AS r
      FROM (SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) AS page FROM pages)) WHERE r = 1
    """,
)
def dedup_clean_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    urls = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page"))
    return pages.dedup_clean_pages(urls, "page", "page_id")


# --- tagging ----------------------------------------------------------------------------------------------------

TAGGED = f"""
SELECT doc_id, list_transform(w, lambda x: {{'word': x, 'tag': {tag_case('x')}}}) AS tagged
FROM (SELECT doc_id, {WORDS} AS w FROM documents)
"""


@query(
    "tag_tokens",
    f"""
    SELECT doc_id, unnest(range(len(tagged)))::INT AS position, unnest(tagged).word AS word, unnest(tagged).tag AS tag
    FROM ({TAGGED})
    """,
)
def tag_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    lexicon = tables.literal_frame(
        spark, [(word, tag) for tag, members in CLOSED_CLASS_TAGS.items() for word in members], "word string, tag string"
    )
    tokens = _documents(spark, sf_dir).select("doc_id", text.words(F.col("text")).alias("tokens"))
    tagged = tagging.tag_tokens(tokens, "doc_id", "tokens", lexicon)
    rows = text.unroll(tagged, ["doc_id"], F.col("tagged"), "t", "position")
    return rows.select("doc_id", "position", "t.word", "t.tag")


# One- and two-word phrases of the documents with their tags.
def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")
    tokens = documents.select("doc_id", "lang", text.words(F.col("text")).alias("tokens"))
    grams = text.unroll(tokens, ["doc_id", "lang"], text.all_ngrams(F.col("tokens"), 2), "sequence")
    unique = grams.groupBy("sequence").agg(F.min("doc_id").alias("doc_id"), F.min("lang").alias("lang"))
    return unique.withColumn("tags", tagging.tags_of(F.split("sequence", " ")))


PHRASES = f"""
SELECT sequence, min(doc_id) AS doc_id, min(lang) AS lang,
       list_transform(string_split(sequence, ' '), lambda x: {tag_case('x')}) AS tags
FROM (SELECT doc_id, lang, unnest(w) AS sequence FROM (SELECT doc_id, lang, {WORDS} AS w FROM documents)
      UNION ALL
      SELECT doc_id, lang, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
      FROM (SELECT doc_id, lang, {WORDS} AS w FROM documents))
GROUP BY sequence
"""

SQL_FLAGS = {
    "starts_verb": "starts_with(tags[1], 'VB') AND tags <> ['VBN', 'NN']",
    "starts_space": "starts_with(tags[1], '_SP')",
    "starts_colon": "starts_with(tags[1], ':')",
    "starts_adverb": "starts_with(tags[1], 'RB')",
    "bad_char": "contains(array_to_string(tags, ' '), '€')",
    "bad_cd_ratio": "3 * len(list_filter(tags, lambda t: t = 'CD')) > len(tags)",
    "bad_length": "length(array_to_string(tags, '')) < 4",
}


@query(
    "pos_filters",
    f"SELECT sequence, {', '.join(f'({e}) AS {n}' for n, e in SQL_FLAGS.items())},"
    f" starts_with(tags[-1], 'NN') AS ends_noun FROM ({PHRASES})",
)
def pos_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [test(F.col("tags")).alias(name) for name, test in pos.REMOVAL_FLAGS.items()]
    return _phrases(spark, sf_dir).select("sequence", *flags, pos.ends_with_noun(F.col("tags")).alias("ends_noun"))


# The URL a phrase is judged against: that of a German phrase carries the hyphenated words.
URL_SQL = "CASE WHEN lang = 'de' THEN 'http://site/' || replace(sequence, ' ', '-') || '/' ELSE 'http://site/' || doc_id END"


@query(
    "final_cd_check",
    f"""
    SELECT sequence, bad AND NOT (bad AND tags IN (['CD', 'NN'], ['CD', 'NNS'])
           AND contains(page, replace(sequence, ' ', '-'))) AS final_cd
    FROM (SELECT sequence, tags, {SQL_FLAGS['bad_cd_ratio']} AS bad, {URL_SQL} AS page FROM ({PHRASES}))
    """,
)
def final_cd_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_url(_phrases(spark, sf_dir)).select("sequence", _final_cd().alias("final_cd"))


def _with_url(phrases: DataFrame) -> DataFrame:
    tail = F.when(
        F.col("lang") == "de", F.concat(F.replace("sequence", F.lit(" "), F.lit("-")), F.lit("/"))
    ).otherwise(F.col("doc_id").cast("string"))
    return phrases.withColumn("page", F.concat(F.lit("http://site/"), tail))


def _final_cd():
    tags = F.col("tags")
    return pos.final_number_check(pos.bad_number_ratio(tags), tags, F.col("sequence"), F.col("page"))


@query(
    "noun_phrases",
    f"SELECT sequence, array_to_string(tags, ' ') AS tags FROM ({PHRASES}) WHERE starts_with(tags[-1], 'NN')"
    + "".join(f" AND NOT ({e})" for e in SQL_FLAGS.values()),
)
def noun_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = _phrases(spark, sf_dir).where(pos.is_noun_phrase(F.col("tags")))
    return kept.select("sequence", F.array_join("tags", " ").alias("tags"))


# One- to three-word phrases, with every document that holds them; the queries above take two words and one document.
def _all_phrases(documents: DataFrame) -> DataFrame:
    tokens = documents.select("doc_id", "lang", text.words(F.col("text")).alias("tokens"))
    return text.unroll(tokens, ["doc_id", "lang"], F.array_distinct(text.all_ngrams(F.col("tokens"), 3)), "sequence")


def _phrase_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "text"), "doc_id")


def _tagged(phrases: DataFrame) -> DataFrame:
    return phrases.withColumn("tags", tagging.tags_of(F.split("sequence", " ")))


ALL_PHRASES = f"""
SELECT doc_id, lang, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]),
       list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) AS sequence
FROM (SELECT doc_id, lang, {WORDS} AS w FROM documents)
"""
TAGS_SQL = f"list_transform(string_split(sequence, ' '), lambda x: {tag_case('x')}) AS tags"


@query(
    "pos_filters_three_words",
    f"SELECT sequence, {', '.join(f'({e}) AS {n}' for n, e in SQL_FLAGS.items())}, starts_with(tags[-1], 'NN') AS ends_noun"
    f" FROM (SELECT sequence, {TAGS_SQL} FROM (SELECT DISTINCT sequence FROM ({ALL_PHRASES})))",
)
def pos_filters_three_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = [test(F.col("tags")).alias(name) for name, test in pos.REMOVAL_FLAGS.items()]
    phrases = _tagged(_all_phrases(_phrase_documents(spark, sf_dir)).select("sequence").distinct())
    return phrases.select("sequence", *flags, pos.ends_with_noun(F.col("tags")).alias("ends_noun"))


@query(
    "final_cd_check_pages",
    f"""
    SELECT DISTINCT doc_id, sequence, bad AND NOT (bad AND tags IN (['CD', 'NN'], ['CD', 'NNS'])
           AND contains(page, replace(sequence, ' ', '-'))) AS final_cd
    FROM (SELECT doc_id, sequence, tags, {SQL_FLAGS['bad_cd_ratio']} AS bad, {URL_SQL} AS page
          FROM (SELECT *, {TAGS_SQL} FROM (SELECT DISTINCT doc_id, lang, sequence FROM ({ALL_PHRASES}))))
    """,
)
def final_cd_check_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    def judged(phrases: DataFrame) -> DataFrame:
        return _with_url(_tagged(phrases)).select("doc_id", "sequence", _final_cd().alias("final_cd"))

    # A document's phrases are made distinct in its own row; only rows that share an id have to meet.
    single, shared = pages.apart(_phrase_documents(spark, sf_dir), "doc_id")
    found = judged(_all_phrases(single))
    return found if shared is None else found.unionByName(judged(_all_phrases(shared).distinct()).distinct())


@query(
    "noun_phrases_three_words",
    f"SELECT sequence, array_to_string(tags, ' ') AS tags"
    f" FROM (SELECT sequence, {TAGS_SQL} FROM (SELECT DISTINCT sequence FROM ({ALL_PHRASES})))"
    f" WHERE starts_with(tags[-1], 'NN')" + "".join(f" AND NOT ({e})" for e in SQL_FLAGS.values()),
)
def noun_phrases_three_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    phrases = tagging.accepted_phrases(_phrase_documents(spark, sf_dir), [], "text", pos.is_noun_phrase).distinct()
    return _tagged(phrases).select("sequence", F.array_join("tags", " ").alias("tags"))


# --- n-grams ----------------------------------------------------------------------------------------------------


@query(
    "ngrams",
    f"""
    SELECT doc_id, n, gram, count(*) AS occurrences FROM (
      SELECT doc_id, 1 AS n, unnest(w) AS gram FROM (SELECT doc_id, {WORDS} AS w FROM documents)
      UNION ALL SELECT doc_id, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))
      FROM (SELECT doc_id, {WORDS} AS w FROM documents)
      UNION ALL SELECT doc_id, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
      FROM (SELECT doc_id, {WORDS} AS w FROM documents))
    GROUP BY ALL
    """,
)
def ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sized(tagging.phrase_counts(_documents(spark, sf_dir), "doc_id", "text"), "gram")


def _sized(counts: DataFrame, name: str) -> DataFrame:
    """Counts with the number of words, which hold no space."""
    return counts.select("doc_id", F.size(F.split("term", " ")).alias("n"), F.col("term").alias(name), F.col("tf").alias("occurrences"))


def noun_ngrams_sql(gate: str) -> str:
    grams = []
    for n in (1, 2, 3):
        phrase = " || ' ' || ".join(f"k[e - {n - 1 - i}].word" if i < n - 1 else "k[e].word" for i in range(n))
        grams.append(
            f"SELECT doc_id, {n} AS n, unnest(list_transform(list_filter(range({n}, len(k) + 1),"
            f" lambda e: ends_with(k[e].tag, 'NN')), lambda e: {phrase})) AS term FROM base"
            + (f" WHERE {n} <= 2 * numbers" if gate else "")
        )
    return f"""
    WITH base AS (
      SELECT doc_id, list_filter(tagged, lambda t: t.tag NOT IN ('VB', 'SP', 'RB', 'Co')) AS k,
             len(list_filter(tagged, lambda t: t.tag = 'CD')) AS numbers FROM ({TAGGED}))
    SELECT doc_id, n, term, count(*) AS occurrences FROM ({' UNION ALL '.join(grams)}) GROUP BY ALL
    """


def _noun_ngrams(spark: SparkSession, sf_dir: str, factor: int | None) -> DataFrame:
    return _sized(tagging.document_term_counts(_documents(spark, sf_dir), "doc_id", "text", number_factor=factor), "term")


@query("noun_ngrams", noun_ngrams_sql("gate"))
def noun_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noun_ngrams(spark, sf_dir, 2)


@query("noun_ngrams_ungated", noun_ngrams_sql(""))
def noun_ngrams_ungated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noun_ngrams(spark, sf_dir, None)


# --- TF-IDF -----------------------------------------------------------------------------------------------------


def tfidf_sql(source: str = "documents", key: str = "doc_id", max_df: float = 0.7) -> str:
    """Common table expressions counts, idf, scores."""
    return f"""
    src AS (SELECT {key}, text FROM ({'SELECT * FROM ' + source if ' ' not in source else source})),
    counts AS (SELECT {key}, term, count(*) AS tf FROM (SELECT {key}, unnest({WORDS}) AS term FROM src)
               WHERE term NOT IN ({STOP}) GROUP BY ALL),
    total AS (SELECT count(*) AS n FROM src),
    idf AS (SELECT term, df, ln((1.0 + n) / (1.0 + df)) + 1 AS idf
            FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total WHERE df <= {max_df} * n),
    scores AS (SELECT {key}, term, tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY {key})) AS score
               FROM counts JOIN idf USING (term))"""


def _counts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    counts = tagging.word_counts(_documents(spark, sf_dir), "doc_id", "text")
    return table(spark, sf_dir, "documents"), tfidf.without_stop_words(counts)


def _scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, counts = _counts(spark, sf_dir)
    return tfidf.fit_score(counts, documents, "doc_id")


@query("term_idf", f"WITH {tfidf_sql()} SELECT term, df, round(idf, 6) AS idf FROM idf")
def term_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, counts = _counts(spark, sf_dir)
    return tfidf.fit_idf(counts, documents).withColumn("idf", F.round("idf", 6))


@query(
    "term_idf_low_cap",
    f"WITH {tfidf_sql(max_df=0.1)} SELECT term, df, round(idf, 6) AS idf FROM idf",
)
def term_idf_low_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, counts = _counts(spark, sf_dir)
    return tfidf.fit_idf(counts, documents, 0.1).withColumn("idf", F.round("idf", 6))


@query("tfidf_scores", f"WITH {tfidf_sql()} SELECT doc_id, term, round(score, 6) AS score FROM scores")
def tfidf_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(spark, sf_dir).select("doc_id", "term", F.round("score", 6).alias("score"))


@query(
    "noun_tfidf",
    f"""
    WITH counts AS (SELECT doc_id, term, sum(occurrences) AS tf FROM ({noun_ngrams_sql('gate')})
                    WHERE term NOT IN ({STOP}) GROUP BY ALL),
    total AS (SELECT count(*) AS n FROM documents),
    idf AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1 AS idf
            FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), total WHERE df <= 0.7 * n)
    SELECT doc_id, term, round(tf * idf / sqrt(sum(tf * idf * tf * idf) OVER (PARTITION BY doc_id)), 6) AS score
    FROM counts JOIN idf USING (term)
    """,
)
def noun_tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain: text, tagged, noun n-grams with the number gate, scores."""
    documents = table(spark, sf_dir, "documents")
    counts = tfidf.without_stop_words(tagging.document_term_counts(_documents(spark, sf_dir), "doc_id", "text"))
    return tfidf.fit_score(counts, documents, "doc_id").select("doc_id", "term", F.round("score", 6).alias("score"))


BENCHMARK_TERMS = f"SELECT DISTINCT term FROM (SELECT unnest({WORDS}) AS term FROM benchmark)"


@query(
    "retain_terms",
    f"WITH {tfidf_sql()} SELECT term, df, round(idf, 6) AS idf FROM idf WHERE term IN ({BENCHMARK_TERMS})",
)
def retain_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, counts = _counts(spark, sf_dir)
    wanted = tagging.word_terms(table(spark, sf_dir, "benchmark"), "item_id", "text")
    return tfidf.retain_terms(tfidf.fit_idf(counts, documents), wanted).withColumn("idf", F.round("idf", 6))


@query(
    "tfidf_renormalised",
    f"""
    WITH {tfidf_sql()},
    again AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1 AS idf2
              FROM (SELECT term, count(*) AS df FROM scores GROUP BY term), total),
    twice AS (SELECT doc_id, term, score * idf2 AS raw FROM scores JOIN again USING (term))
    SELECT doc_id, term, round(raw / sqrt(sum(raw * raw) OVER (PARTITION BY doc_id)), 6) AS score FROM twice
    """,
)
def tfidf_renormalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    again = tfidf.renormalise(_scores(spark, sf_dir), table(spark, sf_dir, "documents"), "doc_id")
    return again.withColumn("score", F.round("score", 6))


@query(
    "tfidf_terms_tagged",
    f"""
    WITH {tfidf_sql()}
    SELECT doc_id, term, round(score, 6) AS score,
           array_to_string(list_transform(string_split(term, ' '), lambda x: x || '/' || {tag_case('x')}), ' ') AS pos_tags
    FROM scores
    """,
)
def tfidf_terms_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = F.transform("pos_tags", lambda t: F.concat_ws("/", t["word"], t["tag"]))
    return tfidf.tag_terms(_scores(spark, sf_dir)).select(
        "doc_id", "term", F.round("score", 6).alias("score"), F.array_join(named, " ").alias("pos_tags")
    )


SIMILAR_SQL = f"""
    WITH {tfidf_sql(CORPUS, 'page')},
    pairs AS (SELECT t.page AS page, s.page AS similar_page, round(sum(t.score * s.score), 9) AS score
              FROM scores t JOIN scores s USING (term)
              WHERE starts_with(t.page, 'b-') AND t.page <> s.page GROUP BY ALL)
    SELECT page, similar_page, round(score, 6) AS score, rank FROM (
      SELECT *, row_number() OVER (PARTITION BY page ORDER BY score DESC, similar_page)::INT AS rank FROM pairs) WHERE rank <= 5
    """


@query("top_similar_pages", SIMILAR_SQL)
def top_similar_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For each benchmark passage the five most similar pages among all documents and passages."""
    texts = corpus(spark, sf_dir)
    counts = tfidf.without_stop_words(tagging.word_counts(texts, "page", "text"))
    scores = materialize(tfidf.fit_score(counts, texts, "page").drop("df"))
    targets = table(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("b-"), F.col("item_id").cast("string")).alias("page")
    )
    found = tfidf.top_similar_pages(scores, targets, "page", 5)
    return found.withColumn("score", F.round("score", 6))


@query(
    "export_head",
    f"WITH {tfidf_sql()} SELECT doc_id, term, round(score, 6) AS score FROM scores ORDER BY doc_id, term LIMIT 10000",
)
def export_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/head-{uuid.uuid4().hex}"
    rounded = _scores(spark, sf_dir).select("doc_id", "term", F.round("score", 6).alias("score"))
    sinks.export_head(rounded, path, ["doc_id", "term"])
    return spark.read.schema("doc_id bigint, term string, score double").option("header", True).csv(path)


@query("cached_artifact", ORACLE["term_idf"])
def cached_artifact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{work_dir(spark)}/idf-{uuid.uuid4().hex}"
    sinks.get_or_build(spark, path, lambda: term_idf(spark, sf_dir))
    return sinks.get_or_build(spark, path, lambda: term_idf(spark, sf_dir))


@query(
    "page_terms",
    r"""
    SELECT page_id, page, len(regexp_extract_all(lower(page_text), '[\p{L}\p{N}_]+'))::INT AS n_words
    FROM (SELECT page_id, split_part(split_part(url, '?', 1), '#', 1) AS page,
                 trim(regexp_replace(regexp_replace(html, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS page_text FROM pages)
    WHERE length(page_text) > 0
    """,
)
def page_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = page_text(spark, sf_dir).where(text.has_text(F.col("page_text")))
    return kept.select("page_id", text.clean_page(F.col("page")).alias("page"), F.size(text.words(F.col("page_text"))).alias("n_words"))

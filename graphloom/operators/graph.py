"""Entity graph: extraction, merging into stored tables, and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import SENTENCE_END, ngrams, unroll, words
from graphloom.session import materialize

MENTIONS = "MENTIONS"
#: Words by which longer names are found.
ANCHOR_WORDS = 3


# --- extraction -------------------------------------------------------------------------------------------------


def entity_mentions(docs: DataFrame, gazetteer: DataFrame, key: str, text: str, max_words: int = 1, name: str = "id") -> DataFrame:
    """Dictionary matches ``(key, sentence, position, id)`` of 1..max_words word runs within a sentence.

    Names are reduced to their words like the text, so punctuation inside a name does not matter; ``name`` is the column
    that holds them, if ids are something else. A sentence is unrolled to one row a word with the words after it, and only
    there runs are put together. The gazetteer joins on the phrase. Spark sends it to every task only when its size allows that.
    """
    after = [f"_w{n}" for n in range(max_words)]
    places = F.transform(
        "tokens", lambda word, at: F.struct(at.alias("position"), word.alias("_w0"), *[F.get("tokens", at + n).alias(after[n]) for n in range(1, max_words)])
    )
    found = sentences_of(docs, key, text).select(key, "sentence", F.inline(places))
    # A run that goes beyond the end of its sentence is null and meets no name.
    runs = [F.concat(*[part for w in after[:n] for part in (F.lit(" "), F.col(w))][1:]) for n in range(1, max_words + 1)]
    found = found.select(key, "sentence", "position", F.explode(F.array(*runs)).alias("phrase"))
    names = gazetteer.select(F.array_join(words(F.col(name)), " ").alias("phrase"), "id").where("phrase != ''")
    return found.join(names, "phrase").select(key, "sentence", "position", "id")


def entity_mentions_long(docs: DataFrame, gazetteer: DataFrame, key: str, text: str) -> DataFrame:
    """The matches of :func:`entity_mentions` for names of any number of words, without unrolling every run.

    Names of more than ``ANCHOR_WORDS`` words are met by their first ones. Only where these stand in a sentence are the
    runs made that such names can have, at most one for each length of a name with that beginning. Sentences are
    tokenised once and written. Rows that repeat a key are matched apart; null texts and names without words give nothing.
    """
    sentences = materialize(sentences_of(docs, key, text).withColumn("_row", F.monotonically_increasing_id()))
    named = gazetteer.select(words(F.col("id")).alias("_words"), "id").withColumn("_n", F.size("_words"))
    starts = F.flatten(
        F.array(*[
            F.transform(ngrams(F.col("tokens"), n), lambda phrase, at: F.struct(phrase.alias("phrase"), at.alias("position")))
            for n in range(1, ANCHOR_WORDS + 1)
        ])
    )
    phrase = F.array_join("_words", " ").alias("phrase")
    short = named.where(F.col("_n").between(1, ANCHOR_WORDS)).select(phrase, "id")
    found = sentences.select(key, "sentence", F.inline(starts)).join(short, "phrase").select(key, "sentence", "position", "id")

    long_names = named.where(F.col("_n") > ANCHOR_WORDS)
    anchors = long_names.groupBy(F.array_join(F.slice("_words", 1, ANCHOR_WORDS), " ").alias("phrase")).agg(F.collect_set("_n").alias("_lengths"))
    runs = sentences.select("_row", F.posexplode(ngrams(F.col("tokens"), ANCHOR_WORDS)).alias("position", "phrase"))
    hits = runs.join(anchors, "phrase").groupBy("_row").agg(F.collect_list(F.struct("position", "_lengths")).alias("_hits"))

    def run(at: Column, n: Column) -> Column:
        text_of = F.when(at + n <= F.size("tokens"), F.array_join(F.slice("tokens", at + 1, n), " "))
        return F.struct(at.alias("position"), text_of.alias("phrase"))

    made = F.flatten(F.transform("_hits", lambda h: F.transform(h["_lengths"], lambda n: run(h["position"], n))))
    tried = sentences.join(hits, "_row").select(key, "sentence", F.inline(made)).where("phrase IS NOT NULL")
    return found.unionByName(tried.join(long_names.select(phrase, "id"), "phrase").select(key, "sentence", "position", "id"))


def sentences_of(docs: DataFrame, key: str, text: str) -> DataFrame:
    parts = unroll(docs, [key], F.split(F.col(text), SENTENCE_END), "_part", "sentence")
    return parts.select(key, "sentence", words(F.col("_part")).alias("tokens"))


def cooccurrence_edges(mentions: DataFrame, key: str) -> DataFrame:
    """``(src, type, dst, weight)``: every pair of distinct entities of a sentence, weighted by their common sentences.

    ``src < dst``. A sentence's entities are one sorted list, from which its pairs are unrolled in place; the list is
    as long as the sentence has distinct entities.
    """
    listed = mentions.groupBy(key, "sentence").agg(F.sort_array(F.collect_set("id")).alias("_ids"))
    heads = listed.select("_ids", F.posexplode("_ids").alias("_at", "src"))
    pairs = heads.select("src", F.explode(F.slice("_ids", F.col("_at") + 2, F.size("_ids"))).alias("dst"))
    return (
        pairs.groupBy("src", "dst")
        .agg(F.count(F.lit(1)).alias("weight"))
        .select("src", F.lit("CO_OCCURS").alias("type"), "dst", "weight")
    )


def numbered(names: DataFrame) -> DataFrame:
    """``(id, name)``: names numbered in their order, gaps between. Numbers are compared, hashed and moved at less cost."""
    return materialize(names.select(F.col("id").alias("name")).orderBy("name").select(F.monotonically_increasing_id().alias("id"), "name"))


def named_edges(edges: DataFrame, names: DataFrame) -> DataFrame:
    """Edges between numbers as edges between the names of :func:`numbered`, in whose order ``src < dst`` still holds."""
    heads, tails = (names.select(F.col("id").alias(end), F.col("name").alias(f"_{end}")) for end in ("src", "dst"))
    named = edges.join(heads, "src").join(tails, "dst")
    return named.select(*[F.col(f"_{c}" if c in ("src", "dst") else c).alias(c) for c in edges.columns])


def extract_graph(docs: DataFrame, gazetteer: DataFrame, key: str, text: str, max_words: int = 1) -> dict[str, DataFrame]:
    """Nodes, edges and document mentions of a document table, ready for :func:`upsert_graph`."""
    mentions = entity_mentions(docs, gazetteer, key, text, max_words)
    edges = cooccurrence_edges(mentions, key).select("src", "type", "dst", F.lit(None).cast("string").alias("description"))
    pairs = mentions.select(F.col(key).alias("doc_id"), F.col("id").alias("entity_id")).distinct()
    nodes = gazetteer.join(pairs.select(F.col("entity_id").alias("id")).distinct(), "id", "left_semi")
    return {
        "nodes": nodes.select("id", "type", "description"),
        "edges": edges,
        "documents": docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")),
        "mentions": pairs,
    }


# --- stored graph -----------------------------------------------------------------------------------------------


def _first(column: str, order: str) -> Column:
    """First non-null value in a stated order."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.col(order))).alias(column)


def upsert_nodes(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """One row per entity id. Values already stored win; a missing value is filled from the newcomers."""
    stacked = new.withColumn("_seq", F.lit(1))
    if old is not None:
        stacked = old.select("id", "type", "description").withColumn("_seq", F.lit(0)).unionByName(stacked)
    ordered = stacked.withColumn("_order", F.struct("_seq", F.coalesce("type", F.lit("")), F.coalesce("description", F.lit(""))))
    return ordered.groupBy("id").agg(_first("type", "_order"), _first("description", "_order"))


def upsert_edges(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """One row per (src, type, dst)."""
    stacked = new.select("src", "type", "dst", "description").withColumn("_seq", F.lit(1))
    if old is not None:
        stacked = old.select("src", "type", "dst", "description").withColumn("_seq", F.lit(0)).unionByName(stacked)
    ordered = stacked.withColumn("_order", F.struct("_seq", F.coalesce("description", F.lit(""))))
    return ordered.groupBy("src", "type", "dst").agg(_first("description", "_order"))


def upsert_mentions(old: DataFrame | None, new: DataFrame) -> DataFrame:
    new = new.select("doc_id", "entity_id")
    return (new if old is None else old.select("doc_id", "entity_id").union(new)).distinct()


def upsert_documents(old: DataFrame | None, new: DataFrame) -> DataFrame:
    stacked = new.select("doc_id", "text").withColumn("_seq", F.lit(1))
    if old is not None:
        stacked = old.select("doc_id", "text").withColumn("_seq", F.lit(0)).union(stacked)
    return stacked.groupBy("doc_id").agg(F.min_by("text", F.struct("_seq", "text")).alias("text"))


def upsert_graph(
    old: dict[str, DataFrame] | None, new: dict[str, DataFrame], include_source: bool = True
) -> dict[str, DataFrame]:
    """Merge extracted tables into the stored ones; documents and mentions only when sources are included."""
    old = old or {}
    merged = {
        "nodes": upsert_nodes(old.get("nodes"), new["nodes"]),
        "edges": upsert_edges(old.get("edges"), new["edges"]),
    }
    if include_source:
        merged["documents"] = upsert_documents(old.get("documents"), new["documents"])
        merged["mentions"] = upsert_mentions(old.get("mentions"), new["mentions"])
    return merged


def write_graph(graph: dict[str, DataFrame], path: str) -> None:
    """Write each graph table under ``path``; read it back with ``spark.read.parquet(f"{path}/<table>")``."""
    for name, frame in graph.items():
        frame.write.mode("overwrite").parquet(f"{path}/{name}")


def write_property(nodes: DataFrame, values: DataFrame, key: str, name: str, insert: bool = False) -> DataFrame:
    """Put ``values.name`` on the nodes with the same key; a node without a new value keeps its old one.

    With ``insert`` keys that no node has become new rows. A key with several values gets the smallest, so that no
    node is ever repeated.
    """
    fresh = values.groupBy(key).agg(F.min(name).alias("_new"))
    joined = nodes.join(fresh, key, "full_outer" if insert else "left")
    kept = F.coalesce(F.col("_new"), F.col(name)) if name in nodes.columns else F.col("_new")
    return joined.withColumn(name, kept).drop("_new")


def key_violations(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """The frame itself; raises when a key repeats."""
    bad = key_violations(df, key).limit(5).collect()
    if bad:
        raise ValueError(f"{key} is not unique: {[row[key] for row in bad]}")
    return df


# --- statistics -------------------------------------------------------------------------------------------------


def entities_per_document(documents: DataFrame, mentions: DataFrame) -> DataFrame:
    """``(doc_id, entity_count)``, documents without entities included. Counted before the join."""
    counts = mentions.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_count"))
    return documents.join(counts, "doc_id", "left").select(
        "doc_id", F.coalesce("_count", F.lit(0)).alias("entity_count")
    )


def linear_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Least-squares line of ``y`` on ``x``, one row."""
    return df.agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def node_degree(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Undirected degree over all relationships but MENTIONS; a self-loop counts once, lonely nodes count zero."""
    related = edges.where(F.col("type") != MENTIONS)
    ends = related.select(
        F.explode(
            F.when(F.col("src") == F.col("dst"), F.array("src")).otherwise(F.array("src", "dst"))
        ).alias("id")
    )
    degree = ends.groupBy("id").agg(F.count(F.lit(1)).alias("_degree"))
    return nodes.select("id").join(degree, "id", "left").select("id", F.coalesce("_degree", F.lit(0)).alias("degree"))


def distribution(df: DataFrame, column: str, points: tuple[float, ...] = (0.25, 0.5, 0.75, 0.9)) -> DataFrame:
    """Mean and interpolated percentiles, one row.

    Exact: the counts are of distinct values, so partial results stay small for degrees and token counts.
    """
    stats = df.agg(
        F.avg(column).alias("mean"), F.percentile(column, F.array(*[F.lit(p) for p in points])).alias("_p")
    )
    return stats.select("mean", *[F.col("_p")[i].alias(f"p{int(p * 100)}") for i, p in enumerate(points)])


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """``(bin, low, high, n)`` for equal bins from minimum to maximum, empty ones included; the maximum falls in the
    last bin.

    Values are counted before they are placed, so the second pass reads one row per distinct value.
    """
    values = df.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("double").alias("_x")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    limits = values.agg(
        F.min("_x").alias("lo"), ((F.max("_x") - F.min("_x")) / F.lit(float(bins))).alias("width")
    )
    placed = values.withColumn("_b", limits.select(F.struct("lo", "width")).scalar())
    # A constant column has no width: its first bin holds everything.
    place = F.when(F.col("_b.width") == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_x") - F.col("_b.lo")) / F.col("_b.width")), F.lit(bins - 1))
    )
    counted = placed.groupBy(place.cast("int").alias("bin")).agg(F.sum("_n").alias("_count"))
    edges = limits.where(F.col("lo").isNotNull()).select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", "width"
    )
    return edges.join(counted, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("low"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("high"),
        F.coalesce("_count", F.lit(0)).alias("n"),
    )


def description_coverage(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Total and described counts of nodes and of relationships."""
    parts = [
        frame.agg(
            F.count(F.lit(1)).alias("total_count"), F.count("description").alias("non_null_descriptions")
        ).select(F.lit(name).alias("type"), "total_count", "non_null_descriptions")
        for name, frame in (("node", nodes), ("relationship", edges.where(F.col("type") != MENTIONS)))
    ]
    return parts[0].unionAll(parts[1])


def undirected_weights(edges: DataFrame) -> DataFrame:
    """``(src, dst, weight)`` with ``src <= dst`` and the number of parallel edges as weight."""
    return edges.groupBy(F.least("src", "dst").alias("src"), F.greatest("src", "dst").alias("dst")).agg(
        F.count(F.lit(1)).alias("weight")
    )

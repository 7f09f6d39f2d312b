"""Column expressions over page and article text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Token patterns. Unicode classes are spelled out because \w is ASCII-only by default.
WORD_PATTERN = r"[\p{L}\p{N}_]+"
TOKEN_PATTERN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"
SENTENCE_END = r"[.!?\n]+"
TAG_PATTERN = r"<[^>]*>"
SPACE_PATTERN = r"\s+"


def clean_page(url: Column) -> Column:
    """URL up to its first ``?``, then up to its first ``#``; null stays null."""
    return F.split_part(F.split_part(url, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1))


def has_suffix(url: Column, suffix: str = ".pdf") -> Column:
    """Suffix test where a null URL counts as no match."""
    return F.coalesce(url.endswith(suffix), F.lit(False))


def has_text(text: Column) -> Column:
    return F.length(text) > 0


def title_and_text(title: Column, text: Column) -> Column:
    return F.concat_ws(" ", title, text)


def token_count(text: Column) -> Column:
    """Words plus single punctuation marks. Not a model's subword count."""
    return F.size(F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0)))


def words(text: Column) -> Column:
    """Lowercased word list in text order."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), F.lit(0))


def unroll(df: DataFrame, keep: list[str], items: Column, name: str, position: str | None = None) -> DataFrame:
    """One row per list item, with the columns to keep and, on request, the item's position.

    The outer form avoids the size test that Spark puts before a plain explode, which would evaluate the list again.
    """
    if position is None:
        rows = df.select(*keep, F.explode_outer(items).alias(name))
    else:
        rows = df.select(*keep, F.posexplode_outer(items).alias(position, name))
    return rows.where(F.col(name).isNotNull())


def counted(df: DataFrame, keep: list[str], items: Column, name: str, count: str) -> DataFrame:
    """One row per distinct item of each row's list and how often it occurs there. No row leaves its task.

    Equal items lie side by side in the sorted list, so memory is bounded by one list, not by the rows of a task.
    """
    lists = df.select(*keep, F.sort_array(items).alias("_sorted"))
    places = F.when(F.size("_sorted") > 0, F.sequence(F.lit(1), F.size("_sorted")))
    last = F.filter(places, lambda i: ~F.get("_sorted", i).eqNullSafe(F.get("_sorted", i - 1)))
    lists = lists.withColumn("_ends", last)
    runs = F.transform(
        "_ends",
        lambda e, k: F.struct(
            F.get("_sorted", e - 1).alias(name), (e - F.coalesce(F.get("_ends", k - 1), F.lit(0))).cast("long").alias(count)
        ),
    )
    return unroll(lists, keep, runs, "_run").select(*keep, f"_run.{name}", f"_run.{count}")


def strip_markup(html: Column) -> Column:
    """Page text: tags replaced by spaces, white space collapsed."""
    return F.trim(F.regexp_replace(F.regexp_replace(html, TAG_PATTERN, " "), SPACE_PATTERN, " "))


def ngrams(tokens: Column, n: int) -> Column:
    """All runs of ``n`` neighbouring tokens, joined by a space, in order; empty when there are fewer.

    Pass a column of a frame, not an expression: the list is read once per run.
    """
    starts = F.when(F.size(tokens) >= n, F.sequence(F.lit(1), F.size(tokens) - (n - 1)))
    if n == 1:
        grams = F.transform(starts, lambda i: F.coalesce(F.get(tokens, i - 1), F.lit("")))
    else:
        grams = F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(tokens, i + (k - 1)) for k in range(n)]))
    return F.coalesce(grams, F.array().cast("array<string>"))


def all_ngrams(tokens: Column, max_n: int = 3) -> Column:
    """All 1-grams, then all 2-grams and so on; duplicates kept."""
    return F.concat(*[ngrams(tokens, n) for n in range(1, max_n + 1)])

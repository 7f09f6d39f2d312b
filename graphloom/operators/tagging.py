"""Part-of-speech tagging by lexicon and suffix rules, and noun n-grams.

Everything up to the n-gram list stays inside the document's own row: no shuffle.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.functions.text import all_ngrams, counted, unroll, words
from graphloom.functions.wordlists import CLOSED_CLASS_TAGS, SUFFIX_TAGS
from graphloom.operators.pages import apart

# Tags whose words leave before n-grams are built, and the tags the n-gram rules look at.
DROPPED_TAGS = ("VB", "SP", "RB", "Co")
NUMBER_TAG = "CD"
NOUN_TAG = "NN"
INLINE_LEXICON_ROWS = 5_000


def suffix_tag(word: Column, rules: list[tuple[str, str]] = SUFFIX_TAGS, number=NUMBER_TAG, noun=NOUN_TAG) -> Column:
    """Digits are numbers; otherwise the first suffix rule that fits; otherwise a noun."""
    # Words below ":" begin with a digit or less: the pattern runs on those only.
    tag = F.when((word < ":") & word.rlike("^[0-9]+$"), F.lit(number))
    for suffix, name in rules:
        tag = tag.when(word.endswith(suffix), F.lit(name))
    return tag.otherwise(F.lit(noun))


def lexicon_tag(
    word: Column, lexicon: dict[str, list[str]] = CLOSED_CLASS_TAGS, rules: list[tuple[str, str]] = SUFFIX_TAGS,
    number=NUMBER_TAG, noun=NOUN_TAG,
) -> Column:
    """Tag of a single word from hash-set membership tests: one for the whole lexicon, then one per tag."""
    if not lexicon:
        return suffix_tag(word, rules, number, noun)
    known = F
    for name, members in lexicon.items():
        known = known.when(word.isin(members), F.lit(name))
    everything = [member for members in lexicon.values() for member in members]
    return F.when(word.isin(everything), known).otherwise(suffix_tag(word, rules, number, noun))


def tagged(tokens: Column, lexicon: dict[str, list[str]] = CLOSED_CLASS_TAGS, rules=SUFFIX_TAGS) -> Column:
    """Token list to a list of (word, tag)."""
    return F.transform(tokens, lambda w: F.struct(w.alias("word"), lexicon_tag(w, lexicon, rules).alias("tag")))


def tag_tokens(
    df: DataFrame, key: str, tokens: str, lexicon: DataFrame | None = None, rules: list[tuple[str, str]] = SUFFIX_TAGS
) -> DataFrame:
    """Add ``tagged``: a list of (word, tag) beside the token list.

    A word with several tags has the smallest. A lexicon table of at most ``INLINE_LEXICON_ROWS`` rows is read into the expression; a larger one is joined on the
    word, each document sending every distinct word once.
    """
    if lexicon is None:
        return df.withColumn("tagged", tagged(F.col(tokens), rules=rules))
    lexicon = lexicon.where("word IS NOT NULL AND tag IS NOT NULL").groupBy("word").agg(F.min("tag").alias("tag"))
    head = lexicon.select("word", "tag").limit(INLINE_LEXICON_ROWS + 1).collect()
    if len(head) <= INLINE_LEXICON_ROWS:
        by_tag: dict[str, list[str]] = defaultdict(list)
        for row in sorted(head):
            by_tag[row.tag].append(row.word)
        return df.withColumn("tagged", tagged(F.col(tokens), dict(by_tag), rules))
    vocabulary = unroll(df, [key], F.array_distinct(tokens), "word")
    known = (
        vocabulary.join(lexicon.select("word", "tag"), "word")
        .groupBy(key)
        .agg(F.map_from_entries(F.collect_list(F.struct("word", "tag"))).alias("_known"))
    )
    pair = lambda w: F.struct(
        w.alias("word"),
        F.coalesce(F.try_element_at(F.col("_known"), w), suffix_tag(w, rules)).alias("tag"),
    )
    known = known.withColumnRenamed(key, "_key")
    return df.join(known, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key").withColumn("tagged", F.transform(tokens, pair)).drop("_known")


def tags_of(tokens: Column, lexicon: dict[str, list[str]] = CLOSED_CLASS_TAGS, rules=SUFFIX_TAGS) -> Column:
    """Token list to its list of tags."""
    return F.transform(tokens, lambda w: lexicon_tag(w, lexicon, rules))


def _noun_gram_lists(
    df: DataFrame, key: str, max_n: int, number_factor: int | None, dropped_tags: tuple[str, ...]
) -> tuple[DataFrame, list[Column]]:
    """Rows with a document's kept words, and for each length the expression of its list of n-grams."""
    kept = F.filter("tagged", lambda t: ~t["tag"].isin(*dropped_tags))
    numbers = F.size(F.filter("tagged", lambda t: t["tag"] == NUMBER_TAG))
    base = df.select(key, kept.alias("_kept"), numbers.alias("_numbers"))
    base = base.withColumn("_words", F.transform("_kept", lambda t: t["word"]))

    def grams(n: int) -> Column:
        ends = F.when(F.size("_kept") >= n, F.sequence(F.lit(n), F.size("_kept")))
        ends = F.filter(ends, lambda e: F.get(F.col("_kept"), e - 1)["tag"].endswith(NOUN_TAG))
        made = F.transform(ends, lambda e: F.array_join(F.slice(F.col("_words"), e - (n - 1), n), " "))
        made = F.coalesce(made, F.array().cast("array<string>"))
        if number_factor is None:
            return made
        return F.when(F.lit(n) <= F.col("_numbers") * number_factor, made).otherwise(F.array().cast("array<string>"))

    return base, [grams(n) for n in range(1, max_n + 1)]


def noun_ngrams(
    df: DataFrame,
    key: str,
    max_n: int = 3,
    number_factor: int | None = 2,
    dropped_tags: tuple[str, ...] = DROPPED_TAGS,
) -> DataFrame:
    """One row per kept n-gram occurrence: ``(key, term, n)``.

    Words with a dropped tag leave first, so n-grams bridge them. Kept are n-grams whose last tag ends with NN and,
    unless ``number_factor`` is None, whose length is at most that factor times the document's count of numbers.
    """
    base, lists = _noun_gram_lists(df, key, max_n, number_factor, dropped_tags)

    def sized(grams: Column, n: int) -> Column:
        return F.transform(grams, lambda g: F.struct(g.alias("term"), F.lit(n).alias("n")))

    grams = F.concat(*[sized(made, n) for n, made in enumerate(lists, 1)])
    return unroll(base, [key], grams, "_gram").select(key, "_gram.term", "_gram.n")


def noun_ngram_counts(
    df: DataFrame,
    key: str,
    max_n: int = 3,
    number_factor: int | None = 2,
    dropped_tags: tuple[str, ...] = DROPPED_TAGS,
) -> DataFrame:
    """The n-grams of :func:`noun_ngrams` as ``(key, term, tf)``, counted in each row; rows of one key are not added up."""
    base, lists = _noun_gram_lists(df, key, max_n, number_factor, dropped_tags)
    return counted(base, [key], F.concat(*lists), "term", "tf")


def document_terms(
    df: DataFrame,
    key: str,
    text: str,
    max_n: int = 3,
    number_factor: int | None = 2,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Text to noun n-gram occurrences: tokenise, tag, filter."""
    tokens = df.select(key, words(F.col(text)).alias("tokens"))
    return noun_ngrams(tag_tokens(tokens, key, "tokens", lexicon), key, max_n, number_factor)


def document_term_counts(
    df: DataFrame,
    key: str,
    text: str,
    max_n: int = 3,
    number_factor: int | None = 2,
    lexicon: DataFrame | None = None,
) -> DataFrame:
    """Text to noun n-grams with their counts ``(key, term, tf)``; rows that share a key are added up."""

    def made(part: DataFrame) -> DataFrame:
        tokens = part.select(key, words(F.col(text)).alias("tokens"))
        return noun_ngram_counts(tag_tokens(tokens, key, "tokens", lexicon), key, max_n, number_factor)

    return counts_by_key(df, key, made)


def counts_by_key(documents: DataFrame, key: str, made: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``(key, term, tf)`` of documents from ``made``, which counts in each row; only rows that share a key meet."""
    single, shared = apart(documents, key)
    counts = made(single)
    if shared is None:
        return counts
    return counts.unionByName(made(shared).groupBy(key, "term").agg(F.sum("tf").alias("tf")))


def word_counts(df: DataFrame, key: str, text: str) -> DataFrame:
    """Plain words with their counts ``(key, term, tf)``; rows that share a key are added up."""
    return counts_by_key(df, key, lambda part: counted(part, [key], words(F.col(text)), "term", "tf"))


def phrase_counts(df: DataFrame, key: str, text: str, max_n: int = 3) -> DataFrame:
    """Runs of one to ``max_n`` words with their counts ``(key, term, tf)``; rows that share a key are added up."""

    def made(part: DataFrame) -> DataFrame:
        tokens = part.select(key, words(F.col(text)).alias("tokens"))
        return counted(tokens, [key], all_ngrams(F.col("tokens"), max_n), "term", "tf")

    return counts_by_key(df, key, made)


def noun_run_counts(
    df: DataFrame, key: str, text: str, max_n: int = 3, dropped_tags: tuple[str, ...] = DROPPED_TAGS
) -> DataFrame:
    """As :func:`phrase_counts`, but only the runs that can be a term of :func:`noun_ngrams` of any document.

    A word's tag depends on the word alone, so these are the runs that end in a noun and hold no word with a dropped tag.
    """

    def made(part: DataFrame) -> DataFrame:
        tokens = part.select(key, words(F.col(text)).alias("tokens"))
        base = tokens.select(key, "tokens", tags_of(F.col("tokens")).alias("_tags"))
        base = base.withColumn("_held", F.transform("_tags", lambda t: ~t.isin(*dropped_tags)))

        def runs(n: int) -> Column:
            def named(e: Column) -> Column:
                fits = F.get(F.col("_tags"), e - 1).endswith(NOUN_TAG)
                for back in range(1, n + 1):
                    fits = fits & F.get(F.col("_held"), e - back)
                return fits

            ends = F.when(F.size("tokens") >= n, F.sequence(F.lit(n), F.size("tokens")))
            made = F.transform(F.filter(ends, named), lambda e: F.array_join(F.slice(F.col("tokens"), e - (n - 1), n), " "))
            return F.coalesce(made, F.array().cast("array<string>"))

        return counted(base, [key], F.concat(*[runs(n) for n in range(1, max_n + 1)]), "term", "tf")

    return counts_by_key(df, key, made)


def accepted_phrases(
    df: DataFrame, keep: list[str], text: str, accept: Callable[[Column], Column], max_n: int = 3,
    lexicon: dict[str, list[str]] = CLOSED_CLASS_TAGS, rules: list[tuple[str, str]] = SUFFIX_TAGS,
) -> DataFrame:
    """``(*keep, sequence)``: the runs of one to ``max_n`` words whose tag list is accepted, each once a row.

    A word is tagged once, by its tag's number. There are few lists of so many tags: the test is made once for each of them, and
    a run looks its list up. Only accepted runs are put together.
    """
    names = sorted({NUMBER_TAG, NOUN_TAG, *lexicon, *(tag for _, tag in rules)})
    number = {name: at for at, name in enumerate(names)}
    tag = lambda w: lexicon_tag(
        w, {number[t]: members for t, members in lexicon.items()}, [(suffix, number[t]) for suffix, t in rules], number[NUMBER_TAG], number[NOUN_TAG]
    )
    tokens = df.select(*keep, words(F.col(text)).alias("_tokens"))
    base = tokens.select(*keep, "_tokens", F.transform("_tokens", tag).alias("_codes"))

    def code(at: Callable[[int], Column], n: int) -> Column:
        out = at(0)
        for k in range(1, n):
            out = out * len(names) + at(k)
        return out

    def runs(n: int) -> Column:
        lists = df.sparkSession.range(len(names) ** n).select(
            "id", F.array(*[F.get(F.split(F.lit(",".join(names)), ","), (F.expr(f"id div {len(names) ** (n - 1 - k)}") % len(names)).cast("int")) for k in range(n)]).alias("tags")
        )
        wanted = {row.id for row in lists.where(accept(F.col("tags"))).collect()}
        known = F.split(F.lit(",".join(str(int(i in wanted)) for i in range(len(names) ** n))), ",")
        starts = F.when(F.size("_tokens") >= n, F.sequence(F.lit(0), F.size("_tokens") - n))
        fits = F.filter(starts, lambda i: F.get(known, code(lambda k: F.get("_codes", i + k), n)) == "1")
        made = F.transform(fits, lambda i: F.concat_ws(" ", *[F.get("_tokens", i + k) for k in range(n)]))
        return F.coalesce(made, F.array().cast("array<string>"))

    return unroll(base, keep, F.array_distinct(F.concat(*[runs(n) for n in range(1, max_n + 1)])), "sequence")


def word_terms(df: DataFrame, key: str, text: str) -> DataFrame:
    """Plain word occurrences ``(key, term)``."""
    return unroll(df, [key], words(F.col(text)), "term")

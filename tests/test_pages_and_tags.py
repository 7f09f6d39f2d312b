from pyspark.sql import functions as F

from graphloom.functions import pos, text
from graphloom.operators import pages, tagging


def test_latest_takes_newest_with_text_and_breaks_ties(spark, rows):
    df = spark.createDataFrame(
        [("a", "2024-01-01", 1, "x"), ("a", "2024-01-02", 3, "y"), ("a", "2024-01-02", 2, "z"), ("a", "2024-02-01", 4, ""),
         ("b", "2024-01-01", 5, None)],
        "page string, date string, id int, text string",
    )
    assert rows(pages.latest_per_key(df, "page", "date", "id", "text"), "page", "id") == [("a", 2)]


def test_dedup_after_cleaning(spark, rows):
    df = spark.createDataFrame([("http://a/x?p=1", 2), ("http://a/x#top", 1), ("http://a/y#b?c", 3), (None, 4)], "page string, id int")
    assert rows(pages.dedup_clean_pages(df, "page", "id")) == [("http://a/x", 1), ("http://a/y", 3), (None, 4)]


def test_suffix_filter(spark, rows):
    df = spark.createDataFrame([("a.pdf",), ("a.PDF",), ("a.pdf?x=1",), (None,)], "page string")
    assert rows(df.where(text.has_suffix(F.col("page")))) == [("a.pdf",)]
    assert df.select(text.has_suffix(F.col("page")).alias("s")).where("s is null").count() == 0


def test_tokens_of_other_alphabets(spark):
    row = spark.createDataFrame([("Straße, señal élan_1!",)], "t string").select(
        text.words(F.col("t")).alias("w"), text.token_count(F.col("t")).alias("n")
    ).first()
    assert row.w == ["straße", "señal", "élan_1"] and row.n == 5


def test_title_and_text_skips_null(spark):
    row = spark.createDataFrame([(None, "b")], "a string, b string").select(text.title_and_text(F.col("a"), F.col("b")).alias("c")).first()
    assert row.c == "b"


def test_ngrams_order_and_short_lists(spark):
    row = spark.createDataFrame([(["a", "b", "a"], ["x"], [])], "l array<string>, s array<string>, e array<string>").select(
        text.all_ngrams(F.col("l")).alias("l"), text.all_ngrams(F.col("s")).alias("s"), text.all_ngrams(F.col("e")).alias("e")
    ).first()
    assert row.l == ["a", "b", "a", "a b", "b a", "a b a"] and row.s == ["x"] and row.e == []


CASES = [
    (["VBN", "NN"], set()),
    (["VB", "NN"], {"starts_verb"}),
    (["VBN", "NN", "NN"], {"starts_verb"}),
    (["_SP", "NN"], {"starts_space"}),
    ([":", "NNS"], {"starts_colon"}),
    (["RBR", "NN"], {"starts_adverb"}),
    (["€", "NNP"], {"bad_char"}),
    (["NN"], {"bad_length"}),
    (["NNP"], {"bad_length"}),
    (["NNPS"], set()),
    (["CD", "NN"], {"bad_cd_ratio"}),
    (["CD", "NN", "NN"], set()),
    (["NN", "NN", "JJ"], set()),
    ([], {"bad_length"}),
]


def test_predicates(spark):
    df = spark.createDataFrame([(i, tags) for i, (tags, _) in enumerate(CASES)], "i int, tags array<string>")
    flags = [test(F.col("tags")).alias(name) for name, test in pos.REMOVAL_FLAGS.items()]
    for row in df.select("i", pos.ends_with_noun(F.col("tags")).alias("noun"), pos.is_noun_phrase(F.col("tags")).alias("keep"), *flags).collect():
        tags, wanted = CASES[row.i]
        assert {name for name in pos.REMOVAL_FLAGS if row[name]} == wanted, tags
        noun = bool(tags) and tags[-1].startswith("NN")
        assert bool(row.noun) == noun and row.keep == (noun and not wanted), tags


def test_final_number_check(spark, rows):
    df = spark.createDataFrame(
        [(1, True, ["CD", "NN"], "24 hours", "http://a/24-hours"), (2, True, ["CD", "NN"], "24 hours", "http://a/none"),
         (3, True, ["CD", "CD"], "1 2", "http://a/1-2"), (4, False, ["NN", "NN"], "a b", "http://a/a-b"),
         (5, True, ["CD", "NNS"], "24 Hours", "http://a/24-hours")],
        "id int, bad boolean, tags array<string>, seq string, page string",
    )
    check = pos.final_number_check(F.col("bad"), F.col("tags"), F.col("seq"), F.col("page"))
    assert rows(df.select("id", check.alias("c"))) == [(1, False), (2, True), (3, True), (4, False), (5, True)]


def tagged(spark, pairs):
    return spark.createDataFrame([(k, list(p)) for k, p in pairs], "id int, tagged array<struct<word:string,tag:string>>")


def test_number_gate(spark, rows):
    body = [("big", "JJ"), ("run", "VB"), ("dogs", "NNS"), ("house", "NN")]
    df = tagged(spark, [(0, body), (1, body + [("1", "CD")]), (2, body + [("1", "CD"), ("2", "CD")])])
    gated = tagging.noun_ngrams(df, "id")
    # The dropped verb is bridged, NNS does not end a phrase.
    assert rows(gated) == [
        (1, "dogs house", 2), (1, "house", 1),
        (2, "big dogs house", 3), (2, "dogs house", 2), (2, "house", 1),
    ]
    assert rows(tagging.noun_ngrams(df, "id", number_factor=None).where("id = 0"), "term") == [("big dogs house",), ("dogs house",), ("house",)]


def test_lexicon_join_equals_inline(spark, rows, monkeypatch):
    tokens = spark.createDataFrame([(1, ["the", "dog", "ran", "the", "12"]), (2, ["dog"]), (3, [])], "id int, tokens array<string>")
    lexicon = spark.createDataFrame([("the", "DT"), ("ran", "VBD")], "word string, tag string")
    inline = rows(tagging.tag_tokens(tokens, "id", "tokens", lexicon))
    monkeypatch.setattr(tagging, "INLINE_LEXICON_ROWS", 1)
    assert rows(tagging.tag_tokens(tokens, "id", "tokens", lexicon)) == inline
    assert [t.tag for t in inline[0][2]] == ["DT", "NN", "VBD", "DT", "CD"]

"""Run hashes and minimisers against plain code, columns with the operators' own names and types, repeated rows."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from graphloom.llm import common, packing, pii, quality, substrings

LONG = " ".join(f"w{i}" for i in range(120))
INNER = ["_found", "_new", "_id", "_of", "_doc", "_key", "_text", "_spans", "_picked", "_row", "_quality", "_statistics", "statistics", "quality"]


def _odd(frame):
    """Extra columns under the names in use, of types that are not plain numbers or texts."""
    kinds = [
        F.array(F.lit("a")), F.lit("2024-01-01").cast("date"), F.lit(1.5).cast("float"), F.struct(F.lit(1).alias("x")),
        F.lit("2024-01-01 00:00:00").cast("timestamp"), F.create_map(F.lit("k"), F.lit(1)), F.lit(3).cast("decimal(10,2)"),
    ]
    return frame.select("*", *[kinds[i % len(kinds)].alias(name) for i, name in enumerate(INNER)])


@pytest.mark.parametrize("width", [1, 5, 50])
def test_run_hashes_are_those_of_plain_code(width):
    rng = np.random.default_rng(width)
    for n in (0, 1, width, 200, 20000):
        hashes = rng.integers(0, 2**63, n).astype(np.uint64)
        found = common.rolling(hashes, width)
        wanted = []
        for i in range(max(0, min(n, 400) - width + 1)):
            total = 0
            for h in hashes[i : i + width].tolist():
                total = (total * common._BASE + h) % 2**64
            wanted.append(total)
        assert len(found) == max(0, n - width + 1)
        assert found[: len(wanted)].tolist() == common.mix64(np.array(wanted, np.uint64)).tolist()


@pytest.mark.parametrize("span", [1, 2, 46])
def test_least_places(span):
    rng = np.random.default_rng(span)
    for n in (span, span + 1, 500, substrings.LONGEST + span - 1):
        hashes = rng.integers(0, 2**62, n).astype(np.uint64)
        hashes[rng.integers(0, n, n // 2)] = 7
        found = substrings._least_places(hashes, span)
        assert found.tolist() == [i + int(hashes[i : i + span].argmin()) for i in range(n - span + 1)]


def test_windows_do_not_cross_strings():
    strings = [b" ".join(b"%d" % (i * k) for i in range(n)) for k, n in ((1, 50), (2, 73), (1, 50), (3, 99))]
    a, b, counts = substrings.window_hashes(strings, 50)
    assert counts.tolist() == [1, 24, 1, 50] and a[0] == a[25] and b[0] == b[25] and len(set(a.tolist())) == 75


def test_columns_of_any_name_and_type_stay(spark):
    rows = [(1, f"mail a.b1@c.de {LONG}"), (2, LONG), (2, LONG), (3, None), (None, "x")]
    docs = _odd(spark.createDataFrame(rows, "doc_id long, text string"))
    hidden = pii.pseudonymise(docs, key="k")
    assert hidden.schema == docs.schema
    for r in hidden.collect():
        assert r["_found"] == ["a"] and "a.b1@" not in str(r)
    stripped = substrings.strip_repeats(docs)
    assert stripped.columns == docs.columns and [f.dataType for f in stripped.schema] == [f.dataType for f in docs.schema]
    own = lambda frame: sorted(str([r[n] for n in INNER]) for r in frame.collect())
    assert own(stripped) == own(docs) and sorted(r.text or "" for r in stripped.collect() if r.doc_id == 2) == ["", ""]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns, name
        assert stage(spark, docs.where("false"), "/root/testdata/sf0.001").count() == 0, name


def test_keys_of_pseudonyms(spark):
    docs = spark.createDataFrame([(i, "call 4111 1111 1111 1111") for i in range(3)], "doc_id long, text string")
    one, two, drawn = (pii.pseudonymise(docs, key=key) for key in ("a", "b", None))
    texts = [{r.text for r in frame.collect()} for frame in (one, two, drawn)]
    assert [len(t) for t in texts] == [1, 1, 1] and len(set.union(*texts)) == 3


def test_equal_rows_of_one_id_are_linear(spark):
    docs = spark.createDataFrame([(7, LONG)] * 500 + [(9, "a " + LONG)] * 500 + [(9, LONG + " b")], "doc_id long, text string")
    found = substrings.digests(docs).groupBy("doc_id", "n_words", "n_removed").count().collect()
    assert {tuple(r) for r in found} == {(7, 120, 0, 500), (9, 121, 120, 501)}


def test_dedup_stage_keeps_one_row_of_an_id(spark):
    rows = [(1, LONG), (1, LONG), (2, LONG + " x"), (3, "other"), (3, None), (None, "n"), (None, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("_picked", F.lit("own"))
    kept = corpus_pipeline.keep_one_of_each(spark, docs, "")
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("1", LONG), ("3", "other"), ("None", "n"), ("None", "n")]
    assert kept.columns == docs.columns


def test_accepted_is_the_score(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = quality.with_statistics(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), "statistics").cache()
    model = quality.fit(rows.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id"))
    scored = quality.score(rows.withColumn("ok", F.coalesce(quality.accepted(model, "statistics"), F.lit(False))), model, "doc_id", "ok")
    assert scored.where("ok <> (predicted = 1)").count() == 0 and 0 < scored.where("ok").count() < scored.count()
    none = quality.fit(rows.withColumn("quality", F.lit(None).cast("int")))
    assert rows.where(quality.accepted(none, "statistics")).count() == rows.count()


def test_packing_spreads_rows_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP_PIECES", 50)
    pieces = spark.range(1000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(0).alias("piece"), (F.col("id") % 60 + 1).alias("length"))
    packed = packing.pack(pieces, 64)
    groups = packed.groupBy((F.col("sequence_id") / (1 << 32)).cast("long")).count().collect()
    assert len(groups) >= 15 and max(r["count"] for r in groups) < 120
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 64").count() == 0


def test_a_text_that_repeats_itself_names_each_string_once(spark):
    """Every minimiser and every packed string has one row a document, and the kept words equal plain code."""
    words = substrings.hash_words(b"a b c d e".split() * 60)
    starts, counts, minimisers = substrings.super_kmers(words, 50)
    first, _, own, more = substrings._by_minimiser(starts, counts, minimisers)
    assert len(own) == len(set(minimisers.tolist())) < len(starts)
    places = [*first.tolist(), *(int(x) for m in more if m is not None for x in m[0::2])]
    assert sorted(places) == starts.tolist()
    whole = {"id": [1], "text": [" ".join(["a b c d e"] * 60)], "key": [7]}
    cuts = [{"start": int(s), "windows": int(c), "more": None if m is None else m.tolist(), "minimiser": int(k), "hot": True} for s, c, k, m in zip(first, counts, own, more)]
    packed = substrings._packed(pa.RecordBatch.from_pydict({**whole, "cuts": [cuts]}), 50).to_pylist()
    assert len({r["sid"] for r in packed}) == len(packed)
    assert sum(1 + len(r["more"] or []) for r in packed) > 10 * len(packed)

    rows = [(5, " ".join(["a b c d e"] * 60)), (3, "x " + " ".join(["a b c d e"] * 30) + " y"), (4, " ".join(["p q r"] * 40)), (9, "z " + " ".join(["p q r"] * 17 + ["s"] * 70))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen, removed = {}, {}
    for number, value in sorted(rows):
        split = value.split()
        for at in range(len(split) - 49):
            seen.setdefault(tuple(split[at : at + 50]), number)
    for number, value in rows:
        split = value.split()
        gone = {at + k for at in range(len(split) - 49) if seen[tuple(split[at : at + 50])] < number for k in range(50)}
        removed[number] = len(gone)
    assert {r.doc_id: r.n_removed for r in substrings.digests(docs).collect()} == removed and removed[5] == 300 and removed[9] > 0

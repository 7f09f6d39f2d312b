"""Sharding, whitening and resampling: against plain code, and their defined results for odd rows."""

import math
import zlib
from collections import Counter, defaultdict
from fractions import Fraction
from hashlib import sha256

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from graphloom.llm import resampling, sharding, spectrum, whitening
from graphloom.llm.ranks import numbered

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_points.queries()
ROWS = [(1, "some words " * 15), (2, None), (2, None), (3, ""), (4, "Ärger über 12 % "), (5, "some words " * 15), (None, "a b"), (None, "a b")]
CLASH = ["shard", "slot", "rank", "score", "_tie", "_part", "_row", "_n", "_file", "size", "x", "n", "bucket", "words", "law"]


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string")
    return frame.select("*", *[F.array(F.lit("own")).alias(name) for name in CLASH])


# --- numbers ----------------------------------------------------------------------------------------------------


def test_numbers_are_gapless_over_many_files(spark):
    rows = spark.range(5000).select((F.col("id") % 3).alias("g"), F.pmod(F.hash("id"), F.lit(50)).alias("v"))
    rows = rows.withColumn("g", F.when(F.col("g") < 2, F.col("g")))
    found = numbered(rows, ["g"], [F.col("v").asc()], "place").collect()
    by_group = defaultdict(list)
    for r in found:
        by_group[r.g].append((r.place, r.v))
    assert set(by_group) == {0, 1, None}
    for places in by_group.values():
        places.sort()
        assert [p for p, _ in places] == list(range(len(places))) and [v for _, v in places] == sorted(v for _, v in places)


# --- sharding ---------------------------------------------------------------------------------------------------


def _plain_shard(key, shards, seed="shard"):
    def earliest(nodes):
        def clock(name, weight):
            u = (int(__import__("hashlib").md5(f"{seed}:{name}:{key}".encode()).hexdigest()[:13], 16) + 0.5) / 16**13
            return -math.log(u) / weight

        return min(nodes, key=lambda name: (clock(name, nodes[name]), name))

    def weights(kind, place, chosen):
        out = Counter()
        for s in shards:
            if all(s[i] == v for i, v in chosen.items()):
                out[f"{kind} {s[place]}"] += s[3]
        return {name: w for name, w in out.items() if w > 0}

    chosen = {}
    for place, kind in enumerate(("region", "rack", "shard")):
        chosen[place] = int(earliest(weights(kind, place, chosen)).split()[1])
    return chosen[2]


def test_shards_of_plain_code_and_odd_rows(spark, docs):
    found = sharding.assign(docs, 8).collect()
    assert sorted(str((r.doc_id, r.size, r.text_crc32, r.law, r.shard, r.grown_shard)) for r in found) == sorted(
        str((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key", _plain_shard("" if i is None else i, sharding.topology(8)),
             _plain_shard("" if i is None else i, sharding.topology(9)))) for i, t in ROWS
    )
    for shard in {r.shard for r in found}:
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(sum(r.shard == shard for r in found)))
    assert sharding.assign(docs.where("false"), 8).count() == 0


def test_growing_moves_rows_into_the_new_shard_only(spark):
    keys = spark.range(20000)
    before = [F.col("id"), sharding.shard_of(F.col("id"), sharding.topology(8)).alias("a")]
    for more in (9, 10, 11):
        columns = [sharding.shard_of(F.col("id"), sharding.topology(n)).alias(f"s{n}") for n in (more - 1, more)]
        moved = keys.select("id", *columns).where(f"s{more - 1} <> s{more}")
        share = moved.count() / 20000
        assert moved.where(f"s{more} <> {more - 1}").count() == 0 and abs(share - 1 / more) < 0.01
    sizes = [r["count"] for r in keys.select(*before).groupBy("a").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 1.1 * 2500 and min(sizes) > 0.9 * 2500


def test_a_changed_weight_moves_rows_on_its_path_only(spark):
    old = sharding.topology(8)
    new = [(r, k, s, 3.0 if s == 5 else w) for r, k, s, w in old]
    place = {s: (r, k) for r, k, s, _ in old}
    rows = spark.range(20000).select(
        sharding.shard_of(F.col("id"), old).alias("a"), sharding.shard_of(F.col("id"), new).alias("b")
    ).collect()
    moved = [(r.a, r.b) for r in rows if r.a != r.b]
    for a, b in moved:
        # Another region's rows come into the grown region, never the other way; inside it into the grown rack, then shard.
        if place[a][0] != place[5][0]:
            assert place[b][0] == place[5][0]
        elif place[a][1] != place[5][1]:
            assert place[b][1] == place[5][1]
        else:
            assert b == 5
    share = Counter(r.b for r in rows)
    assert abs(share[5] / 20000 - 3 / 10) < 0.02 and moved
    dropped = [(r, k, s, 0.0 if s == 2 else w) for r, k, s, w in old]
    assert spark.range(2000).where(sharding.shard_of(F.col("id"), dropped) == 2).count() == 0


def test_written_shards_hold_whole_rows(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    sharding.write_shards(docs, sharding.topology(8), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, [(r.doc_id, r.text) for r in back.collect()])) == sorted(map(str, ROWS))
    with pytest.raises(ValueError):
        sharding.write_shards(docs.withColumn("Shard", F.lit(1)), sharding.topology(8), str(tmp_path / "no"))
    for bad in ([], [(0, 0, 0, -1.0)], [(0, 0, 0, 1.0), (0, 1, 0, 1.0)]):
        with pytest.raises(ValueError):
            sharding.shard_of(F.lit(1), bad)


# --- whitening --------------------------------------------------------------------------------------------------


def _polynomial(matrix):
    residues = {}
    for p in spectrum.primes_for(matrix):
        residues[p] = spectrum.polynomial_modulo(np.array([[v % p for v in row] for row in matrix], np.int64), p).tolist()
    return spectrum.from_residues(residues)


def _leverrier(matrix):
    """Characteristic polynomial by traces of powers, in fractions."""
    d = len(matrix)
    m, out = [[Fraction(0)] * d for _ in range(d)], [Fraction(1)]
    for k in range(1, d + 1):
        m = [[sum(matrix[i][x] * m[x][j] for x in range(d)) + (out[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        out.append(-sum(sum(matrix[i][x] * m[x][i] for x in range(d)) for i in range(d)) / k)
    return [int(c) for c in reversed(out)]


@settings(max_examples=30, deadline=None)
@given(st.integers(1, 6).flatmap(lambda d: st.lists(st.lists(st.integers(-(10**6), 10**6), min_size=d, max_size=d), min_size=1, max_size=8)))
def test_polynomial_roots_and_vectors(rows):
    a = np.array(rows, dtype=object)
    matrix = [[int(v) for v in row] for row in a.T @ a]
    poly = _polynomial(matrix)
    assert poly == _leverrier(matrix)
    trace = sum(matrix[i][i] for i in range(len(matrix)))
    if not trace:
        return
    found = spectrum.largest_roots(poly, len(matrix), trace)
    rank = np.linalg.matrix_rank(np.array(rows, float))
    assert sum(m for _, _, m in found) >= rank
    values = [n / 2**b for n, b, m in found for _ in range(m)]
    wanted = np.linalg.eigvalsh(np.array(matrix, float))[::-1][: len(values)]
    assert np.allclose(values, wanted, rtol=1e-9, atol=1e-9 * trace)
    vectors = spectrum.eigenvectors(matrix, found)
    v = np.array([[float(x) for x in vector] for _, vector in vectors])
    assert np.allclose(v @ v.T, np.eye(len(v)), atol=1e-12)
    assert np.allclose(v @ np.array(matrix, float), np.array(values)[:, None] * v, atol=1e-9 * trace)


def test_equal_and_zero_roots():
    poly = _polynomial([[2, 0, 0, 0], [0, 2, 0, 0], [0, 0, 5, 0], [0, 0, 0, 0]])
    assert poly == [0, -20, 24, -9, 1]
    assert [m for _, _, m in spectrum.largest_roots(poly, 4, 9)] == [1, 2]
    assert [spectrum.roots_beyond(poly, a) for a in (-1, 0, 1, 2, 4, 5)] == [4, 3, 3, 1, 1, 0]


def test_whitening_against_plain_code(spark):
    rng = np.random.default_rng(3)
    vectors = np.round(rng.standard_normal((80, 6)) @ rng.standard_normal((6, 6)), 3)
    vectors[60:] = vectors[:20]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
    odd = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (102, [math.nan] * 6), (103, [math.inf] * 6), (104, [1.0, 2.0]), (None, rows[0][1])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").select("*", *[F.lit("own").alias(n) for n in CLASH])
    found = whitening.whiten(frame, components=4).collect()
    x = np.floor(64 * vectors) + 1_000_000
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T, bias=True)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    white = (x - s / n) @ axes / np.sqrt(values)
    assert len(found) == 4 * 81 and {r.n for r in found} == {n} and max(r.identity_error for r in found) < 1e-9
    for r in found:
        i = r.vec_id or 0
        assert abs(abs(r.whitened) - abs(white[i, r.component - 1])) < 1e-9
        assert abs(r.explained - values[r.component - 1] / np.trace(cov)) < 1e-12
        assert r.deviation == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s))
    signs = {r.component: r.whitened * white[0, r.component - 1] > 0 for r in found if r.vec_id == 0}
    assert all((r.whitened * white[r.vec_id, r.component - 1] > 0) == signs[r.component] for r in found if r.vec_id)


def test_whitening_of_few_and_huge_vectors(spark):
    make = lambda *v: spark.createDataFrame([(i, list(map(float, x))) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    assert whitening.whiten(make((1, 2)).where("false")).count() == 0
    assert whitening.whiten(make((1, 2), (1, 2))).count() == 0 and whitening.whiten(make((), ())).count() == 0
    line = whitening.whiten(make((1, 2), (2, 4), (3, 6))).collect()
    assert len(line) == 3 and abs(sum(r.whitened**2 for r in line) - 3) < 1e-12 and abs(line[0].explained - 1) < 1e-15
    huge = whitening.whiten(make((1e300, 0), (-1e300, 0), (0, 1e9), (5, -7))).collect()
    assert len(huge) == 8 and all(math.isfinite(r.whitened) for r in huge) and {r.deviation for r in huge if r.vec_id == 0} == {None}
    assert max(r.identity_error for r in huge) < 1e-9


# --- resampling -------------------------------------------------------------------------------------------------


def _plain_draw(docs, target, buckets, share, least):
    def features(text):
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        ws = "".join(c if not c.isascii() or c.isalnum() else " " for c in lower).split(" ")
        ws = [w for w in ws if w]
        return len(ws), [zlib.crc32(f.encode()) % buckets for f in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    ratio = lambda b: (t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))
    rows = []
    for i, text in docs:
        n_words, own = features(text)
        weight = sum(math.floor(1000 * math.log(ratio(b))) for b in own) // len(own) if own else 0
        h = int(sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n_words, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))])
    able = sorted((r for r in rows if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[3], -r[2]))
    drawn = [(*r, k + 1) for k, r in enumerate(able[: share * len(able) // 100])]
    left = Counter(map(tuple, rows)) - Counter(r[:5] for r in drawn)
    return sorted(map(str, drawn + [(*r, None) for r in left.elements()]))


@pytest.mark.parametrize("share", [0, 1, 25, 60, 100])
def test_draw_of_plain_code(spark, docs, share):
    rng = np.random.default_rng(5)
    vocabulary = ["alpha", "Beta", "größe", "naïve", "x9", "日本", "long" * 20, "b", "—", "e-mail"]
    rows = ROWS + [(i, ", ".join(rng.choice(vocabulary, rng.integers(0, 30)))) for i in range(200)] + [(7, "alpha " * 20)] * 40
    target = ["alpha beta " * 9, None, "größe " * 4, "long" * 20]
    frame = spark.createDataFrame(rows, "doc_id long, text string").select("*", *[F.lit("own").alias(n) for n in CLASH])
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(frame, goal, 100, share, 5).collect()
    assert sorted(str(tuple(r)) for r in found) == _plain_draw(rows, target, 100, share, 5)


def test_draw_of_tied_scores_and_empty_tables(spark):
    rows = [(i % 40 if i % 9 else None, 9, 5, 7, 100) for i in range(300)] + [(3, 9, 5, 9, 200)] * 20
    scored = spark.createDataFrame(rows, "doc_id long, n_words long, n_features long, weight long, score long")
    for share in (3, 6, 50, 95):
        drawn = [r for r in resampling.draw(scored, share, 1).collect() if r.rank]
        wanted = sorted(rows, key=lambda r: (-r[4], r[0] is None, r[0] or 0))[: 320 * share // 100]
        assert [r.doc_id for r in sorted(drawn, key=lambda r: r.rank)] == [r[0] for r in wanted]
        assert sorted(r.rank for r in drawn) == list(range(1, len(wanted) + 1))
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert resampling.resample(docs.where("false"), docs.select("text")).count() == 0
    assert resampling.resample(docs, docs.select("text").where("false")).count() == len(ROWS)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(max_size=200), max_size=5))
def test_checksums_of_features(texts):
    lists = [resampling.words(t) for t in texts] + [[b"y" * 300, b"z" * 49, b"w" * 48], []]
    found, counts = resampling.feature_checksums(lists, resampling._Checksums(), resampling._appending_tables())
    wanted = [sorted([zlib.crc32(w) for w in ws] + [zlib.crc32(a + b" " + b) for a, b in zip(ws, ws[1:])]) for ws in lists]
    edges = np.concatenate([[0], np.cumsum(counts)])
    assert [sorted(found[a:b].tolist()) for a, b in zip(edges, edges[1:])] == wanted

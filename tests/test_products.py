"""Blocks of pages multiplied in tasks give what the plain way gives."""

import random

import numpy as np
import pytest

from graphloom.operators import impact, products, tfidf
from graphloom.session import materialize


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(4)
    texts = {i: ["hot"] * rng.randint(0, 2) + ["warm"] * rng.randint(0, 3) + [f"w{rng.randint(0, 25)}" for _ in range(rng.randint(0, 6))] for i in range(60)}
    texts |= {100 + i: texts[7] for i in range(8)} | {200: ["alone"], 201: []}
    counts = spark.createDataFrame([(k, w, t.count(w)) for k, t in texts.items() for w in set(t)], "page long, term string, tf long")
    return materialize(tfidf.fit_score(counts, spark.range(len(texts)), "page", 1.0).drop("df"))


def similar(scores, targets, n, bound):
    return [tuple(r) for r in tfidf.top_similar_pages(scores, targets, "page", n, bound).orderBy("page", "rank").collect()]


@pytest.mark.parametrize("block,share,at_once,n", [(7, 1 / 256, 1 << 21, 3), (7, 2.0, 16, 1), (1000, 0.0, 16, 5), (20, 0.02, 50, 10)])
def test_blocks_are_exact(spark, scores, monkeypatch, block, share, at_once, n):
    some = spark.createDataFrame([(i,) for i in (3, 7, 104, 200, 999)], "page long")
    plain = [similar(scores, targets, n, tfidf.BROADCAST_POSTINGS) for targets in (None, some)]
    monkeypatch.setattr(impact, "candidate_scores", None)
    monkeypatch.setattr(tfidf, "MEETINGS", 0)
    for name, value in (("BLOCK_PAGES", block), ("DENSE_SHARE", share), ("PRODUCTS_AT_ONCE", at_once)):
        monkeypatch.setattr(products, name, value)
    records = spark.conf.get(products.RECORDS)
    assert [similar(scores, None, n, 0), similar(scores, some, n, 1)] == plain and len(plain[0]) > 50
    assert spark.conf.get(products.RECORDS) == records


def test_common_terms_make_no_pairs(spark, monkeypatch):
    """Five common terms on every page: their pairs used to be rows."""
    rng = np.random.default_rng(1)
    rows = [(p, f"t{t}", float(w)) for p in range(300) for t, w in enumerate((lambda v: v / np.linalg.norm(v))(rng.random(5) + 0.1))]
    scores = materialize(spark.createDataFrame(rows, "page long, term string, score double"))
    plain = similar(scores, None, 4, tfidf.BROADCAST_POSTINGS)
    monkeypatch.setattr(impact, "_meet", None)
    assert similar(scores, None, 4, 0) == plain and len(plain) == 1200

"""Texts in parts below a budget, and their reduction to one reply a key."""

import re

import pytest
from pyspark.sql import functions as F

from graphloom.operators import modelio


def counted(text):
    return len(re.findall(modelio.UNIT, text))


def plain_parts(rows, budget):
    """The same parts by a loop, for keys of one block."""
    limit, out, at = budget // 4, {}, {}
    for key, place, text in sorted((r for r in rows if r[2]), key=lambda r: (r[0], r[1], r[2])):
        found = re.findall(modelio.UNIT, text)
        for i in range(0, len(found), limit):
            start = at.get(key, 0)
            out.setdefault((key, start // (budget - limit)), []).append("".join(found[i : i + limit]))
            at[key] = start + len(found[i : i + limit])
    return {k: "\n".join(v) for k, v in out.items()}


ROWS = [("a", f"p{i:03d}", "word " * (i % 7) + "x" * (i % 40)) for i in range(200)]
ROWS += [("b", "p", "one"), ("c", "p", None), ("c", "q", "  "), ("d", "p", "y" * 1000), ("e", "same", "tie two"), ("e", "same", "tie one"), ("e", "same", "tie one")]


def test_parts_equal_a_loop(spark):
    frame = spark.createDataFrame(ROWS, "key string, place string, text string").withColumn("part", F.lit(1))
    got = {(r.key, r.part): r.text for r in modelio.budgeted_parts(frame, "key", "place", "text", 24).collect()}
    assert got == plain_parts(ROWS, 24)
    assert max(counted(text) for text in got.values()) < 24
    assert modelio.budgeted_parts(frame.where("false"), "key", "place", "text", 24).count() == 0
    with pytest.raises(ValueError):
        modelio.budgeted_parts(frame, "key", "place", "text", 3)


def test_parts_of_a_long_key_are_numbered_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(modelio, "PARTS_TOGETHER", 2)
    frame = spark.createDataFrame(ROWS, "key string, place string, text string")
    got = modelio.budgeted_parts(frame, "key", "place", "text", 24).collect()
    assert len({r.part >> 32 for r in got if r.key == "a"}) > 3
    assert max(counted(r.text) for r in got) < 24
    assert sum(counted(r.text) for r in got) == sum(counted(t) for _, _, t in ROWS if t)


def test_one_reply_for_each_key(spark):
    asked = []

    def answer(requests):
        asked.append(max(counted(r.prompt) for r in requests.collect()))
        body = F.regexp_replace(F.regexp_replace("prompt", "^ask ", ""), " end$", "")
        reply = F.concat(F.lit("r"), F.sha2(body, 256).substr(1, 5), F.lit(" told" * 30))
        return requests.where(~F.col("prompt").contains("y")).select("request_id", reply.alias("response"))

    frame = spark.createDataFrame(ROWS, "key string, place string, text string")
    got = {r.key: r for r in modelio.reduce_texts(frame, "key", "place", "text", 24, answer, "ask {text} end", "").collect()}
    assert set(got) == {"a", "b", "d", "e"}
    assert got["d"].summary is None and got["b"].rounds == 0 and got["a"].rounds >= 3
    assert all(got[k].summary.count("told") == 30 for k in "abe")
    assert max(asked) < 24 + 2

import random
from collections import defaultdict

from graphloom.operators import modelio, resolve


def entities(spark, ids, block="b"):
    return spark.createDataFrame([(i, block) for i in ids], "id string, block string")


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(ids):
    low = sorted({i.lower() for i in ids if len(i) > 4})
    return {(a, b): distance(a, b) for a in low for b in low if a < b and distance(a, b) < 3}


def check_pairs(spark, ids):
    found = {(r.a, r.b): r.distance for r in resolve.duplicate_pairs(entities(spark, ids), "block").collect()}
    assert found == brute(ids)


def test_pairs_match_brute_force(spark):
    rng = random.Random(5)
    short = {"".join(rng.choice("abc") for _ in range(rng.randint(3, 8))) for _ in range(150)}
    check_pairs(spark, sorted(short))


def test_pairs_of_long_ids(spark):
    rng = random.Random(6)
    ids = set()
    for length in (36, 38, 39, 40, 41, 42, 43, 44, 60, 90):
        base = "".join(rng.choice("abcdef ") for _ in range(length))
        for _ in range(8):
            s = list(base)
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(s))
                s[at : at + 1] = rng.choice([[], ["z"], [s[at], "y"]])
            ids.add("".join(s))
    check_pairs(spark, sorted(ids))


def test_blocks_stay_apart(spark):
    both = entities(spark, ["abcdef"], "x").union(entities(spark, ["abcdeg"], "y"))
    assert resolve.duplicate_pairs(both, "block").count() == 0


def test_groups_close_over_chains_and_case(spark, rows):
    ids = ["aaaaaa", "aaaabb", "aabbbb", "zzzzz", "ZZZZZ", "four", "Four", "single"]
    assert rows(resolve.duplicate_groups(entities(spark, ids), "block")) == [
        ("ZZZZZ", "ZZZZZ"), ("ZZZZZ", "zzzzz"), ("aaaaaa", "aaaaaa"), ("aaaaaa", "aaaabb"), ("aaaaaa", "aabbbb"),
    ]


def test_rule_merges_formats_but_not_numbers(spark, rows):
    groups = spark.createDataFrame(
        [(1, "Star Road: The Return"), (1, "Star Road The Return"), (2, "May 2, 2020"), (2, "May 12, 2020"), (2, "May 22, 2020"),
         (3, "1 12 items"), (3, "11 2 items")],
        "group_id int, entity_id string",
    )
    assert rows(resolve.entity_resolution(groups), "entity_id") == [("Star Road The Return",), ("Star Road: The Return",)]


def test_decisions_replace_the_rule(spark, rows):
    groups = spark.createDataFrame([(1, "a b"), (1, "ab")], "group_id int, entity_id string")
    none = spark.createDataFrame([], "group_id int, entity_id string")
    assert resolve.entity_resolution(groups, none).count() == 0
    given = spark.createDataFrame([(9, "a b"), (9, "x"), (8, None)], "group_id int, entity_id string")
    assert rows(resolve.entity_resolution(groups, given)) == [(9, "a b"), (9, "x")]


def test_merge(spark, rows):
    nodes = spark.createDataFrame([(i, f"d{i}") for i in "abcde"], "id string, description string")
    merges = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (2, "c"), (3, "d"), (3, "unknown")], "group_id int, entity_id string")
    mapping = resolve.survivors(nodes, merges)
    assert rows(mapping) == [("b", "a"), ("c", "a")]
    assert rows(resolve.merge_entities(nodes, mapping)) == [("a", "da"), ("d", "dd"), ("e", "de")]
    edges = spark.createDataFrame([("a", "R", "d"), ("b", "R", "d"), ("b", "R", "c"), ("e", "R", "c")], "src string, type string, dst string")
    assert rows(resolve.merge_edges(edges, mapping), "src", "dst", "is_loop") == [
        ("a", "a", True), ("a", "d", False), ("a", "d", False), ("e", "a", False)
    ]
    assert resolve.merge_edges(edges, mapping, keep_loops=False).count() == 3
    mentions = spark.createDataFrame([(1, "b"), (1, "c"), (2, "e")], "doc_id int, entity_id string")
    assert rows(resolve.merge_mentions(mentions, mapping)) == [(1, "a"), (2, "e")]


def test_requests_and_replies(spark):
    rows = [("g1", n) for n in ("Old One", "old-one", "Old Two", "oldtwo")] + [("g2", "a b"), ("g2", "A.B")] + [("g3", "x"), ("g4", "y1"), ("g4", "y2")]
    groups = spark.createDataFrame(rows, "group_id string, entity_id string")
    requests, links = modelio.resolution_requests(groups)
    prompts = {r.request_id: r for r in requests.collect()}
    of = {r.group_id: r.request_id for r in links.collect()}
    assert set(of) == {"g1", "g2", "g4"} and "Old One\nOld Two\nold-one\noldtwo" in prompts[of["g1"]].prompt
    assert all(r.system == modelio.RESOLUTION_SYSTEM for r in prompts.values())
    answers = {
        "g1": 'Sure:\n[["Old One", "old-one", "unknown"], ["Old Two", "oldtwo"], ["Old One"]]', "g2": "I can't tell.", "g4": "[]",
    }
    replies = spark.createDataFrame([(of[g], g, t) for g, t in answers.items()] + [("r", "g4", None), ("r", "g4", '[["y1", 3')], "request_id string, group_id string, response string")
    decisions, rejects = modelio.parse_resolution(replies, groups)
    assert sorted(map(tuple, decisions.collect())) == [
        ("g1|Old One", "Old One"), ("g1|Old One", "old-one"), ("g1|Old Two", "Old Two"), ("g1|Old Two", "oldtwo"),
    ]
    assert sorted(r.response for r in rejects.collect()) == ["I can't tell.", '[["y1", 3']
    parts, part_links = modelio.resolution_requests(groups, max_names=2)
    held = {r.request_id: r.prompt for r in parts.collect()}
    together = [held[r.request_id] for r in part_links.collect() if r.group_id == "g1"]
    assert any("Old One" in p and "old-one" in p for p in together) and any("Old Two" in p and "oldtwo" in p for p in together)


def test_groups_are_the_closure_of_all_pairs_without_making_them(spark, monkeypatch):
    rng = random.Random(5)
    ids = {"".join(rng.choice("aab1 ") for _ in range(rng.randint(5, 9))) for _ in range(250)}
    ids |= {f"No#{rng.randrange(3000):07d}" for _ in range(300)} | {"x" * n + y for n in (38, 41, 60) for y in ("", "ab", "cd", "Ab")}
    frame = spark.createDataFrame([(x, "pq"[i % 2]) for i, x in enumerate(sorted(ids))] + [("abcdef", "p"), ("abcdef", "q")], "id string, block string")
    leader = {}

    def find(x):
        while leader.setdefault(x, x) != x:
            x = leader[x]
        return x

    by_low = defaultdict(list)
    for row in frame.where("length(id) > 4").selectExpr("block", "id", "lower(id) AS low").collect():
        by_low[row.block, row.low].append(row.id)
    for names in by_low.values():
        for x in names:
            leader[max(find(names[0]), find(x))] = min(find(names[0]), find(x))
    for p in resolve.duplicate_pairs(frame, "block").collect():
        one, two = find(by_low[p.block, p.a][0]), find(by_low[p.block, p.b][0])
        leader[max(one, two)] = min(one, two)
    wanted = {(find(x), x) for x in list(leader)}
    wanted = {(g, x) for g, x in wanted if sum(g == h for h, _ in wanted) > 1}
    # Neither all pairs are made, nor do the outcomes differ when few or many keys are left to ask for.
    monkeypatch.setattr(resolve, "duplicate_pairs", None)
    for most in (0, 10**6):
        monkeypatch.setattr(resolve, "BROADCAST_KEYS", most)
        assert {tuple(r) for r in resolve.duplicate_groups(frame, "block").select("group_id", "entity_id").collect()} == wanted

import random
from collections import defaultdict

import pytest

import pandas as pd

from graphloom.operators import community, leiden, modelio


def graph_of(spark, edges, extra=()):
    nodes = sorted({n for a, b, _ in edges for n in (a, b)} | set(extra))
    return (
        spark.createDataFrame(edges, "src string, dst string, weight long"),
        spark.createDataFrame([(n,) for n in nodes], "id string"),
        nodes,
    )


def clique(names):
    return [(a, b, 1) for i, a in enumerate(names) for b in names[i + 1 :]]


def modularity(edges, where):
    twice_m = 2 * sum(w for _, _, w in edges)
    inner, total = defaultdict(float), defaultdict(float)
    for a, b, w in edges:
        total[where[a]] += w
        total[where[b]] += w
        if where[a] == where[b]:
            inner[where[a]] += 2 * w
    return sum(inner.values()) / twice_m - sum(t * t for t in total.values()) / twice_m**2


def connected(edges, members):
    members = set(members)
    seen, todo = set(), [next(iter(members))]
    while todo:
        n = todo.pop()
        if n in seen:
            continue
        seen.add(n)
        todo += [y for a, b, _ in edges for x, y in ((a, b), (b, a)) if x == n and y in members]
    return seen == members


def check_levels(rows, edges, nodes):
    levels = defaultdict(dict)
    for r in rows:
        assert r.entity not in levels[r.level]
        levels[r.level][r.entity] = r.community
    assert sorted(levels) == list(range(len(levels)))
    last = -1.0
    for level in range(len(levels)):
        where = levels[level]
        assert set(where) == set(nodes)
        groups = defaultdict(list)
        for n, c in where.items():
            groups[c].append(n)
        assert all(min(members) == c and connected(edges, members) for c, members in groups.items())
        if level:
            above = defaultdict(set)
            for n in nodes:
                above[levels[level - 1][n]].add(where[n])
            assert all(len(parents) == 1 for parents in above.values())
        now = modularity(edges, where)
        assert now >= last - 1e-9
        last = now
    return levels, last


def test_two_cliques_and_a_lonely_node(spark):
    left, right = ["a1", "a2", "a3", "a4", "a5"], ["b1", "b2", "b3", "b4", "b5"]
    edges = clique(left) + clique(right) + [("a1", "b1", 1)]
    edge_frame, node_frame, nodes = graph_of(spark, edges, ["z"])
    levels, _ = check_levels(community.detect_communities(edge_frame, node_frame).collect(), edges, nodes)
    final = levels[max(levels)]
    assert {final[n] for n in left} == {"a1"} and {final[n] for n in right} == {"b1"} and final["z"] == "z"


@pytest.mark.parametrize("block,hub", [(200_000, 50_000), (60, 12)])
def test_invariants_on_planted_groups(spark, monkeypatch, block, hub):
    monkeypatch.setattr(leiden, "BLOCK_ARCS", block)
    monkeypatch.setattr(leiden, "HUB_ARCS", hub)
    rng = random.Random(11)
    names = [f"n{i:02d}" for i in range(48)]
    weight = defaultdict(int)
    for i, a in enumerate(names):
        for j in range(i + 1, len(names)):
            if rng.random() < (0.5 if i // 12 == j // 12 else 0.03):
                weight[a, names[j]] += rng.randint(1, 3)
    edges = [(a, b, w) for (a, b), w in weight.items()]
    edge_frame, node_frame, nodes = graph_of(spark, edges, names)
    first = community.detect_communities(edge_frame, node_frame).collect()
    _, quality = check_levels(first, edges, nodes)
    planted = modularity(edges, {n: i // 12 for i, n in enumerate(names)})
    assert quality > 0.95 * planted
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        again = community.detect_communities(edge_frame, node_frame).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(first) == sorted(again)


def test_refinement_keeps_badly_tied_nodes_apart():
    """Two cliques that one weak edge put into one community come apart; their own nodes find together."""
    names = ["a", "b", "c", "x", "y", "z"]
    edges = clique(names[:3]) + clique(names[3:]) + [("c", "x", 0.01)]
    weights = [(a, b, float(w)) for p, q, w in edges for a, b in ((p, q), (q, p))]
    degree = defaultdict(float)
    for a, _, w in weights:
        degree[a] += w
    rows = [(a, b, w, degree[a], sum(degree.values())) for a, b, w in weights]
    parts = leiden.refine(pd.DataFrame(rows, columns=["a", "b", "w", "k", "total"]), sum(degree.values()), 1.0)
    assert {parts[n] for n in "abc"}.isdisjoint({parts[n] for n in "xyz"})
    assert parts["a"] == parts["b"] == "a" and parts["x"] == parts["y"] == "x"


def test_settling_ends_in_a_local_optimum():
    rng = random.Random(4)
    edges = [(i, j, rng.randint(1, 3)) for i in range(40) for j in range(i + 1, 40) if rng.random() < (0.6 if i // 10 == j // 10 else 0.05)]
    arcs = [(a, b, w) for i, j, w in edges for a, b in ((i, j), (j, i))]
    degree = defaultdict(int)
    for a, _, w in arcs:
        degree[a] += w
    rows = [(a, b, b, w, degree[b], a, degree[a], degree[a]) for a, b, w in arcs]
    rng.shuffle(rows)
    columns = ["a", "b", "cb", "w", "total_b", "ca", "k", "total_a"]
    where = leiden.settle(pd.DataFrame(rows, columns=columns), float(sum(degree.values())), 1.0)
    best = modularity(edges, where)
    for node in where:
        for c in set(where.values()):
            assert modularity(edges, where | {node: c}) <= best + 1e-9
    assert where == leiden.settle(pd.DataFrame(rows[::-1], columns=columns), float(sum(degree.values())), 1.0)


def test_modularity_value(spark):
    edges = clique(["a", "b", "c"]) + clique(["d", "e", "f"]) + [("a", "d", 2)]
    where = {n: n in "abc" for n in "abcdef"}
    edge_frame, _, _ = graph_of(spark, edges)
    members = spark.createDataFrame([(n, int(c)) for n, c in where.items()], "id string, community int")
    assert community.modularity(edge_frame, members).first().modularity == pytest.approx(modularity(edges, where))


def test_no_edges(spark):
    edge_frame, node_frame, _ = graph_of(spark, [], ["a", "b"])
    assert sorted(tuple(r) for r in community.detect_communities(edge_frame, node_frame).collect()) == [("a", 0, "a"), ("b", 0, "b")]


@pytest.fixture
def membership(spark):
    data = [("a", 0, 1), ("b", 0, 1), ("c", 0, 2), ("a", 1, 9), ("b", 1, 9), ("c", 1, 9), ("a", 2, 9), ("b", 2, 9), ("c", 2, 9)]
    return spark.createDataFrame(data, "entity string, level int, community long")


def test_hierarchy(membership, rows):
    assert rows(community.community_nodes(membership)) == [("0-1", 0), ("0-2", 0), ("1-9", 1), ("2-9", 2)]
    assert rows(community.community_edges(membership)) == [
        ("0-1", "1-9", 0), ("0-2", "1-9", 0), ("1-9", "2-9", 1), ("a", "0-1", -1), ("b", "0-1", -1), ("c", "0-2", -1)
    ]


def test_rank_has_no_row_without_documents(spark, membership, rows):
    mentions = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "doc_id int, entity_id string")
    assert rows(community.community_rank(membership, mentions)) == [("0-1", 2), ("1-9", 2), ("2-9", 2)]


def test_contents_and_text(spark, membership, rows):
    nodes = spark.createDataFrame([("a", "T", "first"), ("b", "T", ""), ("c", None, None)], "id string, type string, description string")
    edges = spark.createDataFrame(
        [("a", "R", "b", None), ("a", "R", "b", None), ("b", "R", "c", "why"), ("a", "R", "q", None)],
        "src string, type string, dst string, description string",
    )
    inside = community.community_nodes_of(membership, nodes)
    rels = community.community_rels_of(membership, edges)
    # Level 2 is not reported, community 0-2 has a single entity.
    assert rows(inside, "community", "id") == [("0-1", "a"), ("0-1", "b"), ("1-9", "a"), ("1-9", "b"), ("1-9", "c")]
    assert rows(rels, "community", "start", "end") == [("0-1", "a", "b")] * 2 + [("1-9", "a", "b")] * 2 + [("1-9", "b", "c")]
    texts = {r.community: r.text for r in community.community_text(inside, rels).collect()}
    assert texts["1-9"] == (
        "Nodes are:\nid: a, type: T, description: first\nid: b, type: T\nid: c, type: None\n"
        "\nRelationships are:\n(a)-[:R]->(b)\n(a)-[:R]->(b)\n(b)-[:R]->(c), description: why\n"
    )


def test_large_community_text_keeps_every_line(spark):
    nodes = spark.createDataFrame([("c", f"n{i:03d}", None, "T") for i in range(100)], "community string, id string, description string, type string")
    rels = spark.createDataFrame([("c", "a", "R", "b", None)] * 57, "community string, start string, type string, end string, description string")
    parts = community.community_text(nodes, rels, parts=6).collect()
    lines = [line for r in parts for line in r.text.split("\n")]
    assert len(parts) == 6
    assert sum(line.startswith("id: ") for line in lines) == 100 and sum(line.startswith("(a)") for line in lines) == 57
    assert len({line for line in lines if line.startswith("id: ")}) == 100


def test_entity_type(spark):
    df = spark.createDataFrame([(["__Entity__", "Person"],), (["__Entity__"],)], "labels array<string>")
    assert [r.t for r in df.select(community.entity_type(df.labels).alias("t")).collect()] == ["Person", None]


# --- tables around model calls ----------------------------------------------------------------------------------


def test_requests_are_asked_once(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (4, None)], "id int, text string")
    requests, links = modelio.prompt_requests(df, "id", "text", "Say {text} now", "sys")
    assert rows(requests, "prompt", "n_sources") == [("Say x now", 2), ("Say y now", 1)]
    replies = requests.where("n_sources = 2").selectExpr("request_id", "'r' AS response")
    assert rows(modelio.attach_responses(links, replies), "id", "response") == [(1, "r"), (2, "r"), (3, None)]
    with pytest.raises(ValueError):
        modelio.prompt_requests(df, "id", "text", "no slot")


def test_triples(spark, rows):
    reply = "Sure:\n\n(Ann, KNOWS, Bob)\n ( Ann ,KNOWS, Bob )\n(Ann, LIVES_IN, Paris, France)\n(two, parts)\n( , R, x)"
    df = spark.createDataFrame([(1, reply)], "id int, response string")
    good, bad = modelio.parse_triples(df, "id")
    assert rows(good) == [(1, "Ann", "KNOWS", "Bob", 2), (1, "Ann", "LIVES_IN", "Paris, France", 1)]
    assert rows(bad, "line") == [("( , R, x)",), ("(two, parts)",), ("Sure:",)]


def test_contacts(spark, rows):
    text = "Associate\nName: Jo Doe\nEmail jo.doe@example.org Phone +44 (0)20 0000 0000 office"
    df = spark.createDataFrame([(1, text), (2, "plain words")], "id int, text string")
    assert rows(modelio.contact_fields(df, "id", "text")) == [(1, "Jo Doe", ["jo.doe@example.org"], ["+44 (0)20 0000 0000"])]


def test_sweep(spark):
    requests = spark.createDataFrame([("r1", "p"), ("r2", "q")], "request_id string, prompt string")
    swept = modelio.parameter_sweep(requests)
    assert swept.count() == 28 and swept.select("run_id").distinct().count() == 28

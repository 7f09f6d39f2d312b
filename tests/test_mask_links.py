import random
from collections import defaultdict

from graphloom.operators import resolve


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def closed(named):
    lead = {n: n for n in named}

    def root(n):
        while lead[n] != n:
            n = lead[n]
        return n

    for x, (bx, lx) in named.items():
        for y, (by, ly) in named.items():
            if x < y and bx == by and min(len(x), len(y)) > 4 and edits(lx, ly) < 3:
                a, b = sorted((root(x), root(y)))
                lead[b] = a
    groups = defaultdict(list)
    for n in named:
        groups[root(n)].append(n)
    return sorted((g, n) for g, members in groups.items() if len(members) > 1 for n in members)


def test_groups_of_one_length_and_of_many(spark, rows):
    rng = random.Random(8)
    named = {}
    for i in range(60):
        name = f"Item#{rng.randrange(10**4):04d}"
        named[name] = ("even", name.lower())
    for i in range(90):
        name = "".join(rng.choice("abé😀") for _ in range(rng.randint(5, 10))) + "_"
        named[name] = ("odd", name.lower())
    for name in ("x" * 37 + "yyyy1", "x" * 37 + "yyzz1", "x" * 37 + "zzyy12", "x" * 36 + "zzz12"):
        named[name] = ("long", name)
    frame = spark.createDataFrame([(n, b) for n, (b, _) in named.items()], "id string, block string")
    assert rows(resolve.duplicate_groups(frame, "block")) == closed(named)


def test_forms_of_one_length_make_no_keys_of_two_deletions(spark, rows, monkeypatch):
    """Sparse numbers, as in blocks that hold every hundredth: a table of 100 keys a form was written and joined with itself."""
    rng = random.Random(3)
    names = {f"Customer#{n:09d}": ("b", f"customer#{n:09d}") for n in rng.sample(range(20_000), 150)}
    written, write = [], resolve.materialize
    monkeypatch.setattr(resolve, "materialize", lambda df: written.append(write(df)) or written[-1])
    frame = spark.createDataFrame([(n, "b") for n in names], "id string, block string")
    assert rows(resolve.duplicate_groups(frame, "block")) == closed(names)
    assert max(df.count() for df in written) <= 5 * len(names)

"""Sharding by a weighted hash tree: region, then rack, then shard.

At each level every child of the chosen node draws an exponential clock from the hash of the key and the child's name,
at the rate of its weight, and the earliest clock wins: a child is chosen in proportion to its weight. A clock depends on
nothing but key, name and weight. When the weight of a subtree changes, only that subtree's clocks change, so at
each level keys move only into a subtree that grew or out of one that shrank, and the inside of the others stays.
All of it is column expressions.
"""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graphloom.llm.ranks import numbered
from graphloom.session import materialize

#: Hexadecimal digits of a draw: 52 bits, which a double holds exactly.
DIGITS = 13

Shard = tuple[int, int, int, float]


def topology(shards: int, founding: int = 8, per_rack: int = 2, per_region: int = 4) -> list[Shard]:
    """``(region, rack, shard, weight)`` of equal shards.

    The founding shards fill racks and regions in turn. Every later shard stands in a region of its own: its weight then
    changes no other subtree, so that going from any count of at least ``founding`` to the next one moves rows into the
    new shard only.
    """
    tree = [(i // per_region, i // per_rack, i, 1.0) for i in range(min(shards, founding))]
    regions, racks = -(-founding // per_region), -(-founding // per_rack)
    return tree + [(regions + i - founding, racks + i - founding, i, 1.0) for i in range(founding, shards)]


def _unit(key: Column, name: Column, seed: str) -> Column:
    """A number between 0 and 1, both excluded, from the MD5 of seed, node and key."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), name, key))
    return (F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("double") + 0.5) / float(16**DIGITS)


def _winner(children: Column, key: Column, seed: str) -> Column:
    """The child with the earliest clock; the smaller name where two are equal."""
    clocks = F.transform(
        children,
        lambda child: F.struct(
            (-F.log(_unit(key, child["name"], seed)) / child["weight"]).alias("clock"), child["name"].alias("name"),
            child.alias("node"),
        ),
    )
    return F.array_min(clocks)["node"]


def _tree(shards: list[Shard]) -> Column:
    """Nested lists of regions, racks and shards with their names and weights."""
    regions: dict = defaultdict(lambda: defaultdict(list))
    for region, rack, shard, weight in shards:
        if weight < 0:
            raise ValueError(f"shard {shard} has a negative weight")
        if weight > 0:
            regions[region][rack].append((shard, weight))
    if not regions:
        raise ValueError("no shard has a weight")
    if len({s for _, _, s, _ in shards}) < len(shards):
        raise ValueError("a shard is named twice")

    def node(name: str, weight: float, *more: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.lit(float(weight)).alias("weight"), *more)

    out = []
    for region, racks in sorted(regions.items()):
        inside = []
        for rack, members in sorted(racks.items()):
            leaves = F.array(*[node(f"shard {s}", w, F.lit(s).alias("shard")) for s, w in sorted(members)])
            inside.append(node(f"rack {rack}", sum(w for _, w in members), leaves.alias("children")))
        total = sum(w for members in racks.values() for _, w in members)
        out.append(node(f"region {region}", total, F.array(*inside).alias("children")))
    return F.array(*out)


def shard_of(key: Column, shards: list[Shard], seed: str = "shard") -> Column:
    """The shard of a key; a null key counts as the empty text. Equal keys share a shard, whatever the other columns."""
    key = F.coalesce(key.cast("string"), F.lit(""))
    rack = _winner(_winner(_tree(shards), key, seed)["children"], key, seed)
    return _winner(rack["children"], key, seed)["shard"]


def assign(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", seed: str = "shard") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``docs``.

    The law is ``key``: id and number of shards decide, and ``grown_shard`` is the shard with one more. ``size`` is the
    UTF-8 length plus one; a null text is as long as an empty one and has the checksum of it. Slots count the rows of a
    shard from 0 in the order of id (nulls first), size and checksum; repeated rows get a slot each. Other columns are
    not read, whatever their names.
    """
    content, own = F.coalesce(F.col(text), F.lit("")), F.col(key)
    rows = docs.select(
        own.cast("long").alias("doc_id"), (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(content).cast("long").alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(own, topology(shards), seed).alias("shard"), shard_of(own, topology(shards + 1), seed).alias("grown_shard"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("size").asc(), F.col("text_crc32").asc()]
    placed = numbered(materialize(rows), ["shard"], order, "slot")
    return placed.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write_shards(docs: DataFrame, shards: list[Shard], path: str, key: str = "doc_id", name: str = "shard", seed: str = "shard") -> None:
    """Write whole rows as Parquet, one folder ``name=<shard>`` per shard; tasks write their own rows, nothing is shuffled.

    A column that is called ``name`` already is refused, since it would be lost.
    """
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"the rows have a column {name} already")
    docs.withColumn(name, shard_of(F.col(key), shards, seed)).write.partitionBy(name).parquet(path)

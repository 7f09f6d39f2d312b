"""Entity resolution: candidate pairs by edit distance, groups, decisions, merging.

Candidates come from equi-joins on keys that any two ids within the distance must share, never from all pairs of a
component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graphloom.functions.text import unroll
from graphloom.operators.components import connected_components, updated_components
from graphloom.session import materialize, shuffle_width

MIN_ID_LENGTH = 4
MAX_EDITS = 2
SHORT_ID = 40
#: Keys (64 bits each) that are sent whole to every task.
BROADCAST_KEYS = 2_000_000


def _without_up_to_two(text: Column) -> Column:
    """The text and every text left after deleting one or two of its characters, without repeats."""
    n = F.length(text)
    places = F.sequence(F.lit(1), n)

    def cut_from(i: Column) -> Column:
        # j == i deletes one character, j > i deletes two.
        return F.transform(
            F.sequence(i, n),
            lambda j: F.concat(
                F.substr(text, F.lit(1), i - 1),
                F.substr(text, i + 1, F.greatest(j - i - 1, F.lit(0))),
                F.substr(text, j + 1),
            ),
        )

    return F.array_distinct(F.concat(F.array(text), F.flatten(F.transform(places, cut_from))))


def _short_keys(ids: DataFrame) -> DataFrame:
    """Ids within two edits share a text that both reach by deleting at most two characters."""
    short = ids.where(F.length("low") <= SHORT_ID + MAX_EDITS)
    texts = unroll(short, ["block", "low"], _without_up_to_two(F.col("low")), "_text")
    return texts.select("block", "low", F.xxhash64("_text").alias("key"))


def _long_pairs(ids: DataFrame) -> DataFrame:
    """Of three equal parts of an id, two edits leave one intact, moved by at most two places.

    Each long id sends 3 stored keys and 75 looked-up keys, whatever its length.
    """
    long_ids = ids.where(F.length("low") > SHORT_ID - MAX_EDITS).withColumn("n", F.length("low").cast("int"))
    segments = F.array(*[F.lit(s) for s in range(3)])

    def start(n: Column, s: Column) -> Column:
        return F.floor(n * s / 3).cast("int")

    stored = long_ids.select("block", F.col("low").alias("b"), "n", F.explode(segments).alias("s"))
    stored = stored.select(
        "block", "b", "n", "s",
        F.xxhash64(
            F.substr("b", start(F.col("n"), F.col("s")) + 1, start(F.col("n"), F.col("s") + 1) - start(F.col("n"), F.col("s")))
        ).alias("key"),
    )
    shifts = F.array(*[F.lit(d) for d in range(-MAX_EDITS, MAX_EDITS + 1)])
    looked = (
        long_ids.select("block", F.col("low").alias("a"), "n", F.explode(shifts).alias("d"))
        .select("block", "a", (F.col("n") + F.col("d")).alias("n"))
        .withColumn("s", F.explode(segments))
        .withColumn("shift", F.explode(shifts))
        .withColumn("at", start(F.col("n"), F.col("s")) + F.col("shift"))
        .withColumn("len", start(F.col("n"), F.col("s") + 1) - start(F.col("n"), F.col("s")))
        .where((F.col("at") >= 0) & (F.col("at") + F.col("len") <= F.length("a")))
        .select("block", "a", "n", "s", F.xxhash64(F.substr("a", F.col("at") + 1, F.col("len"))).alias("key"))
    )
    return stored.hint("merge").join(looked, ["block", "n", "s", "key"]).where(F.col("a") < F.col("b")).select("block", "a", "b")


def _near(a: Column, b: Column) -> Column:
    """Below three edits. With a threshold Spark returns -1 for anything farther."""
    return (F.abs(F.length(a) - F.length(b)) <= MAX_EDITS) & F.levenshtein(a, b, MAX_EDITS).between(0, MAX_EDITS)


def duplicate_pairs(entities: DataFrame, block: str, key: str = "id") -> DataFrame:
    """``(block, a, b, distance)`` with ``a < b``: lowercased ids over four characters, of one block, that are fewer
    than three edits apart. Ids that differ only by case are one form here; :func:`duplicate_groups` ties them.
    """
    ids = entities.where(F.length(key) > MIN_ID_LENGTH).select(
        F.col(block).alias("block"), F.col(key).alias("id"), F.lower(key).alias("low")
    )
    # A fixed width: the few bytes of the forms say little about the keys they turn into.
    width = shuffle_width(entities.sparkSession)
    forms = ids.select("block", "low").repartition(width, "block", "low").distinct()
    keys = _short_keys(forms)
    left = keys.select("block", "key", F.col("low").alias("a"))
    right = keys.select("block", "key", F.col("low").alias("b"))
    # Size estimates do not see how many keys an id makes: a merge join keeps them from being broadcast.
    short = left.hint("merge").join(right, ["block", "key"]).where(F.col("a") < F.col("b")).select("block", "a", "b")
    # Verified before the repeats are removed: false candidates do not reach the shuffle.
    pairs = short.where(_near(F.col("a"), F.col("b"))).union(
        _long_pairs(forms).where(_near(F.col("a"), F.col("b")))
    )
    return pairs.distinct().withColumn("distance", F.levenshtein("a", "b"))


def _leads(entities: DataFrame, block: str, key: str) -> tuple[DataFrame, DataFrame]:
    """Ids over four characters ``(block, id, low)``, and the smallest id ``lead`` of each lowercased form of a block."""
    ids = entities.where(F.length(key) > MIN_ID_LENGTH).select(
        F.col(block).alias("block"), F.col(key).alias("id"), F.lower(key).alias("low")
    )
    return ids, ids.groupBy("block", "low").agg(F.min("id").alias("lead"))


def _without_one(text: Column) -> Column:
    """The text and every text left after deleting one of its characters, without repeats."""
    cut = F.transform(F.sequence(F.lit(1), F.length(text)), lambda i: F.concat(F.substr(text, F.lit(1), i - 1), F.substr(text, i + 1)))
    return F.array_distinct(F.concat(F.array(text), cut))


def close_links(leads: DataFrame) -> DataFrame:
    """``(src, dst)`` links between forms that one deletion at most on either side makes equal.

    All forms that reach the same text this way are fewer than three edits apart, so each is tied to one of them only.
    """
    short = leads.where(F.length("low") <= SHORT_ID + MAX_EDITS)
    texts = unroll(short, ["block", "lead"], _without_one(F.col("low")), "_text")
    first = F.min("lead").over(Window.partitionBy("block", "_text"))
    return texts.select(F.col("lead").alias("src"), first.alias("dst")).where("src <> dst").distinct()


def mask_links(named: DataFrame) -> DataFrame:
    """``(src, dst)`` links between labels of ``(block, low, label)``: short forms of one length that differ in two places.

    Forms that are equal but for the same two places are fewer than three edits apart, so each group of them is tied to one
    label: no pairs are made and none is to be verified. Only places in which forms of the block and length differ count.
    """
    short = named.where(F.length("low") <= SHORT_ID + MAX_EDITS).withColumn("n", F.length("low"))
    places = short.select("block", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("at"), "low")
    letters = places.select("block", "n", "at", F.substr("low", F.col("at"), F.lit(1)).alias("letter"))
    varied = letters.distinct().groupBy("block", "n", "at").agg(F.count(F.lit(1)).alias("letters")).where("letters > 1")
    varied = varied.groupBy("block", "n").agg(F.sort_array(F.collect_list("at")).alias("at")).where(F.size("at") > 1)
    chosen = F.flatten(F.transform("at", lambda i: F.transform(F.filter("at", lambda j: j > i), lambda j: F.struct(i.alias("i"), j.alias("j")))))
    pairs = varied.select("block", "n", chosen.alias("pairs"))
    cut = short.join(pairs, ["block", "n"]).select("block", "low", "label", F.explode("pairs").alias("at"))
    rest = F.concat(F.expr("substr(low, 1, at.i - 1)"), F.expr("substr(low, at.i + 1, at.j - at.i - 1)"), F.expr("substr(low, at.j + 1)"))
    rows = cut.select("block", "at", rest.alias("rest"), F.col("label").alias("src"))
    first = F.min("src").over(Window.partitionBy("block", "at", "rest"))
    return rows.withColumn("dst", first).where("src <> dst").select("src", "dst").distinct()


def apart_links(leads: DataFrame, first: DataFrame) -> DataFrame:
    """``(src, dst)`` links between forms fewer than three edits apart that are not in one component of ``first`` yet.

    Blocks of one component have none. Short forms of one length are either one deletion on each side apart, so that they
    are in one component, or tied by :func:`mask_links`. For other partners, keys are made of short forms whose block has
    forms one or two characters longer or shorter. Of two components one is not its block's largest: only the others'
    forms look for partners, among all forms of their block.
    """
    named = leads.join(first.select(F.col("id").alias("lead"), "component"), "lead", "left")
    named = materialize(named.select("block", "low", "lead", F.coalesce("component", "lead").alias("label")))
    sizes = named.groupBy("block", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.groupBy("block").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.count(F.lit(1)).alias("labels"))
    open_ = named.join(largest.where("labels > 1").select("block", "largest"), "block")
    open_ = materialize(open_.repartition(shuffle_width(named.sparkSession), "block", "low"))
    forms = open_.select("block", "low")
    label = lambda low, name: open_.select("block", F.col("low").alias(low), F.col("label").alias(f"_{name}"), F.col("lead").alias(name))

    lengths = forms.where(F.length("low") <= SHORT_ID + MAX_EDITS).select("block", F.length("low").alias("n")).distinct()
    others_of = lengths.select("block", F.col("n").alias("other"))
    uneven = materialize(lengths.join(others_of, "block").where(F.abs(F.col("n") - F.col("other")).between(1, MAX_EDITS)).select("block", "n").distinct())

    def keyed(rows: DataFrame, low: str, name: str) -> DataFrame:
        short = rows.where(F.length("low") <= SHORT_ID + MAX_EDITS).withColumn("n", F.length("low")).join(uneven, ["block", "n"])
        texts = unroll(short, ["block", "low", "label", "lead"], _without_up_to_two(F.col("low")), "_text")
        return texts.select("block", F.xxhash64("_text").alias("key"), F.col("low").alias(low), F.col("label").alias(f"_{name}"), F.col("lead").alias(name))

    # Up to a bound the bare keys are sent to the others, of which few are left then. Size estimates do not see how many keys
    # an id makes: a merge join keeps them from being broadcast.
    asking = materialize(keyed(open_.where("label <> largest"), "a", "src"))
    others = keyed(open_, "b", "dst")
    if asking.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS:
        others = others.join(F.broadcast(asking.select("key").distinct()), "key", "left_semi")
    short = asking.hint("merge").join(others, ["block", "key"]).where((F.col("_src") != F.col("_dst")) & (F.length("a") != F.length("b")) & _near(F.col("a"), F.col("b")))
    long_ = _long_pairs(forms).join(label("a", "src"), ["block", "a"]).join(label("b", "dst"), ["block", "b"])
    long_ = long_.where((F.col("_src") != F.col("_dst")) & _near(F.col("a"), F.col("b")))
    return mask_links(open_).union(short.select("src", "dst")).union(long_.select("src", "dst")).distinct()


def duplicate_groups(entities: DataFrame, block: str, key: str = "id") -> DataFrame:
    """``(group_id, entity_id)``: candidate groups of more than one entity, closed over shared members.

    The group's id is its smallest member. One row per member: no group is gathered into a row. Links are those of
    :func:`duplicate_pairs` and of ids that differ only by case, but pairs inside a group are not all made: the cheapest
    links come first, then only those between the components they give.
    """
    ids, leads = _leads(entities, block, key)
    same = ids.join(leads, ["block", "low"]).where(F.col("id") != F.col("lead")).select(
        F.col("id").alias("src"), F.col("lead").alias("dst")
    )
    first = materialize(connected_components(materialize(same.union(close_links(leads)))))
    found = updated_components(first, materialize(apart_links(leads, first)))
    return found.select(F.col("component").alias("group_id"), F.col("id").alias("entity_id"))


# --- decisions --------------------------------------------------------------------------------------------------


def normal_form(name: Column) -> Column:
    """Lowercase without punctuation and spaces."""
    return F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]", "")


def digit_runs(name: Column) -> Column:
    """The name's runs of digits, in order, separated."""
    return F.array_join(F.regexp_extract_all(name, F.lit("[0-9]+"), F.lit(0)), ",")


def entity_resolution(groups: DataFrame, decisions: DataFrame | None = None) -> DataFrame:
    """``(group_id, entity_id)`` to merge, from candidate groups.

    By rule: names that agree once case, punctuation and spaces are gone and whose runs of digits are equal, so that
    different numbers or dates stay apart. A ``decisions`` table from outside replaces the rule; no rows, no merge.
    """
    if decisions is not None:
        named = decisions.where(F.col("entity_id").isNotNull()).select("group_id", "entity_id").distinct()
        return named
    formed = groups.select(
        "group_id", "entity_id",
        normal_form(F.col("entity_id")).alias("form"), digit_runs(F.col("entity_id")).alias("digits"),
    )
    same = ["group_id", "form", "digits"]
    sizes = formed.groupBy(*same).agg(F.count(F.lit(1)).alias("n"), F.min("entity_id").alias("lead"))
    return formed.join(sizes.where(F.col("n") > 1), same).select(F.col("lead").alias("group_id"), "entity_id")


# --- merging ----------------------------------------------------------------------------------------------------


def survivors(entities: DataFrame, merges: DataFrame, key: str = "id") -> DataFrame:
    """``(id, survivor)`` for every entity that disappears.

    Names that are no entity are ignored. Groups that share a member become one; the smallest id survives.
    """
    known = merges.join(entities.select(F.col(key).alias("entity_id")), "entity_id", "left_semi")
    lead = known.groupBy("group_id").agg(F.min("entity_id").alias("dst"))
    links = known.join(lead, "group_id").select(F.col("entity_id").alias("src"), "dst")
    found = connected_components(materialize(links))
    return found.where(F.col("id") != F.col("component")).select("id", F.col("component").alias("survivor"))


def merge_entities(entities: DataFrame, mapping: DataFrame) -> DataFrame:
    """Survivors keep their own properties; merged entities leave."""
    return entities.join(mapping, "id", "left_anti")


def merge_edges(edges: DataFrame, mapping: DataFrame, keep_loops: bool = True) -> DataFrame:
    """Edges re-pointed to survivors. Parallel edges stay; ``is_loop`` marks edges whose ends became one."""
    heads = mapping.select(F.col("id").alias("src"), F.col("survivor").alias("_src"))
    tails = mapping.select(F.col("id").alias("dst"), F.col("survivor").alias("_dst"))
    moved = (
        edges.join(heads, "src", "left")
        .join(tails, "dst", "left")
        .withColumn("src", F.coalesce("_src", "src"))
        .withColumn("dst", F.coalesce("_dst", "dst"))
        .drop("_src", "_dst")
        .withColumn("is_loop", F.col("src") == F.col("dst"))
    )
    return moved if keep_loops else moved.where(~F.col("is_loop"))


def merge_mentions(mentions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Mentions re-pointed to survivors, one per document and entity."""
    target = mapping.select(F.col("id").alias("entity_id"), F.col("survivor").alias("_to"))
    return mentions.join(target, "entity_id", "left").select(
        "doc_id", F.coalesce("_to", "entity_id").alias("entity_id")
    ).distinct()

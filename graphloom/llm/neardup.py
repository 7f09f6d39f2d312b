"""Near-duplicate documents by SetSketch registers (Ertl, 2021).

A document is the set of its word shingles. Every shingle sends random points to the registers, a register keeps the
least, and stores it on an exponential scale: the floor of minus its logarithm to base ``BASE``, truncated to a byte
pair. Registers of two sets merge by their maximum, and equal registers are the likelier the more alike the sets are.
Bands of registers make buckets, the joint likelihood of two sketches leaves out pairs that can't reach the similarity,
and the full sets confirm the others.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import hash_words, map_batches, mix64, rolling, texts, unused
from graphloom.operators.components import connected_components
from graphloom.session import materialize

SHINGLE = 5
ROWS, BANDS = 6, 44
REGISTERS = ROWS * BANDS
BASE = 1.02
#: Registers hold 0 to TOP; OFFSET keeps points of up to e**5 above 0.
TOP, OFFSET = 4095, 256
#: Pairs stay unless the likelihood of the wanted similarity is below the best one's by half of this (over 6 deviations).
DOUBT = 40.0
#: So many ids (8 bytes each) are counted and then sent to all executors, to pick their texts without moving the others.
PICKED_IDS = 2_000_000

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text: str, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``width`` words; of all words where they are fewer."""
    hashes = hash_words(text.encode().translate(_LOWER).split())
    if not len(hashes):
        return hashes
    if len(hashes) < width:
        return rolling(hashes, len(hashes), seed=100 + len(hashes))
    return np.unique(rolling(hashes, width))


def sketch(elements: np.ndarray) -> np.ndarray:
    """Registers of a non-empty set.

    An element's points arrive at rate ``REGISTERS`` and go to random registers. Only those up to a limit are made,
    about ``REGISTERS * log(REGISTERS)`` in all, whatever the set's size. If a register is then still without a point,
    the limit is doubled: the result is that of all points.
    """
    n, limit = len(elements), (np.log(REGISTERS) + 2.0) / len(elements)
    while True:
        mean = REGISTERS * limit
        width = int(mean + 7 * mean**0.5) + 8
        counters = mix64(np.arange(1, width + 1, dtype=np.uint64), 7)
        draws = mix64(elements[:, None] ^ counters[None, :], 11)
        gaps = -np.log(((draws >> np.uint64(32)).astype(np.float64) + 0.5) * 2.0**-32) / REGISTERS
        times = np.cumsum(gaps, axis=1)
        if times[:, -1].min() > limit:  # no element has further points below the limit
            inside = times <= limit
            least = np.full(REGISTERS, np.inf)
            places = ((draws[inside] & np.uint64(0xFFFFFFFF)) * np.uint64(REGISTERS) >> np.uint64(32)).astype(np.int64)
            np.minimum.at(least, places, times[inside])
            if np.isfinite(least).all():
                return np.clip(np.floor(OFFSET - np.log(least) / np.log(BASE)), 0, TOP).astype(np.uint16)
        limit *= 2


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of the union."""
    return np.maximum(one, other)


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)


def _log_likelihood(j, u, v, more, fewer):
    above, below = np.clip(_p(u - v * j), 1e-12, 1), np.clip(_p(v - u * j), 1e-12, 1)
    equal = np.clip(1 - above - below, 1e-12, 1)
    return more * np.log(above) + fewer * np.log(below) + (REGISTERS - more - fewer) * np.log(equal)


def likely(one: np.ndarray, other: np.ndarray, n_one: np.ndarray, n_other: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood similarities of rows of registers, and which pairs may reach ``similarity``."""
    more, fewer = (one > other).sum(axis=1), (one < other).sum(axis=1)
    u, v = n_one / (n_one + n_other), n_other / (n_one + n_other)
    most = np.minimum(u / v, v / u)
    grid = np.linspace(0, 1, 65)[:, None] * most
    values = _log_likelihood(grid, u, v, more, fewer)
    best = values.argmax(axis=0)
    found = grid[best, np.arange(len(u))]
    wanted = _log_likelihood(np.minimum(similarity, most), u, v, more, fewer)
    return found, (most >= similarity - 1e-9) & ((found >= similarity) | (2 * (values.max(axis=0) - wanted) <= DOUBT))


def sketches(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE) -> DataFrame:
    """``(id, n, same, registers)``; ``same`` is a digest of the set. Empty sets have no digest and no registers."""

    def run(batch: pa.RecordBatch) -> dict:
        columns: dict = {"id": batch.column("id"), "n": [], "same": [], "registers": []}
        for value in texts(batch, "text"):
            own = shingles(value, width)
            columns["n"].append(len(own))
            columns["same"].append(hashlib.blake2b(own.tobytes(), digest_size=16).digest() if len(own) else None)
            columns["registers"].append(sketch(own).tobytes() if len(own) else None)
        return columns

    rows = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text"))
    return map_batches(rows, run, "id long, n long, same binary, registers binary")


def _bands(reps: DataFrame) -> DataFrame:
    """``(bucket, id, n)``: one row for each band."""

    def run(batch: pa.RecordBatch) -> dict:
        registers = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(batch.num_rows, BANDS, ROWS)
        key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), registers.shape[:2])
        for row in range(ROWS):
            key = mix64(key ^ registers[:, :, row].astype(np.uint64), row)
        repeat = lambda name: np.repeat(batch.column(name).to_numpy(), BANDS)
        return {"bucket": key.ravel().view(np.int64), "id": repeat("id"), "n": repeat("n")}

    return map_batches(reps.select("id", "n", "registers"), run, "bucket long, id long, n long")


def _plausible(pairs: DataFrame, reps: DataFrame, hundredths: int) -> DataFrame:
    """Of ``(a, b)`` pairs, those whose sketches allow the similarity."""
    own = reps.select("id", "n", "registers")
    both = pairs.join(own.toDF("a", "n_a", "r_a").hint("merge"), "a").join(own.toDF("b", "n_b", "r_b").hint("merge"), "b")

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                rows = lambda name: np.frombuffer(b"".join(part.column(name).to_pylist()), np.uint16).reshape(part.num_rows, -1)  # noqa: B023,E731
                sizes = [part.column(name).to_numpy().astype(float) for name in ("n_a", "n_b")]
                _, keep = likely(rows("r_a"), rows("r_b"), *sizes, hundredths / 100)
                yield part.select(["a", "b"]).filter(pa.array(keep))

    return both.mapInArrow(run, "a long, b long")


def picked(docs: DataFrame, ids: DataFrame, doc_id: str = "id", how: str = "left_semi") -> DataFrame:
    """The documents of a written table of distinct ``id`` values, or (``left_anti``) the others.

    Beyond ``PICKED_IDS`` both sides are shuffled. Rows without an id match none.
    """
    few = ids.limit(PICKED_IDS + 1).count() <= PICKED_IDS
    (name,) = unused(docs.columns, "_picked")
    own = ids.select(F.col("id").alias(name))
    return docs.join(F.broadcast(own) if few else own.hint("merge"), docs[doc_id] == F.col(name), how)


def _confirmed(pairs: DataFrame, docs: DataFrame, hundredths: int, width: int) -> DataFrame:
    """Of ``(a, b)`` pairs, those whose full sets have ``100 * intersection >= hundredths * union``."""
    ids = materialize(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct())

    def sets(batch: pa.RecordBatch) -> dict:
        return {"id": batch.column("id"), "items": [shingles(value, width).tobytes() for value in texts(batch, "text")]}

    needed = materialize(map_batches(picked(docs, ids), sets, "id long, items binary"))
    with_a = pairs.join(needed.toDF("a", "items_a").hint("merge"), "a")
    both = with_a.join(needed.toDF("b", "items_b").hint("merge"), "b")

    def run(batches):
        for batch in batches:
            keep = []
            for one, other in zip(batch.column("items_a"), batch.column("items_b")):
                x, y = np.frombuffer(one.as_buffer(), np.uint64), np.frombuffer(other.as_buffer(), np.uint64)
                merged = np.sort(np.concatenate([x, y]))
                common = int((merged[1:] == merged[:-1]).sum())
                keep.append(100 * common >= hundredths * (len(merged) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame, hundredths: int = 80, doc_id: str = "doc_id", text: str = "text", width: int = SHINGLE
) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)``: one row for each id.

    Words are runs of non-blank characters (blank: space and 9 to 13), A to Z lowered. Documents are linked where
    ``100 * intersection >= hundredths * union`` of their sets; ``component_id`` is the smallest id reachable. Null and
    empty texts have empty sets and are linked with nothing. Rows that repeat an id are one document with the greatest
    of their texts; rows without an id are left out. An empty table gives none.

    Equal sets are one representative from the start. In a bucket every member meets the smallest (a number of pairs
    that is linear in the bucket), links are confirmed and components merged; buckets whose members then lie in more
    than one component go on by their rarest shingles (prefix filter), which is exact. No group is capped and none is
    gathered in one task.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("id"), docs[text].alias("text")).where("id IS NOT NULL")
    repeated = rows.groupBy("id").count().where("count > 1").limit(1).count()
    sets = materialize(rows.groupBy("id").agg(F.max("text").alias("text"))) if repeated else rows
    table = materialize(sketches(sets, "id", "text", width))
    groups = table.where("n > 0").groupBy("same").agg(F.min(F.struct("id", "n", "registers")).alias("s"))
    reps = materialize(groups.select("same", "s.*"))

    buckets = _bands(reps)
    stat = buckets.groupBy("bucket").agg(F.min(F.struct("id", "n")).alias("pivot"), F.count(F.lit(1)).alias("k")).where("k > 1")
    live = materialize(buckets.join(stat.hint("merge"), "bucket").select("bucket", "id", "n", F.col("pivot.id").alias("pivot"), F.col("pivot.n").alias("pivot_n")))
    ratio = lambda x, y: 100 * F.least(x, y) >= hundredths * F.greatest(x, y)
    star = live.where(F.col("id") != F.col("pivot")).where(ratio(F.col("n"), F.col("pivot_n")))
    star = star.select(F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()
    links = materialize(_confirmed(materialize(_plausible(star, reps, hundredths)), sets, hundredths, width))
    # pivots have met their buckets; what is left is pairs of other members in different components
    found = materialize(connected_components(links, src="a", dst="b", node="id"))
    labelled = live.where(F.col("id") != F.col("pivot")).select("bucket", "id").join(found, "id", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "id"))
    split = labelled.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    open_ids = labelled.join(split.select("bucket").hint("merge"), "bucket").groupBy("id").agg(F.first("component").alias("component"))
    open_ids = materialize(open_ids)
    if open_ids.limit(1).count():
        pairs = materialize(_rare_pairs(open_ids, reps, sets, hundredths, width))
        more = materialize(_confirmed(materialize(_plausible(pairs, reps, hundredths)), sets, hundredths, width))
        found = materialize(connected_components(links.union(more), src="a", dst="b", node="id"))

    component = reps.select("same", F.col("id").alias("rep")).join(found.select(F.col("id").alias("rep"), "component"), "rep", "left")
    named = component.select("same", F.coalesce("component", "rep").alias("component"))
    out = table.select("id", "n", "same").join(named.hint("merge"), "same", "left")
    out = out.select("id", "n", F.coalesce("component", "id").alias("component_id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", (F.col("id") == F.col("component_id")).alias("kept"))


def _rare_pairs(members: DataFrame, reps: DataFrame, docs: DataFrame, hundredths: int, width: int) -> DataFrame:
    """Pairs ``(a, b)`` of ``(id, component)`` members that lie in different components and may be linked.

    Two sets that are alike enough share one of their rarest shingles: if both are put in one order, rarest first, the
    first common one has so many behind it in either set that the wanted overlap can still be reached. Members of a
    large family that differ in rare shingles therefore never meet, however much they have in common.
    """

    def items(batch: pa.RecordBatch) -> dict:
        sets = [shingles(value, width) for value in texts(batch, "text")]
        return {"id": np.repeat(batch.column("id").to_numpy(), [len(x) for x in sets]), "item": np.concatenate(sets).view(np.int64)}

    flat = materialize(map_batches(picked(docs, members), items, "id long, item long"))
    counts = flat.groupBy("item").agg(F.count(F.lit(1)).alias("df"))
    placed = flat.join(counts.hint("merge"), "item").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("df", "item"))).alias("items"))
    # a set of n has at most n - ceil(share * n) + 1 places where its first common shingle can lie
    front = F.slice("items", 1, (F.size("items") - F.ceil(F.size("items") * hundredths / 100) + 1).cast("int"))
    firsts = placed.select("id", F.size("items").alias("n"), F.posexplode(front).alias("place", "cell")).where("cell.df > 1")
    firsts = firsts.select("id", "n", "place", F.col("cell.item").alias("item")).join(members.hint("merge"), "id")
    firsts = materialize(firsts)
    one, other = (firsts.select(*[F.col(c).alias(f"{c}_{x}") for c in ("id", "n", "place", "component")], F.col("item")) for x in "ab")
    reach = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    pairs = one.join(other.hint("merge"), "item").where("component_a < component_b")
    pairs = pairs.where(reach * (100 + hundredths) >= hundredths * (F.col("n_a") + F.col("n_b")))
    return pairs.select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct()

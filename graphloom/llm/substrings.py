"""Substring deduplication by super-k-mers of words.

A window is ``width`` consecutive words; its minimiser is the run of ``KMER`` words with the least hash inside it.
Consecutive windows that share their minimiser form a super-k-mer. Minimisers that occur in one document only can't
hold a repeated window and are left out after counting; every other super-k-mer travels as one packed string to its
minimiser's bucket, once for each distinct string. There its windows are sorted, which tells for every window exactly
the smallest document that holds it. A bucket of too many strings (a passage in many documents with other words around)
isn't gathered: its windows travel as hashes, and the smallest document of each is an aggregate.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from graphloom.llm.common import hash_words, map_batches, rolling, texts, unused
from graphloom.session import materialize, shuffle_width

KMER = 5
#: Windows of a text whose minimisers are found at once.
LONGEST = 1 << 14
#: Packed strings sorted together; a bucket sorted here is never cut.
BLOCK_STRINGS = 4000
#: Buckets with more documents are cut again by a second minimiser.
HOT = 2000
#: Buckets with more strings even so are taken window by window.
WIDE = 4000


def super_kmers(words: np.ndarray, width: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First windows, numbers of windows and minimisers of the super-k-mers of word hashes."""
    kmer = min(KMER, width)
    hashes = rolling(words, kmer, seed)
    span = width - kmer + 1
    windows = len(hashes) - span + 1
    if windows <= 0:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    places = np.empty(windows, np.int64)
    for at in range(0, windows, LONGEST):
        some = hashes[at : min(at + LONGEST, windows) + span - 1]
        places[at : min(at + LONGEST, windows)] = at + _least_places(some, span)
    starts = np.flatnonzero(np.concatenate([[True], places[1:] != places[:-1]]))
    return starts, np.diff(np.append(starts, windows)), hashes[places[starts]].view(np.int64)


def _least_places(hashes: np.ndarray, span: int) -> np.ndarray:
    """Place of the least hash in each run of ``span``, the first of those with equal upper bits.

    Each place is packed below the upper bits. A run covers the end of one block of ``span`` and the start of the next,
    whose least values are known from both sides.
    """
    bits = np.uint64((LONGEST + span).bit_length())  # the same for every text
    packed = np.full(-(-len(hashes) // span) * span, np.iinfo(np.uint64).max, np.uint64)
    packed[: len(hashes)] = hashes >> bits << bits | np.arange(len(hashes), dtype=np.uint64)
    blocks = packed.reshape(-1, span)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(hashes) - span + 1
    least = np.minimum(behind[:n], ahead[span - 1 : span - 1 + n])
    return (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def window_hashes(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows of packed strings, one string after the other, as two hashes each, and their number in each string."""
    hashes = hash_words(b" ".join(strings).split(b" "))
    ends = np.cumsum([s.count(b" ") + 1 for s in strings])
    counts = np.diff(ends, prepend=0) - (width - 1)
    # The runs that cross from one string into the next are left out.
    inside = np.arange(counts.sum()) + np.repeat(np.arange(len(strings)) * (width - 1), counts)
    one, two = rolling(hashes, width, 1), rolling(hashes ^ np.uint64(0x5851F42D4C957F2D), width, 2)
    return one[inside], two[inside], counts


def first_documents(strings: list[bytes], documents: np.ndarray, width: int) -> list[np.ndarray]:
    """For each packed string, the smallest document of each of its windows among all strings given."""
    a, b, counts = window_hashes(strings, width)
    owner = np.repeat(documents, counts)
    order = np.lexsort((owner, b, a))
    new = np.concatenate([[True], (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])])
    first = owner[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    back = np.empty(len(order), np.int64)
    back[order] = first
    return np.split(back, np.cumsum(counts)[:-1])


def repeated_spans(docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, key, spans)``: word spans covered by windows that also start in a document with a smaller id.

    ``key`` is a hash of the text, so that rows which share an id keep their own spans. ``spans`` holds starts and
    stops in turn. Documents without such windows have no row; rows without an id neither cover nor are covered.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("id"), F.xxhash64(docs[text]).alias("key"), docs[text].alias("text"))
    rows = rows.where("id IS NOT NULL AND text IS NOT NULL")
    if rows.groupBy("id", "key").count().where("count > 1").limit(1).count():
        rows = materialize(rows.distinct())  # equal rows are judged alike

    def cut(batch: pa.RecordBatch) -> dict:
        columns: dict = {name: [] for name in ("id", "key", "start", "windows", "minimiser")}
        more: list = []
        for number, key, value in zip(batch.column("id").to_pylist(), batch.column("key").to_pylist(), texts(batch, "text")):
            starts, counts, minimisers, others = _by_minimiser(*super_kmers(hash_words(value.encode().split()), width))
            if len(starts):
                more += others
                columns["id"].append(np.full(len(starts), number))
                columns["key"].append(np.full(len(starts), key))
                for name, values in (("start", starts), ("windows", counts), ("minimiser", minimisers)):
                    columns[name].append(values)
        return {"more": more, **{name: np.concatenate(values) if values else np.empty(0, np.int64) for name, values in columns.items()}}

    cuts = materialize(map_batches(rows, cut, "id long, key long, start int, windows int, more array<int>, minimiser long"))
    counted = cuts.groupBy("minimiser").agg(F.min("id").alias("lo"), F.max("id").alias("hi"), F.count(F.lit(1)).alias("k"))
    shared = counted.where("lo < hi").select("minimiser", (F.col("k") > HOT).alias("hot"))
    parts = cuts.join(shared.hint("merge"), "minimiser")
    parts = parts.groupBy("id", "key").agg(F.collect_list(F.struct("start", "windows", "more", "minimiser", "hot")).alias("cuts"))
    keyed = rows.join(parts.select("id", "key"), ["id", "key"], "left_semi")
    joined = keyed.join(parts.hint("merge"), ["id", "key"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                yield _packed(batch.slice(at, 200), width)

    packed = materialize(joined.mapInArrow(pack, "id long, key long, start int, more array<int>, bucket long, sid binary, packed binary, hot boolean"))
    distinct = packed.where("hot").select("bucket", "sid").distinct()
    # at most one bucket for WIDE strings, so few enough to be sent everywhere
    wide = F.broadcast(materialize(distinct.groupBy("bucket").count().where(F.col("count") > WIDE).select("bucket")))
    strings = _strings(packed.join(wide, "bucket", "left_anti"))
    strings = strings.repartition(shuffle_width(docs.sparkSession), "bucket").sortWithinPartitions("bucket")

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < BLOCK_STRINGS:
                continue
            whole = pa.Table.from_batches(held)
            buckets = whole.column("bucket").to_numpy()
            stop = int(np.searchsorted(buckets, buckets[-1]))  # the last bucket may go on
            if stop:
                yield from _runs(whole.slice(0, stop), width)
            held = whole.slice(stop).to_batches()
        if held and sum(b.num_rows for b in held):
            yield from _runs(pa.Table.from_batches(held), width)

    runs = strings.mapInArrow(sort, _RUNS_DDL)
    runs = materialize(runs.union(_wide_runs(_strings(packed.where("hot").join(wide, "bucket", "left_semi")), width)))
    # a string held once names its place itself; only those that several places hold go back to them by a join
    places = packed.select("id", "key", "start", "more", "sid").join(runs.where("key IS NULL").select("sid", "runs").hint("merge"), "sid")
    refs = runs.where("key IS NOT NULL").select("id", "key", F.array("start").alias("starts"), "runs")
    refs = refs.unionByName(places.select("id", "key", F.concat(F.array("start"), F.coalesce("more", F.array().cast("array<int>"))).alias("starts"), "runs"))
    at = lambda i, k: F.element_at("runs", i + k)
    earlier = F.filter(F.sequence(F.lit(0), F.size("runs") - 3, F.lit(3)), lambda i: at(i, 3) < F.col("id"))
    span = lambda s, i: F.struct((s + at(i, 1)).alias("from"), (s + at(i, 2) + F.lit(width)).alias("to"))
    spans = refs.select("id", "key", F.flatten(F.transform("starts", lambda s: F.transform(earlier, lambda i: span(s, i)))).alias("spans")).where(F.size("spans") > 0)
    listed = F.sort_array(F.flatten(F.collect_list("spans")))
    return spans.groupBy("id", "key").agg(F.flatten(F.transform(listed, lambda s: F.array(s["from"], s["to"]))).alias("spans"))


def _by_minimiser(starts: np.ndarray, counts: np.ndarray, minimisers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    """One document's super-k-mers, one entry a minimiser.

    A text that repeats itself has the same minimiser again and again: the first place is the entry's, the others follow
    as starts and numbers of windows in turn, or None where there are none.
    """
    order = np.argsort(minimisers, kind="stable")
    edges = np.flatnonzero(np.concatenate([[True], minimisers[order][1:] != minimisers[order][:-1]])) if len(order) else order
    if len(edges) == len(starts):
        return starts, counts, minimisers, [None] * len(starts)
    groups = np.split(np.stack([starts, counts], axis=1).astype(np.int32)[order], edges[1:])
    first = order[edges]
    return starts[first], counts[first], minimisers[first], [g[1:].ravel() if len(g) > 1 else None for g in groups]


_PACKED = pa.schema([
    ("id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("more", pa.list_(pa.int32())), ("bucket", pa.int64()), ("sid", pa.binary()),
    ("packed", pa.binary()), ("hot", pa.bool_()),
])
_RUNS_DDL = "sid binary, id long, key long, start int, runs array<long>"
_RUNS = pa.schema([("sid", pa.binary()), ("id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("runs", pa.list_(pa.int64()))])


def _packed(batch: pa.RecordBatch, width: int) -> pa.RecordBatch:
    """The packed strings of some documents, each once a document with all places where it starts."""
    out: list[tuple] = []
    for number, value, key, cuts in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "key", "cuts"))):
        words = value.encode().split()
        held: dict[bytes, tuple[int, bool, list[int]]] = {}
        for part in cuts:
            more = part["more"] or []
            wholes: dict[bytes, list[int]] = {}
            for start, count in [(part["start"], part["windows"]), *zip(more[0::2], more[1::2])]:
                wholes.setdefault(b" ".join(words[start : start + count + width - 1]), []).append(start)
            for whole, starts in wholes.items():
                pieces = [(0, whole, part["minimiser"])]
                if part["hot"]:
                    inner = whole.split(b" ")
                    again = super_kmers(hash_words(inner), width, seed=5)
                    pieces = [(s, b" ".join(inner[s : s + n + width - 1]), part["minimiser"] ^ m) for s, n, m in zip(*(x.tolist() for x in again))]
                for offset, string, bucket in pieces:
                    held.setdefault(string, (bucket, part["hot"], []))[2].extend(s + offset for s in starts)
        for string, (bucket, hot, starts) in held.items():
            sid = hashlib.blake2b(string, digest_size=16).digest()
            out.append((number, key, starts[0], starts[1:] or None, bucket, sid, string, hot))
    columns = zip(*out) if out else [[]] * len(_PACKED)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, _PACKED)], schema=_PACKED)


def _runs(table: pa.Table, width: int) -> Iterator[pa.RecordBatch]:
    """For each string, runs of windows with one smallest document: first and last window, document."""
    firsts = first_documents(table.column("packed").to_pylist(), table.column("lo").to_numpy(), width)
    rows, found = [], []
    for row, (hi, first) in enumerate(zip(table.column("hi").to_pylist(), firsts)):
        starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
        stops = np.append(starts[1:], len(first)) - 1
        wanted = first[starts] < hi  # else no document of this string comes later
        if wanted.any():
            rows.append(row)
            found.append(np.stack([starts[wanted], stops[wanted], first[starts][wanted]], axis=1).ravel())
    named = table.select(["sid", "lo", "key", "start"]).take(pa.array(rows, pa.int64()))
    columns = [column.combine_chunks() for column in named.columns]
    yield pa.RecordBatch.from_arrays([*columns, pa.array(found, _RUNS.field("runs").type)], schema=_RUNS)


def _strings(packed: DataFrame) -> DataFrame:
    """Each distinct string of a bucket with the smallest and the largest document that has it.

    ``key`` and ``start`` are those of its only place, or null where it has several.
    """
    once = (F.count(F.lit(1)) == 1) & (F.count("more") == 0)
    return packed.groupBy("bucket", "sid").agg(
        F.min("id").alias("lo"), F.max("id").alias("hi"), F.first("packed").alias("packed"),
        F.when(once, F.min("key")).alias("key"), F.when(once, F.min("start")).alias("start"),
    )


def _wide_runs(strings: DataFrame, width: int) -> DataFrame:
    """The runs of ``_runs``, with no bucket in one place: windows meet by their hashes, one row on the side of the smallest."""

    def cut(batch: pa.RecordBatch) -> dict:
        a, b, counts = window_hashes(batch.column("packed").to_pylist(), width)
        owner = np.repeat(np.arange(batch.num_rows), counts)
        return {
            **{name: batch.column(name).take(pa.array(owner)) for name in ("sid", "key", "start")}, "lo": batch.column("lo").to_numpy()[owner], "hi": batch.column("hi").to_numpy()[owner],
            "place": np.arange(len(a)) - np.repeat(np.cumsum(counts) - counts, counts), "a": a.view(np.int64), "b": b.view(np.int64),
        }

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                yield batch.slice(at, 1000)

    some = strings.select("sid", "key", "start", "lo", "hi", "packed")
    some = some.mapInArrow(pieces, some.schema)
    windows = materialize(map_batches(some, cut, "sid binary, key long, start int, lo long, hi long, place long, a long, b long"))
    firsts = windows.groupBy("a", "b").agg(F.min("lo").alias("first"), F.max("hi").alias("last")).where("first < last").drop("last")
    found = windows.drop("lo").join(firsts.hint("merge"), ["a", "b"]).where("first < hi")
    found = found.groupBy("sid", F.col("hi").alias("id"), "key", "start").agg(F.sort_array(F.collect_list(F.struct("place", "first"))).alias("found"))

    def joined(batch: pa.RecordBatch) -> dict:
        runs = []
        for own in batch.column("found").to_pylist():
            places, first = np.array([x["place"] for x in own]), np.array([x["first"] for x in own])
            starts = np.flatnonzero(np.concatenate([[True], (places[1:] != places[:-1] + 1) | (first[1:] != first[:-1])]))
            stops = np.append(starts[1:], len(own)) - 1
            runs.append(np.stack([places[starts], places[stops], first[starts]], axis=1).ravel())
        return {**{name: batch.column(name) for name in ("sid", "id", "key", "start")}, "runs": runs}

    return map_batches(found, joined, _RUNS_DDL)


def kept_words(docs: DataFrame, keep: list[str], make, schema: str | StructType, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``make(batch, words, masks)`` over all rows of ``docs`` with the mask of kept words of each.

    Words are runs of non-blank bytes (blank: space and 9 to 13) of the whole text, unchanged. A null text has none.
    """
    spans = repeated_spans(docs, width, doc_id, text)
    own, own_key, doc, doc_key, own_text, found = unused(keep, "_id", "_of", "_doc", "_key", "_text", "_spans")
    spans = spans.toDF(own, own_key, found)
    rows = docs.select(
        *[docs[f"`{c}`"] for c in keep], docs[doc_id].cast("long").alias(doc), F.xxhash64(docs[text]).alias(doc_key), docs[text].alias(own_text)
    )
    same = (F.col(doc) == F.col(own)) & (F.col(doc_key) == F.col(own_key))
    joined = rows.join(spans.hint("shuffle_hash"), same, "left").drop(own, own_key, doc, doc_key)

    def run(batch: pa.RecordBatch) -> dict:
        all_words, masks = [], []
        for value, parts in zip(batch.column(own_text).to_pylist(), batch.column(found).to_pylist()):
            words = (value or "").encode().split()
            edges = np.zeros(len(words) + 1, np.int64)
            if parts:
                np.add.at(edges, parts[0::2], 1)
                np.add.at(edges, parts[1::2], -1)
            all_words.append(words)
            masks.append(np.cumsum(edges[:-1]) == 0)
        return make(batch, all_words, masks)

    return map_batches(joined, run, schema)


def digests(docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` for every row of ``docs``.

    A word goes if a window that covers it also starts in a document with a smaller id; windows are those of the input.
    Repeated rows are each judged alike; rows without an id are kept whole. An empty table gives none.
    """

    def make(batch: pa.RecordBatch, words: list, masks: list) -> dict:
        kept = [b" ".join([w for w, k in zip(own, mask.tolist()) if k]) if not mask.all() else b" ".join(own) for own, mask in zip(words, masks)]
        return {
            "doc_id": batch.column("doc_id"), "n_words": [len(w) for w in words],
            "n_removed": [len(m) - int(m.sum()) for m in masks], "kept_sha256": [hashlib.sha256(k).hexdigest() for k in kept],
        }

    picked = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return kept_words(picked, ["doc_id"], make, "doc_id long, n_words long, n_removed long, kept_sha256 string", width)


def strip_repeats(docs: DataFrame, width: int = 50, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with repeated words taken out of ``text``; texts that lose nothing stay as they are."""
    names = docs.columns

    def make(batch: pa.RecordBatch, words: list, masks: list) -> dict:
        out = {name: batch.column(name) for name in names}
        out[text] = [
            value if mask.all() else b" ".join([w for w, k in zip(own, mask.tolist()) if k]).decode()
            for value, own, mask in zip(batch.column(text).to_pylist(), words, masks)
        ]
        return out

    return kept_words(docs, names, make, docs.schema, width, doc_id, text)

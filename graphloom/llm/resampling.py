"""Importance resampling toward a target distribution.

Word runs are counted in hashed buckets over the corpus and over the target texts. The gain of a bucket is the log ratio
of its smoothed shares, the weight of a document the floored mean of its features' gains, and its score the weight plus
Gumbel noise from its id: the highest scores are a weighted draw without replacement. Buckets of documents are written
once as arrays and read again to be scored. The cut-off is found by bisection with exact counts over the written scores,
then over the ids tied at it, and only the drawn rows are sorted.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.ranks import numbered
from graphloom.session import materialize

#: Words taken together in one array; a text is never cut.
CHUNK_WORDS = 100_000
#: Words of up to so many bytes have tables to append them to a checksum; longer ones are hashed as they come.
TABLE_BYTES = 48
REMEMBERED_WORDS = 200_000
#: Thresholds counted in one job: four halvings.
POINTS = 15

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    """Runs of ASCII digits, letters (lower-cased) and all characters beyond ASCII; null has none."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()


def _appending_tables() -> np.ndarray:
    """``[n, j, b]``: what byte ``j`` of a checksum, if it is ``b``, becomes when n bytes are appended."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    current = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    out = [current]
    for _ in range(TABLE_BYTES):
        current = table[current & 255] ^ (current >> 8)
        out.append(current)
    return np.stack(out)


class _Checksums(dict):
    """CRC-32 of words with their length in the upper half, remembered within a bound."""

    def __missing__(self, word: bytes) -> int:
        value = zlib.crc32(word) | min(len(word), 2**31) << 32
        if len(word) <= TABLE_BYTES:
            if len(self) >= REMEMBERED_WORDS:
                self.clear()
            self[word] = value
        return value


def feature_checksums(lists: list[list[bytes]], checksums: dict, tables: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of all single words and neighbouring pairs, list after list, and the number of features of each list."""
    flat = [w for ws in lists for w in ws]
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    counts = np.maximum(2 * sizes - 1, 0)
    if not flat:
        return np.empty(0, np.uint32), counts
    packed = np.fromiter(map(checksums.__getitem__, flat), np.uint64, len(flat))
    own, length = (packed & np.uint64(0xFFFFFFFF)).astype(np.uint32), (packed >> np.uint64(32)).astype(np.int64)

    def appended(crc: np.ndarray, n: np.ndarray | int) -> np.ndarray:
        return tables[n, 0, crc & 255] ^ tables[n, 1, crc >> 8 & 255] ^ tables[n, 2, crc >> 16 & 255] ^ tables[n, 3, crc >> 24]

    spaced = appended(own[:-1], 1) ^ np.uint32(zlib.crc32(b" "))
    known = length[1:] <= TABLE_BYTES
    pairs = appended(spaced, np.where(known, length[1:], 0)) ^ own[1:]
    for i in np.flatnonzero(~known):
        pairs[i] = zlib.crc32(flat[i + 1], int(spaced[i]))
    both = np.zeros((len(flat), 2), np.uint32)
    both[:, 0], both[:-1, 1] = own, pairs
    keep = np.ones((len(flat), 2), bool)
    keep[np.cumsum(sizes[sizes > 0]) - 1, 1] = False  # no pair leaves its list
    return both[keep], counts


def feature_buckets(docs: DataFrame, n_buckets: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, n_words, buckets)``: the bucket of every feature of the whole text; a null text has none."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("buckets", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        checksums, tables = _Checksums(), _appending_tables()

        def batch_of(ids: list, lists: list[list[bytes]]) -> pa.RecordBatch:
            crc, counts = feature_checksums(lists, checksums, tables)
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            buckets = pa.ListArray.from_arrays(pa.array(offsets), pa.array((crc % np.uint32(n_buckets)).astype(np.int32)))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([len(ws) for ws in lists], pa.int64()), buckets], schema=schema)

        for batch in batches:
            ids, lists, held = [], [], 0
            for own, value in zip(batch.column(0), batch.column(1)):
                ids.append(own.as_py())
                lists.append(words(value.as_py()))
                held += len(lists[-1])
                if held >= CHUNK_WORDS:
                    yield batch_of(ids, lists)
                    ids, lists, held = [], [], 0
            if ids:
                yield batch_of(ids, lists)

    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, n_words long, buckets array<int>"
    )


def bucket_counts(features: DataFrame, n_buckets: int) -> DataFrame:
    """``(bucket, n)``; each task adds up its own rows first and sends at most one row per bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=n_buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some], pa.int64())], names=["bucket", "n"])

    return features.select("buckets").mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(corpus: DataFrame, target: DataFrame, n_buckets: int) -> np.ndarray:
    """Gain of every bucket in thousandths. The driver sees ``n_buckets`` numbers, however large the tables."""
    s, t = np.zeros(n_buckets, np.int64), np.zeros(n_buckets, np.int64)
    for counts, into in ((corpus, s), (target, t)):
        for row in bucket_counts(counts, n_buckets).collect():
            into[row.bucket] = row.n
    total_s, total_t = float(s.sum() + n_buckets), float(t.sum() + n_buckets)
    ratio = ((t + 1).astype(float) * total_s) / ((s + 1).astype(float) * total_t)
    return np.floor(1000.0 * np.log(ratio)).astype(np.int64)


def score_documents(features: DataFrame, gains: np.ndarray, seed: int) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score)``; a document without features has weight 0."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2)
            sums = np.concatenate([[0], np.cumsum(gains[column.flatten().to_numpy()])])
            edges = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            n = np.diff(edges)
            weight = np.diff(sums[edges]) // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(weight, pa.int64())], schema=schema)

    weighted = features.mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return weighted.withColumn("score", F.col("weight") + noise)


def _last_point(rows: DataFrame, column: str, low: int, high: int, reached) -> int:
    """The largest value in ``low..high`` that ``reached`` (falling in the value) accepts; ``low`` must be accepted.

    ``reached(count of rows with column >= value)``. Each job counts exactly at several values between the bounds.
    """
    while low < high:
        points = sorted({low + (high - low) * i // POINTS for i in range(1, POINTS + 1)} - {low})
        row = rows.agg(*[F.count_if(F.col(column) >= F.lit(p)).alias(f"c{i}") for i, p in enumerate(points)]).head()
        accepted = [p for i, p in enumerate(points) if reached(row[i])]
        refused = [p for i, p in enumerate(points) if not reached(row[i])]
        low, high = max(accepted, default=low), min(refused, default=high + 1) - 1
    return low


def draw(scored: DataFrame, share: int, min_words: int) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, ... for the highest scores among documents of enough words, null for the others.

    ``floor(share * N / 100)`` of the N documents are drawn. Equal scores go to the smaller id, null ids last; rows of
    one id and score go by weight, then features, and as many repeated rows are drawn as are needed. ``scored`` is a
    written table.
    """
    able = scored.where(F.col("n_words") >= min_words)
    facts = able.agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("low"), F.max("score").alias("high")).head()
    wanted = facts.n * share // 100
    if not wanted:
        return scored.withColumn("rank", F.lit(None).cast("long"))
    bar = _last_point(able, "score", facts.low, facts.high, lambda n: n >= wanted)
    tied = able.where(F.col("score") == bar)
    above = able.where(F.col("score") > bar).count()
    ids = tied.agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count("doc_id").alias("n")).head()
    at_bar = F.col("score") == bar
    if above + ids.n >= wanted:
        # The smallest id with enough ids up to it: the largest whose rows at or beyond it hold the one that is needed.
        last = _last_point(tied, "doc_id", ids.low, ids.high, lambda n: n > ids.n - (wanted - above))
        at_bar = at_bar & F.coalesce(F.col("doc_id") <= F.lit(last), F.lit(False))
    chosen = (F.col("n_words") >= min_words) & ((F.col("score") > bar) | at_bar)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight").desc(), F.col("n_features").desc()]
    ranked = numbered(scored.where(chosen), [], order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < wanted, F.col("rank") + 1))
    return ranked.unionByName(scored.where(~chosen).withColumn("rank", F.lit(None).cast("long")))


def resample(
    docs: DataFrame, target: DataFrame, n_buckets: int = 10_000, share: int = 25, min_words: int = 20, seed: int = 7,
    key: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_features, weight, score, rank)``, one row per row of ``docs``; rank is null where undrawn.

    All texts of both tables count. Null and empty texts have no features and are never drawn while ``min_words`` is
    above 0. A null id draws its noise from the seed alone. Other columns are not read. Empty tables give no gains or no rows.
    """
    features = materialize(feature_buckets(docs, n_buckets, key, text))
    gains = bucket_gains(features, feature_buckets(target.select(F.lit(0).alias("doc_id"), F.col(text).alias("text")), n_buckets), n_buckets)
    scored = materialize(score_documents(features, gains, seed))
    return draw(scored, share, min_words)

"""Document fingerprints from prefix polynomial hashes.

``PrefixHashes`` holds, for every prefix of a text, its polynomial hash modulo a prime. Any span's hash follows from two
entries, so spans can be compared in constant time and the longest common extension of two positions is found by
binary search. A fingerprint is the hash of the whole text and, for each of ``SLOTS`` slots, the least mixed hash among
the spans of ``SPAN`` characters that fall into the slot (one permutation, empty slots filled from the next full one).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from graphloom.llm.common import mix64
from graphloom.session import materialize, shuffle_width

MODULUS = (1 << 31) - 1
PRIME = np.uint64(MODULUS)
BASES = (911382323, 972663749)
INVERSES = tuple(pow(base, MODULUS - 2, MODULUS) for base in BASES)
SLOTS = 64
SPAN = 12
#: Characters of a text that tell ranges of one id apart; texts are still sorted as a whole.
RANGE_PREFIX = 32


_tables: dict[int, np.ndarray] = {}


def _mod(x: np.ndarray) -> np.ndarray:
    """Values below 2**63 modulo the Mersenne prime, in place."""
    over = x >> np.uint64(31)
    for _ in range(2):
        x &= PRIME
        x += over
        np.right_shift(x, np.uint64(31), out=over)
    np.subtract(x, PRIME, out=over)  # wraps round where it would be negative
    return np.minimum(x, over, out=x)


def _powers(n: int, base: int) -> np.ndarray:
    """``base ** i`` for i up to n; one table for each base in a worker, as long as its longest text needs."""
    have = _tables.get(base)
    if have is None or len(have) <= n:
        have, step = np.ones(1, np.uint64), base
        while len(have) <= n:
            have = np.concatenate([have, _mod(have * np.uint64(step))])
            step = step * step % MODULUS
        _tables[base] = have
    return have


class PrefixHashes:
    """Prefix hashes of a text's code points for two bases: sums of ``c[i] * base**i``."""

    def __init__(self, text: str, before: "PrefixHashes | None" = None, keep: int = 0) -> None:
        """Of ``text``, or of the first ``keep`` characters of ``before`` and then ``text``."""
        points = np.frombuffer(text.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(1)
        self.n = keep + len(points)
        self.prefix = []
        for i, base in enumerate(BASES):
            total = np.zeros(self.n + 1, np.uint64)
            if keep:
                total[: keep + 1] = before.prefix[i][: keep + 1]
            # below 2**63 up to 2**31 characters
            total[keep + 1 :] = np.cumsum(_mod(points * _powers(self.n, base)[keep : self.n])) + total[keep]
            total[keep + 1 :] = _mod(total[keep + 1 :])
            self.prefix.append(total)
        self.mixed = self._mixed(before, keep)

    def _mixed(self, before: "PrefixHashes | None", keep: int) -> np.ndarray:
        """Mixed hashes of all spans of ``SPAN`` characters (of the whole, where it is shorter)."""
        width = min(SPAN, self.n)
        count = self.n - width + 1 if self.n else 0
        known = keep - SPAN + 1 if keep >= SPAN else 0
        rest = mix64(self.span(slice(known, count), slice(known + width, self.n + 1))) if count > known else np.empty(0, np.uint64)
        return np.concatenate([before.mixed[:known], rest]) if known else rest

    def span(self, start: slice, stop: slice) -> np.ndarray:
        """62-bit hashes of spans; the start's power is divided out, so that equal spans agree wherever they lie."""
        out = []
        for inverse, prefix in zip(INVERSES, self.prefix):
            unshift = _powers(self.n, inverse)
            out.append(_mod(_mod(prefix[stop] + PRIME - prefix[start]) * unshift[start]))
        return out[0] << np.uint64(31) | out[1]

    def equal(self, start: int, other: "PrefixHashes", other_start: int, length: int) -> bool:
        for i, (base, inverse) in enumerate(zip(BASES, INVERSES)):
            mine, theirs = self.prefix[i], other.prefix[i]
            one = (int(mine[start + length]) - int(mine[start])) * int(_powers(start, inverse)[start])
            two = (int(theirs[other_start + length]) - int(theirs[other_start])) * int(_powers(other_start, inverse)[other_start])
            if (one - two) % MODULUS:
                return False
        return True

    def extension(self, start: int, other: "PrefixHashes", other_start: int) -> int:
        """Length of the longest common extension of two positions, by binary search."""
        low, high = 0, min(self.n - start, other.n - other_start)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, other_start, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def fingerprint(self) -> str:
        """Length, whole hash and one byte for each slot, in hexadecimal."""
        whole = int(self.span(slice(0, 1), slice(self.n, self.n + 1))[0]) if self.n else 0
        hashes = self.mixed
        least = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(least, (hashes >> np.uint64(58)).astype(np.int64), hashes)
        full = np.flatnonzero(least != np.iinfo(np.uint64).max)
        if len(full):
            source = full[np.searchsorted(full, np.arange(SLOTS)) % len(full)]
            gap = (source - np.arange(SLOTS)) % SLOTS
            cells = (mix64(least[source] + gap.astype(np.uint64), 1) >> np.uint64(56)).astype(np.uint8)
        else:
            cells = np.zeros(SLOTS, np.uint8)
        return f"{self.n:08x}{whole:016x}{cells.tobytes().hex()}"


def likeness(one: str, other: str) -> float:
    """Share of equal slots beyond chance, 1 for equal fingerprints, below 1 for all others."""
    if one == other:
        return 1.0
    if not int(one[:8], 16) or not int(other[:8], 16):
        return 0.0
    a, b = np.frombuffer(bytes.fromhex(one[24:]), np.uint8), np.frombuffer(bytes.fromhex(other[24:]), np.uint8)
    chance = 1 / 256
    return float(min(max(((a == b).mean() - chance) / (1 - chance), 0.0), 1 - 1 / (4 * SLOTS)))


def _pair(row: tuple, following: tuple) -> tuple:
    """A result row from a document and the next one: ``(doc_id, text, prefix hashes, fingerprint)`` each."""
    number, text, own, mark = row
    n = len(text)
    cut = n // 4
    edited = text[: n - cut] + following[1][:cut] if cut else text
    changed = PrefixHashes(following[1][:cut], own, n - cut) if cut else own
    edited_mark = changed.fingerprint() if cut else mark
    return (
        number, n, hashlib.sha256(edited.encode()).hexdigest(), mark, edited_mark, likeness(mark, edited_mark),
        likeness(mark, following[3]), own.extension(0, changed, 0),
    )


_NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "common_prefix")
_KINDS = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long"


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every text, of its edited text, and their likeness.

    The edited text has the last quarter of the code points (floor) replaced by the first as many of the next document
    by ascending id; the last document is followed by the first. Null texts count as empty. Rows that repeat an id
    follow each other by text, rows without an id come first. ``common_prefix`` is the longest common extension of the
    text and the edited text from their starts. An empty table gives none; a single row follows itself.

    Texts move once, to ranges of the id (and of ``RANGE_PREFIX`` characters, for repeated ids), so the keys that the
    driver samples stay short. Each task passes over its range in order and holds two texts; the last row of
    a range is completed with the first of the next, which are as few as there are tasks.
    """
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), F.coalesce(docs[text], F.lit("")).alias("text"))
    dealt = rows.repartitionByRange(shuffle_width(docs.sparkSession), "doc_id", F.substring("text", 1, RANGE_PREFIX)).sortWithinPartitions("doc_id", "text")
    dealt = dealt.withColumn("part", F.spark_partition_id())
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
        ("common_prefix", pa.int64()), ("part", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("last_id", pa.int64()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before = first = None
        part = -1
        for batch in batches:
            out = []
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for number, value in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                own = PrefixHashes(value)
                row = (number, value, own, own.fingerprint())
                if before is None:
                    first = row
                else:
                    out.append((*_pair(before, row), None, None, None, None))
                before = row
            yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*out) if out else [[]] * 12, schema)], schema=schema)
        if before is not None:
            edge = (None,) * 8 + (part, first[1], before[1], before[0])
            yield pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(edge, schema)], schema=schema)

    found = materialize(dealt.mapInArrow(run, _KINDS + ", part int, first string, last string, last_id long"))
    order = Window.orderBy("part")  # one row for each task that had rows
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = found.where("part IS NOT NULL").select("part", "first", "last", "last_id")
    paired = edges.select(
        "last_id", "last", F.coalesce(F.lead("first").over(order), F.first("first").over(whole)).alias("following")
    )

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, value, after in zip(*(batch.column(c).to_pylist() for c in ("last_id", "last", "following"))):
                own, then = PrefixHashes(value), PrefixHashes(after)
                row = _pair((number, value, own, own.fingerprint()), (None, after, then, then.fingerprint()))
                yield pa.RecordBatch.from_arrays([pa.array([c], type=f.type) for c, f in zip(row, schema)], schema=pa.schema(list(schema)[:8]))

    return found.where("part IS NULL").select(*_NAMES).unionByName(paired.mapInArrow(close, _KINDS))

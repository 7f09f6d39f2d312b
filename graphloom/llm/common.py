"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from graphloom.session import spread


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A whole input table, dealt out over all cores where its files have too few splits."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def vocabulary_path(name: str) -> str:
    """Where a public tokenizer's file lies on the machine that asks."""
    import public_tokenizers

    return public_tokenizers.path(name)


#: Rows of a batch whose Python values are held at once.
SLICE_ROWS = 1000
#: Tables of remembered values by name. Python workers live on, so a task empties all but the one it names itself.
REMEMBERED: dict[str, dict] = {}


def forget(keep: str | None) -> None:
    """Empty this worker's tables but one. A function of the module, so that tasks reach the worker's own tables."""
    for name, table in REMEMBERED.items():
        if name != keep:
            table.clear()


def map_batches(df: DataFrame, make, schema: str | StructType, keep: str | None = None) -> DataFrame:
    """``make(batch) -> dict of columns`` over Arrow batches of a bounded number of rows; empty ones give nothing.

    Columns that are Arrow arrays already are passed on as they are, whatever their type. ``keep`` names the remembered
    table that further tasks of the same kind go on with.
    """
    arrow = arrow_schema(schema)
    names = [field.name for field in arrow]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget(keep)
        try:
            for batch in batches:
                for at in range(0, batch.num_rows, SLICE_ROWS):
                    columns = make(batch.slice(at, SLICE_ROWS))
                    arrays = [
                        c if isinstance(c := columns[field.name], pa.Array) else pa.array(c, type=field.type) for field in arrow
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, names=names)
        finally:
            forget(keep)

    return df.mapInArrow(run, schema)


def arrow_schema(schema: str | StructType) -> pa.Schema:
    """The Arrow form of a schema, as Spark itself maps types."""
    return to_arrow_schema(StructType.fromDDL(schema) if isinstance(schema, str) else schema)


def unused(columns: Iterable[str], *wanted: str) -> list[str]:
    """The wanted names, lengthened until no column is called so in any case."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column with nulls as empty texts."""
    return [value or "" for value in batch.column(column).to_pylist()]


def mix64(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser (splitmix64) over unsigned integers."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered within a bound."""

    LIMIT = 300_000

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.LIMIT:
            self.clear()
        self[word] = value
        return value


_WORDS = WordHashes()
REMEMBERED["words"] = _WORDS


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))


#: Base of run hashes, odd and so with an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2**64; a bounded number is kept."""
    if _POWERS and len(_POWERS[0]) >= n:
        return _POWERS[0][:n], _POWERS[1][:n]
    with np.errstate(over="ignore"):
        made = []
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            steps = np.full(max(n, 1 << 14), base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
    if n <= 1 << 18:
        _POWERS[:] = made
    return made[0][:n], made[1][:n]


def rolling(hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """One 64-bit hash for every run of ``width`` consecutive word hashes: a polynomial modulo 2**64, from prefix sums."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        powers, inverses = _powers(len(hashes))
        sums = np.empty(len(hashes) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(hashes * inverses, out=sums[1:])
        total = (sums[width:] - sums[:n]) * powers[width - 1 :]
    return mix64(total, seed)

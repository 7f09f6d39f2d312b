"""Language identification by hyperdimensional profiles.

Every symbol has a random vector of +1 and -1. A trigram is bound as the product of its letters' vectors, each rotated
by its place; a text bundles (sums) its trigrams; a language bundles its unit-length texts. A text gets the language of
the nearest prototype by cosine.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm.common import map_batches, texts

DIMENSIONS = 1024
#: Symbols: code points of letters are folded to so many, 0 stands for everything that is no letter.
SYMBOLS = 128
SEED = 17
#: Labelled texts used at most for each language, the ones with the smallest id hashes.
TRAINING_TEXTS = 20_000
#: Texts handled together within a task.
BLOCK = 64


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Fold of each code point of the basic plane: 0 for no letter, 1 to 26 for a to z, else a hashed symbol."""
    fold = np.zeros(0x10000, np.uint8)
    for point in range(0x10000):
        char = chr(point)
        if char.isalpha():
            low = char.lower()[0]
            fold[point] = ord(low) - 96 if "a" <= low <= "z" else 27 + (ord(low) * 2654435761 >> 7) % (SYMBOLS - 27)
    return fold


@lru_cache(maxsize=1)
def _places() -> list[np.ndarray]:
    """The symbols' vectors, rotated by two, one and no place."""
    base = np.random.default_rng(SEED).choice(np.array([-1, 1], np.int8), size=(SYMBOLS, DIMENSIONS))
    return [np.roll(base, shift, axis=1) for shift in (2, 1, 0)]


def symbols(text: str) -> np.ndarray:
    """Folded letters of a text with single zeros between words."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    folded = np.where(points < 0x10000, _letters()[np.minimum(points, 0xFFFF)], 0)
    beyond = np.flatnonzero(points >= 0x10000)
    for i in beyond.tolist():
        if text[i].isalpha():
            folded[i] = 27 + (int(points[i]) * 2654435761 >> 7) % (SYMBOLS - 27)
    keep = (folded != 0) | np.concatenate([[True], folded[:-1] != 0])
    return folded[keep]


def bundle(values: list[str]) -> np.ndarray:
    """One float32 row for each text; zero rows for texts without letters."""
    out = np.zeros((len(values), DIMENSIONS), np.float32)
    first, second, third = _places()
    keys, rows = [], []
    for i, value in enumerate(values):
        s = symbols(value).astype(np.int32)
        if s.any():
            s = np.concatenate([[0], s, [0]]) if s[-1] else np.concatenate([[0], s])
            keys.append((s[:-2] * SYMBOLS + s[1:-1]) * SYMBOLS + s[2:])
            rows.append(i)
    if not rows:
        return out
    counts = [np.unique(k, return_counts=True) for k in keys]
    seen = np.unique(np.concatenate([k for k, _ in counts]))
    grid = np.zeros((len(rows), len(seen)), np.float32)
    for i, (k, n) in enumerate(counts):
        grid[i, np.searchsorted(seen, k)] = n
    bound = first[seen // SYMBOLS**2] * second[seen // SYMBOLS % SYMBOLS] * third[seen % SYMBOLS]
    out[rows] = grid @ bound.astype(np.float32)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(norms == 0, 1, norms)


def fit(labelled: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", training_texts: int = TRAINING_TEXTS) -> tuple[list[str], np.ndarray]:
    """Languages in order and their unit prototypes.

    Rows with a null text or language teach nothing. Each task sums the texts it holds, so that only one vector for a
    task and language is sent; the number of languages is the only thing that grows with them.
    """
    rows = labelled.select(labelled[doc_id].cast("string").alias("doc_id"), labelled[text].alias("text"), labelled[lang].alias("lang"))
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL")
    share = rows.groupBy("lang").count().select("lang", (F.lit(training_texts * float(1 << 20)) / F.col("count")).alias("below"))
    bounds = {r["lang"]: r["below"] for r in share.collect()}  # one row for each language
    if not bounds:
        return [], np.zeros((0, DIMENSIONS), np.float32)
    limit = F.create_map(*[F.lit(x) for pair in sorted(bounds.items()) for x in pair])[F.col("lang")]
    picked = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < limit)

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            values, langs = texts(batch, "text"), np.array(batch.column("lang").to_pylist(), object)
            for at in range(0, len(values), BLOCK):
                rows = _unit(bundle(values[at : at + BLOCK]))
                for name in set(langs[at : at + BLOCK].tolist()):
                    sums[name] = sums.get(name, 0) + rows[langs[at : at + BLOCK] == name].sum(axis=0, dtype=np.float64)
        if sums:
            yield pa.RecordBatch.from_pydict({"lang": list(sums), "sums": [v.tolist() for v in sums.values()]})

    partial = picked.select("text", "lang").mapInArrow(run, "lang string, sums array<double>")
    parts = partial.select("lang", F.posexplode("sums").alias("place", "value")).groupBy("lang", "place").agg(F.sum("value").alias("value"))
    totals = {r["lang"]: r["v"] for r in parts.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "value"))).alias("v")).collect()}
    names = sorted(totals)
    return names, _unit(np.array([[cell["value"] for cell in totals[n]] for n in names])).astype(np.float32)


def predict(docs: DataFrame, names: list[str], prototypes: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, lang_pred, score)`` for every row; ``und`` with score 0 where the text is null or has no letter.

    The score is the cosine with the winning prototype, cut to 0 to 1; ties go to the first language by name.
    """

    def run(batch: pa.RecordBatch) -> dict:
        values = texts(batch, "text")
        found, scores = ["und"] * len(values), [0.0] * len(values)
        for at in range(0, len(values), BLOCK):
            rows = _unit(bundle(values[at : at + BLOCK]))
            near = rows @ prototypes.T if names else np.zeros((len(rows), 0))
            for i in np.flatnonzero(rows.any(axis=1)).tolist():
                if names:
                    best = int(np.argmax(near[i]))
                    found[at + i], scores[at + i] = names[best], float(min(1.0, max(0.0, near[i, best])))
        return {"doc_id": batch.column("doc_id"), "lang_pred": found, "score": scores}

    picked = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_batches(picked, run, "doc_id long, lang_pred string, score double")

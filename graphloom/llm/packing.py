"""Vector best-fit packing of token sequences.

A sequence has three capacities: tokens, documents and attention cost (the sum of squared piece lengths). Every piece
goes, longest first, to the open sequence that fits it under all three and scores best: by the weighted dot product of
its needs with what is left, or by the weighted norm of what would be left.
"""

from __future__ import annotations

import zlib
from array import array
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graphloom.llm import common
from graphloom.llm.common import map_batches, texts
from graphloom.session import materialize

#: Pieces that are packed together, on average. A group leaves about one sequence partly filled.
GROUP_PIECES = 4096
#: White-space chunks whose ids one worker remembers; longer ones are encoded each time.
REMEMBERED = 400_000
REMEMBERED_LENGTH = 64
#: Written for the end of a word.
MARK = "\x01"


class ChunkTokenizer:
    """Ids that the ``tokenizers`` library gives for a lower-casing vocabulary with end-of-word marks.

    No token holds white space, so the ids of a white-space chunk are remembered. Merging itself is left to tiktoken,
    which takes the same vocabulary with the mark written as a control character (chunks that hold it go to ``tokenizers``). Both libraries agree as
    long as each entry's bytes, merged alone in order of rank, end in the entry's own two halves; ``consistent`` tests
    that.
    """

    #: White_Space characters that Python's split leaves out are none; these four it has beyond them.
    EXTRA = "\x1c\x1d\x1e\x1f"

    def __init__(self, path: str) -> None:
        import json

        import regex
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        self.plain = Tokenizer.from_file(path)
        self.plain.encode_special_tokens = True
        byte_of = {char: bytes([value]) for value, char in enumerate(_byte_characters())}

        def raw(token: str) -> bytes:
            marked = token.endswith("</w>") and len(token) > 4
            return b"".join(byte_of[c] for c in (token[:-4] if marked else token)) + MARK.encode() * marked

        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        made = {left + right for left, right in merges}
        base = [t for t in model["vocab"] if t not in made and all(c in byte_of for c in t.removesuffix("</w>"))]
        order = sorted(base, key=lambda t: (len(raw(t)), model["vocab"][t])) + [left + right for left, right in merges]
        ranks = {raw(token): rank for rank, token in enumerate(order)}
        self.ids = [model["vocab"][token] for token in order]
        self.pairs = {raw(left + right): (raw(left), raw(right)) for left, right in merges}
        self.ranks = ranks
        self.same = self.ids == list(range(len(order)))
        self.merge = tiktoken.Encoding(
            "words", pat_str=f"[^{MARK}]*{MARK}", mergeable_ranks=ranks, special_tokens={}
        ).encode_ordinary
        self.words = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+").findall
        self.spaces = regex.compile(r"\s+")
        self.chunks = _Chunks(self)
        common.REMEMBERED["chunks"] = self.chunks

    def consistent(self) -> bool:
        """Every entry, merged alone below its own rank, ends in its two halves."""
        for token, pair in self.pairs.items():
            limit = self.ranks[token]
            body = token[:-2] if token.endswith(MARK.encode()) else token
            parts = [body[i : i + 1] for i in range(len(body))] + [token[-2:]] * token.endswith(MARK.encode())
            while len(parts) > 1:
                best = min((self.ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1))
                if best[0] >= limit:
                    break
                parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
            if tuple(parts) != pair:
                return False
        return True

    def split(self, text: str) -> list[str]:
        """White-space chunks of the composed, lower-case text.

        Latin-1 texts are composed already and every library lowers them alike.
        """
        try:
            text.encode("latin-1")
            text = text.lower()
        except UnicodeEncodeError:
            text = self.plain.normalizer.normalize_str(text)
        if any(c in text for c in self.EXTRA):
            return [chunk for chunk in self.spaces.split(text) if chunk]
        return text.split()

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.chunks.__getitem__, self.split(text)))


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabulary files."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(value) if value in plain else chr(next(spare)) for value in range(256)]


class _Chunks(dict):
    def __init__(self, tokenizer: ChunkTokenizer) -> None:
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, chunk: str) -> bytes:
        own = self.tokenizer
        if MARK in chunk:
            ids = own.plain.encode(chunk, add_special_tokens=False).ids
        else:
            ids = own.merge(MARK.join([*own.words(chunk), ""]))
            if not own.same:
                ids = [own.ids[i] for i in ids]
        value = array("I", ids).tobytes()
        if len(chunk) <= REMEMBERED_LENGTH:
            if len(self) >= REMEMBERED:
                self.clear()
            self[chunk] = value
        return value


@lru_cache(maxsize=2)
def tokenizer(name: str) -> ChunkTokenizer:
    import public_tokenizers

    return ChunkTokenizer(name if "/" in name else public_tokenizers.path(name))


def token_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32[, ids])``: the ids of each row's text and then ``end_id``, cut at the capacity.

    Null and empty texts are one piece that holds ``end_id`` alone. Repeated rows each give their pieces.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids binary" * keep_ids
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batch: pa.RecordBatch) -> dict:
        columns: dict = {name: [] for name in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
        encode = tokenizer(vocabulary).encode
        for number, value in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")):
            data = encode(value) + end
            for piece, at in enumerate(range(0, len(data), step)):
                part = data[at : at + step]
                columns["doc_id"].append(number)
                columns["piece"].append(piece)
                columns["start"].append(at // 4)
                columns["length"].append(len(part) // 4)
                columns["ids_crc32"].append(zlib.crc32(part))
                if keep_ids:
                    columns["ids"].append(part)
        return columns

    return map_batches(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")), run, schema, keep="chunks")


def pack_group(
    lengths: np.ndarray, capacity: int, max_documents: int, max_attention: float, weights: tuple[float, float, float], rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece; pieces come longest first."""
    full = np.array([capacity, max_documents, max_attention], float)
    scale = np.array(weights, float) / full**2
    left = np.empty((len(lengths), 3))
    number = np.empty(len(lengths), np.int64)
    used = 0  # rows of `left` that are open
    made = 0
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    least = lengths.min() if len(lengths) else 0
    for i, length in enumerate(lengths.tolist()):
        need = np.array([length, 1.0, float(length) ** 2])
        best = -1
        if used:
            room = left[:used]
            fits = (room >= need).all(axis=1)
            if fits.any():
                if rule == "dot":
                    score = (room * (need * scale)).sum(axis=1)
                else:
                    score = -(((room - need) ** 2) * scale).sum(axis=1)
                best = int(np.argmax(np.where(fits, score, -np.inf)))
        if best < 0:
            if (full < need).any():
                raise ValueError("a piece exceeds a capacity of an empty sequence")
            best, used = used, used + 1
            left[best], number[best] = full, made
            made += 1
        bins[i], offsets[i] = number[best], capacity - int(left[best, 0])
        left[best] -= need
        if left[best, 0] < least or left[best, 1] < 1 or left[best, 2] < least**2:  # nothing fits any more
            used -= 1
            left[best], number[best] = left[used], number[used]
    return bins, offsets


def pack(
    pieces: DataFrame, capacity: int = 2048, max_documents: int | None = None, max_attention: float | None = None,
    weights: tuple[float, float, float] = (1.0, 0.0, 0.0), rule: str = "norm",
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``max_documents`` and ``max_attention`` default to values that the token capacity implies (as many documents as
    tokens, the square of the capacity), so that tokens alone bind. With the default weights the norm is plain best
    fit by tokens. Pieces are dealt by a hash to groups of about ``GROUP_PIECES``, which are packed alone: no task sees
    more, also where rows repeat an id or have none, and the loss is below one sequence a group. Ties go to the smaller
    id (null ids last) and piece. ``pieces`` is a written table; an empty one gives none.
    """
    documents = max_documents or capacity
    attention = float(max_attention or capacity**2)
    names = pieces.columns
    groups = max(1, -(-pieces.count() // GROUP_PIECES))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        bins, offsets = pack_group(frame["length"].to_numpy(), capacity, documents, attention, weights, rule)
        packed = frame[names].copy()
        packed["sequence_id"] = frame["_group"].to_numpy() * np.int64(1 << 32) + bins
        packed["offset"] = offsets
        return packed

    # The running number spreads rows that repeat an id or have none.
    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInPandas(run, f"{kinds}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = 2048, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize, cut and pack whole documents. The small table of pieces is written once, as counting reads it too."""
    return pack(materialize(token_pieces(docs, vocabulary, capacity, doc_id=doc_id, text=text)), capacity)

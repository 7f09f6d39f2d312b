"""Byte-level BPE by backtracking over longest dictionary matches.

Bytes are mapped to the 256 Latin-1 characters, so that pyahocorasick finds every vocabulary entry inside a piece of
text. The encoder walks left to right with the longest match and goes back to shorter ones whenever two neighbouring
tokens are not what the merges would leave side by side. That test is remembered per pair of tokens, every position is
given up at most once, and the result equals the merges' own.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm.common import map_batches, texts

#: Entries kept by a table of remembered answers in one worker (twice as many for chunks and pairs).
REMEMBERED = 250_000
#: Longer pieces are encoded each time.
REMEMBERED_LENGTH = 64


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Bpe:
    """Encoder and decoder of one rank file."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        import ahocorasick
        import regex

        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token
        self.size = [len(token) for token in self.bytes_of]
        self.halves: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        self.automaton = ahocorasick.Automaton()
        reachable = set()
        for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
            if len(token) > 1:
                parts = self._merge_below(token, rank)
                if len(parts) != 2:
                    continue  # the merges never make this entry, only a whole piece can be it
                self.halves[rank] = (parts[0], parts[1])
                self.merged[parts[0], parts[1]] = rank
            reachable.add(token)
            self.automaton.add_word(token.decode("latin-1"), (rank, len(token)))
        self.automaton.make_automaton()
        self.shorter = {
            ranks[token]: next((ranks[token[:n]] for n in range(len(token) - 1, 0, -1) if token[:n] in reachable), None)
            for token in reachable
        }
        self.fits_memo: dict[int, bool] = {}
        self.piece_memo: dict[str, bytes] = {}
        self.chunk_memo = _Chunks(self)

    def _merge_below(self, token: bytes, limit: int) -> list[int]:
        """Plain merging with ranks below ``limit``."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 1:
            best = min(
                (self.ranks.get(parts[i] + parts[i + 1], limit), i) for i in range(len(parts) - 1)
            )
            if best[0] >= limit:
                break
            parts[best[1] : best[1] + 2] = [parts[best[1]] + parts[best[1] + 1]]
        return [self.ranks[p] for p in parts]

    def fits(self, left: int, right: int) -> bool:
        """Would the merges leave these two tokens side by side?

        Both are taken apart again, latest merge first. If at any point the two tokens at the border would have been
        merged before the merges already undone, the pair can't stand.
        """
        known = self._fits(left, right)
        if len(self.fits_memo) >= 2 * REMEMBERED:
            self.fits_memo.clear()
        self.fits_memo[left << 32 | right] = known
        return known

    def _fits(self, left: int, right: int) -> bool:
        later = None  # (rank, 0 for the left side, 1 for the right) of the merge undone last
        while True:
            joint = self.merged.get((left, right))
            if joint is not None and (later is None or joint < later[0] or (joint == later[0] and later[1])):
                return False
            left_cut, right_cut = left in self.halves, right in self.halves
            if not left_cut and not right_cut:
                return True
            # of two equal merges the left one comes first, so the right one is undone first
            if right_cut and (not left_cut or right >= left):
                later = (right, 1)
                right = self.halves[right][0]
            else:
                later = (left, 0)
                left = self.halves[left][1]

    def encode_piece(self, piece: bytes) -> list[int]:
        """Ids of one match of the pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        longest = [0] * n
        for end, (rank, length) in self.automaton.iter(piece.decode("latin-1")):
            longest[end - length + 1] = rank  # ends ascend, so the last one is the longest
        size, shorter, fits, memo = self.size, self.shorter, self.fits, self.fits_memo
        alive = bytearray(b"\1") * (n + 1)
        found: list[int] = []
        at, token, last = 0, longest[0], -1
        while True:
            end = at + size[token]
            if alive[end]:
                good = last < 0 or memo.get(last << 32 | token)
                if good is None:
                    good = fits(last, token)
                if good:
                    found.append(token)
                    if end == n:
                        return found
                    at, last, token = end, token, longest[end]
                    continue
            less = shorter[token]
            while less is None:
                alive[at] = 0
                if not found:
                    raise ValueError("the vocabulary lacks a byte of this piece")
                token = found.pop()
                last = found[-1] if found else -1
                at -= size[token]
                less = shorter[token]
            token = less

    def _piece(self, piece: str) -> bytes:
        known = self.piece_memo.get(piece)
        if known is None:
            known = array("I", self.encode_piece(piece.encode())).tobytes()
            if len(piece) <= REMEMBERED_LENGTH:
                if len(self.piece_memo) >= REMEMBERED:
                    self.piece_memo.clear()
                self.piece_memo[piece] = known
        return known

    def _pieces(self, text: str) -> bytes:
        return b"".join(map(self._piece, self.find(text)))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        A single space between two other characters always starts a piece, so the text may be cut there and each part
        be remembered with its leading space. Parts that end in white space belong together with the next one.
        """
        first, *rest = text.split(" ")
        try:
            return (self._pieces(first) if first and not first[-1].isspace() else None) + b"".join(
                map(self.chunk_memo.__getitem__, rest)
            )
        except TypeError:
            pass
        runs = [first]
        for part in rest:
            if not runs[-1] or runs[-1][-1].isspace():
                runs[-1] += " " + part
            else:
                runs.append(" " + part)
        return b"".join(map(self._pieces, runs))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class _Chunks(dict):
    """Ids of a space and the part after it; None where the next part decides."""

    def __init__(self, bpe: Bpe) -> None:
        super().__init__()
        self.bpe = bpe

    def __missing__(self, part: str) -> bytes | None:
        if not part or part[-1].isspace():
            return None
        value = self.bpe._pieces(" " + part)
        if len(part) <= REMEMBERED_LENGTH:
            if len(self) >= 2 * REMEMBERED:
                self.clear()
            self[part] = value
        return value


@lru_cache(maxsize=2)
def tokenizer(name: str, pattern: str | None = None) -> Bpe:
    """The encoder of a rank file among the public tokenizers (or of a path), built once per worker."""
    import public_tokenizers

    path = name if "/" in name else public_tokenizers.path(name)
    return Bpe(load_ranks(path), pattern or public_tokenizers.PATTERN)


def encode_documents(
    docs: DataFrame, vocabulary: str, doc_id: str = "doc_id", text: str = "text", keep_ids: bool = True
) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256[, ids])`` for every row of ``docs``.

    Null and empty texts have no tokens. Rows that repeat are encoded each; a null id stays null. Ids are given as one
    binary of little-endian unsigned 32-bit integers. A text takes memory in proportion to its length, in one task.
    """
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids binary" * keep_ids

    def run(batch: pa.RecordBatch) -> dict:
        bpe = tokenizer(vocabulary)
        columns: dict = {"doc_id": batch.column("doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "ids": []}
        for value in texts(batch, "text"):
            ids = bpe.encode(value)
            columns["n_tokens"].append(len(ids) // 4)
            columns["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            columns["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            if keep_ids:
                columns["ids"].append(ids)
        return columns

    return map_batches(docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text")), run, schema)


def decode_documents(encoded: DataFrame, vocabulary: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``(doc_id, text)`` from binaries of ids; null ids give a null text, bytes that are no UTF-8 are replaced."""

    def run(batch: pa.RecordBatch) -> dict:
        bpe = tokenizer(vocabulary)
        return {
            "doc_id": batch.column("doc_id"),
            "text": [None if x is None else bpe.decode(x).decode("utf-8", "replace") for x in batch.column("ids").to_pylist()],
        }

    picked = encoded.select(encoded[doc_id].cast("long").alias("doc_id"), encoded[ids].alias("ids"))
    return map_batches(picked, run, "doc_id long, text string")

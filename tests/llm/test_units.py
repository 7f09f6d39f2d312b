"""Brute-force comparisons and edge cases that need no Spark."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from graphloom.llm import bpe, fingerprint, language, licenses, neardup, neighbours, packing, quality, substrings

ALPHABET = (
    "a b e th the The Th \n \t É ö 日本 语 ١٢ 12 's 'll don't ! .. — 😀 ß İ Σ <|endoftext|> \x01 \x1c \x85 ́".split(" ")
    + [" ", "  ", "\n ", " \n"]
)


def samples(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def test_bpe_equals_tiktoken():
    own = bpe.tokenizer("byte_bpe_multi_50k.tiktoken")
    wanted = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={})
    for text in [*samples(4000, 1), "", "a" * 20000, "ab" * 9000, " " * 900, "x" + " " * 300 + "y"]:
        ids = own.encode(text)
        assert ids == np.array(wanted.encode_ordinary(text), "<u4").tobytes(), text[:80]
        assert own.decode(ids) == text.encode()


def test_chunk_tokenizer_equals_tokenizers():
    own = packing.tokenizer("word_bpe_49k.json")
    assert own.consistent()
    wanted = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted.encode_special_tokens = True
    for text in [*samples(4000, 2), "", "x" * 3000]:
        assert own.encode(text) == np.array(wanted.encode(text, add_special_tokens=False).ids, "<u4").tobytes(), text[:80]


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_keeps_every_capacity(rule):
    rng = np.random.default_rng(3)
    lengths = np.sort(rng.integers(1, 71, 500))[::-1]
    bins, offsets = packing.pack_group(lengths, 100, 4, 6000.0, (1.0, 0.5, 0.5), rule)
    for b in set(bins.tolist()):
        own = bins == b
        assert lengths[own].sum() <= 100 and own.sum() <= 4 and (lengths[own] ** 2).sum() <= 6000
        order = np.argsort(offsets[own])
        assert (np.concatenate([[0], np.cumsum(lengths[own][order])[:-1]]) == offsets[own][order]).all()


def test_packing_is_near_the_least_number():
    lengths = np.sort(np.random.default_rng(4).integers(1, 2049, 4000))[::-1]
    bins, _ = packing.pack_group(lengths, 2048, 2048, 2048.0**2, (1.0, 0.0, 0.0), "norm")
    assert bins.max() + 1 <= 1.03 * (lengths.sum() / 2048) + 1


def test_packing_refuses_what_never_fits():
    with pytest.raises(ValueError):
        packing.pack_group(np.array([50]), 100, 5, 100.0, (1.0, 0.0, 0.0), "norm")


def test_prefix_hashes_against_plain_comparison():
    rng = random.Random(5)
    for _ in range(200):
        a, b = ("".join(rng.choice("ab😀") for _ in range(rng.randint(0, 40))) for _ in range(2))
        x, y = fingerprint.PrefixHashes(a), fingerprint.PrefixHashes(b)
        i, j = rng.randint(0, len(a)), rng.randint(0, len(b))
        n = 0
        while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
            n += 1
        assert x.extension(i, y, j) == n
        keep = rng.randint(0, len(a))
        assert fingerprint.PrefixHashes(b, x, keep).fingerprint() == fingerprint.PrefixHashes(a[:keep] + b).fingerprint()
        assert (x.fingerprint() == y.fingerprint()) == (a == b)
        assert 0 <= fingerprint.likeness(x.fingerprint(), y.fingerprint()) <= 1


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(6)
    items = rng.integers(0, 2**63, 500, dtype=np.uint64)
    one, other = items[:400], items[100:]
    assert (neardup.merge(neardup.sketch(one), neardup.sketch(other)) == neardup.sketch(items)).all()
    found, keep = neardup.likely(neardup.sketch(one)[None], neardup.sketch(other)[None], np.array([400.0]), np.array([400.0]), 0.85)
    assert abs(found[0] - 0.6) < 0.12 and not keep[0]
    assert len(neardup.shingles("")) == 0 and len(neardup.shingles("one two")) == 1
    assert (neardup.shingles("A b C d E") == neardup.shingles("a B c D e")).all()


def test_first_documents_against_plain_search():
    rng = random.Random(7)
    texts = [" ".join(rng.choice("abc") for _ in range(rng.randint(4, 12))).encode() for _ in range(60)]
    numbers = np.arange(60)[::-1].copy()
    found = substrings.first_documents(texts, numbers, 4)
    for text, row in zip(texts, found):
        words = text.split()
        for i, first in enumerate(row.tolist()):
            window = b" ".join(words[i : i + 4])
            holders = [int(n) for t, n in zip(texts, numbers) if any(b" ".join(t.split()[k : k + 4]) == window for k in range(len(t.split()) - 3))]
            assert first == min(holders)


def test_super_kmers_cover_each_window_once():
    words = np.random.default_rng(8).integers(0, 2**63, 300, dtype=np.uint64)
    starts, counts, _ = substrings.super_kmers(words, 50)
    assert starts[0] == 0 and (starts[1:] == starts[:-1] + counts[:-1]).all() and counts.sum() == 251
    assert len(substrings.super_kmers(words[:49], 50)[0]) == 0


def test_patience_keeps_order_and_finds_edits():
    a, b = "x y the a quick c fox d jumped".split(), "the quick brown fox jumped".split()
    pairs = licenses.patience(a, b)
    assert [b[j] for _, j in pairs] == ["the", "quick", "fox", "jumped"]
    assert all(a[i] == b[j] for i, j in pairs) and pairs == sorted(pairs)


def test_license_scan_finds_copies_and_only_them():
    scan = licenses.Scanner(licenses.TEMPLATES, 0.9).scan
    once = "Some words. Released under the MIT License. More words."
    assert scan(once) == [("MIT", 1.0, 2, 7)]
    assert [f[2:] for f in scan(once + " " + once)] == [(2, 7), (11, 16)]
    assert scan("") == [] and scan("released under the new license") == []
    assert scan("x " * 3000 + licenses.TEMPLATES["GPL-3.0"])[0][:3] == ("GPL-3.0", 1.0, 3000)


def test_language_profiles_tell_two_apart():
    english, french = ["the house and the garden were there"] * 3, ["la maison et le jardin sont ici"] * 3
    prototypes = language._unit(np.stack([language.bundle(x).sum(axis=0) for x in (english, french)]))
    near = language._unit(language.bundle(["the garden there", "le jardin ici", "", "123 !"])) @ prototypes.T
    assert near[0, 0] > near[0, 1] and near[1, 1] > near[1, 0] and not near[2:].any()


def test_discriminant_against_densities():
    rng = np.random.default_rng(9)
    width = len(quality.FEATURES)
    rows = [rng.normal(k, 1 + k, (400, width)) for k in (0, 1)]
    sums = np.stack([np.concatenate([[len(r)], r.sum(axis=0), (r.T @ r).ravel()]) for r in rows])
    model = quality.solve(sums, pooled=0.0, ridge=0.0)
    logs = []
    for r in rows:
        spread = np.cov(r.T, bias=True)
        d = np.concatenate(rows) - r.mean(axis=0)
        logs.append(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(spread), d) - 0.5 * np.linalg.slogdet(spread)[1])
    wanted = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -700, 700)))
    assert np.allclose(model.scores(np.concatenate(rows)), wanted, atol=1e-6)
    one_class = quality.solve(np.stack([np.zeros_like(sums[0]), sums[1]]))
    assert (one_class.scores(np.zeros((2, width))) == 1).all()
    assert (quality.solve(np.zeros_like(sums)).scores(np.zeros((2, width))) == 0.5).all()
    assert quality.statistics("") == [0.0] * width


def test_block_best_equals_full_product():
    rng = np.random.default_rng(10)
    c, ids = rng.normal(size=(500, 16)), rng.permutation(500)
    c[100:110] = c[0]
    for i, scores, rows in neighbours.block_best(c[:40], c, ids, 7):
        full = neighbours.exact(np.broadcast_to(c[i], c.shape), c)
        best = np.lexsort((ids, -full))[:7]
        assert (rows == best).all() and (scores == full[best]).all()


def test_block_best_beyond_trusted_bounds():
    rng = np.random.default_rng(11)
    c, ids = rng.normal(size=(300, 8)), rng.permutation(300)
    c[3], c[7, 2], c[11], c[13] = 5e-324, 1e200, c[11] * 1e-310, c[13] * 1e250
    c[17], c[19] = np.where(np.arange(8) % 2, 1e200, -1e200), 1e200  # this product overflows to no number
    for i, scores, rows in neighbours.block_best(c[:30], c, ids, 9):
        full = neighbours.exact(np.broadcast_to(c[i], c.shape), c)
        best = np.lexsort((ids, -full, ~np.isnan(full)))[:9]
        assert (rows == best).all() and np.array_equal(scores, full[best], equal_nan=True)

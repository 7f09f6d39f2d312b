"""License scan by patience alignment.

Words that occur once in both the text and a template anchor their alignment: the longest increasing subsequence of the
anchors is kept and the gaps between them are aligned the same way. The share of the template's words that find their
place is its coverage.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame

from graphloom.llm.common import map_batches, texts

#: Public license notices.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-text": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the "
        "Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "All-rights-reserved": "All rights reserved.",
}
COVERAGE = 0.9

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or 48 <= c <= 57 or c >= 128 else 32 for c in range(256)
)


def words(text: str) -> list[bytes]:
    """Lower-case (A to Z) runs of letters, digits and bytes beyond ASCII."""
    return text.encode().translate(_FOLD).split()


def patience(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Aligned positions of two word lists, increasing in both."""
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a_from, a_to, b_from, b_to = todo.pop()
        while a_from < a_to and b_from < b_to and a[a_from] == b[b_from]:
            found.append((a_from, b_from))
            a_from, b_from = a_from + 1, b_from + 1
        while a_from < a_to and b_from < b_to and a[a_to - 1] == b[b_to - 1]:
            a_to, b_to = a_to - 1, b_to - 1
            found.append((a_to, b_to))
        in_a, in_b = Counter(a[a_from:a_to]), Counter(b[b_from:b_to])
        place = {w: i for i, w in enumerate(b[b_from:b_to], b_from) if in_b[w] == 1 and in_a[w] == 1}
        chain = _longest_chain([(i, place[w]) for i, w in enumerate(a[a_from:a_to], a_from) if w in place])
        found += chain
        edges = [(a_from - 1, b_from - 1), *chain, (a_to, b_to)]
        if chain:
            todo += [
                (i + 1, k, j + 1, m) for (i, j), (k, m) in zip(edges, edges[1:]) if k > i + 1 and m > j + 1
            ]
    return sorted(found)


def _longest_chain(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Longest subsequence that increases in the second place, by patience piles."""
    tops: list[int] = []
    piles: list[int] = []
    before: list[int] = []
    for n, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        before.append(piles[pile - 1] if pile else -1)
        tops[pile : pile + 1] = [j]
        piles[pile : pile + 1] = [n]
    chain, n = [], piles[-1] if piles else -1
    while n >= 0:
        chain.append(pairs[n])
        n = before[n]
    return chain[::-1]


class Scanner:
    """Templates and, for each, the words of which a good enough copy must hold at least one."""

    def __init__(self, templates: dict[str, str], coverage: float) -> None:
        self.coverage = coverage
        self.templates = []
        for name, text in sorted(templates.items()):
            own = words(text)
            once = [w for w, n in Counter(own).items() if n == 1]
            may_lack = int(len(own) * (1 - coverage) + 1e-9)
            needles = sorted(once, key=lambda w: (-len(w), w))[: may_lack + 1]
            if len(needles) <= may_lack:
                raise ValueError(f"template {name} has too few words that occur once")
            self.templates.append((name, own, Counter(own), {w: own.index(w) for w in needles}))
        self.all_needles = {w for t in self.templates for w in t[3]}

    def scan(self, text: str) -> list[tuple[str, float, int, int]]:
        """``(license, coverage, first word, word after the last)`` of copies that don't overlap.

        A copy may be stretched by a quarter of the template. Overlapping finds of one template give the best, then the
        first.
        """
        own = words(text)
        if self.all_needles.isdisjoint(own):
            return []
        places: dict[bytes, list[int]] = {}
        for i, word in enumerate(own):
            if word in self.all_needles:
                places.setdefault(word, []).append(i)
        found = []
        for name, template, counts, needles in self.templates:
            size, slack = len(template), len(template) // 4 + 1
            finds = []
            for start in sorted({i - at for word, at in needles.items() for i in places.get(word, ())}):
                low, high = max(0, start - slack), min(len(own), start + size + slack)
                window = own[low:high]
                have = Counter(window)
                if sum(min(n, have[w]) for w, n in counts.items()) < self.coverage * size:
                    continue
                pairs = patience(window, template)
                if pairs and len(pairs) >= self.coverage * size - 1e-9:
                    finds.append((-len(pairs) / size, low + pairs[0][0], low + pairs[-1][0] + 1))
            taken: list[tuple[int, int]] = []
            for share, low, high in sorted(set(finds)):
                if all(high <= x or low >= y for x, y in taken):
                    taken.append((low, high))
                    found.append((name, -share, low, high))
        return sorted(found, key=lambda f: (f[2], f[0]))


def license_spans(
    docs: DataFrame, templates: dict[str, str] | None = None, coverage: float = COVERAGE, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``(doc_id, license, coverage, start_word, end_word)``: one row for each copy of a template.

    Null and empty texts hold none; repeated rows each give theirs; a null id stays null. An empty table gives none.
    """
    chosen = TEMPLATES if templates is None else templates

    def run(batch: pa.RecordBatch) -> dict:
        scanner = Scanner(chosen, coverage)
        rows = [(n, *f) for n, value in zip(batch.column("doc_id").to_pylist(), texts(batch, "text")) for f in scanner.scan(value)]
        names = ("doc_id", "license", "coverage", "start_word", "end_word")
        return dict(zip(names, zip(*rows) if rows else [[]] * 5))

    picked = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].alias("text"))
    return map_batches(picked, run, "doc_id long, license string, coverage double, start_word int, end_word int")

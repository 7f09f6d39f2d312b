"""A block's scores are rounded and ranked only where they can be among the best, whatever the cut-off."""

import numpy as np
import pandas as pd
import pytest

from graphloom.operators import vectors


def _block(homes, probes, dims, seed):
    rng = np.random.default_rng(seed)

    def side(ids, home):
        # Halves and whole numbers: many equal scores.
        raw = rng.integers(-2, 3, (len(ids), dims)) + 0.0
        raw[:, 0] += 0.5
        return pd.DataFrame({"id": ids, "v": list(raw / np.linalg.norm(raw, axis=1)[:, None]), "home": home})

    return pd.concat([side(list(homes), True), side(list(probes), False)])


def _plain(block, k, cutoff):
    homes, probes = block[block["home"]], block[~block["home"]]
    scores = np.round(np.stack(probes["v"]) @ np.stack(homes["v"]).T, vectors.SCORE_DIGITS)
    out = []
    for i, own in enumerate(probes["id"]):
        others = sorted((-s, o) for s, o in zip(scores[i], homes["id"]) if s >= cutoff and o != own)
        out += [(own, o, -s) for s, o in others[:k]]
    return sorted(out)


@pytest.mark.parametrize("cutoff", [-1.5, 0.0, 0.3, 0.9, 2.0])
@pytest.mark.parametrize("at_once,rows", [(1 << 20, 256), (50, 7)])
def test_best_of_a_block(monkeypatch, cutoff, at_once, rows):
    monkeypatch.setattr(vectors, "SCORES_AT_ONCE", at_once)
    monkeypatch.setattr(vectors, "PROBE_ROWS", rows)
    for names in (lambda ids: ids, lambda ids: [f"e{i}" for i in ids]):
        block = _block(names(range(90, 0, -1)), names(range(60, 100)), 4, 3)
        found = vectors._best_of_block(block, 5, cutoff)
        assert sorted((r.id, r.other, pytest.approx(r.score, abs=2e-9)) for r in found.itertuples()) == _plain(block, 5, cutoff)


def test_few_scores_are_rounded(monkeypatch):
    block, seen, rounded = _block(range(3000), range(3000, 3300), 64, 5), [], np.round
    monkeypatch.setattr(vectors.np, "round", lambda a, *rest, **more: seen.append(np.size(a)) or rounded(a, *rest, **more))
    vectors._best_of_block(block, 10, 0.3)
    assert 0 < sum(seen) < 3000 * 300 / 5

"""Scoring of passages against the test items."""

import numpy as np
import pyarrow as pa

from lifeloom.llm import leaks
from lifeloom.llm.leaks import HALF, SCORE, Index, all_hashed


def made(items, seed=3):
    rng = np.random.default_rng(seed)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.3, 90) % 400) for _ in range(items)]
    index = Index.build([(i, t, t, t) for i, t in enumerate(texts)])
    docs = []
    for k in range(30):
        words = [f"w{x}" for x in rng.zipf(1.3, int(rng.integers(1, 700))) % 500]
        at = int(rng.integers(0, len(words)))
        copied = texts[k % items].split()[: int(rng.integers(0, 90))]
        docs.append(" ".join([*words[:at], *copied, *words[at:]]) if k % 7 else "")
    return index, docs


def by_hand(index, docs):
    """Every window against every posting."""
    out = {}
    words, first = all_hashed(pa.array(docs))
    for d in range(len(docs)):
        own = words[first[d] : first[d + 1]]
        for a in range(0, len(own), HALF):
            scores = np.zeros(len(index.item_of))
            for t in np.unique(own[a : a + 2 * HALF]):
                k = int(np.searchsorted(index.terms, t))
                if k < len(index.terms) and index.terms[k] == t:
                    at = slice(index.begin[k], index.begin[k + 1])
                    scores[index.entry[at]] += index.impact[at]
            for e in np.flatnonzero(scores >= SCORE):
                mine = out.setdefault(d, {})
                mine[int(index.item_of[e])] = max(mine.get(int(index.item_of[e]), 0), float(scores[e]))
    return out


def found(index, docs):
    return index.candidates(*all_hashed(pa.array(docs)))


def test_all_windows_are_scored_as_by_hand_however_few_at_a_time(monkeypatch):
    index, docs = made(20)
    hand = by_hand(index, docs)
    assert len(hand) > 10
    for at_once in (1, 500, 1 << 21):
        monkeypatch.setattr(leaks, "TERMS_AT_ONCE", at_once, raising=False)
        got = found(index, docs)
        assert {d: set(x) for d, x in got.items()} == {d: set(x) for d, x in hand.items()}
        assert all(abs(got[d][i] - s) < 1e-9 for d in hand for i, s in hand[d].items())


def test_windows_are_scored_together(monkeypatch):
    """One sum for each window took most of the time."""
    index, docs = made(20)
    near = " ".join(w for d in docs for w in d.split())
    sums = []
    true = np.bincount
    monkeypatch.setattr(np, "bincount", lambda *x: sums.append(1) or true(*x))
    assert found(index, [near] * 4) and len(sums) == 1

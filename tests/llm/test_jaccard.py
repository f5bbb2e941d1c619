"""The tiled Jaccard join against all pairs, with each of its bounds made small."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lifeloom.llm import jaccard
from lifeloom.llm.jaccard import (
    bands, bitmap, fold, index_keys, index_length, indexed, jaccard_components, most_promising, possible,
)


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").encode().lower().decode())
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked(a, b):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= 80 * (len(a) + len(b) - common)


def by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    name = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]) and name[i] != name[j]:
                old, new = name[i], name[j]
                name = [new if x == old else x for x in name]
    least = {}
    for x, (i, _) in zip(name, rows, strict=True):
        least[x] = min((v for v in (least.get(x), i) if v is not None), default=None)
    return Counter((i, len(s), least[x]) for x, s, (i, _) in zip(name, sets, rows, strict=True))


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(11)
    words = [f"w{i}" for i in range(3000)]
    prose = lambda n: [rng.choice(words) for _ in range(n)]
    rows = []

    def add(text):
        rows.append((len(rows), " ".join(text)))

    passage = prose(40)
    for _ in range(60):
        add(prose(rng.randint(3, 80)) + passage)  # unrelated but for one passage
    for _ in range(25):  # chains of edits of growing distance, with different sizes
        base = prose(rng.randint(6, 150))
        add(base)
        for _ in range(rng.randint(1, 4)):
            base = list(base)
            for _ in range(rng.randint(1, 3)):
                at = rng.randrange(len(base))
                base[at : at + rng.choice((0, 1))] = prose(rng.choice((0, 1, 6)))
            add(base)
    base = prose(300)  # a large group of near copies
    for _ in range(60):
        own = list(base)
        for _ in range(4):
            own[rng.randrange(300)] = rng.choice(words)
        add(own)
    for n in range(1, 8):
        add(words[:n])
        add(words[:n])
    add([w.upper() for w in words[:30]])
    add(words[:30])
    rows += [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "日本 語 текст ñ"), (5004, "a" * 100_000)]
    chain = prose(60)  # a null id in the middle of a chain, a repeated id, texts under one id
    for i, at in ((6001, 0), (None, 1), (6003, 2), (6003, 3), (None, 5)):
        own = list(chain)
        for j in range(at):
            own[5 * j + 2] = "x"
        rows.append((i, " ".join(own)))
    return rows + [(None, rows[3][1]), (None, "alone among the null ones with six words")]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "k") for i, t in texts], "doc_id long, text string, n int, key string").repartition(3)


def got(df):
    return Counter(tuple(r) for r in jaccard_components(df).select("doc_id", "n_shingles", "component_id").collect())


def test_components_equal_those_of_all_pairs(docs, texts):
    assert got(docs) == by_hand(texts)


def test_small_limits_give_the_same(docs, texts, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "FIRST", 1)
    monkeypatch.setattr(jaccard, "HELD", 2)
    monkeypatch.setattr(jaccard, "OFTEN", 3)
    assert got(docs) == by_hand(texts)


def test_no_common_shingles_give_the_same(docs, texts, monkeypatch):
    """With an order that puts nothing last, the shared passage is indexed and all goes through tiles."""
    none = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    monkeypatch.setattr(jaccard, "common_shingles", lambda texts: none)
    assert got(docs) == by_hand(texts)


def test_nothing_and_blank_texts_only(docs):
    assert jaccard_components(docs.limit(0)).count() == 0
    blank = docs.filter("doc_id in (5000, 5001, 5002)")
    assert got(blank) == Counter([(5000, 0, 5000), (5001, 0, 5001), (5002, 0, 5002)])


def test_clashing_columns_change_nothing(docs, texts):
    more = docs.withColumns({c: F.lit(0) for c in ("n_shingles", "component_id", "node", "at", "text_hash", "high")})
    assert got(more) == by_hand(texts)


def test_bitmaps_never_exclude_a_link():
    rng = np.random.default_rng(4)
    for _ in range(500):
        n = int(rng.integers(1, 400))
        pool = np.unique(rng.integers(0, 2**63, n, np.uint64))
        cut = int(len(pool) * rng.uniform(0.7, 1))
        a, b = np.sort(rng.permutation(pool)[:cut]), np.sort(rng.permutation(pool)[: max(1, cut - 3)])
        x, y = (np.frombuffer(bitmap(s), np.uint64)[None, :] for s in (a, b))
        words = min(x.shape[1], y.shape[1])
        differing = int(np.bitwise_count(fold(x, words) ^ fold(y, words)).sum())
        common = len(np.intersect1d(a, b))
        assert differing <= len(a) + len(b) - 2 * common
        if 100 * common >= 80 * (len(a) + len(b) - common):
            assert possible(len(a), len(b), differing)


def test_similar_sets_share_an_indexed_member_and_meet_in_bands(spark):
    """Sets over a small pool, so that many members are shared; some of them are in the list of common ones."""
    rng = np.random.default_rng(6)
    pool = np.unique(rng.integers(0, 2**64, 90, np.uint64))
    common = (pool[::7], rng.permutation(len(pool[::7])) + 1)
    sets = [np.sort(rng.permutation(pool)[: int(rng.integers(1, 40))]) for _ in range(60)]
    sets += [np.sort(rng.permutation(s)[: max(1, len(s) - int(rng.integers(0, 3)))]) for s in sets for _ in range(3)]
    rows = []
    for i, s in enumerate(sets):
        tokens, extra = (x.view(np.int64).tolist() for x in indexed(s, common))
        rows.append((i, len(s), tokens, extra))
    nodes = spark.createDataFrame(rows, "node long, size long, tokens array<long>, extra array<long>")
    keys = [set() for _ in sets]
    for r in index_keys(nodes).collect():
        keys[r.node].add(r.key)
    pairs = 0
    for i, a in enumerate(sets):
        assert len(keys[i]) <= index_length(len(a))
        for j in range(i):
            overlap = len(np.intersect1d(a, sets[j]))
            if 100 * overlap >= 80 * (len(a) + len(sets[j]) - overlap):
                pairs += 1
                assert keys[i] & keys[j]
    assert pairs > 100
    edges = np.array(bands(5000))
    for a in range(1, 4000):
        at = [int((edges <= s).sum()) for s in (a, a * 100 // 80)]
        assert at[1] - at[0] <= 1


def test_the_most_promising_pairs_of_two_components():
    pairs = np.array([[1, 2, 3, 4, 5], [6, 7, 8, 9, 10], [0, 0, 0, 1, 0], [5, 5, 5, 5, 6], [30, 10, 20, 40, 50]])
    assert sorted(most_promising(pairs, 2)[0].tolist()) == [2, 3, 4, 5]

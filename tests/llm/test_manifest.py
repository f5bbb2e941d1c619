"""The Merkle manifest against a tree built by hand."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from lifeloom.llm.manifest import FIELDS, document_leaves, folded, manifest, verified


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 16]) for i in range(0, len(out[-1]), 16)])
    return out


def beside(levels, i):
    for nodes in levels[:-1]:
        begin = i - i % 16
        yield nodes[begin:i], nodes[i + 1 : begin + 16]
        i //= 16


def by_hand(rows):
    groups = {}
    for r in rows:
        bad = dict(r)
        if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0:
            bad["text"] = r["text"].encode().lower().decode()
        leaf, other = (h(*(field(x[f]) for f in FIELDS)) for x in (r, bad))
        groups.setdefault(r["source"], []).append((r["doc_id"], leaf, other))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for g in groups.values():
        g.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    trees = {g: levels_of([x[1] for x in groups[g]]) for g in names}
    top = levels_of([trees[g][-1][0] for g in names])
    for at, g in enumerate(names):
        for i, (doc_id, leaf, other) in enumerate(groups[g]):
            path = [*beside(trees[g], i), *beside(top, at)]
            root, acc = top[-1][0], other
            for left, right in path:
                acc = h(*left, acc, *right)
            yield doc_id, leaf, trees[g][-1][0], root, h(*(x for side in path for x in (*side[0], *side[1]))), acc, acc == root


@pytest.fixture(scope="module")
def docs(spark):
    rows = []
    for i in range(700):  # one source with three levels, others with none, one or two
        source = "big" if i < 300 else None if i < 318 else "lone" if i == 318 else f"s{i % 23}é" if i < 600 else f"own{i}"
        rows.append((i, f"Text {i} ÄB\n" * (i % 4), None if i % 11 == 0 else "en", source, i % 9 or None, i))
    rows += [(None, "Nobody", "en", "big", 1, 0), (None, "Nobody", "en", "big", 1, 1), (7, None, None, None, None, 0)]
    rows += [(7, "Text 7 again", "en", "big", 2, 0), (900, "Y" * 3_000_000, "en", "big", 3, 0), (901, "", "", "", 0, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, pos int").repartition(3)


def test_every_column_equals_the_tree_built_by_hand(docs):
    got = sorted((tuple(r) for r in verified(docs).collect()), key=str)
    assert got == sorted(by_hand([r.asDict() for r in docs.collect()]), key=str)
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("n", [0, 1, 2, 16, 17, 256, 257, 273])
def test_trees_of_every_shape(docs, n):
    some = docs.filter("source = 'big' and doc_id is not null").orderBy("doc_id").limit(n)
    got = sorted((tuple(r) for r in verified(some).collect()), key=str)
    assert got == sorted(by_hand([r.asDict() for r in some.collect()]), key=str)


def test_extra_and_clashing_columns_change_nothing(docs):
    names = ("grp", "node", "path", "leaf", "root", "subroot", "tampered", "_at", "n")
    more = docs.withColumns({c: F.lit("x") for c in names})
    assert sorted(map(str, verified(more).collect())) == sorted(map(str, verified(docs).collect()))


def test_one_changed_row_fails_its_own_proof_only(docs):
    """A proof taken before a change no longer leads the changed leaf to the root."""
    made = manifest(document_leaves(docs), ["doc_id"])
    proofs = made.proofs(["doc_id"])
    changed = F.when(F.col("doc_id") == 5, F.sha2(F.lit("other").cast("binary"), 256)).otherwise(F.col("node"))
    ok = proofs.select("doc_id", (folded(changed, F.col("path")) == F.col("root")).alias("ok"))
    assert [r.doc_id for r in ok.filter("not ok").collect()] == [5]

"""Near-duplicate documents: a multi-index Hamming join of MinHash signatures.

A document is the set of its five-word shingles. Its signature has ``SYMBOLS`` minima of the
set under different hashes, cut to ``BITS`` bits each; the distance of two signatures is the
number of symbols that differ. Two sets of similarity 0.75 differ in a quarter of the symbols
on average; all pairs up to ``DISTANCE`` = 19 of 30 are found (a true pair is farther apart
with a chance of about one in ten million). By the pigeonhole principle such a pair has at
most one wrong symbol in one of ``CHUNKS`` = 10 chunks of three symbols, so each chunk is
indexed under all its two-symbol parts, which are the chunk with every allowed error masked.

Equal sets are one class, and only one representative of a class goes on. Then

1. every index key links its documents to the smallest one (no pairs within a key),
2. keys whose documents are then in more than one component have what is left compared:
   documents of different components, in blocks of ``BLOCK`` by ``BLOCK`` rows so that a key of
   any size is spread over many tasks; keys of more than ``FINE`` documents are first refined by
   a second index key of another chunk, of which a pair within the distance shares one,
3. pairs that also agree in a second sketch (512 bins, by the law of their sampling) are confirmed on the
   full sets, in exact integers.

Hence no true link between two components is lost, and groups of thousands of near copies cost
one comparison per document and key instead of all pairs.

Rules for odd rows: a null or blank text has an empty set and is linked with nothing; fewer
than five words count as one shingle; repeated rows are linked as any equal texts; a null
doc_id is grouped like any other document but never names a component; an empty table gives no
rows; other columns are ignored. Hashes have 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.llm.components import connected
from lifeloom.llm.tables import columns, keep
from lifeloom.llm.words import U, constants, mixed, window_hashes, word_hashes

SHINGLE = 5
PERCENT = 75
BITS = 16
CHUNKS, PER_CHUNK = 10, 3
SYMBOLS = CHUNKS * PER_CHUNK
DISTANCE = 2 * CHUNKS - 1
BINS = 512
FINE = BLOCK = 4000

SKETCH = "doc_id long, n_shingles long, high long, low long, keys array<long>, bins binary"


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its shingles."""
    words, first = word_hashes(texts)
    windows = window_hashes(words, size)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= size:
            yield np.unique(windows[a : b - size + 1])
        elif b > a:
            yield window_hashes(words[a:b], b - a, seed=50 + b - a)
        else:
            yield np.zeros(0, U)


_FACTORS = constants(SYMBOLS, 11)
_PAIRS = [(3 * c + i, 3 * c + j) for c in range(CHUNKS) for i, j in ((0, 1), (0, 2), (1, 2))]
_LEFT, _RIGHT = (np.array(x) for x in zip(*_PAIRS, strict=True))
_NAMES = constants(len(_PAIRS), 12)


def signature(shingles: np.ndarray) -> np.ndarray:
    least = np.full(SYMBOLS, np.iinfo(U).max, U)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _FACTORS[None, :]
        np.minimum(least, part.min(axis=0), out=least)
    return mixed(least) & U((1 << BITS) - 1)


def index_keys(symbols: np.ndarray) -> np.ndarray:
    """A key for each part of a chunk that is left when one symbol of it is masked."""
    return mixed(symbols[_LEFT] * U(1 << BITS) + symbols[_RIGHT] + _NAMES).view(np.int64)


def binned(shingles: np.ndarray) -> bytes:
    """For each of 512 ranges of hashes, eight bits of its smallest member; 0 for none."""
    bins = (shingles >> U(55)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    out = np.zeros(BINS, np.uint8)
    out[bins[first]] = (mixed(shingles[first]) % U(255)).astype(np.uint8) + 1
    return out.tobytes()


def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        n, high, low, keys, bins = [], [], [], [], []
        for s in shingle_sets(b.column(1)):
            n.append(len(s))
            if not len(s):
                high.append(None), low.append(None), keys.append(None), bins.append(None)
                continue
            both = mixed(s + U(len(s)))
            high.append(int(s.sum(dtype=U).view(np.int64)))
            low.append(int(both.sum(dtype=U).view(np.int64)))
            keys.append(index_keys(signature(s)))
            bins.append(binned(s))
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array(n, pa.int64()),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array(keys, pa.list_(pa.int64())),
                pa.array(bins, pa.binary()),
            ],
            ["doc_id", "n_shingles", "high", "low", "keys", "bins"],
        )


def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [s.view(np.int64) for s in shingle_sets(b.column(1))]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.list_(pa.int64()))], ["node", "shingles"])


def promising(a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Pairs whose bins agree about as often as those of sets of similarity 0.75, or more often.

    Used bins are a sample, without repetition, of the union, so what agrees of them follows a
    hypergeometric law: exact where every shingle has a bin of its own. The margin is 4.5
    standard deviations, so of a million true pairs a few are lost at most.
    """
    used = ((a != 0) | (b != 0)).sum(axis=-1)
    same = ((a == b) & (a != 0)).sum(axis=-1)
    share = PERCENT / 100
    union = (size_a + size_b) / (1 + share)  # of a pair at the threshold; above it, less
    spread = used * share * (1 - share) * np.maximum(union - used, 0) / np.maximum(union - 1, 1)
    return (used <= union) & (same >= used * share - 4.5 * np.sqrt(spread) - 1)


def matrix(bins: pd.Series | list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(bins), np.uint8).reshape(len(bins), BINS)


def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Candidate pairs (a, b) whose sketches promise a link."""
    for pdf in batches:
        if len(pdf):
            sizes = (pdf[f"size_{x}"].to_numpy() for x in "ab")
            good = promising(matrix(pdf["bins_a"]), matrix(pdf["bins_b"]), *sizes)
            yield pdf.loc[good, ["a", "b"]]


def across(left: tuple, right: tuple, ordered: bool, place: int) -> tuple[list[int], list[int]]:
    """Promising pairs between two blocks of (node, component, size, bins, keys), of different components.

    A pair that shares several keys is given under the first of them, unless ``place`` is -1.
    """
    out_a: list[int] = []
    out_b: list[int] = []
    nodes, components, sizes, bins, keys = right
    for node, component, size, row, own in zip(*left, strict=True):
        other = components != component
        if ordered:
            other &= nodes > node
        at = np.flatnonzero(other)
        if len(at):
            at = at[promising(row[None, :], bins[at], size, sizes[at])]
            if place >= 0 and len(at):
                at = at[((keys[at] == own) & (own != 0)).argmax(axis=1) == place]
            out_a += [int(node)] * len(at)
            out_b += nodes[at].tolist()
    return out_a, out_b


def within_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each (key, i, j); rows come sorted by these, two blocks at most to a group."""
    names = ["key", "i", "j", "place", "own", "node", "component", "size"]
    rest: list[np.ndarray] | None = None

    def groups(cols: list[np.ndarray], ends: np.ndarray) -> pa.RecordBatch:
        a: list[int] = []
        b: list[int] = []
        at = 0
        for end in ends.tolist():
            _, i, j, place, own, *rows = (c[at:end] for c in cols)
            if i[0] == j[0]:
                pairs = across(rows, rows, True, int(place[0]))
            else:
                first = own == i[0]
                both = (tuple(c[first] for c in rows), tuple(c[~first] for c in rows))
                pairs = across(*both, False, int(place[0]))
            a += pairs[0]
            b += pairs[1]
            at = end
        pairs = np.unique(np.sort(np.array([a, b], np.int64), axis=0), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(pairs[1]), pa.array(pairs[0])], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]
        cols.append(matrix(batch.column("bins").to_pylist()))
        cols.append(batch.column("small").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(_PAIRS)))
        if rest is not None:
            cols = [np.concatenate([r, c]) for r, c in zip(rest, cols, strict=True)]
        change = np.zeros(len(cols[0]), bool)
        for c in cols[:3]:
            change[1:] |= c[1:] != c[:-1]
        ends = np.flatnonzero(change)
        if len(ends):
            yield groups(cols, ends)
            rest = [c[ends[-1] :] for c in cols]
        else:
            rest = cols
    if rest is not None:
        yield groups(rest, np.array([len(rest[0])]))


def confirmed(pairs: DataFrame, docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    ``nodes`` maps a node to one document that has its set; only those that occur in a pair
    have their texts read again.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    place = nodes.join(wanted, "node", "left_semi").select("node", "doc_id", "high", "low")
    t, p = docs.alias("t"), place.select("doc_id").distinct().alias("p")
    texts = t.join(p, F.col("t.doc_id").eqNullSafe(F.col("p.doc_id")), "left_semi")
    # a doc_id, or none, may stand for several texts: the one with the node's set is picked by its hash
    own = texts.select("doc_id", "text").mapInArrow(named_sets, "doc_id long, high long, low long, shingles array<long>")
    o, p = own.alias("o"), place.alias("p")
    same = (F.col("o.high") == F.col("p.high")) & (F.col("o.low") == F.col("p.low"))
    own = o.join(p, same & F.col("o.doc_id").eqNullSafe(F.col("p.doc_id"))).select("p.node", "o.shingles")
    own = own.dropDuplicates(["node"])
    own = keep(own, "sets")
    a = own.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    b = own.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    both = pairs.join(a, "a").join(b, "b")
    common = F.size(F.array_intersect("set_a", "set_b")).cast("long")
    union = F.size("set_a") + F.size("set_b") - common
    return both.filter(100 * common >= PERCENT * union).select("a", "b")


def named_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = list(shingle_sets(b.column(1)))
        high = [int(s.sum(dtype=U).view(np.int64)) for s in sets]
        low = [int(mixed(s + U(len(s))).sum(dtype=U).view(np.int64)) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array(high, pa.int64()),
                pa.array(low, pa.int64()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            ["doc_id", "high", "low", "shingles"],
        )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id reachable) and kept, for every row."""
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    sketch = keep(rows.mapInArrow(sketches, SKETCH), "sketches")
    full = sketch.filter("n_shingles > 0")
    # one node per distinct set; its number is its smallest doc_id, or a hash if all are null
    nodes = full.groupBy("high", "low").agg(
        F.min("doc_id").alias("doc_id"), F.any_value("n_shingles").alias("size"),
        F.any_value("keys").alias("keys"), F.any_value("bins").alias("bins"),
    )
    nodes = nodes.withColumn("node", F.coalesce("doc_id", F.bitwise_not(F.abs(F.xxhash64("high", "low")))))
    # several sets may share a smallest doc_id where doc_id repeats: these have numbers of their own
    shared = nodes.groupBy("node").agg(F.count("*").alias("n")).filter("n > 1")
    odd = nodes.join(shared.select("node"), "node", "left_semi")
    odd = odd.withColumn("node", F.bitwise_not(F.abs(F.xxhash64("high", "low"))))
    plain = nodes.join(shared.select("node"), "node", "left_anti")
    nodes = keep(plain.unionByName(odd), "nodes")

    keyed = nodes.select("node", F.posexplode("keys").alias("place", "key"))
    stars = keyed.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).filter("n > 1")
    member = keep(keyed.join(stars, "key").select("key", "place", "node", "centre", "n"), "members")

    small = nodes.select("node", "size", "bins")
    candidates = member.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    candidates = (
        candidates.join(small.toDF("a", "size_a", "bins_a"), "a")
        .join(small.toDF("b", "size_b", "bins_b"), "b")
        .mapInPandas(compare, "a long, b long")
    )
    linked = keep(confirmed(keep(candidates, "pairs"), rows, nodes), "links")
    first = connected(linked)

    left = unsettled(member, first)
    more = pairs_across(left, small)
    further = confirmed(keep(more, "pairs"), rows, nodes)
    final = connected(linked.unionByName(further))

    # a component is named by the smallest doc_id of all its documents
    of_node = nodes.select("node", "high", "low").join(final, "node", "left")
    of_node = of_node.select("high", "low", F.coalesce("component", "node").alias("component"))
    of_row = sketch.select("doc_id", "n_shingles", "high", "low").join(of_node, ["high", "low"], "left")
    named = of_row.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("name"))
    out = of_row.join(named, "component", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("name")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def unsettled(member: DataFrame, components: DataFrame) -> DataFrame:
    """Members, with their components, of the keys that hold more than one component."""
    now = member.join(components, "node", "left").select(
        "key", "place", "node", "n", F.coalesce("component", "node").alias("component")
    )
    now = keep(now, "unsettled")
    mixed_keys = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return now.join(mixed_keys.filter("x <> y").select("key"), "key", "left_semi")


def refined(left: DataFrame) -> DataFrame:
    """Large keys split by a second key of another chunk.

    Within the distance, a pair that shares a key of one chunk also shares one of a later or
    earlier chunk, except with a chance far below that of missing the distance itself.
    """
    large = left.filter(F.col("n") > FINE)
    other = left.select("node", F.col("key").alias("second"), F.col("place").alias("at"))
    chunk = lambda c: (F.col(c) / PER_CHUNK).cast("int")
    both = large.join(other, "node").filter(chunk("at") > chunk("place"))
    both = both.withColumn("key", F.xxhash64("key", "second"))
    counts = both.groupBy("key").agg(
        F.count("*").alias("n"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    counts = counts.filter("x <> y").select("key", "n")
    return both.drop("n").join(counts, "key").select("key", "node", "n", "component")


def pairs_across(left: DataFrame, bins: DataFrame) -> DataFrame:
    """Promising pairs of different components that share a key; of two, the link was tried."""
    left = keep(left.filter("n > 2"), "left")
    small = left.filter(F.col("n") <= FINE)
    groups = small.select("key", "node", "n", "component", "place")
    groups = groups.unionByName(refined(left).withColumn("place", F.lit(-1)))
    # the keys of each node by place, 0 where a key is not compared as a whole
    held = F.map_from_entries(F.collect_list(F.struct("place", "key")))
    held = small.groupBy("node").agg(held.alias("held"))
    places = F.sequence(F.lit(0), F.lit(len(_PAIRS) - 1))
    none = F.array_repeat(F.lit(0).cast("long"), len(_PAIRS))
    held = held.select("node", F.transform(places, lambda p: F.coalesce(F.col("held")[p], F.lit(0))).alias("small"))
    bins = bins.join(held, "node", "left").withColumn("small", F.coalesce("small", none))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    groups = groups.select("key", "place", "node", "component", own.alias("own"), blocks.alias("blocks"))
    partners = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j")),
    )
    dealt = groups.select("key", "place", "node", "component", "own", F.inline(partners)).join(bins, "node")
    dealt = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    pairs = dealt.mapInArrow(within_blocks, "a long, b long")
    return pairs.distinct()

"""Exact Jaccard join of documents on their word n-grams, over size-banded tiles.

A document is the set of its five-word shingles (64-bit hashes). Two documents link when their
sets' similarity is at least ``PERCENT`` / 100; the result is the components of these links.

* **Candidates.** All sets list their members in one order, rare ones first. Similar sets share a
  member among the first ``n - ceil(0.8 n) + 1`` of each, so only these are index keys. Any order that
  is the same for all gives the same result. This one counts in how many sets a member occurs,
  exactly, for members in the lowest ``LOW`` of hash values, and takes them by that count; then come
  the other members, and last the commonest ones, of which a list of at most ``COMMON`` is known
  from counts over all documents. Hence passages that many documents share are hardly ever keys,
  keys that only one set has are dropped, and what is counted has no very frequent value left in it.
* **Stars.** Of an index key's documents each is first compared with the smallest one, so a
  group of thousands of near copies takes one comparison per document and key.
* **Tiles.** Keys whose documents are then in more than one component are compared within size
  bands. Sets of similarity 0.8 differ in size by a quarter at most and bands grow by a quarter, so
  a link joins equal or adjacent bands. A band is dealt into blocks of ``BLOCK`` documents and
  tiles are pairs of blocks of (adjacent) bands: a key of any size becomes many tasks of bounded
  size, and only documents of different components are compared. A first round hands on the
  ``FIRST`` most promising pairs of two components in a tile, as one link is enough to join them;
  a second one takes the tiles where this left pairs out and compares all pairs of what is still apart.
* **Bitmaps.** A set is hashed to a bitmap of four to eight bits a member. Every bit in which two
  bitmaps differ stands for at least one member that only one set has, so the count of such
  bits bounds the overlap from above: (a + b - bits) / 2. Bitmaps of different lengths are
  folded to the shorter one. Pairs that this bound can't exclude are intersected exactly as
  sorted arrays.

Equal sets are one class with one representative, so exact copies cost nothing. No link between
different sets is lost (up to collisions of 64-bit hashes), whatever the group's size.

Rules for odd rows: a null or blank text has an empty set and is linked with nothing; fewer
than five words count as one shingle; texts of any length are used whole; rows have numbers
of their own, so null and repeated ids neither lose nor join links; a component is named by
the smallest id that is not null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lifeloom.llm.components import connected
from lifeloom.llm.near import shingle_sets
from lifeloom.llm.tables import columns, discard, keep, keep_bucketed, partitions
from lifeloom.llm.words import U, mixed

PERCENT = 80
#: The list of common shingles has at most this many entries, by the share that each must have;
#: what occurs less than ``OFTEN`` times is never common.
COMMON, OFTEN = 1 << 20, 1000
#: Members whose hash is below this share of all hashes are counted. It exceeds the fifth of a set
#: that is indexed; where too many of these are common, uncounted members follow.
LOW = 0.3
BLOCK = 2000
#: Pairs of two components that a tile hands on in the first round.
FIRST = 4
#: Pairs that a tile holds before it thins them out or hands them on.
HELD = 1 << 17

SKETCH = "at long, doc_id long, text_hash long, n long, high long, low long, tokens array<long>, extra array<long>, bits binary"
SETS = "text_hash long, high long, low long, shingles array<long>"


# --- the order of shingles --------------------------------------------------------------------


def often(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that have at least one in ``COMMON`` of a batch's members, and how often they occur.

    What has that share of all members has it in some batch too. Each batch also gives its size.
    """
    for b in batches:
        sets = list(shingle_sets(b.column(0)))
        every = np.concatenate(sets) if sets else np.zeros(0, U)
        values, counts = np.unique(every, return_counts=True)
        some = counts >= max(3, len(every) // COMMON)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(values[some].view(np.int64), 0)),
                pa.array(np.append(counts[some], len(every)).astype(np.int64)),
                pa.array(np.append(np.zeros(int(some.sum()), bool), True)),
            ],
            ["shingle", "n", "is_size"],
        )


def common_shingles(texts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The common shingles, sorted, and each one's rank by how often it occurs.

    Only shingles with at least one in ``COMMON`` of all members are taken, so there are at most
    ``COMMON`` of them: 16 MB on the driver and on each executor, however large the input.
    """
    counts = keep(
        texts.mapInArrow(often, "shingle long, n long, is_size boolean").groupBy("is_size", "shingle").agg(F.sum("n").alias("n")),
        "often",
    )
    size = counts.filter("is_size").agg(F.sum("n")).first()[0] or 0
    least = max(OFTEN, -(-size // COMMON))
    found = counts.filter(~F.col("is_size") & (F.col("n") >= least)).orderBy("n", "shingle").select("shingle").toArrow()
    discard(counts)
    shingles = found.column(0).to_numpy().view(U)
    order = np.argsort(shingles)
    return shingles[order], (order + 1).astype(np.int64)


def ranks(shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """0 for shingles that are not common, else the place in the list."""
    values, rank = common
    if not len(values):
        return np.zeros(len(shingles), np.int64)
    at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
    return np.where(values[at] == shingles, rank[at], 0)


def index_length(n: int) -> int:
    """How many first members two similar sets have one in common of."""
    return n - -(-PERCENT * n // 100) + 1


def indexed(shingles: np.ndarray, common: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The set's members that are to be counted, and those that follow them within the index length."""
    rank = ranks(shingles, common)
    rare = shingles[rank == 0]
    cut = int(np.searchsorted(rare, U(int(LOW * 2**64))))
    tokens, more = rare[:cut], index_length(len(shingles)) - cut
    if more <= 0:
        return tokens, rare[:0]
    late = shingles[rank > 0][np.argsort(rank[rank > 0])]
    return tokens, np.concatenate([rare[cut:], late])[:more]


def index_keys(nodes: DataFrame) -> DataFrame:
    """node and key: the first members of each set, without those that no other set has.

    A counted member goes to one task with all its sets; it has less than one in ``COMMON`` of all
    members, else it would be in the list of common ones.
    """
    counted = nodes.select("node", "size", F.size("tokens").alias("counted"), F.explode("tokens").alias("key"))
    n = F.count(F.lit(1)).over(Window.partitionBy("key"))
    shared = counted.withColumn("n", n).filter("n > 1")
    # sets are ordered by (n, key); those of n = 1 come first and were dropped
    by_set = Window.partitionBy("node")
    first = F.col("size") - F.ceil(F.col("size") * PERCENT / 100) + 1
    alone = F.col("counted") - F.count(F.lit(1)).over(by_set)
    place = F.row_number().over(by_set.orderBy("n", "key")) + alone
    kept = shared.withColumn("first", first).withColumn("place", place).filter("place <= first").select("node", "key")
    return kept.unionByName(nodes.select("node", F.explode("extra").alias("key")))


# --- bitmaps ----------------------------------------------------------------------------------


def bitmap(shingles: np.ndarray) -> bytes:
    """Four to eight bits a member, 64 at least; the length is a power of two."""
    size = max(64, 1 << (4 * len(shingles) - 1).bit_length())
    bits = np.zeros(size, np.uint8)
    bits[(mixed(shingles) & U(size - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bitmaps: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) cut to ``words`` words, a power of two."""
    while bitmaps.shape[1] > words:
        half = bitmaps.shape[1] // 2
        bitmaps = bitmaps[:, :half] | bitmaps[:, half:]
    return bitmaps


def possible(sizes_a, sizes_b, differing):
    """Whether the overlap that the differing bits leave possible would make a link."""
    total = sizes_a + sizes_b
    overlap = np.minimum((total - differing) // 2, np.minimum(sizes_a, sizes_b))
    return 100 * overlap >= PERCENT * (total - overlap)


class Block:
    """Documents of a tile's side: numbers, components, sizes, and bitmaps by their length."""

    def __init__(self, node: np.ndarray, component: np.ndarray, size: np.ndarray, bits: list[bytes]) -> None:
        self.node, self.component, self.size = node, component, size
        lengths = np.array([len(x) // 8 for x in bits])
        self.parts = []
        for words in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == words)
            joined = b"".join(bits[i] for i in rows.tolist())
            self.parts.append((rows, np.frombuffer(joined, U).reshape(len(rows), words)))

    def against(self, other: Block) -> Iterator[np.ndarray]:
        """Pairs of different components that the bitmaps can't exclude, each once within a block.

        Each array has rows a, b, their components (smaller one first) and the differing share in millionths.
        """
        for rows, own in self.parts:
            for those, theirs in other.parts:
                words = min(own.shape[1], theirs.shape[1])
                mine, yours = fold(own, words), fold(theirs, words)
                component, size, node = other.component[those], other.size[those], other.node[those]
                for r, bits in zip(rows.tolist(), mine, strict=True):
                    apart = component != self.component[r]
                    if self is other:
                        apart &= node > self.node[r]
                    at = np.flatnonzero(apart)
                    if len(at):
                        differing = np.bitwise_count(yours[at] ^ bits).sum(axis=1, dtype=np.int64)
                        good = possible(self.size[r], size[at], differing)
                        at, differing = at[good], differing[good]
                        both = component[at], np.full(len(at), self.component[r])
                        share = 1_000_000 * differing // (self.size[r] + size[at])
                        yield np.array([np.full(len(at), self.node[r]), node[at], np.minimum(*both), np.maximum(*both), share])


def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate pairs (a, b) of stars whose bitmaps leave a link possible."""
    for b in batches:
        if not b.num_rows:
            continue
        size_a, size_b = (b.column(i).to_numpy() for i in (2, 3))
        left, right = b.column(4).to_pylist(), b.column(5).to_pylist()
        differing = np.zeros(b.num_rows, np.int64)
        for i, (x, y) in enumerate(zip(left, right, strict=True)):
            words = min(len(x), len(y)) // 8
            one, two = (fold(np.frombuffer(z, U)[None, :], words) for z in (x, y))
            differing[i] = int(np.bitwise_count(one ^ two).sum())
        yield b.select([0, 1]).filter(pa.array(possible(size_a, size_b, differing)))


def most_promising(pairs: np.ndarray, most: int) -> np.ndarray:
    """Of each two components (rows 2 and 3) the ``most`` pairs with the smallest share of differing bits."""
    order = np.lexsort((pairs[4], pairs[3], pairs[2]))
    pairs = pairs[:, order]
    new = np.ones(pairs.shape[1], bool)
    new[1:] = (pairs[2:4, 1:] != pairs[2:4, :-1]).any(axis=0)
    place = np.arange(pairs.shape[1])
    return pairs[:, place - np.maximum.accumulate(np.where(new, place, 0)) < most]


def thinned(pairs: list[np.ndarray], most: int | None) -> np.ndarray:
    together = np.concatenate(pairs, axis=1)
    return together if most is None else most_promising(together, most)


def tiles(most: int | None):
    """Pairs (a, b) of each tile, of two components the ``most`` best; rows come sorted by tile, two blocks at most to one.

    A tile that leaves pairs out says so by a row with its key and no pair.
    """
    tile, held = ["key", "band_a", "band_b", "i", "j"], HELD

    def side(t: pa.Table) -> Block:
        node, component, size = (t.column(c).to_numpy() for c in ("node", "component", "size"))
        return Block(node, component, size, t.column("bits").to_pylist())

    def compared(part: pa.Table, mask: np.ndarray, alone: bool) -> Iterator[np.ndarray]:
        if mask.all():
            one = side(part)
            yield from one.against(one) if alone else ()
        elif mask.any():
            yield from side(part.filter(pa.array(mask))).against(side(part.filter(pa.array(~mask))))

    def handed(pairs: list[np.ndarray], cut: list[int]) -> pa.RecordBatch:
        found = np.concatenate([np.zeros((5, 0), np.int64), *pairs], axis=1)
        both = np.unique(np.sort(found[:2], axis=0), axis=1)
        a, b = (pa.concat_arrays([pa.array(x), pa.nulls(len(cut), pa.int64())]) for x in both[::-1])
        key = pa.concat_arrays([pa.nulls(both.shape[1], pa.int64()), pa.array(cut, pa.int64())])
        return pa.RecordBatch.from_arrays([a, b, key], ["a", "b", "key"])

    def pairs(t: pa.Table, ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        out: list[np.ndarray] = []
        cut: list[int] = []
        left, alone, keys = (t.column(c).to_numpy(zero_copy_only=False) for c in ("is_left", "alone", "key"))
        at = 0
        for end in ends.tolist():
            own: list[np.ndarray] = []
            before = after = waiting = 0
            for found in compared(t.slice(at, end - at), left[at:end], alone[at]):
                own.append(found)
                before, waiting = before + found.shape[1], waiting + found.shape[1]
                if waiting > held:
                    own, waiting = [thinned(own, most)], 0
                    if most is None:
                        yield handed(own, [])
                        own = []
            if own:
                own = [thinned(own, most)]
                after = own[0].shape[1]
            if most is not None and after < before:
                cut.append(int(keys[at]))
            out += own
            at = end
        yield handed(out, cut)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = (pa.concat_tables([rest, table]) if rest is not None else table).combine_chunks()
            change = np.zeros(len(table), bool)
            for c in tile:
                x = table.column(c).to_numpy()
                change[1:] |= x[1:] != x[:-1]
            ends = np.flatnonzero(change)
            if len(ends):
                yield from pairs(table, ends)
                rest = table.slice(int(ends[-1]))
            else:
                rest = table
        if rest is not None:
            yield from pairs(rest, np.array([len(rest)]))

    return run


# --- sketches and exact sets ------------------------------------------------------------------


def digests(shingles: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that name a set."""
    high = shingles.sum(dtype=U)
    low = mixed(shingles + U(len(shingles))).sum(dtype=U)
    return int(high.view(np.int64)), int(low.view(np.int64))


def sketches(common: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, high, low, tokens, extra, bits = [], [], [], [], [], []
            for s in shingle_sets(b.column(3)):
                n.append(len(s))
                names = digests(s) if len(s) else (None, None)
                high.append(names[0]), low.append(names[1])
                first = indexed(s, common.value) if len(s) else (s, s)
                tokens.append(first[0].view(np.int64)), extra.append(first[1].view(np.int64))
                bits.append(bitmap(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *(b.column(i) for i in range(3)),
                    pa.array(n, pa.int64()),
                    pa.array(high, pa.int64()),
                    pa.array(low, pa.int64()),
                    pa.array(tokens, pa.list_(pa.int64())),
                    pa.array(extra, pa.list_(pa.int64())),
                    pa.array(bits, pa.binary()),
                ],
                ["at", "doc_id", "text_hash", "n", "high", "low", "tokens", "extra", "bits"],
            )

    return run


def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = list(shingle_sets(b.column(1)))
        names = [digests(s) if len(s) else (None, None) for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array([x for x, _ in names], pa.int64()),
                pa.array([x for _, x in names], pa.int64()),
                pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
            ],
            ["text_hash", "high", "low", "shingles"],
        )


def linked_exactly(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose sorted sets overlap enough."""
    for b in batches:
        left, right = b.column(2), b.column(3)
        good = np.zeros(b.num_rows, bool)
        for i in range(b.num_rows):
            x, y = (c[i].values.to_numpy() for c in (left, right))
            common = len(np.intersect1d(x, y, assume_unique=True))
            good[i] = 100 * common >= PERCENT * (len(x) + len(y) - common)
        yield b.select([0, 1]).filter(pa.array(good))


def confirmed(pairs: DataFrame, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough.

    A node's text is found again by a hash of id and text, and its set by the set's name. The
    texts lie in buckets by that hash, so they are not shuffled however many are wanted.
    """
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    place = keep(nodes.select("node", "text_hash", "high", "low").join(wanted, "node", "left_semi"), "wanted")
    texts = rows.join(place.select("text_hash").distinct().hint("shuffle_hash"), "text_hash", "left_semi")
    s = texts.select("text_hash", "text").mapInArrow(sets_of, SETS)
    q, same = place, ["text_hash", "high", "low"]
    own = s.join(q, same).select("node", "shingles").dropDuplicates(["node"])
    own = keep(own, "sets")
    both = pairs.join(own.toDF("a", "set_a"), "a").join(own.toDF("b", "set_b"), "b")
    return both.select("a", "b", "set_a", "set_b").mapInArrow(linked_exactly, "a long, b long")


# --- the join ---------------------------------------------------------------------------------


def bands(largest: int) -> list[int]:
    """Smallest size of each band up to ``largest``; each begins a quarter above the one before."""
    edges = [1]
    while edges[-1] <= largest:
        edges.append(-(-edges[-1] * 100 // PERCENT) if edges[-1] > 4 else edges[-1] + 1)
    return edges


def unsettled(member: DataFrame, components: DataFrame) -> DataFrame:
    """Members of the keys that hold more than one component, with their components."""
    now = member.join(components, "node", "left").withColumn("component", F.coalesce("component", "node"))
    now = keep(now.select("key", "node", "component"), "unsettled")
    ends = now.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return now.join(ends.filter("x <> y").select("key"), "key", "left_semi")


def tiled(left: DataFrame, nodes: DataFrame, most: int | None) -> DataFrame:
    """Candidate pairs (a, b) of documents of different components that share a key.

    Of two components a tile gives ``most`` pairs, or all of them. Rows with ``key`` and no pair name
    the keys in which pairs were left out.
    """
    largest = nodes.agg(F.max("size")).first()[0] or 1
    edges = F.lit(bands(largest)).cast("array<long>")
    # the last band that begins at or below the size
    band = F.size(F.filter(edges, lambda e: e <= F.col("size")))
    rows = keep(left.join(nodes.select("node", "size"), "node").withColumn("band", band), "banded")
    by_key = Window.partitionBy("key").orderBy("band")  # at most one row per band
    count = rows.groupBy("key", "band").agg(F.count("*").alias("n"))
    count = count.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("int"))
    near = lambda f, by: F.when(f("band").over(by_key) == F.col("band") + by, f("blocks").over(by_key)).otherwise(0)
    count = count.select("key", "band", "n", "blocks", near(F.lead, 1).alias("above"), near(F.lag, -1).alias("below"))
    # a document alone in its band and without neighbours has no partner here
    count = count.filter("n > 1 or above > 0 or below > 0")
    rows = rows.join(count.drop("n"), ["key", "band"])
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own)
    to = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda o: o < n)
    me, b = F.col("own"), F.col("band")
    same = F.transform(
        to(F.col("blocks")),
        lambda o: F.struct(b.alias("band_a"), b.alias("band_b"), F.least(me, o).alias("i"), F.greatest(me, o).alias("j"), (me <= o).alias("is_left"), (me == o).alias("alone")),
    )
    up = F.transform(
        to(F.col("above")),
        lambda o: F.struct(b.alias("band_a"), (b + 1).alias("band_b"), me.alias("i"), o.alias("j"), F.lit(True).alias("is_left"), F.lit(False).alias("alone")),
    )
    down = F.transform(
        to(F.col("below")),
        lambda o: F.struct((b - 1).alias("band_a"), b.alias("band_b"), o.alias("i"), me.alias("j"), F.lit(False).alias("is_left"), F.lit(False).alias("alone")),
    )
    dealt = rows.select("key", "node", "component", F.inline(F.concat(same, up, down)))
    dealt = dealt.join(nodes.select("node", "size", "bits"), "node")
    dealt = dealt.repartition("key", "band_a", "band_b", "i", "j").sortWithinPartitions("key", "band_a", "band_b", "i", "j")
    return dealt.mapInArrow(tiles(most), "a long, b long, key long").distinct()


def jaccard_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles and component_id of every row."""
    spark = docs.sparkSession
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    # copies differ by their ids, so a text that very many have is spread over the buckets
    rows = rows.withColumn("text_hash", F.xxhash64("doc_id", "text"))
    rows = keep_bucketed(rows, "texts", "text_hash", partitions(spark))
    common = spark.sparkContext.broadcast(common_shingles(rows.select("text")))
    numbered = rows.select(F.monotonically_increasing_id().alias("at"), "doc_id", "text_hash", "text")
    sketch = keep(numbered.mapInArrow(sketches(common), SKETCH), "sketches")

    # one node per distinct set, numbered by its first row
    nodes = sketch.filter("n > 0").groupBy("high", "low")
    first = F.min(F.struct("at", "text_hash", "n"))
    nodes = nodes.agg(first.alias("r"), *(F.any_value(c).alias(c) for c in ("tokens", "extra", "bits")))
    place = [F.col("r.at").alias("node"), "r.text_hash", F.col("r.n").alias("size")]
    nodes = keep(nodes.select("high", "low", *place, "tokens", "extra", "bits"), "nodes")
    of_row = keep(sketch.select("doc_id", "n", "high", "low"), "rows")
    discard(sketch)
    # bitmaps are looked up again and again, in place
    sizes = keep_bucketed(nodes.select("node", "size", "bits"), "bitmaps", "node", partitions(spark))

    keyed = keep(index_keys(nodes), "keys")
    stars = keyed.groupBy("key").agg(F.min("node").alias("centre"), F.count("*").alias("n")).filter("n > 1")
    member = keep(keyed.join(stars, "key"), "members")
    discard(keyed)
    star = member.filter("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b")).distinct()
    star = (
        star.join(sizes.toDF("a", "size_a", "bits_a"), "a")
        .join(sizes.toDF("b", "size_b", "bits_b"), "b")
        .select("a", "b", "size_a", "size_b", "bits_a", "bits_b")
        .mapInArrow(paired, "a long, b long")
    )
    linked = keep(confirmed(keep(star, "pairs"), rows, nodes), "links")
    final = connected(linked)

    # in a key of two documents the star was the whole comparison
    left = member.filter("n > 2").select("key", "node")
    for most in (FIRST, None):
        left = unsettled(left.select("key", "node"), final)
        more = keep(tiled(left, sizes, most), "pairs")
        left = left.join(more.filter("key is not null").select("key").distinct(), "key", "left_semi")
        pairs = more.filter("key is null").select("a", "b")
        linked = keep(linked.unionByName(confirmed(pairs, rows, nodes)), "links")
        final = connected(linked)

    of_node = nodes.select("node", "high", "low").join(final, "node", "left")
    of_node = of_node.select("high", "low", F.coalesce("component", "node").alias("component"))
    of_row = of_row.join(of_node, ["high", "low"], "left")
    named = of_row.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("name"))
    out = of_row.join(named, "component", "left")
    component = F.when(F.col("n") > 0, F.col("name")).otherwise(F.col("doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))

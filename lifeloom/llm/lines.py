"""Line dedup: lines equal to, or one word away from, an earlier line are removed.

Lines are compared as lists of words, A-Z in lower case. The earliest line is the first by
doc_id, then row, then position; a line goes if any line before it, itself removed or not, is
equal, or is within ``one edit`` (a word replaced, left out or put in) and both have at least
``MIN_WORDS`` words.

The join on the deletion neighbourhood never pairs up a group. Two lines one replacement apart
give the same variant when both drop the word at that place, so all lines under (variant,
place) are within one edit of each other and only the earliest of them matters. A line one
word shorter is itself a variant of the longer one. So one minimum per key decides; a template
with any number of lines costs one row per line and place, and minima are combined before the
shuffle. Each decision is then verified on the words of both lines.

Variants are emitted only for lines that can have a partner: one edit leaves the first or the
second half of the shorter line whole, so lines that share no half with another distinct line
have none. Equal lines are brought together first, by a 128-bit hash.

Texts are written once, compressed and hashed by row, and stay there; only numbers are
shuffled, and the words of lines to be verified.

Rules for odd rows: lines without words stay; a null text stays null; repeated rows are later
copies, so all their lines go; rows without doc_id come last; an empty table gives no rows;
all other columns are passed through (``_row`` is reserved). Very long texts are lists of lines
like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeloom.llm.tables import keep, keep_bucketed, partitions, ship
from lifeloom.llm.words import U, _power_table, constants, mixed, word_hashes

MIN_WORDS = 8
LAST = (1 << 63) - 1
_BASES = int(constants(1, 31)[0]), int(constants(1, 32)[0])
_SIDES = constants(2, 33)
ORDER = ("doc", "row", "line")


class Runs:
    """Hashes of any runs of a list of words, from running sums."""

    def __init__(self, words: np.ndarray, base: int) -> None:
        n = len(words)
        self.sums = np.zeros(n + 1, U)
        self.power = _power_table(base, n + 1)
        self.back = _power_table(pow(base, -1, 1 << 64), n + 1)
        np.cumsum(words * self.power[:n], out=self.sums[1:])

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.back[start]

    def hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed(self.raw(start, end) + (end - start).astype(U))


def half_keys(runs: Runs, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Keys of both halves of a line, as a line of its length and as one that is a word longer.

    A line too short for either has 0 there.
    """
    n = end - start
    keys = []
    for length in (n, n - 1):
        half = length // 2
        fit = length >= MIN_WORDS
        tag = mixed(length.astype(U))
        for side, (a, b) in enumerate(((start, start + half), (end - (length - half), end))):
            a, b = np.where(fit, a, 0), np.where(fit, b, 0)
            keys.append(np.where(fit, mixed(runs.hashes(a, b) + tag + _SIDES[side]), U(0)))
    return keys


def split_lines(packed: list[bytes | None]) -> tuple[list[str], np.ndarray]:
    """All lines of some texts, and how many each text has."""
    lines: list[str] = []
    counts = []
    for p in packed:
        own = zstandard.decompress(p).decode().split("\n") if p is not None else []
        lines += own
        counts.append(len(own))
    return lines, np.array(counts, np.int64)


def chunks(b: pa.RecordBatch, at: int, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have a bounded size in all once unpacked, or of one text."""
    first = size = 0
    for i, packed in enumerate(b.column(at)):
        text = packed.as_py()
        size += 0 if text is None else zstandard.frame_content_size(text)
        if size >= most:
            yield b.slice(first, i + 1 - first)
            first, size = i + 1, 0
    if first < b.num_rows:
        yield b.slice(first)


LINES = "doc long, row long, line int, high long, low long, words int, keys array<long>"


def line_rows(with_keys: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per line that has words: its place, hash, number of words and half keys."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in chunks(batch, 2)):
            docs = np.array([LAST if d is None else d for d in b.column(0).to_pylist()], np.int64)
            rows = b.column(1).to_numpy()
            lines, counts = split_lines(b.column(2).to_pylist())
            words, first = word_hashes(pa.array(lines, pa.string()))
            start, end = first[:-1], first[1:]
            full = np.flatnonzero(end > start)
            place = np.arange(len(lines)) - np.repeat(np.cumsum(counts) - counts, counts)
            start, end = start[full], end[full]
            runs = [Runs(words, base) for base in _BASES]
            high, low = (r.hashes(start, end).view(np.int64) for r in runs)
            cols = [
                pa.array(np.repeat(docs, counts)[full]),
                pa.array(np.repeat(rows, counts)[full]),
                pa.array(place[full].astype(np.int32)),
                pa.array(high),
                pa.array(low),
                pa.array((end - start).astype(np.int32)),
            ]
            if with_keys:
                keys = np.stack(half_keys(runs[0], start, end), axis=1).view(np.int64)
                offsets = np.arange(0, keys.size + 1, 4, dtype=np.int32)
                cols.append(pa.ListArray.from_arrays(offsets, pa.array(keys.ravel())))
            names = ["doc", "row", "line", "high", "low", "words", "keys"][: len(cols)]
            yield pa.RecordBatch.from_arrays(cols, names)

    return work


def chosen_lines(packed: bytes, wanted: list[int]) -> list[str]:
    lines = zstandard.decompress(packed).decode().split("\n")
    return [lines[i] for i in wanted]


def variants(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each chosen line all variants with one word dropped, and the line itself (place -1)."""
    for b in (part for batch in batches for part in chunks(batch, 1)):
        lines, place = [], []
        for row, packed, chosen in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            lines += chosen_lines(packed, [c["line"] for c in chosen])
            place += [(c["doc"], row, c["line"]) for c in chosen]
        words, first = word_hashes(pa.array(lines, pa.string()))
        start, end = first[:-1], first[1:]
        n = end - start
        runs = Runs(words, _BASES[0])
        own = np.repeat(np.arange(len(lines)), n)
        at = np.arange(len(words))
        a, z = start[own], end[own]
        rest = runs.raw(a, at) + runs.raw(at + 1, z) * runs.power[at - a]
        dropped = mixed(rest + (z - a - 1).astype(U))
        # dropping any of equal neighbours gives the same rest, but another line may differ at
        # any of their places; for lines of other lengths the first place will do
        begin = np.ones(len(words), bool)
        begin[1:] = words[1:] != words[:-1]
        begin[start[n > 0]] = True
        key = np.concatenate([dropped, runs.hashes(start, end)]).view(np.int64)
        spot = np.concatenate([at - a, np.full(len(lines), -1)]).astype(np.int32)
        line = np.concatenate([own, np.arange(len(lines))])
        first_place = np.concatenate([begin, np.zeros(len(lines), bool)])
        doc, row, number = (np.array(x, np.int64) for x in zip(*place, strict=True))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(key),
                pa.array(spot),
                pa.array(doc[line]),
                pa.array(row[line]),
                pa.array(number[line].astype(np.int32)),
                pa.array(first_place),
            ],
            ["key", "spot", *ORDER, "first_place"],
        )


def texts_of_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in (part for batch in batches for part in chunks(batch, 1)):
        out_row, out_line, out_text = [], [], []
        for row, packed, chosen in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            numbers = sorted({c["line"] for c in chosen})
            out_row += [row] * len(numbers)
            out_line += numbers
            out_text += chosen_lines(packed, numbers)
        yield pa.RecordBatch.from_arrays(
            [pa.array(out_row, pa.int64()), pa.array(out_line, pa.int32()), pa.array(out_text, pa.string())],
            ["row", "line", "text"],
        )


def within_one_edit(a: str, b: str) -> bool:
    """Whether the words of two lines differ by one replacement, insertion or deletion at most."""
    x, y = a.encode().lower().split(), b.encode().lower().split()
    if len(x) > len(y):
        x, y = y, x
    if len(y) - len(x) > 1:
        return False
    i = 0
    while i < len(x) and x[i] == y[i]:
        i += 1
    return x[i:] == y[i + 1 :] if len(x) < len(y) else x[i + 1 :] == y[i + 1 :]


def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        a, z = b.column("text").to_pylist(), b.column("earlier").to_pylist()
        good = [within_one_edit(x, y) for x, y in zip(a, z, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("row"), b.column("line")], ["row", "line"]).filter(pa.array(good))


def store(docs: DataFrame) -> DataFrame:
    """The documents with ``_row`` and with ``text`` compressed, hashed by row."""
    ship(docs.sparkSession)
    rows = docs.withColumn("text", F.col("text").cast("string"))
    rows = rows.withColumn("_row", F.monotonically_increasing_id())
    schema = T.StructType(
        [T.StructField(f.name, T.BinaryType() if f.name == "text" else f.dataType) for f in rows.schema]
    )
    at = rows.columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            texts = [None if (t := x.as_py()) is None else squeeze(t.encode()) for x in b.column(at)]
            cols = [pa.array(texts, pa.binary()) if i == at else c for i, c in enumerate(b.columns)]
            yield pa.RecordBatch.from_arrays(cols, b.schema.names)

    return keep_bucketed(rows.mapInArrow(work, schema), "lines", "_row", partitions(docs.sparkSession))


def near_copies(texts: DataFrame, lines: DataFrame) -> DataFrame:
    """(row, line) of the first of each group of equal lines, where a line one edit away is earlier.

    ``lines`` has one row per distinct line: its earliest place and half keys.
    """
    halves = lines.select("high", "low", "first", F.explode("keys").alias("key")).filter("key <> 0")
    shared = halves.groupBy("key").agg(F.min("high").alias("x"), F.max("high").alias("y")).filter("x <> y")
    able = halves.join(shared.select("key"), "key", "left_semi").select("first.*").distinct()
    wanted = able.groupBy("row").agg(F.collect_list(F.struct("doc", "line")).alias("chosen"))
    given = texts.select(F.col("_row").alias("row"), F.col("text").alias("packed"))
    kinds = "key long, spot int, doc long, row long, line int, first_place boolean"
    found = given.join(wanted, "row").select("row", "packed", "chosen").mapInArrow(variants, kinds)
    found = keep(found.select("key", "spot", "first_place", F.struct(*ORDER).alias("own")), "variants")

    # replacements: all lines that drop the same place to the same rest; the earliest stays
    places = found.groupBy("key", "spot").agg(F.min("own").alias("best"), F.count("*").alias("n"))
    replaced = places.filter("spot >= 0 and n > 1").select("key", "spot", "best")
    by_replacing = found.join(replaced, ["key", "spot"]).filter(F.col("own") > F.col("best")).select("own", "best")
    # a line and those one word longer: whichever is earlier
    whole = found.filter("spot < 0").select("key", F.col("own").alias("shorter"))
    longer = found.filter("first_place").join(whole, "key")
    by_adding = longer.filter(F.col("own") > F.col("shorter")).select("own", F.col("shorter").alias("best"))
    least = longer.groupBy("key").agg(F.min("own").alias("best"))
    by_leaving = whole.join(least, "key").filter(F.col("shorter") > F.col("best"))
    pairs = by_replacing.unionByName(by_adding).unionByName(by_leaving.select(F.col("shorter").alias("own"), "best"))
    pairs = keep(pairs.groupBy("own").agg(F.min("best").alias("best")), "pairs")

    asked = pairs.select(F.explode(F.array("own", "best")).alias("at")).select("at.row", "at.line").distinct()
    asked = asked.groupBy("row").agg(F.collect_list(F.struct("line")).alias("chosen"))
    read = given.join(asked, "row").select("row", "packed", "chosen")
    read = keep(read.mapInArrow(texts_of_lines, "row long, line int, text string"), "line_texts")
    pairs = pairs.select("own.row", "own.line", F.col("best.row").alias("row2"), F.col("best.line").alias("line2"))
    earlier = read.select(F.col("row").alias("row2"), F.col("line").alias("line2"), F.col("text").alias("earlier"))
    both = pairs.join(read, ["row", "line"]).join(earlier, ["row2", "line2"])
    return both.select("row", "line", "text", "earlier").mapInArrow(verify, "row long, line int")


def rebuilt(schema: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    at = schema.fieldNames().index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in chunks(batch, at)):
            texts, total, removed = [], [], []
            gone = b.column(b.schema.get_field_index("_gone")).to_pylist()
            for packed, drop in zip(b.column(at).to_pylist(), gone, strict=True):
                lines = zstandard.decompress(packed).decode().split("\n") if packed is not None else []
                out = set(drop or ())
                texts.append(None if packed is None else "\n".join(x for i, x in enumerate(lines) if i not in out))
                total.append(sum(1 for x in lines if x.encode().split()))
                removed.append(len(out))
            cols = [pa.array(texts, pa.string()) if i == at else b.column(i) for i in range(len(schema) - 2)]
            cols += [pa.array(total, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, schema.fieldNames())

    return work


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The documents without repeated lines; n_lines and n_removed_lines are added.

    Input columns of these two names are replaced.
    """
    docs = docs.drop("n_lines", "n_removed_lines")
    texts = store(docs)
    places = texts.select(F.col("doc_id").cast("long").alias("doc"), F.col("_row").alias("row"), F.col("text"))
    order = F.struct(*ORDER)
    lines = places.mapInArrow(line_rows(True), LINES)
    distinct = lines.groupBy("high", "low").agg(
        F.min(order).alias("first"), F.count("*").alias("n"), F.any_value("keys").alias("keys")
    )
    distinct = keep(distinct, "distinct_lines")
    near = keep(near_copies(texts, distinct.select("high", "low", "first", "keys")), "near_lines")
    firsts = distinct.select("high", "low", "n", "first", "first.row", "first.line")
    gone = firsts.join(near.withColumn("all", F.lit(True)), ["row", "line"], "left")
    gone = gone.filter("n > 1 or all").select("high", "low", "first", F.coalesce("all", F.lit(False)).alias("all"))
    every = places.mapInArrow(line_rows(False), LINES.rpartition(", ")[0])
    removed = every.join(gone, ["high", "low"]).filter(F.col("all") | (order > F.col("first")))
    lists = removed.groupBy(F.col("row").alias("_row")).agg(F.collect_list("line").alias("_gone"))
    schema = T.StructType(
        [f if f.name != "text" else T.StructField("text", T.StringType()) for f in docs.schema]
        + [T.StructField("n_lines", T.LongType()), T.StructField("n_removed_lines", T.LongType())]
    )
    result = texts.join(lists, "_row", "left").select(*(F.col(f"`{c}`") for c in docs.columns), "_gone")
    return result.mapInArrow(rebuilt(schema), schema)

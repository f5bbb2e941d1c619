"""Shards of nearly equal row counts along a Hilbert curve over metadata columns.

Each column is cut into ``2 ** bits`` classes of nearly equal size, a row's classes are a cell
of a grid, and cells are visited in the order of a Hilbert curve. Cutting that order into runs
gives shards whose files hold few values of every column, so that filters on any of them skip
most files. Only DataFrame functions are used.

A row's rank is the number of rows in the cells before its own, plus its place in the cell.
Cells with many rows are split by a hash of ``doc_id`` into at most ``SPLITS`` parts in all
(and one more per cell), so one cell may hold any share of the rows. Only counts per part,
at most ``SPLITS + 2 ** (bits * columns)`` rows, are ever brought together.

Rules for odd rows: a null in a column is in its lowest class; a null text has size 1 and
crc32 0; equal rows have places of their own; an empty table gives no rows; other columns of
the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeloom.llm.tables import columns

BITS = 4
SPLITS = 4096
DIMENSIONS = ("lang", "source", "n_chars")


def curve_steps(n: int) -> list[int]:
    """Steps of the Hilbert curve in ``n`` dimensions, by state and octant of a point.

    A state is the curve's entry corner and direction in the current cube. An entry is
    ``next state * 2**n + place of the octant on the curve``.
    """
    size = 1 << n
    gray = [i ^ (i >> 1) for i in range(size)]
    place = {g: i for i, g in enumerate(gray)}

    def turn(x: int, by: int) -> int:  # left rotation of n bits
        by %= n
        return ((x << by) | (x >> (n - by))) & (size - 1)

    def ones(i: int) -> int:  # trailing one bits
        return ((i + 1) & ~i).bit_length() - 1

    steps = []
    for corner in range(size):
        for axis in range(n):
            for octant in range(size):
                w = place[turn(octant ^ corner, -(axis + 1))]
                enter = 0 if w == 0 else gray[2 * ((w - 1) // 2)]
                along = 0 if w == 0 else ones(w) if w % 2 else ones(w - 1)
                state = (corner ^ turn(enter, axis + 1)) * n + (axis + along + 1) % n
                steps.append(state * size + w)
    return steps


def hilbert_index(classes: list[Column], bits: int) -> Column:
    """Place on the Hilbert curve of a point with coordinates in ``0 .. 2**bits - 1``."""
    n = len(classes)
    size = 1 << n
    table = F.array(*(F.lit(s) for s in curve_steps(n)))
    octants = []
    for i in reversed(range(bits)):
        octant = F.lit(0)
        for j, c in enumerate(classes):
            bit = F.shiftright(c.cast("int"), i).bitwiseAND(F.lit(1))
            octant = octant + bit * F.lit(1 << j)
        octants.append(octant)

    def step(at: Column, octant: Column) -> Column:
        found = F.get(table, at["state"] * F.lit(size) + octant)
        return F.struct(
            (at["index"] * F.lit(size) + found.bitwiseAND(F.lit(size - 1))).cast("long").alias("index"),
            F.shiftright(found, n).alias("state"),
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(F.array(*octants), start, step, lambda at: at["index"])


def as_number(df: DataFrame, name: str) -> Column:
    """A column as a number in its own order; of a text, its first seven bytes."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.NumericType):
        return F.col(name).cast("double")
    if isinstance(kind, T.TimestampType | T.DateType):
        return F.col(name).cast("timestamp").cast("double")
    head = F.hex(F.substring(F.col(name).cast("string").cast("binary"), 1, 7))
    return F.conv(F.rpad(head, 14, "0"), 16, 10).cast("double")


def classes_of(df: DataFrame, names: list[str], bits: int) -> list[Column]:
    """For each column, the class of its value among ``2**bits`` of nearly equal size.

    The bounds come from one pass over all rows; there are ``2**bits - 1`` per column at most.
    """
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    found = df.agg(
        *(F.array_distinct(F.percentile_approx(as_number(df, n), shares, 10_000)).alias(n) for n in names)
    ).first()
    out = []
    for n in names:
        bounds = found[n] or []
        number = as_number(df, n)
        above = [F.when(number > F.lit(b), 1).otherwise(0) for b in bounds]
        out.append(sum(above, F.lit(0)) if above else F.lit(0))
    return out


def hilbert_shards(
    docs: DataFrame,
    shards: int = 16,
    dimensions: tuple[str, ...] = DIMENSIONS,
    bits: int = BITS,
    splits: int = SPLITS,
) -> DataFrame:
    """doc_id, size, text_crc32, curve (place on the curve), shard, slot (place in the shard).

    Shard counts differ by one at most. ``size`` is the text's UTF-8 bytes plus 1.
    """
    names = list(dimensions)
    rows = columns(docs, *dict.fromkeys(["doc_id", "text", *names]))
    cell = hilbert_index(classes_of(rows, names, bits), bits)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    placed = rows.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        cell.alias("curve"),
    )
    # both tables have a bounded number of rows and are small enough to broadcast
    cells = placed.groupBy("curve").agg(F.count("*").alias("n"))
    everything = Window.partitionBy()
    cells = cells.select(
        "curve", F.ceil(F.col("n") * splits / F.sum("n").over(everything)).cast("long").alias("parts")
    )
    split = placed.join(F.broadcast(cells), "curve").withColumn(
        "part", F.pmod(F.xxhash64("doc_id"), F.col("parts"))
    )
    before = Window.orderBy("curve", "part").rowsBetween(Window.unboundedPreceding, -1)
    parts = split.groupBy("curve", "part").agg(F.count("*").alias("n"))
    parts = parts.select(
        "curve",
        "part",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        F.sum("n").over(everything).alias("total"),
    )
    own = Window.partitionBy("curve", "part").orderBy("doc_id", "text_crc32", "size")
    ranked = (
        split.withColumn("place", F.row_number().over(own) - 1)
        .join(F.broadcast(parts), ["curve", "part"])
        .withColumn("rank", F.col("before") + F.col("place"))
    )
    shard = F.expr(f"(rank * {int(shards)}) div total")
    first = F.expr(f"(shard * total + {int(shards) - 1}) div {int(shards)}")
    return ranked.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        "curve",
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - first).cast("long").alias("slot"),
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write documents to one folder per shard, in order of their slots.

    ``placed`` comes from :func:`hilbert_shards` over the same rows; ``doc_id`` must be a key.
    """
    both = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    (
        both.repartitionByRange("shard", "slot")
        .sortWithinPartitions("shard", "slot")
        .drop("slot")
        .write.mode("overwrite")
        .partitionBy("shard")
        .parquet(path)
    )

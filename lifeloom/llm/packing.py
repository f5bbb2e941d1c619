"""Packing of documents into fixed windows, with a bounded number of open windows.

Every partition of the input works alone. A document's tokens fill whole windows first; its
rest goes to the open window where the least room stays free. If it fits in none, the fullest
open window is closed and a new one opened. The windows still open at the end of a partition
are small in number (``open_windows`` at most); groups of partitions merge theirs, settle all but
the ``open_windows`` emptiest, and hand these on to groups of groups, until one group is left. No
step holds more than ``open_windows`` windows of tokens or ``open_windows * FAN`` lengths, however
large the input.

Rules for odd rows: a null text counts as empty and gives one piece, the end token alone;
repeated rows are packed each; an empty table gives no pieces; other columns are ignored.
Very long documents are cut at window borders.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.llm.tables import columns, keep
from lifeloom.llm.tokens import TokenBytes

WINDOW = 1024
OPEN_WINDOWS = 256
#: So many partitions merge their open windows in one task.
FAN = 32

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "window long, offset long, closed boolean"
)


class OpenWindows:
    """A fixed number of open windows, found by the room that is left in them."""

    def __init__(self, window: int, most: int, first: int) -> None:
        self.window, self.most, self.next = window, most, first
        self.rooms: list[tuple[int, int]] = []  # (room, window id), by room

    def fresh(self) -> int:
        self.next += 1
        return self.next - 1

    def place(self, length: int) -> tuple[int, int, int | None]:
        """The window and offset for a piece, and the window that had to be closed for it."""
        i, closed = bisect_left(self.rooms, (length, -1)), None
        if i < len(self.rooms):
            room, name = self.rooms.pop(i)
        else:
            if len(self.rooms) == self.most:
                closed = self.rooms.pop(0)[1]
            room, name = self.window, self.fresh()
        if room > length:
            insort(self.rooms, (room - length, name))
        return name, self.window - room, closed


def pieces_of(
    batches: Iterator[pa.RecordBatch], partition: int, tokenizer: str, window: int, most: int, ids: bool
) -> Iterator[pa.RecordBatch]:
    """The pieces of one partition, in order of input; ``closed`` is false in windows left open."""
    encode = TokenBytes.load(tokenizer)
    space = OpenWindows(window, most, partition << 32)
    held: dict[int, list[tuple]] = {}  # rows in windows that are open still
    done: list[tuple] = []

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        names = [f.split()[0] for f in PIECES.split(", ")] + ["ids"] * ids
        types = [pa.int64()] * 7 + [pa.bool_()] + [pa.binary()] * ids
        data = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(data, types, strict=True)], names)

    for b in batches:
        docs, texts = b.column(0).to_pylist(), b.column(1)
        for doc, text in zip(docs, texts, strict=True):
            buffer = encode(text.as_py() or "") + b"\0\0\0\0"
            total = len(buffer) // 4
            for start in range(0, total, window):
                part = memoryview(buffer)[4 * start : 4 * (start + window)]
                n = len(part) // 4
                row = (doc, start, n, zlib.crc32(part), total)
                tail = (part.tobytes(),) if ids else ()
                if n == window:
                    done.append((*row, space.fresh(), 0, True, *tail))
                    continue
                name, offset, closed = space.place(n)
                if closed is not None:
                    done += [(*r[:7], True, *r[8:]) for r in held.pop(closed)]
                held.setdefault(name, []).append((*row, name, offset, False, *tail))
                if offset + n == window:
                    done += [(*r[:7], True, *r[8:]) for r in held.pop(name)]
            if len(done) >= 4000:
                yield batch(done)
                done = []
    yield batch(done + [r for rows in held.values() for r in rows])


def merged(windows: pd.DataFrame, window: int, most: int) -> pd.DataFrame:
    """Windows of one group, largest first, put together where they fit best; the ``most`` emptiest stay open."""
    windows = windows.sort_values(["used", "window"], ascending=[False, True])
    space = OpenWindows(window, len(windows) + 1, 0)
    names: dict[int, int] = {}
    rows = []
    for name, used in zip(windows["window"], windows["used"], strict=True):
        own, offset, _ = space.place(int(used))
        rows.append((name, own, names.setdefault(own, name), offset))
    emptiest = {own for _, own in space.rooms[::-1][:most]}
    done = [(name, into, base, own in emptiest) for name, own, into, base in rows]
    return pd.DataFrame(done, columns=["window", "into", "base", "open"])


def leftovers(open_windows: DataFrame, parts: int, window: int, most: int = OPEN_WINDOWS) -> DataFrame:
    """(window, sequence_id, base) of every window left open by the partitions."""
    now = open_windows.select(
        "window", F.col("window").alias("into"), F.lit(0).cast("long").alias("base"), "used", F.lit(True).alias("open")
    )
    groups = parts
    while True:
        groups = -(-groups // FAN)
        share = F.shiftright("into", 32) % F.lit(groups)
        bins = now.filter("open").groupBy("into").agg(F.max(F.col("base") + F.col("used")).alias("used"))
        bins = bins.select(F.col("into").alias("window"), "used", share.alias("share"))
        step = bins.groupBy("share").applyInPandas(
            lambda pdf: merged(pdf, window, most), "window long, into long, base long, open boolean"
        )
        step = step.select(
            F.col("window").alias("into"), F.col("into").alias("next"), F.col("base").alias("more"), F.col("open").alias("still")
        )
        now = now.join(step, "into", "left").select(
            "window",
            F.coalesce("next", "into").alias("into"),
            (F.col("base") + F.coalesce("more", F.lit(0))).alias("base"),
            "used",
            F.coalesce("still", F.lit(False)).alias("open"),
        )
        if groups == 1:
            return now.select("window", F.col("into").alias("sequence_id"), "base")


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    window: int = WINDOW,
    open_windows: int = OPEN_WINDOWS,
    with_ids: bool = False,
) -> DataFrame:
    """Pieces of documents with their place in sequences of at most ``window`` tokens.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and with
    ``with_ids`` the piece's ids as little-endian 32-bit numbers. A document is its tokens and
    then id 0. ``tokenizer`` is the vocabulary file; by default the byte-level BPE of 50 k.
    """
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        return pieces_of(batches, part, tokenizer, window, open_windows, with_ids)

    schema = PIECES + ", ids binary" * with_ids
    pieces = keep(rows.mapInArrow(work, schema), "pieces")
    parts = (pieces.agg(F.max(F.shiftright("window", 32))).first()[0] or 0) + 1
    left = pieces.filter(~F.col("closed"))
    used = left.groupBy("window").agg(F.sum("length").alias("used"))
    places = leftovers(used, parts, window, open_windows)
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
    settled = pieces.filter("closed").withColumnRenamed("window", "sequence_id").select(*out)
    moved = left.join(places, "window").withColumn("offset", F.col("offset") + F.col("base")).select(*out)
    return settled.unionByName(moved)


def sequences(pieces: DataFrame) -> DataFrame:
    """One row per sequence of ``pack(..., with_ids=True)``: its ids and document borders."""
    part = F.struct("offset", "doc_id", "start", "length", "ids")
    parts = F.array_sort(F.collect_list(part))  # at most a window of tokens
    return pieces.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id",
        F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: F.struct(p["doc_id"], p["start"], p["length"])).alias("documents"),
    )

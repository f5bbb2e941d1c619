"""Bytes covered by a string of 200 bytes that starts anywhere else in the corpus.

External induced sorting of suffixes, made for tables: suffixes are known by tuples (names of
bounded prefixes, place), the disk-backed queue that brings equal names together is Spark's own
shuffle, and what is found for few suffixes is carried to their neighbours level by level:

level 0   Only sampled suffixes are sorted: those that are smaller than all suffixes around them,
          in the order of a hash of their first ``PREFIX`` bytes. In every 200 bytes there is one
          (the leftmost smallest), and equal strings have it at the same place, so it stands for
          all suffixes up to it. A suffix whose prefix occurs once shares fewer than 200 bytes
          with any other, and so do the suffixes it stands for: these leave at once.
level 1   The suffixes that a sampled one stands for are split into blocks of ``BLOCK`` by their
          distance from it.
level 2   Single suffixes.

At each level a node is a range of suffixes at one distance from a sampled suffix, with two
common-prefix values: ``full``, the hash of all bytes that their 200-byte prefixes cover, and
``core``, the hash of the bytes that they share. If another node has the same ``full``, all of
them repeat. If none has the same ``core``, none of them does. Only nodes between the two are
split further, along with one node for each group that is settled already, as it may hold the
other half of a repeat. Nothing is collected per string, so a passage may repeat any number of
times; texts stay where they are, in a table hashed by row, and only numbers move.

Rules for odd rows: a null text counts as empty; texts under 200 bytes keep all bytes; repeated
rows are repeats of each other, so both lose all they share; doc_id may be null or repeat, as
rows have numbers of their own; an empty table gives no rows. Full values have 128 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.llm.tables import columns, discard, keep, keep_bucketed, partitions
from lifeloom.llm.words import U, _power_table, constants, mixed

LENGTH = 200
PREFIX = 32
BLOCK = 16

NODES = "row long, at long, low long, high long, full long, more long, core long"
_BYTES = constants(256, 21), constants(256, 22)
_BASES = int(constants(1, 23)[0]), int(constants(1, 24)[0])


def inverse_powers(base: int, n: int) -> np.ndarray:
    return _power_table(pow(base, -1, 1 << 64), n)[:n]


class Spans:
    """Hashes of any spans of one text, from running sums; two independent ones."""

    def __init__(self, data: np.ndarray) -> None:
        n = len(data)
        self.sums, self.back = [], []
        for values, base in zip(_BYTES, _BASES, strict=True):
            sums = np.zeros(n + 1, U)
            np.cumsum(values[data] * _power_table(base, n)[:n], out=sums[1:])
            self.sums.append(sums)
            self.back.append(inverse_powers(base, n + 1))

    def hashes(self, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
        sums, back = self.sums[which], self.back[which]
        return mixed((sums[end] - sums[start]) * back[start] + (end - start).astype(U))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours: running minima from both ends of blocks."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(U).max, U)
    padded[: len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def sampled(spans: Spans, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Places of the sampled suffixes, their prefix names, and the first and last suffix each stands for.

    The order is that of the upper half of the prefix's hash, and leftmost first.
    """
    starts = np.arange(size - PREFIX + 1)
    names = spans.hashes(starts, starts + PREFIX)
    ranked = (names & U(0xFFFFFFFF00000000)) | starts.astype(U)
    places = (sliding_least(ranked, LENGTH - PREFIX + 1) & U(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.diff(places, prepend=-1))
    last = np.append(first[1:], len(places)) - 1
    at = places[first]
    return at, names[at], first, last


def emit(parts: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in NODES.split(", ")]
    cols = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in cols], names)


def node_rows(spans: Spans, row: int, at: np.ndarray, low: np.ndarray, high: np.ndarray, size: int) -> tuple:
    """Nodes of the suffixes ``at - high .. at - low``, of which one at least has 200 bytes.

    Where not all of them do, ``full`` is a value that no other node has.
    """
    first, last = at - high, at - low
    whole = (first >= 0) & (last + LENGTH <= size)
    begin, end = np.where(whole, first, 0), np.where(whole, last + LENGTH, 0)
    own = mixed(at.astype(U) * U(65536) + low.astype(U) + mixed(np.full(len(at), row, U)))
    # distances are part of the names, as only suffixes at equal distances are compared
    apart = mixed(low.astype(U) * U(1 << 20) + high.astype(U))
    many = [np.where(whole, spans.hashes(begin, end, k) + apart, own) for k in (0, 1)]
    core = spans.hashes(last, first + LENGTH) + apart
    return (np.full(len(at), row), at, low, high, *(x.view(np.int64) for x in (*many, core)))


def text_bytes(packed: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(packed) if packed else b"", np.uint8)


def sample_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Level 0: a node for each sampled suffix with all it stands for; core is its prefix's name."""
    for b in batches:
        parts = []
        for row, packed in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            data = text_bytes(packed)
            if len(data) < LENGTH:
                continue
            spans = Spans(data)
            at, names, first, last = sampled(spans, len(data))
            rows = node_rows(spans, row, at, at - last, at - first, len(data))
            parts.append((*rows[:-1], names.view(np.int64)))
        yield emit(parts)


def split_nodes(step: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Nodes of the next level: blocks of ``step`` distances that the given ranges touch."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            parts = []
            for row, packed, nodes in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                data = text_bytes(packed)
                spans, most = Spans(data), len(data) - LENGTH
                given = np.array([(n["at"], n["low"], n["high"]) for n in nodes], np.int64)
                given = np.unique(given, axis=0)
                at, low, high = given.T
                begin = low // step
                counts = high // step - begin + 1
                own = np.repeat(np.arange(len(at)), counts)
                block = begin[own] + np.arange(len(own)) - np.repeat(np.cumsum(counts) - counts, counts)
                at, low = at[own], block * step
                high = low + step - 1
                some = (at - low >= 0) & (at - high <= most)
                at, low, high = np.unique(np.stack([at[some], low[some], high[some]]), axis=1)
                parts.append(node_rows(spans, row, at, low, high, len(data)))
            yield emit(parts)

    return work


def settle(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Spans (row, start, end) known to repeat, and the nodes to be split."""
    groups = nodes.groupBy("full", "more").agg(
        F.count("*").alias("n"), F.max("known").alias("known"), F.min("core").alias("core"),
        F.min(F.struct("row", "at", "low", "high")).alias("one"),
    )
    groups = keep(groups, "groups")
    again = groups.filter("n > 1").select("full", "more")
    spans = nodes.join(again, ["full", "more"], "left_semi").select(
        "row", (F.col("at") - F.col("high")).alias("start"), (F.col("at") - F.col("low") + LENGTH).alias("end")
    )
    settled = F.col("known") | (F.col("n") > 1)
    cores = groups.groupBy("core").agg(F.count("*").alias("groups"), F.min(settled).alias("all_settled"))
    # a single suffix is its own core, so no group of it has company and none is split further
    unclear = cores.filter((F.col("groups") > 1) & ~F.col("all_settled")).select("core")
    further = groups.join(unclear, "core", "left_semi").select("one.*", settled.alias("known"))
    return spans, further


def next_level(texts: DataFrame, open_nodes: DataFrame, step: int) -> DataFrame:
    """Nodes of the next level; ``known`` says that the node they come from repeats."""
    lists = open_nodes.groupBy("row").agg(F.collect_list(F.struct("at", "low", "high")).alias("nodes"))
    nodes = texts.join(lists, "row").select("row", "packed", "nodes").mapInArrow(split_nodes(step), NODES)
    return nodes.withColumn("known", F.lit(False))


def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        texts = [squeeze((t or "").encode()) for t in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.binary())], ["row", "doc_id", "packed"])


def cleaned(with_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for packed, spans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                data = text_bytes(packed)
                gone = np.zeros(len(data) + 1, np.int32)
                if spans:
                    found = np.array([(s["start"], s["end"]) for s in spans], np.int64)
                    np.add.at(gone, found[:, 0], 1)
                    np.add.at(gone, found[:, 1], -1)
                removed = np.cumsum(gone)[:-1] > 0
                runs = int(removed[0]) + int((removed[1:] & ~removed[:-1]).sum()) if len(data) else 0
                left = data[~removed].tobytes()
                row = (len(data), int(removed.sum()), runs, hashlib.sha256(left).hexdigest())
                rows.append((*row, left) if with_text else row)
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text
            types = [pa.int64()] * 3 + [pa.string()] + [pa.binary()] * with_text
            data = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            arrays = [b.column(0)] + [pa.array(c, t) for c, t in zip(data, types, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *names])

    return work


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    ``with_text`` adds ``kept``, the bytes that are left.
    """
    rows = columns(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), F.col("text").cast("string")
    )
    packed = rows.mapInArrow(pack_texts, "row long, doc_id long, packed binary")
    texts = keep_bucketed(packed, "texts", "row", partitions(docs.sparkSession))

    every = keep(texts.select("row", "packed").mapInArrow(sample_nodes, NODES), "nodes")
    names = every.groupBy("core").agg(F.count("*").alias("n")).filter("n > 1").select("core")
    nodes = keep(every.join(names, "core", "left_semi").withColumn("known", F.lit(False)), "nodes")
    discard(every)
    found, further = settle(nodes)
    spans = [found]
    for step in (BLOCK, 1):
        nodes = keep(next_level(texts, further, step), "nodes")
        found, further = settle(nodes)
        spans.append(found)
    repeats = spans[0].unionByName(spans[1]).unionByName(spans[2])
    lists = repeats.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    result = texts.join(lists, "row", "left").select("doc_id", "packed", "spans")
    out = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text
    return result.mapInArrow(cleaned(with_text), out)

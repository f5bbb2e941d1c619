"""Likelihood of texts under a unigram model of subword pieces, summed over all segmentations.

The pieces are those of an existing vocabulary. A text is drawn piece by piece, each by its own
probability, until an end piece; what it is worth is the sum over all ways to cut its words
into pieces, by a forward recursion in log space. Pieces don't cross words (the first piece of
a word carries the vocabulary's word mark), so this sum is a product over words, and the
recursion runs once per distinct word. Characters outside the vocabulary are spelt in its byte
pieces, so no text is impossible.

The vocabulary's own scores are ranks of a merge order; they give first weights by Zipf's law,
1 / (rank + 2.7), and ``ROUNDS`` passes of expected counts (forward and backward recursion over
the word counts of all training documents) turn them into probabilities. The vocabulary itself
stays as it is.

Word counts cover the whole corpus. Words with at least a hundred-thousandth of all tokens,
which can be no more than ``FREQUENT`` = 100,000, are looked up in a table sent to all tasks;
all other words are joined by hash, one row per word and batch of documents, so no word has a
large share of that join.

Rules for odd rows: a null text is empty and has the end token alone; a null doc_id counts as
the text "" and so as training; rows are scored one by one, so repeated rows are fine; without
training documents all pieces keep their first weights; an empty table gives no rows; other
columns are ignored. Words may have any length.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lifeloom.llm.tables import columns, keep
from lifeloom.llm.words import U, constants, mixed, word_hashes

FREQUENT = 100_000
ROUNDS = 2
#: Added to each piece's expected count.
PRIOR = 0.1
FOLDS, HELD_OUT = 5, 1
#: Cells (words by positions) of one step of the recursion.
CELLS = 200_000
#: Distinct words that a counting task holds before it hands them on.
HELD_WORDS = 500_000
_BASE = constants(1, 41)[0]
_SLOTS = 1 << 21


class Pieces:
    """The vocabulary as a hash table over strings of code points."""

    def __init__(self, path: str | None = None) -> None:
        import public_tokenizers
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(
            model_file=path or public_tokenizers.path("piece_bpe_32k.model")
        )
        strings: list[str] = []
        rank: list[int] = []
        self.byte_piece = np.zeros(256, np.int64)
        for i in range(model.get_piece_size()):
            if model.is_control(i) or model.is_unknown(i):
                continue
            if model.is_byte(i):
                self.byte_piece[int(model.id_to_piece(i)[3:5], 16)] = len(rank)
                strings.append("")
                rank.append(model.get_piece_size())
            else:
                strings.append(model.id_to_piece(i))
                rank.append(int(-model.get_score(i)))
        self.count = len(rank)
        weights = 1 / (np.array(rank) + 2.7)
        self.first = np.log(weights / weights.sum())
        self.longest = max(map(len, strings))
        names = np.array([self.name(np.array([*map(ord, s)], U)) if s else 0 for s in strings], U)
        self.slot_name = np.zeros(_SLOTS, U)
        self.slot_piece = np.full(_SLOTS, -1, np.int32)
        self.probes = 1
        for piece, name in enumerate(names):
            if name:
                at, steps = int(name) & (_SLOTS - 1), 1
                while self.slot_piece[at] >= 0:
                    at, steps = (at + 1) & (_SLOTS - 1), steps + 1
                self.slot_name[at], self.slot_piece[at] = name, piece
                self.probes = max(self.probes, steps)

    @staticmethod
    def name(points: np.ndarray) -> np.uint64:
        total = np.zeros(1, U)
        for p in points:
            total = total * _BASE + p + U(1)
        return mixed(total + U(len(points)))[0]

    def find(self, names: np.ndarray) -> np.ndarray:
        """The piece with each name, or -1."""
        at = (names & U(_SLOTS - 1)).astype(np.int64)
        out = np.where(self.slot_name[at] == names, self.slot_piece[at], -1)
        for step in range(1, self.probes):
            near = (at + step) & (_SLOTS - 1)
            out = np.where((out < 0) & (self.slot_name[near] == names), self.slot_piece[near], out)
        return out


_pieces: dict[str | None, Pieces] = {}


def pieces(path: str | None) -> Pieces:
    if path not in _pieces:
        _pieces[path] = Pieces(path)
    return _pieces[path]


MARK = "▁"


def groups(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of like lengths: their numbers, lengths, and code points in a matrix, word mark first."""
    points = [MARK + w.decode("utf-8", "replace") for w in words]
    lengths = np.array([len(p) for p in points], np.int64)
    order = np.argsort(lengths, kind="stable")
    at = 0
    while at < len(order):
        shortest = lengths[order[at]]
        rows = max(1, int(CELLS // (shortest + shortest // 4 + 1)))
        to = min(len(order), at + rows)
        to = min(to, at + max(1, int(np.searchsorted(lengths[order[at:to]], shortest + shortest // 4, "right"))))
        own = order[at:to]
        width = int(lengths[own[-1]])
        text = "".join(points[i].ljust(width, "\0") for i in own)
        cells = np.frombuffer(text.encode("utf-32-le"), np.uint32).reshape(len(own), width)
        yield own, lengths[own], cells
        at = to


class Lattice:
    """The forward recursion for words of like lengths, all at once."""

    def __init__(self, vocabulary: Pieces, weights: np.ndarray, lengths: np.ndarray, cells: np.ndarray) -> None:
        self.vocabulary, self.weights, self.lengths = vocabulary, np.append(weights, -np.inf), lengths
        n, width = cells.shape
        self.width = width
        sums = np.zeros((width + 1, n), U)
        for j in range(width):
            sums[j + 1] = sums[j] * _BASE + cells[:, j].astype(U) + U(1)
        power = np.multiply.accumulate(np.append(np.ones(1, U), np.full(vocabulary.longest, _BASE)))
        self.spelt = self.spelling(cells.T, self.weights)
        self.edges: dict[tuple[int, int], np.ndarray] = {}
        forward = np.full((width + 1, n), -np.inf)
        forward[0] = 0
        for j in range(1, width + 1):
            found = [forward[j - 1] + self.spelt[j - 1]]
            for size in range(1, min(j, vocabulary.longest) + 1):
                i = j - size
                piece = vocabulary.find(mixed(sums[j] - sums[i] * power[size] + U(size)))
                if (piece >= 0).any():
                    self.edges[i, j] = piece
                    found.append(forward[i] + self.weights[piece])
            stack = np.stack(found)
            top = stack.max(axis=0)
            with np.errstate(invalid="ignore"):
                forward[j] = np.where(np.isfinite(top), top + np.log(np.exp(stack - top).sum(axis=0)), -np.inf)
        self.forward = forward
        self.total = forward[lengths, np.arange(n)]

    def spelling(self, cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Log probability of each character in byte pieces."""
        out = np.zeros(cells.shape)
        for piece, use in self.byte_use(cells):
            out += np.where(use, weights[piece], 0)
        return out

    def byte_use(self, cells: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Byte pieces of the UTF-8 form of each character, one byte after the other."""
        c = cells.astype(np.int64)
        size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        lead = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size]
        for k in range(4):
            after = size - 1 - k
            byte = (c >> (6 * np.maximum(after, 0))) & 0xFF
            byte = np.where(k == 0, np.where(size == 1, c & 0x7F, lead | byte & (0xFF >> size)), 0x80 | byte & 0x3F)
            yield self.vocabulary.byte_piece[byte & 0xFF], after >= 0

    def expected(self, counts: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, words weighted by their counts."""
        n = len(self.lengths)
        backward = np.full((self.width + 1, n), -np.inf)
        backward[self.lengths, np.arange(n)] = 0
        out = np.zeros(self.vocabulary.count)
        by_end: dict[int, list[tuple[int, np.ndarray]]] = {}
        for (i, j), piece in self.edges.items():
            by_end.setdefault(i, []).append((j, piece))
        spelt = np.zeros((self.width, n))
        with np.errstate(invalid="ignore"):
            for i in range(self.width - 1, -1, -1):
                paths = [backward[i + 1] + self.spelt[i]]
                spelt[i] = np.exp(self.forward[i] + paths[0] - self.total) * counts
                for j, piece in by_end.get(i, ()):
                    paths.append(backward[j] + self.weights[piece])
                    use = np.exp(self.forward[i] + paths[-1] - self.total) * counts
                    have = (piece >= 0) & (use > 0)
                    out += np.bincount(piece[have], use[have], minlength=len(out))
                stack = np.stack([backward[i], *paths])
                top = stack.max(axis=0)
                backward[i] = np.where(np.isfinite(top), top + np.log(np.exp(stack - top).sum(axis=0)), -np.inf)
        spelt = np.nan_to_num(spelt)
        for piece, use in self.byte_use(cells.T):
            have = use & (spelt > 0)
            out += np.bincount(piece[have], spelt[have], minlength=len(out))
        return out


def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, uses in training documents, uses in all) of one task, handed on in bounded parts."""
    held: tuple[Counter, Counter] = Counter(), Counter()

    def batch() -> pa.RecordBatch:
        words = list(held[0].keys() | held[1].keys())
        train = [held[0][w] for w in words]
        every = [t + held[1][w] for w, t in zip(words, train, strict=True)]
        cols = [pa.array(words, pa.binary()), pa.array(train, pa.int64()), pa.array(every, pa.int64())]
        for c in held:
            c.clear()
        return pa.RecordBatch.from_arrays(cols, ["word", "train", "every"])

    for b in batches:
        for out, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            held[out].update((text or "").encode().lower().split())
            if len(held[0]) + len(held[1]) > HELD_WORDS:
                yield batch()
    yield batch()


def piece_counts(path: str | None, weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        total = np.zeros(vocabulary.count)
        for b in batches:
            counts = b.column(1).to_numpy().astype(float)
            for own, lengths, cells in groups(b.column(0).to_pylist()):
                total += Lattice(vocabulary, weights, lengths, cells).expected(counts[own], cells)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["piece", "uses"])

    return work


def word_scores(path: str | None, weights: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(hash, uses in training, uses in all, log10 of the word's probability)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(path)
        for b in batches:
            words = b.column(0).to_pylist()
            score = np.zeros(len(words))
            for own, lengths, cells in groups(words):
                score[own] = Lattice(vocabulary, weights, lengths, cells).total / np.log(10)
            hashes, _ = word_hashes(b.column(0))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.view(np.int64)), b.column(1), b.column(2), pa.array(score)],
                ["hash", "train", "every", "lattice"],
            )

    return work


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, known long, log_counts double, lattice double, "
    "hash long, rows array<int>"
)


def score_batches(frequent: tuple) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Sums over the frequent words of each document, and the places of all other words.

    For these, a row has a word's hash, the number of the first document of the batch, and the
    documents that have it, counted from there.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, logs, known, lattice = frequent.value
        fields = [f.split() for f in SCORED.split(", ")]
        kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "array<int>": pa.list_(pa.int32())}
        for whole in batches:
            for b in (whole.slice(i, 4000) for i in range(0, whole.num_rows, 4000)):
                words, first = word_hashes(b.column(3))
                size = b.num_rows
                own = np.repeat(np.arange(size), np.diff(first))
                at = np.searchsorted(names, words)
                at[at == len(names)] = 0
                hit = names[at] == words if len(names) else np.zeros(len(words), bool)
                doc, at = own[hit], at[hit]
                sums = [np.bincount(doc, x[at], size) if len(at) else np.zeros(size) for x in (known, logs, lattice)]
                none = pa.nulls(size)
                done = [
                    b.column(0), b.column(1), b.column(2), pa.array(np.diff(first) + 1),
                    pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2]), none, none,
                ]
                done = [c.cast(kinds[k]) for c, (_, k) in zip(done, fields, strict=True)]
                yield pa.RecordBatch.from_arrays(done, [n for n, _ in fields])
                rest, doc = words[~hit], own[~hit]
                if not len(rest):
                    continue
                order = np.argsort(rest, kind="stable")
                rest, doc = rest[order], doc[order]
                begin = np.flatnonzero(np.append(True, rest[1:] != rest[:-1]))
                places = pa.ListArray.from_arrays(
                    pa.array(np.append(begin, len(rest)).astype(np.int32)), pa.array(doc.astype(np.int32))
                )
                base = np.full(len(begin), b.column(0)[0].as_py())
                cols = [pa.nulls(len(begin), kinds[k]) for _, k in fields]
                cols[0], cols[7], cols[8] = pa.array(base), pa.array(rest[begin].view(np.int64)), places
                yield pa.RecordBatch.from_arrays(cols, [n for n, _ in fields])

    return work


def lattice_scores(docs: DataFrame, vocabulary: str | None = None, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS
    rows = columns(docs, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        (fold == HELD_OUT).alias("held_out"),
        F.col("text").cast("string"),
    )
    counted = rows.select(F.col("held_out").cast("int"), "text").mapInArrow(count_words, "word binary, train long, every long")
    words = keep(counted.groupBy("word").agg(F.sum("train").alias("train"), F.sum("every").alias("every")), "words")
    ends = rows.filter(~F.col("held_out")).count()
    sums = words.agg(F.sum("train"), F.sum("every"), F.count_if(F.col("train") > 0)).first()
    train_tokens, distinct = (sums[0] or 0) + ends, (sums[2] or 0) + (ends > 0)

    known = pieces(vocabulary)
    weights, end = known.first, float(np.log(0.01))
    weights = weights + np.log1p(-np.exp(end))
    train = words.filter("train > 0").select("word", "train")
    for _ in range(rounds if train_tokens else 0):
        uses = train.mapInArrow(piece_counts(vocabulary, weights), "piece long, uses double")
        total = np.full(known.count, PRIOR)
        for r in uses.groupBy("piece").agg(F.sum("uses").alias("uses")).collect():  # one row per piece
            total[r["piece"]] += r["uses"]
        everything = total.sum() + ends + PRIOR
        weights, end = np.log(total / everything), float(np.log((ends + PRIOR) / everything))

    scored = words.mapInArrow(word_scores(vocabulary, weights), "hash long, train long, every long, lattice double")
    scored = keep(scored, "word_scores")
    often = scored.filter(F.col("every") * FREQUENT >= (sums[1] or 0)).toPandas()  # FREQUENT rows at most
    order = np.argsort(often["hash"].to_numpy(np.int64).view(U))
    often = often.iloc[order]
    uses = often["train"].to_numpy(np.int64)
    table = (
        often["hash"].to_numpy(np.int64).view(U), np.log10(uses + 0.5), (uses > 0).astype(float),
        often["lattice"].to_numpy(float),
    )
    sent = spark.sparkContext.broadcast(table)
    parts = keep(rows.mapInArrow(score_batches(sent), SCORED), "scored")

    rare = parts.filter("hash is not null").select("row", "hash", "rows")
    rare = rare.join(scored.select("hash", "train", F.col("lattice").alias("l")), "hash")
    each = rare.select(F.explode("rows").alias("i"), "row", "train", "l").select(
        (F.col("row") + F.col("i")).alias("row"),
        (F.col("train") > 0).cast("long").alias("k"),
        F.log10(F.col("train") + 0.5).alias("b"),
        "l",
    )
    rare = each.groupBy("row").agg(*(F.sum(c).alias(c) for c in ("k", "b", "l")))
    whole = parts.filter("hash is null").join(rare, "row", "left")
    least = float(np.log10(train_tokens + 0.5 * (distinct + 1)))
    zero = F.lit(0.0)
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("k", F.lit(0)) + int(ends > 0)).cast("long").alias("n_known"),
        F.lit(train_tokens).cast("long").alias("train_tokens"),
        (F.col("log_counts") + F.coalesce("b", zero) + float(np.log10(ends + 0.5)) - F.col("n_tokens") * least).alias("base_score"),
        (F.col("lattice") + F.coalesce("l", zero) + end / float(np.log(10))).alias("score"),
    )

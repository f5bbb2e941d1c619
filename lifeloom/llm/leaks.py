"""Benchmark decontamination: training passages as queries to a BM25 index of test items.

The index holds the words of every test item (long items in parts of ``HALF`` words, so that
every part fits into a passage), with BM25 impacts divided by the item's score for itself, so
one threshold fits all items: ``SCORE`` of what the item itself would get. Postings are cut at
fixed ranges of ``ITEMS_PER_BLOCK`` items, each term knowing its largest impact in each range.

Every passage of every document is a query: windows of two halves of ``HALF`` words, one half
on. As in block-max WAND, the largest impacts of its words in a range are summed first, and only
ranges whose sum reaches the threshold are scored; all items above the threshold are found,
since no item can exceed its range's sum. A hit is then verified on the whole document: at
least ``OVERLAP`` of the word triples of the item's question, and of its answer, must occur.

The index is sent to all tasks; its size is checked. Items beyond ``INDEX_BYTES`` of text go
through the documents in further passes, each with an index of its own.

Rules for odd rows: a null or blank document has no passages and no hits; null or blank items
are not indexed; items without columns question and answer are split at their last sentence,
or at two thirds of their words if they have only one; a part of fewer than three words is
matched as one run; repeated rows each give their hits; a null item_id stays null; an empty
table on either side gives no hits. Words are compared in lower case (of any script) without
closing punctuation.
"""

from __future__ import annotations

import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeloom.llm.tables import columns
from lifeloom.llm.words import window_hashes, word_hashes

HALF = 64
ITEMS_PER_BLOCK = 8
SCORE = 0.5
OVERLAP = 0.5
GRAM = 3
K1, B = 1.2, 0.75
INDEX_BYTES = 16 << 20
TERMS_AT_ONCE = 2_000_000
CLOSING = string.punctuation.encode()


def all_hashed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return word_hashes(pc.utf8_lower(texts), silent=CLOSING)


def hashed(text: str) -> np.ndarray:
    return all_hashed(pa.array([text], pa.string()))[0]


def grams(words: np.ndarray) -> np.ndarray:
    return np.unique(window_hashes(words, min(GRAM, len(words)), seed=70 + min(GRAM, len(words))))


def question_and_answer(text: str) -> tuple[str, str]:
    """A test item without parts of its own: its last sentence is the answer."""
    cut = [m.end() for m in re.finditer(r"[.?!]+\s+", text.strip())]
    if cut:
        return text[: cut[-1]], text[cut[-1] :]
    words = text.split()
    at = max(1, len(words) * 2 // 3)
    return " ".join(words[:at]), " ".join(words[at:]) or " ".join(words[:at])


def spread(begin: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places ``begin`` to ``begin + sizes`` of every run, and the run of each place."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) + (begin - np.cumsum(sizes) + sizes)[of], of


@dataclass
class Index:
    """Postings of up to a bounded number of test items, sorted by term and then entry."""

    terms: np.ndarray  # hashes, sorted
    begin: np.ndarray  # of each term in the postings, one more at the end
    entry: np.ndarray
    impact: np.ndarray
    most: np.ndarray  # largest impact of each term in each range of entries
    item_of: np.ndarray  # position in ``items`` of each entry
    items: list[int | None]
    parts: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)  # triples of question, answer

    def __post_init__(self) -> None:
        """Where the postings of each term in each range of entries begin."""
        term = np.repeat(np.arange(len(self.terms)), np.diff(self.begin))
        each = term * self.most.shape[1] + self.entry // ITEMS_PER_BLOCK
        first = np.flatnonzero(np.diff(each, prepend=-1))
        self.runs, self.run_begin = each[first], np.append(first, len(each))

    @staticmethod
    def build(rows: list[tuple[int | None, str, str, str]]) -> Index | None:
        entries, item_of, items, parts = [], [], [], []
        for name, text, question, answer in rows:
            words = hashed(text)
            if not len(words):
                continue
            item_of += [len(items)] * len(range(0, len(words), HALF))
            entries += [words[i : i + HALF] for i in range(0, len(words), HALF)]
            items.append(name)
            parts.append((grams(hashed(question)), grams(hashed(answer))))
        if not items:
            return None
        found = [np.unique(e, return_counts=True) for e in entries]
        term = np.concatenate([t for t, _ in found])
        count = np.concatenate([c for _, c in found]).astype(float)
        entry = np.repeat(np.arange(len(entries)), [len(t) for t, _ in found])
        length = np.array([len(e) for e in entries], float)
        terms, place, df = np.unique(term, return_inverse=True, return_counts=True)
        idf = np.log(1 + (len(entries) - df + 0.5) / (df + 0.5))
        impact = idf[place] * count * (K1 + 1) / (count + K1 * (1 - B + B * length[entry] / length.mean()))
        impact /= np.bincount(entry, impact)[entry]
        order = np.lexsort((entry, place))
        begin = np.searchsorted(place[order], np.arange(len(terms) + 1))
        most = np.zeros((len(terms), -(-len(entries) // ITEMS_PER_BLOCK)), np.float32)
        np.maximum.at(most, (place, entry // ITEMS_PER_BLOCK), impact)
        return Index(terms, begin, entry[order], impact[order], most, np.array(item_of), items, parts)

    def candidates(self, words: np.ndarray, first: np.ndarray) -> dict[int, dict[int, float]]:
        """For each text its items above the threshold, with their best scores."""
        at = np.searchsorted(self.terms, words)
        at[at == len(self.terms)] = 0
        known = np.flatnonzero(self.terms[at] == words)
        text = np.searchsorted(first, known, side="right") - 1
        half = (known - first[text]) // HALF
        # numbers of halves, with one left free after each text so that windows don't join texts
        halves = (first[1:] - first[:-1] + HALF - 1) // HALF + 1
        base = np.cumsum(halves) - halves
        where, term = base[text] + half, at[known]
        out: dict[int, dict[int, float]] = {}
        step = 200_000
        cuts = [0]
        while cuts[-1] < len(known):  # slices end between texts
            to = cuts[-1] + step
            to = len(known) if to >= len(known) else max(int(np.searchsorted(text, text[to])), cuts[-1] + 1)
            if to < len(known) and text[to - 1] == text[to]:
                to = int(np.searchsorted(text, text[to], side="right"))
            cuts.append(to)
        for a, z in zip(cuts, cuts[1:], strict=False):
            # a word counts once in each half
            pair = np.unique(where[a:z] * len(self.terms) + term[a:z])
            spot, own = pair // len(self.terms), pair % len(self.terms)
            begin = np.flatnonzero(np.diff(spot, prepend=-1))
            sums = np.add.reduceat(self.most[own], begin, axis=0)
            name = spot[begin]
            follows = np.append(name[1:] == name[:-1] + 1, False)
            bound = sums.copy()
            bound[follows] += sums[1:][follows[:-1]]
            window, block = np.nonzero(bound >= SCORE - 1e-6)
            if not len(window):
                continue
            ends = np.append(begin[1:], len(own))
            ends[follows] = ends[1:][follows[:-1]]
            doc = np.searchsorted(base, name, side="right") - 1
            for w, e, score in zip(*(x.tolist() for x in self.scored(own, begin, ends, window, block)), strict=True):
                mine = out.setdefault(int(doc[w]), {})
                item = int(self.item_of[e])
                mine[item] = max(mine.get(item, 0.0), score)
        return out

    def scored(
        self, own: np.ndarray, begin: np.ndarray, ends: np.ndarray, window: np.ndarray, block: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, entry, score) of the entries above the threshold in the live (window, block) pairs.

        Window w has the terms ``own[begin[w] : ends[w]]``; the pairs are sorted. About ``TERMS_AT_ONCE``
        terms of pairs are looked up at a time.
        """
        most = (ends - begin)[window].cumsum()
        found = []
        cuts = [0]
        while cuts[-1] < len(window):  # slices end between windows
            done = most[cuts[-1] - 1] if cuts[-1] else 0
            to = max(int(np.searchsorted(most, done + TERMS_AT_ONCE)), cuts[-1] + 1)
            cuts.append(int(np.searchsorted(window, window[to - 1], side="right")))
        for a, z in zip(cuts, cuts[1:], strict=False):
            live, place = np.unique(window[a:z], return_inverse=True)
            at, of = spread(begin[live], ends[live] - begin[live])
            pair = np.unique(of * len(self.terms) + own[at])  # both halves of a window may have a word
            of, term = pair // len(self.terms), pair % len(self.terms)
            start = np.searchsorted(of, np.arange(len(live) + 1))
            at, row = spread(start[place], start[place + 1] - start[place])
            term, range_of = term[at], block[a:z][row]
            has = np.flatnonzero(self.most[term, range_of] > 0)
            term, row = term[has], row[has]
            run = np.searchsorted(self.runs, term * self.most.shape[1] + range_of[has])
            at, of = spread(self.run_begin[run], self.run_begin[run + 1] - self.run_begin[run])
            spot = row[of] * ITEMS_PER_BLOCK + self.entry[at] % ITEMS_PER_BLOCK
            scores = np.bincount(spot, self.impact[at], (z - a) * ITEMS_PER_BLOCK)
            hit = np.flatnonzero(scores >= SCORE)
            row, e = hit // ITEMS_PER_BLOCK, hit % ITEMS_PER_BLOCK
            found.append((window[a:z][row], block[a:z][row] * ITEMS_PER_BLOCK + e, scores[hit]))
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))

    def hits(self, texts: pa.Array) -> list[list[tuple[int | None, float, float, float]]]:
        """For each text: (item_id, score, share of the question, share of the answer) of its hits."""
        words, first = all_hashed(texts)
        found: list[list[tuple]] = [[] for _ in range(len(texts))]
        for doc, items in self.candidates(words, first).items():
            own = words[first[doc] : first[doc + 1]]
            seen = {n: np.unique(window_hashes(own, n, seed=70 + n)) for n in range(1, GRAM + 1)}
            for item, score in sorted(items.items()):
                shares = [self.share(part, seen) for part in self.parts[item]]
                if min(shares) >= OVERLAP:
                    found[doc].append((self.items[item], score, *shares))
        return found

    @staticmethod
    def share(part: np.ndarray, seen: dict[int, np.ndarray]) -> float:
        if not len(part):
            return 1.0
        return max(float(np.isin(part, s).mean()) for s in seen.values())


def indexes(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of all test items, each of a bounded size."""
    parts = {"question", "answer"} <= set(benchmark.columns)
    names = ("question", "answer") if parts else ("text",)
    rows = columns(benchmark, "item_id", *names)
    rows = rows.select(F.col("item_id").cast("long"), *(F.coalesce(F.col(n).cast("string"), F.lit("")).alias(n) for n in names))
    size = rows.agg(F.sum(sum((F.octet_length(n) for n in names), F.lit(0)))).first()[0] or 0
    passes = int(size // INDEX_BYTES) + 1
    share = F.pmod(F.xxhash64(*rows.columns), F.lit(passes))
    for i in range(passes):
        given = rows.filter(share == i).collect() if passes > 1 else rows.collect()
        items = []
        for r in given:
            question, answer = (r["question"], r["answer"]) if parts else question_and_answer(r["text"])
            items.append((r["item_id"], f"{question} {answer}" if parts else r["text"], question, answer))
        built = Index.build(items)
        if built is not None:
            yield built


def finder(
    index: Index, docs: DataFrame, text: int
) -> Callable[[pa.RecordBatch], list[list[tuple[int | None, float, float, float]]]]:
    sent = docs.sparkSession.sparkContext.broadcast(index)

    def find(b: pa.RecordBatch) -> list[list[tuple]]:
        out: list[list[tuple]] = []
        column = b.column(text)
        for at in range(0, len(column), 1000):
            out += sent.value.hits(column.slice(at, 1000))
        return out

    return find


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, question_share, answer_share) of every verified hit."""
    rows = columns(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    schema = "doc_id long, item_id long, score double, question_share double, answer_share double"
    found = None
    for index in indexes(benchmark):
        find = finder(index, docs, 1)

        def work(batches: Iterator[pa.RecordBatch], find: Callable = find) -> Iterator[pa.RecordBatch]:
            kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
            names = ["doc_id", "item_id", "score", "question_share", "answer_share"]
            for b in batches:
                pairs = zip(b.column(0).to_pylist(), find(b), strict=True)
                hits = [(doc, *hit) for doc, own in pairs for hit in own]
                cols = list(zip(*hits, strict=True)) if hits else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)

        one = rows.mapInArrow(work, schema)
        found = one if found is None else found.unionByName(one)
    return docs.sparkSession.createDataFrame([], schema) if found is None else found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that have no verified hit, all columns as they are."""
    columns(docs, "doc_id", "text")
    at = docs.columns.index("text")
    for index in indexes(benchmark):
        find = finder(index, docs, at)

        def work(batches: Iterator[pa.RecordBatch], find: Callable = find) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array([not own for own in find(b)], pa.bool_()))

        docs = docs.withColumn("text", F.col("text").cast(T.StringType())).mapInArrow(work, docs.schema)
    return docs

"""The training-data operators against brute force, on small tables with odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lifeloom.llm import leaks as leaks_module
from lifeloom.llm import near, pii, repeats
from lifeloom.llm.components import connected
from lifeloom.llm.lattice import MARK, Pieces, lattice_scores
from lifeloom.llm.leaks import leaks, without_leaks
from lifeloom.llm.lines import dedup_lines, within_one_edit
from lifeloom.llm.near import near_duplicates
from lifeloom.llm.packing import pack, sequences
from lifeloom.llm.pii import detect, luhn, pseudonymise
from lifeloom.llm.preferences import as_turns, preference_pairs, tokenised
from lifeloom.llm.quality import quality
from lifeloom.llm.repeats import remove_repeats
from lifeloom.llm.sharding import curve_steps, hilbert_shards
from lifeloom.llm.tokens import TokenBytes

VOCABULARY = "the of and thin erble tion hand ost an wher re ion est heon blend ati".split()


def prose(rng, words):
    return " ".join(rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(words))


@pytest.fixture(scope="module")
def texts():
    """(doc_id, text) with copies, near copies, nulls, blanks, odd whitespace and other scripts."""
    rng = random.Random(5)
    rows = [(i, prose(rng, rng.randint(5, 160))) for i in range(40)]
    for i in range(12):
        words = rows[i][1].split()
        words[len(words) // 2] = "changed"
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, rows[i][1]) for i in range(6)]
    lines = [prose(rng, 12) for _ in range(8)]
    for i in range(12):
        own = [rng.choice(lines) for _ in range(5)]
        own[1] = " ".join(own[1].split()[:-1])
        rows.append((300 + i, "\n".join(own)))
    rows += [(400, None), (401, ""), (402, " \n\t "), (403, "word"), (404, "日本語 текст ñandú"), (405, "a" * 700)]
    rows += [(None, prose(rng, 60)), (7, rows[7][1]), (7, "another text under the same number")]
    return rows


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "x", 1, "en", "s", len(t or "")) for i, t in texts]
    return spark.createDataFrame(
        rows, "doc_id long, text string, shard string, row int, lang string, source string, n_chars long"
    ).repartition(3)


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.limit(0)


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return (text or "").encode().lower().decode()


# --- line dedup -----------------------------------------------------------------------------


def test_line_dedup_equals_a_scan(docs, texts):
    got = sorted((r.doc_id, r.text, r.n_lines, r.n_removed_lines) for r in dedup_lines(docs).collect() if r.doc_id not in (None, 7))
    earlier, want = [], []
    for i, t in sorted((x for x in texts if x[0] is not None), key=lambda x: x[0]):
        kept, n = [], 0
        for line in (t or "").split("\n"):
            words = lowered(line).split()
            again = words in earlier or any(
                min(len(words), len(e)) >= 8 and within_one_edit(" ".join(words), " ".join(e)) for e in earlier
            )
            n += bool(words)
            if words:
                earlier.append(words)
            if not words or not again:
                kept.append(line)
        if i != 7:
            total = sum(1 for x in (t or "").split("\n") if x.split())
            want.append((i, None if t is None else "\n".join(kept), n, total - sum(1 for x in kept if x.split())))
    assert [(a, b or "") for a, b, *_ in got] == [(a, b or "") for a, b, *_ in sorted(want, key=lambda x: x[0])]
    assert [x[2:] for x in got] == [x[2:] for x in sorted(want, key=lambda x: x[0])]


def test_line_dedup_of_doubled_words_equals_a_scan(spark):
    """Tables and stutters: the word that differs may stand anywhere in a run of equal words."""
    rng = random.Random(13)
    lines = ["0 0 0 0 0 0 0 0", "0 0 0 1 0 0 0 0", "a b b c d e f g h", "a b d c d e f g h", "a b b b c d e f g h"]
    for _ in range(120):
        base = prose(rng, 5).split() if rng.random() < 0.5 else ["0", "1", "2"]
        lines.append(" ".join(rng.choice(base) for _ in range(rng.randint(8, 12))))
        near_by = [w for w in lines[-1].split() for _ in range(1 + (rng.random() < 0.2))]
        near_by[rng.randrange(len(near_by))] = rng.choice(["x", *base])
        lines.append(" ".join(near_by))
    gone = [any(within_one_edit(b, a) for a in lines[:i]) for i, b in enumerate(lines)]
    df = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.n_removed_lines for r in dedup_lines(df).collect()}
    assert [got[i] for i in range(len(lines))] == [int(g) for g in gone]


def test_line_dedup_of_nothing_and_other_columns(docs, nothing):
    assert dedup_lines(nothing).count() == 0
    assert set(docs.columns) <= set(dedup_lines(docs).columns)


@pytest.mark.parametrize(
    ("a", "b", "close"),
    [("a b c", "a x c", True), ("a b c", "a c", True), ("a b", "a b x", True), ("A b", "a B", True),
     ("a b c", "c a b", False), ("a b c", "x y c", False), ("a b c", "a", False), ("", "a", True)],
)
def test_one_edit(a, b, close):
    assert within_one_edit(a, b) is close and within_one_edit(b, a) is close


# --- preferences ----------------------------------------------------------------------------


def test_common_prefix_and_masks(spark):
    turns = lambda *x: [{"role": r, "text": t} for r, t in x]
    start = [("user", "hi"), ("assistant", "hello")]
    rows = [
        (1, turns(*start, ("user", "q"), ("assistant", "good")), turns(*start, ("user", "q"), ("assistant", "bad <|end|>"))),
        (2, turns(*start), turns(*start)),
        (3, turns(*start), turns(start[0])),
        (4, turns(("user", "a")), turns(("user", "b"))),
        (5, None, turns(*start)),
    ]
    kind = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>"
    got = {r.pair_id: r for r in preference_pairs(spark.createDataFrame(rows, kind)).collect()}
    assert [got[i].prompt_turns for i in range(1, 6)] == [3, 2, 1, 0, 0]
    assert got[1].chosen == "<|assistant|>\ngood<|end|>\n" and got[2].chosen == got[2].rejected == ""
    for r in got.values():
        for text, spans in ((r.chosen, r.chosen_spans), (r.rejected, r.rejected_spans)):
            assert all(text[s.start : s.end].endswith("<|end|>\n") and "<|assistant|>\n" == text[s.start - 14 : s.start] for s in spans)
    ids = {r.pair_id: r for r in tokenised(preference_pairs(spark.createDataFrame(rows, kind))).collect()}
    assert all(len(r.chosen_ids) == len(r.chosen_mask) and len(r.rejected_ids) == len(r.rejected_mask) for r in ids.values())
    assert sum(ids[1].chosen_mask) > 0 and ids[1].chosen_mask[0] == 0


def test_nulls_and_marks_inside_turns(spark):
    kind = "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>, prompt int"
    user = {"role": "user", "text": "hi"}
    rows = [
        (1, [user, {"role": "assistant", "text": None}], [user, {"role": "assistant", "text": "b"}], 0),
        (2, [user, {"role": "assistant", "text": None}], [user, {"role": "assistant", "text": ""}], 0),
        (3, [{"role": None, "text": "x"}, None], [{"role": "", "text": "x"}, user], 0),
        (4, [{"role": "user", "text": "q<|end|>\n<|assistant|>\nz"}], [{"role": "user", "text": "q"}], 0),
        (5, [{"role": "user", "text": "y" * 300_000}], [], 0),
    ]
    got = {r.pair_id: r for r in preference_pairs(spark.createDataFrame(rows, kind)).collect()}
    assert [got[i].prompt_turns for i in range(1, 6)] == [1, 2, 1, 0, 0]
    assert got[1].chosen == "<|assistant|>\n<|end|>\n" and got[1].rejected == "<|assistant|>\nb<|end|>\n"
    assert got[3].prompt == "<||>\nx<|end|>\n" and got[3].chosen == "<||>\n<|end|>\n"
    assert got[4].chosen == "<|user|>\nq< |end|>\n< |assistant|>\nz<|end|>\n" and not got[4].chosen_spans
    assert len(got[5].chosen) > 300_000
    assert preference_pairs(spark.createDataFrame([], kind)).count() == 0
    assert as_turns(spark.createDataFrame([], "conv_id long, turn int, role string, text string")).count() == 0


def test_turns_are_put_in_order(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, None, None, None), (None, 0, "user", "<|x")]
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in as_turns(
        spark.createDataFrame(rows, "conv_id long, turn int, role string, text string")).collect()}
    assert got == {1: [("user", "a"), ("assistant", "b")], 2: [("", "")], None: [("user", "< |x")]}


def test_texts_are_unpacked_a_bounded_part_at_a_time():
    """Texts that compress well count by the size they have once unpacked."""
    import pyarrow as pa
    import zstandard

    from lifeloom.llm import lines

    text = "\n".join(["some line of words that all texts share"] * 6_000)  # 240 kB, packed below 1 kB
    packed = zstandard.ZstdCompressor(level=1).compress(text.encode())
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(40)), pa.array(range(40)), pa.array([packed] * 39 + [None], pa.binary())], ["doc", "row", "text"]
    )
    parts = list(lines.line_rows(True)(iter([batch])))
    assert sum(p.num_rows for p in parts) == 39 * 6_000 and max(p.num_rows for p in parts) <= 5 * 6_000
    assert sorted(set(parts[-1].column("doc").to_pylist()))[-1] == 38
    chosen = pa.array([[{"doc": 1, "line": 0}, {"doc": 1, "line": 5_999}]] * 39)
    batch = pa.RecordBatch.from_arrays([batch.column(0)[:39], batch.column(2)[:39], chosen], ["row", "packed", "chosen"])
    read = list(lines.texts_of_lines(iter([batch])))
    assert sum(p.num_rows for p in read) == 78 and len(read) >= 8


# --- quality --------------------------------------------------------------------------------


def test_surface_counts_equal_brute_force(spark, docs, texts):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)] + [(None, 1, 0), (31, None, 0)], "doc_id long, quality int, toxic int")
    extra = [(500, "a b c a b c x\nx\nx\n\n \n#$ a b c <|>"), (501, "# # # # #"), (502, "z " * 80)]
    more = spark.createDataFrame(extra, "doc_id long, text string")
    got = {(r.doc_id, r.text): r for r in quality(docs.unionByName(more, True), labels).collect()}
    for i, t in texts + extra:
        words = words_of(t)
        counts = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
        covered = {k + j for k in range(len(words) - 2) if counts[tuple(words[k : k + 3])] > 1 for j in range(3)}
        lines = [x for x in (t or "").split("\n") if words_of(x)]
        r = got[i, t]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(covered),
        )
        assert r.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words))
        assert not (r.kept and r.base_failed)


def test_ratio_parts_clean_text_from_junk(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 80)) for i in range(60)] + [(100 + i, prose(rng, 80).upper().replace(" ", "!! ")) for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first, again = (sorted(quality(df.repartition(n), labels).select("doc_id", "kept", "score").collect()) for n in (1, 5))
    assert first == again  # whole numbers add up alike in any order
    assert [r for r in first if r.kept != (r.doc_id < 100)] == []
    assert quality(df.limit(0), labels).count() == 0 and quality(df, labels.limit(0)).count() == len(rows)


def test_few_insults_and_one_bad_passage_are_rejected(spark):
    """Diluted so far that the mean over the text does not show them."""
    rng = random.Random(12)
    rows, labels = [], []
    for i in range(600):
        words = prose(rng, 300).split()
        kind = ("clean", "toxic", "junk")[i % 3]
        if kind == "toxic":
            for _ in range(2):
                words[rng.randrange(300)] = rng.choice(["scoundrel", "dimwit"])
        if kind == "junk":
            words[-20:] = [f"{w}%%%" for w in words[-20:]]
        rows.append((i, " ".join(words), kind))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = quality(spark.createDataFrame(rows, "doc_id long, text string, kind string"), labels).collect()
    kept = Counter(r.kind for r in got if r.kept)
    assert kept["toxic"] == kept["junk"] == 0 and kept["clean"] >= 190, kept


def test_all_labels_count(spark):
    from lifeloom.llm.quality import held_ids, trusted_ids

    labels = spark.range(120_000).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    trusted, held = trusted_ids(labels).count(), held_ids(labels).count()
    assert trusted + held == 120_000 and held > 20_000


def test_texts_are_not_shuffled_to_labels(spark):
    """Marks are bits of neighbouring ids, small enough to broadcast where a list of ids is not."""
    from lifeloom.llm.quality import trusted_ids, with_marks

    n = 150_000
    ids = spark.range(-n // 2, n // 2).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("k"))
    labels = ids.select("doc_id", F.when(F.col("k") == 0, 0).otherwise(1).alias("quality"), F.lit(0).alias("toxic"))
    docs = ids.select("doc_id", F.lit("a text").alias("text")).unionByName(
        spark.createDataFrame([(None, "no id"), (n, "no label"), (-n, "nor here")], "doc_id long, text string")
    )
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "128k")
    try:
        marked = with_marks(docs, trusted_ids(labels), "trusted")
        plan = marked._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
        got = {r.doc_id for r in marked.filter("trusted").collect()}
        assert got == {r.doc_id for r in trusted_ids(labels).collect()} and marked.count() == n + 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_marks_of_any_type_of_id(spark):
    from lifeloom.llm.quality import held_ids, with_marks

    rows = [(str(i), i % 2, i % 5 == 0) for i in range(400)]
    labels = spark.createDataFrame([(i, q, int(t)) for i, q, t in rows], "doc_id string, quality int, toxic int")
    docs = spark.createDataFrame([(i, "text") for i, *_ in rows] + [(None, "text")], "doc_id string, text string")
    held = {r.doc_id: (r._junk, r._toxic) for r in held_ids(labels).collect()}
    got = with_marks(docs, held_ids(labels), "_junk", "_toxic", how="inner").collect()
    assert {r.doc_id: (r._junk, r._toxic) for r in got} == held and len(got) == len(held) > 40
    whole = labels.withColumn("doc_id", F.col("doc_id").cast("int") - 200)
    held = {r.doc_id: (r._junk, r._toxic) for r in held_ids(whole).collect()}
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long") - 200)
    got = with_marks(docs, held_ids(whole), "_junk", "_toxic", how="inner").collect()
    assert {r.doc_id: (r._junk, r._toxic) for r in got} == held and len(got) == len(held) > 40


def test_plans_do_not_spell_out_weights(spark, docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    assert len(quality(docs, labels)._jdf.queryExecution().toString()) < 200_000


def test_thresholds_move_from_the_prior_to_the_labels():
    """One rule: without labels the prior stands, few labels hardly move it, many decide."""
    from lifeloom.llm.quality import BELIEF, best_cut

    assert best_cut({}, {}, -30) == -30 and best_cut({}, {}, -4000) == -4000
    good, bad = {100: 1}, {0: 1}  # one of each, apart at 1 to 100
    assert best_cut(good, bad, -30) == -30 and best_cut(good, bad, -4000) == -4000
    for n in (2, 4, 19, 20, 21, 60, 200):  # from some number on the labels win, and then for good
        cuts = [best_cut({100: k}, {0: k}, -4000) for k in (n, n + 1, 2 * n)]
        assert cuts == sorted(cuts) and set(cuts) <= {-4000, 50}
    assert best_cut({100: 20 * BELIEF}, {0: 20 * BELIEF}, -4000) == 50
    assert best_cut({0: 200}, {0: 200}, -30) == -30  # labels that tell nothing apart


# --- lattice --------------------------------------------------------------------------------


def every_segmentation(text, known, weights, vocabulary):
    """Log probability of a word by plain recursion."""
    best = [-math.inf] * (len(text) + 1)
    best[0] = 0.0
    for j in range(1, len(text) + 1):
        found = [best[j - 1] + sum(weights[vocabulary.byte_piece[b]] for b in text[j - 1].encode())]
        found += [best[i] + weights[known[text[i:j]]] for i in range(j) if text[i:j] in known]
        top = max(found)
        best[j] = top + math.log(sum(math.exp(x - top) for x in found))
    return best[-1]


def test_lattice_sums_over_all_segmentations():
    import public_tokenizers
    import sentencepiece

    from lifeloom.llm.lattice import Lattice, groups

    vocabulary = Pieces()
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    plain = [i for i in range(model.get_piece_size()) if not model.is_control(i) and not model.is_unknown(i)]
    known = {model.id_to_piece(i): k for k, i in enumerate(plain) if not model.is_byte(i)}
    words = ["the", "thinerble", "日本語", "ñandú", "x" * 60, "é", "zqxj😀"]
    for own, lengths, cells in groups([w.encode() for w in words]):
        lattice = Lattice(vocabulary, vocabulary.first, lengths, cells)
        for k, i in enumerate(own):
            assert lattice.total[k] == pytest.approx(every_segmentation(MARK + words[i], known, vocabulary.first, vocabulary))
        # expected uses of pieces spell each word once: characters add up
        uses = lattice.expected(np.ones(len(own)), cells)
        sizes = np.zeros(vocabulary.count)
        for piece, k in known.items():
            sizes[k] = len(piece)
        spelt = sum(uses[vocabulary.byte_piece[b]] for b in range(256))
        assert uses @ sizes <= lengths.sum() + 1e-6 <= uses @ sizes + spelt + 1e-5


def test_base_scores_equal_brute_force(docs, texts, nothing):
    got = defaultdict(list)
    for r in lattice_scores(docs, rounds=1).collect():
        got[r.doc_id].append(r)
    held = {i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1 for i, _ in texts}
    tokens = [(i, [*lowered(t).split(), "\n"]) for i, t in texts]
    counts = Counter(w for i, ws in tokens for w in ws if not held[i])
    total, kinds = sum(counts.values()), len(counts)
    for i, ws in tokens:
        base = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in ws)
        match = [r for r in got[i] if r.n_tokens == len(ws) and r.base_score == pytest.approx(base)]
        assert match and match[0].n_known == sum(counts[w] > 0 for w in ws)
        assert match[0].held_out == held[i] and match[0].train_tokens == total and match[0].score < 0
    assert lattice_scores(nothing).count() == 0


# --- sharding -------------------------------------------------------------------------------


@pytest.mark.parametrize("n", [2, 3])
def test_curve_visits_neighbours(n):
    bits, size, steps = 3, 1 << n, curve_steps(n)
    seen = {}
    for cell in range(1 << (n * bits)):
        point = [(cell >> (bits * k)) & 7 for k in range(n)]
        state = index = 0
        for i in reversed(range(bits)):
            found = steps[state * size + sum(((p >> i) & 1) << k for k, p in enumerate(point))]
            state, index = found // size, index * size + found % size
        seen[index] = point
    path = [seen[i] for i in range(1 << (n * bits))]
    assert all(sum(abs(x - y) for x, y in zip(a, b, strict=True)) == 1 for a, b in zip(path, path[1:], strict=False))


def test_shards_are_even_and_gapless(docs, texts, nothing):
    rows = hilbert_shards(docs, splits=8).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.shard].append(r.slot)
    assert len(rows) == len(texts) and set(by) <= set(range(16))
    assert max(map(len, by.values())) - min(len(by[s]) for s in range(16)) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    want = sorted((len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in texts)
    assert sorted((r.size, r.text_crc32) for r in rows) == want
    assert hilbert_shards(nothing).count() == 0


# --- near duplicates ------------------------------------------------------------------------


def brute_components(texts):
    sets = []
    for _, t in texts:
        w = lowered(t).split()
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= 75 * (len(sets[i]) + len(sets[j]) - common):
                parent[top(i)] = top(j)
    groups = defaultdict(list)
    for i in range(len(sets)):
        groups[top(i)].append(i)
    return sets, groups


def test_components_equal_brute_force(spark, docs, texts, nothing):
    """All rows, those without an id or with one that others have too; a null id may be all that links two others."""
    chain = "one two three four five six seven eight nine ten".split() * 6
    near_by = []
    for at, i in enumerate((7001, None, 7003)):
        words = [f"{w}{k}" for k, w in enumerate(chain)]
        for j in range(at):
            words[20 * j + 5] = "x"
        near_by.append((i, " ".join(words)))
    texts = texts + near_by
    more = spark.createDataFrame(near_by, "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_duplicates(docs.unionByName(more, True)).collect())
    sets, groups = brute_components(texts)
    want = Counter()
    for members in groups.values():
        least = min((texts[i][0] for i in members if texts[i][0] is not None), default=None)
        for i in members:
            want[texts[i][0], len(sets[i]), least if sets[i] else texts[i][0]] += 1
    assert got == want
    assert near_duplicates(nothing).count() == 0


def test_chain_of_near_copies_in_blocks(spark, monkeypatch):
    """A long chain, each a copy of the one before, with blocks and refinement at their smallest."""
    monkeypatch.setattr(near, "FINE", 6)
    monkeypatch.setattr(near, "BLOCK", 3)
    rng = random.Random(2)
    words = prose(rng, 120).split()
    rows = []
    for i in range(40):
        words[(7 * i) % 120] = f"w{i}"
        rows.append((rng.randint(0, 10**6) if i else 5, " ".join(words)))
    common = prose(rng, 60)
    rows += [(2_000_000 + i, f"{common} {prose(rng, 60)}") for i in range(30)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_duplicates(df).collect()}
    _, groups = brute_components(rows)
    for members in groups.values():
        names = [rows[i][0] for i in members]
        assert {got[n] for n in names} == {min(names)}


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 105), (105, 103)] + [(200 + i, 200) for i in range(1, 30)]
    got = {r.node: r.component for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {i: 100 for i in (100, 103, 105)} | {200 + i: 200 for i in range(30)}


# --- surrogates -----------------------------------------------------------------------------

LETTER = (
    'Mr. Stone wrote to Mrs. Anna Stone and to JOHN Q. at ann.lee+1@mail.example.com, card 4111 1111 1111 1111, '
    'phone +1 (212) 555-0100, host 10.0.0.7, token = "0a1b2c3d4e5f60718293". Peter Stone paid 4111-1111-1111-1111.'
)


def test_surrogates_keep_type_format_and_identity(spark):
    rows = [(1, LETTER), (2, f"Again: ann.lee+1@mail.example.com and 10.0.0.7. {LETTER}"), (3, "No data at all."), (4, None), (5, ""), (1, LETTER)]
    got = [(r.doc_id, r.text, r.n_replaced) for r in pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    by = defaultdict(list)
    for i, t, n in got:
        by[i].append((t, n))
    assert by[3] == [("No data at all.", 0)] and by[4] == [(None, 0)] and by[5] == [("", 0)]
    text = by[1][0][0]
    assert by[1][0] == by[1][1] and by[2][0][0].endswith(text)
    for old in ("Stone", "ann.lee", "4111", "555-0100", "10.0.0.7", "0a1b2c3d"):
        assert old not in text
    cards = re.findall(r"\b\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{4}\b", text)
    assert len({re.sub(r"\D", "", c) for c in cards}) == 1 and luhn(re.sub(r"\D", "", cards[0])) == 0
    surnames = re.findall(r"Mr\. (\S+)|Mrs\. \S+ (\S+)", text)
    assert surnames[0][0] == surnames[1][1]
    given = re.search(r"Mrs\. (\S+) ", text).group(1)
    assert set(given.split("-")) <= set(pii.GIVEN["LATIN", "f"])
    assert re.search(r"phone \+\d \(\d{3}\) \d{3}-\d{4},", text) and re.search(r'token = "[0-9a-f]{20}"', text)


def test_no_two_entities_share_a_surrogate(spark):
    rows = [(i, f"Mr. Person{chr(97 + i // 26)}{chr(97 + i % 26)} was here.") for i in range(200)]
    new = [r.text for r in pseudonymise(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert len(set(new)) == 200 and not any("Person" in t for t in new)


def test_other_key_other_surrogates(spark):
    df = spark.createDataFrame([(1, LETTER)], "doc_id long, text string")
    assert pseudonymise(df, b"a").first().text != pseudonymise(df, b"b").first().text
    assert pseudonymise(df.limit(0)).count() == 0


def test_scripts_and_plain_text():
    kinds = [k for _, _, k, _ in detect("Госпожа Иванова и Κύριος Παππάς")]
    assert kinds == ["surname:CYRILLIC", "surname:GREEK"]
    assert detect("Version 1.2.3 of 2024-01-02, 12 items, 'quoted text here', don't.") == []


AKIA = "AKIA" + "ABCDEFGH12345678"
BODY = "MIIEpAIBAAKCAQEA7bq3\nx9Zk2LmQ8v+T/4=="


@pytest.mark.parametrize(
    ("text", "found", "kind"),
    [("call (743) 555-3824.", "(743) 555-3824", "phone"), ("call 743-555-3824 now", "743-555-3824", "phone"),
     ("Tel. 030 1234567", "030 1234567", "phone"), ("au 01 23 45 67 89.", "01 23 45 67 89", "phone"),
     ("api_key=abcdefghijklmnopqrst", "abcdefghijklmnopqrst", "secret"), ("password: hunter2hunter2", "hunter2hunter2", "secret"),
     ("Authorization: Bearer abc.def1.ghi234567890", "abc.def1.ghi234567890", "secret"), (f"id {AKIA} end", AKIA[4:], "secret"),
     ("ghp_" + "a1B2" * 9, "a1B2" * 9, "secret"),
     (f"-----BEGIN RSA PRIVATE KEY-----\n{BODY}\n-----END RSA PRIVATE KEY-----", f"\n{BODY}\n", "secret"),
     ("host 2001:db8::8a2e:370:7334 up", "2001:db8::8a2e:370:7334", "ipv6"), ("at fe80::1", "fe80::1", "ipv6"),
     ("IBAN DE89 3704 0044 0532 0130 00 OK", "DE89 3704 0044 0532 0130 00", "iban"), ("GB82WEST12345698765432", "GB82WEST12345698765432", "iban")],
)
def test_further_forms_are_replaced(text, found, kind):
    (start, end, got, canon), = detect(text)
    assert (text[start:end], got) == (found, kind)
    new = pii.poured(found, kind, pii.surrogate(pii.KEY, kind, canon, 0))
    assert new != found and (kind == "ipv6" or len(new) == len(found))
    again = f"{text[:start]}{new}{text[end:]}"
    assert [d[2] for d in detect(again)] == [kind]


def test_known_names_and_look_alikes():
    assert [k for *_, k, _ in detect("The Susan Miller case")] == ["given:LATIN:f", "surname:LATIN"]
    for text in ("2024-01-02 12:30:45", "1743-555-38241", "ISBN 978-3-16-148410-0", "std::vector and a::b", "00:1a:2b:3c:4d:5e",
                 "DE89 3704 0044 0532 0130 01 is wrong", "the token is: unknown", "key = value", "tokens: 1024", "the bearer of this letter",
                 "password: internationalization", "0.5 12345", "New York", "Susan said so"):
        assert [d for d in detect(text) if d[2] != "card"] == [], text


# --- packing --------------------------------------------------------------------------------


def test_pieces_are_an_exact_round_trip(docs, texts, nothing):
    rows = pack(docs, window=64, open_windows=3, with_ids=True)
    pieces = rows.collect()
    encode = TokenBytes.load()
    want = Counter((i, encode(t or "") + b"\0\0\0\0") for i, t in texts)
    sizes = defaultdict(list)
    for p in pieces:
        sizes[p.sequence_id].append((p.offset, p.length))
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    for own in sizes.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64
    # rows that share a doc_id can't be told apart by it, so their pieces are counted together
    parts = Counter((p.doc_id, p.start, p.doc_tokens, bytes(p.ids)) for p in pieces)
    assert parts == Counter(
        (i, s, len(b) // 4, b[4 * s : 4 * s + 256]) for (i, b), n in want.items() for _ in range(n) for s in range(0, len(b) // 4, 64)
    )
    full = sequences(rows).collect()
    assert sum(len(s.ids) for s in full) == sum(4 * p.length for p in pieces)
    assert pack(nothing).count() == 0


def test_tokens_by_parts_equal_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    whole.encode_special_tokens = True
    rng, encode = random.Random(3), TokenBytes.load()
    for _ in range(500):
        text = "".join(rng.choice(" \n\t  ab'sé9.!?\r\x0b 字<|endoftext|>") for _ in range(rng.randint(0, 40)))
        assert np.frombuffer(encode(text), np.uint32).tolist() == whole.encode(text, add_special_tokens=False).ids


# --- decontamination ------------------------------------------------------------------------


def test_leaks_are_found_and_clean_text_is_not(spark, nothing):
    rng = random.Random(4)
    items = [(i, f"{prose(rng, 20).capitalize()}. {prose(rng, 9).capitalize()}.") for i in range(30)] + [(98, None), (99, " "), (50, prose(rng, 150))]
    rows = [(i, prose(rng, 300)) for i in range(30)]
    for i in range(10):
        filler = prose(rng, 200)
        rows.append((100 + i, f"{filler} {items[i][1].upper()}!! {prose(rng, 100)}"))
    rows += [(200, items[0][1].split(". ")[0]), (201, None), (202, ""), (203, f"{prose(rng, 40)} {items[-1][1]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(docs, bench).collect()}
    assert got == {(100 + i, i) for i in range(10)} | {(203, 50)}
    assert leaks(nothing, bench).count() == 0 and leaks(docs, bench.limit(0)).count() == 0
    left = {r.doc_id for r in without_leaks(docs, bench).collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in got}


def test_block_bounds_lose_no_candidate():
    rng = random.Random(6)
    items = [(i, prose(rng, rng.randint(5, 60)), "q", "a") for i in range(40)]
    index = leaks_module.Index.build(items)
    texts = [prose(rng, 90) + " " + items[i][1] for i in range(20)] + [prose(rng, 20)]
    import pyarrow as pa

    words, first = leaks_module.all_hashed(pa.array(texts))
    found = index.candidates(words, first)
    half = leaks_module.HALF
    for d in range(len(texts)):
        own = words[first[d] : first[d + 1]]
        want = {}
        for k in range(max(1, -(-len(own) // half))):
            terms = np.intersect1d(index.terms, own[k * half : (k + 2) * half])
            scores = index.score(np.searchsorted(index.terms, terms), np.arange(index.most.shape[1]))
            for e in np.flatnonzero(scores >= leaks_module.SCORE):
                item = int(index.item_of[e])
                want[item] = max(want.get(item, 0), scores[e])
        assert found.get(d, {}) == pytest.approx(want)


# --- repeated strings -----------------------------------------------------------------------


def brute_repeats(texts, length):
    data = [(t or "").encode() for _, t in texts]
    counts = Counter(b[k : k + length] for b in data for k in range(len(b) - length + 1))
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, int)
        for k in range(len(b) - length + 1):
            if counts[b[k : k + length]] > 1:
                gone[k] += 1
                gone[k + length] -= 1
        removed = np.cumsum(gone)[:-1] > 0
        runs = sum(1 for k in range(len(b)) if removed[k] and (k == 0 or not removed[k - 1]))
        kept = bytes(x for x, r in zip(b, removed, strict=True) if not r)
        out.append((len(b), int(removed.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_repeats_equal_brute_force(docs, texts, nothing):
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in remove_repeats(docs).collect())
    assert got == Counter((i, *x) for (i, _), x in zip(texts, brute_repeats(texts, 200), strict=True))
    assert remove_repeats(nothing).count() == 0


def test_repeats_at_all_borders(spark):
    """Pieces of 190 to 215 bytes at beginnings, middles and ends, periodic strings and runs."""
    rng = random.Random(8)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    shared = [letters(n) for n in (190, 199, 200, 201, 207, 215)]
    texts = []
    for s in shared:
        texts += [s, s + letters(150), letters(90) + s, letters(33) + s + letters(77), letters(300)]
    texts += ["ab" * 180, "x" + "ab" * 140, "y" * 450, letters(10) + "y" * 230, letters(250)]
    rows = list(enumerate(texts))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)
           for r in remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[i] for i, _ in rows] == brute_repeats(rows, 200)


def test_sampled_suffixes_cover_all(texts):
    for _, t in texts:
        data = np.frombuffer((t or "").encode(), np.uint8)
        if len(data) >= repeats.LENGTH:
            at, _, first, last = repeats.sampled(repeats.Spans(data), len(data))
            assert first[0] == 0 and last[-1] == len(data) - repeats.LENGTH
            assert (first[1:] == last[:-1] + 1).all()
            assert ((at >= last) & (at + repeats.PREFIX <= first + repeats.LENGTH)).all()


# --- pipeline -------------------------------------------------------------------------------


def test_pipeline_stages(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(9)
    item = f"{prose(rng, 20).capitalize()}. {prose(rng, 9).capitalize()}."
    rows = [(i, "\n".join(prose(rng, 30) for _ in range(4))) for i in range(40)]
    rows += [(100 + i, rows[i][1]) for i in range(5)]  # copies
    rows += [(200 + i, rows[i][1].upper().replace(" ", "!! ")) for i in range(10, 20)]  # junk
    rows += [(300, f"{prose(rng, 60)}\n{item}\n{prose(rng, 40)}"), (301, "short"), (302, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 40, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert now.schema == docs.schema
        ids.append({r.doc_id for r in now.select("doc_id").collect()})
    clean = set(range(40))
    assert ids[0] == clean | {100, 101, 102, 103, 104, 300}
    assert ids[1] == clean | {300} and ids[2] == clean | {300} and ids[3] == ids[4] == clean
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


def test_near_stage_keeps_one_of_each_group(spark, docs, texts):
    """Every group keeps one row, whatever its ids; texts that are no copies all stay, also under one id."""
    import corpus_pipeline

    left = Counter((r.doc_id, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").select("doc_id", "text").collect())
    sets, groups = brute_components(texts)
    for members in groups.values():
        assert sum(left[k] for k in {texts[i] for i in members}) == (1 if sets[members[0]] else len(members))


def test_stages_hand_on_columns_with_the_names_of_results(spark, docs, tmp_path):
    import corpus_pipeline

    names = ("score", "kept", "n_words", "n_lines", "n_removed_lines", "component_id", "item_id", "sequence_id", "_row", "_words", "base_failed")
    odd = docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in names})
    spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, prose(random.Random(1), 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, odd, str(tmp_path))
        assert out.schema == odd.schema, name
        kept = out.filter("doc_id is not null").collect()
        assert kept and all(r[c] == f"{c} of {r.doc_id}" for r in kept for c in names), name
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, odd.limit(0), str(tmp_path)).count() == 0, name
    assert corpus_pipeline.packing(spark, odd, str(tmp_path)).select("doc_id").distinct().count() > 0


def test_columns_with_clashing_names(spark, docs):
    odd = docs.withColumn("score", F.lit(1)).withColumn("hash", F.lit("x")).withColumn("n_replaced", F.lit("x"))
    assert lattice_scores(odd, rounds=0).count() == odd.count()
    assert pseudonymise(odd).count() == odd.count()
    assert hilbert_shards(odd).count() == odd.count()


def test_preference_query_equals_its_sql(spark, tmp_path):
    import duckdb

    from lifeloom.llm.catalog import OP2_SQL, op2_preferences

    rng = random.Random(11)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["a", "b <|x", "ñ 日本", "", None]))
            for c in range(60) for t in range(rng.randint(1, 8))]
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").coalesce(1).write.parquet(path)
    got = op2_preferences(spark, str(tmp_path))
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW conversations AS SELECT * FROM '{path}/*.parquet'")
        want = db.sql(OP2_SQL)
        names = want.columns
        assert sorted(want.fetchall()) == sorted(tuple(r) for r in got.select(*names).collect()) != []

"""Quality rules: surface counts of a text, and a log-likelihood ratio of hashed n-grams.

The ratio compares two multinomials over hashed words and word pairs: one counted over the
documents that labels call good (quality 1, nothing toxic), one over the whole corpus. A
document's score is the mean of log(trusted / raw) over its n-grams. A few insults or one bad
passage hardly move the mean of a long text, so a document is also judged by its worst word and
by its worst passage: the lowest mean over overlapping windows of ``PASSAGE`` words that cover
the whole text. These two take classes ``FINER`` times finer, in which an insult is not mixed
with many other words, and weights that stay near 0 for classes with few n-grams.

The three thresholds are fitted: one labelled document in ``HELD_ONE_IN`` is left out of the
trusted counts, and each threshold is the one that catches
the most bad documents held out, less ``COST`` times the good ones lost; toxic ones for the worst
word, those of quality 0 for the others. To these come ``BELIEF`` documents of each kind that only
a prior threshold tells apart: ``THRESHOLD`` for the mean, one below all scores for the other two.
So few labels hardly move the thresholds, many decide them, and there is one rule at every size.

All counts cover every row and every label. Labels are first packed to one bit per document and mark, one row
for ``BITS`` neighbouring ids, and written; Spark broadcasts these while it finds them small, so that texts stay where they are,
and shuffles texts to them beyond. One weight for each hash class goes to every task, as the one row of a written
table. Weights are whole parts of 1/10,000, so the sum does not depend on any order of rows. Only DataFrame functions are used.

Rules for odd rows: a null or blank text has no words, fails the base rules and has score 0;
rows are judged one by one, so repeated rows and rows without doc_id are fine; labels with a
null doc_id or null marks are ignored; without trusted documents both multinomials are equal
and every score and worst mean is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lifeloom.llm.tables import SPACE, columns, keep

BUCKETS = 1 << 14
#: Mean log ratio per n-gram from which a document is kept, before labels have a say.
THRESHOLD = -0.1
#: Documents of each kind that the prior thresholds stand for.
BELIEF = 5
#: Words in a window of the worst passage; windows overlap by half.
PASSAGE = 16
#: Classes of the worst word and passage for each class of the ratio.
FINER = 16
#: Trusted n-grams that are added to what a fine class has and to what it should have.
DOUBT = 1.5
#: One labelled document in so many is for fitting thresholds only.
HELD_ONE_IN = 5
#: Neighbouring doc_ids whose marks are the bits of one number.
BITS = 64
#: Bad documents that must be caught for each good one lost, as shares.
COST = 2.0
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50
SYMBOLS = r"[#*$%&|<>]"
#: The trusted counts are mixed with so many n-grams per class spread like the raw corpus, so
#: that classes with few n-grams say little. It matters in small corpora only.
PRIOR = 1.0
#: Weights are kept as whole numbers of this many parts.
PARTS = 10_000
#: A fine weight counts so much in a packed one; sums of coarse weights of a few n-grams stay far below half of it.
SPAN = 1 << 31


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text.cast("string"), F.lit("")), SPACE), "")


def duplicate_lines(text: Column) -> Column:
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    return F.size(lines) - F.size(F.array_distinct(lines))


def hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def repeated_words(hashes: Column, size: int = 3) -> Column:
    """Words that lie in a window of ``size`` words found twice or more in the text, from the words' hashes.

    Windows are compared by a 64-bit hash. Sorted, equal windows are neighbours; the places of
    those that have an equal neighbour, sorted again, give the words they cover.
    """
    n = F.size(hashes)
    spans = F.transform(
        F.slice(hashes, 1, F.greatest(n - (size - 1), F.lit(0))),
        lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, size))),
    )

    def covered(hashes: Column) -> Column:
        placed = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def alike(places: Column) -> Column:
            same = F.filter(
                places,
                lambda x, i: (x["h"] == F.get(places, i - 1)["h"]) | (x["h"] == F.get(places, i + 1)["h"]),
            )
            return F.array_sort(F.transform(same, lambda x: x["i"]))

        at = F.aggregate(
            F.flatten(F.transform(F.array(placed), alike)),
            F.struct(F.lit(0).alias("n"), F.lit(-size).alias("last")),
            lambda a, i: F.struct(
                (a["n"] + F.least(F.lit(size), i - a["last"])).alias("n"), i.alias("last")
            ),
        )
        return at["n"]

    found = F.transform(
        F.array(spans),
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0),
    )
    return F.when(n > size, F.get(found, F.lit(0))).otherwise(0)


def ngrams(hashes: Column, buckets: int) -> Column:
    """Hash classes of the words, and after them of the pairs of neighbouring words."""
    last = F.greatest(F.size(hashes) - 1, F.lit(0))
    ones = F.transform(hashes, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))
    twos = F.transform(
        F.slice(hashes, 1, last), lambda h, i: F.pmod(F.xxhash64(h, F.get(hashes, i + 1)), F.lit(buckets)).cast("int")
    )
    return F.concat(ones, twos)


def is_held() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit("held")), F.lit(HELD_ONE_IN)) == 0


def trusted_ids(labels: DataFrame) -> DataFrame:
    """doc_id of all documents that all their labels call good, but for those held out."""
    marks = columns(labels, "doc_id", "quality", "toxic").dropna().filter(~is_held())
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return marks.groupBy("doc_id").agg(F.min(good).alias("trusted")).filter("trusted")


def held_ids(labels: DataFrame) -> DataFrame:
    """(doc_id, junk, toxic) of all documents held out; neither mark means good."""
    marks = columns(labels, "doc_id", "quality", "toxic").dropna().filter(is_held())
    return marks.groupBy("doc_id").agg(
        F.max(F.col("quality") != 1).alias("_junk"), F.max(F.col("toxic") != 0).alias("_toxic")
    )


def with_marks(docs: DataFrame, ids: DataFrame, *marks: str, how: str = "left") -> DataFrame:
    """The rows with the boolean ``marks`` of their doc_id; without one they are false, or the row goes if ``how`` is inner.

    ``ids`` has one row per doc_id. Whole numbers are packed, one row for ``BITS`` neighbours, so that
    dense ids take 64 times fewer rows; scattered ones take as many as they are.
    """
    found = F.lit(True).alias("_found")
    if not all(isinstance(d.schema["doc_id"].dataType, T.IntegralType) for d in (docs, ids)):
        listed = keep(ids.select("doc_id", *marks, found), "marks")
        rows = docs.join(listed, "doc_id", how)
    else:
        at = F.col("doc_id").cast("long")
        word, place = F.shiftright(at, BITS.bit_length() - 1).alias("_word"), F.pmod(at, F.lit(BITS)).cast("int")
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        packed = ids.select(word, bit.alias("_bit"), *marks, found).groupBy("_word")
        bits = (F.bit_or(F.when(F.col(m), F.col("_bit")).otherwise(F.lit(0).cast("long"))) for m in (*marks, "_found"))
        packed = keep(packed.agg(*(b.alias(m) for b, m in zip(bits, (*marks, "_found"), strict=True))), "marks")
        rows = docs.withColumn("_word", word).join(packed, "_word", how).drop("_word")
        rows = rows.withColumns({m: F.getbit(m, place) == 1 for m in (*marks, "_found")})
    if how == "inner":
        rows = rows.filter("_found")
    return rows.drop("_found").withColumns({m: F.coalesce(m, F.lit(False)) for m in marks})


def gram_counts(docs: DataFrame, labels: DataFrame, buckets: int) -> DataFrame:
    """(bucket, raw, good): n-grams of all and of trusted rows by class, counted in one pass."""
    text = with_marks(columns(docs, "doc_id", "text"), trusted_ids(labels), "trusted")
    rows = with_words(text, F.col("trusted").cast("long").alias("trusted"))
    grams = rows.select("trusted", F.explode(ngrams(F.col("_hashes"), buckets)).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("trusted").alias("good"))
    return keep(counts, "gram_counts")


def with_totals(counts: DataFrame) -> DataFrame:
    # one row of totals beside one row a class
    return counts.join(F.broadcast(counts.agg(F.sum("raw").alias("all_raw"), F.sum("good").alias("all_good"))))


def weights(counts: DataFrame, buckets: int = BUCKETS, prior: float = PRIOR) -> DataFrame:
    """(bucket, weight): log of the trusted over the raw share of each class, in whole parts.

    Counts may be of classes finer by a whole factor; classes without n-grams are missing and weigh nothing.
    """
    bucket = (F.col("bucket") % buckets).alias("bucket")
    both = with_totals(counts.groupBy(bucket).agg(F.sum("raw").alias("raw"), F.sum("good").alias("good")))
    share = F.col("raw") / F.col("all_raw")
    pull = F.lit(prior * buckets)
    good = F.log((F.col("good") + pull * share) / (F.col("all_good") + pull))
    raw = F.log(share)
    return both.select("bucket", F.round((good - raw) * PARTS).cast("long").alias("weight"))


def fine_weights(counts: DataFrame, doubt: float = DOUBT) -> DataFrame:
    """(bucket, weight): log of the trusted n-grams a class has over those its raw count lets expect.

    ``doubt`` is added to both, so a class that should have few says little, however few it has.
    """
    expected = F.col("raw") * F.col("all_good") / F.col("all_raw")
    ratio = F.log((F.col("good") + doubt) / (expected + doubt))
    return with_totals(counts).select("bucket", F.round(ratio * PARTS).cast("long").alias("weight"))


def weight_list(found: DataFrame, buckets: int) -> Column:
    """The weights as one array by bucket, a scalar subquery; there are ``buckets`` of them, however many rows.

    As a constant they would be spelled out in every plan that the driver keeps.
    """
    classes = found.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    weight = F.coalesce("weight", F.lit(0).cast("long")).alias("weight")
    pairs = classes.join(found, "bucket", "left").select(F.struct("bucket", weight).alias("pair"))
    row = pairs.agg(F.array_sort(F.collect_list("pair")).getField("weight").alias("weights"))
    return keep(row, "weights").scalar()


def looked_up(rows: DataFrame, table: Column, use: Callable[[Column], Column], name: str) -> DataFrame:
    """``rows`` with a column made by ``use`` of a subquery's value.

    Lambdas can't name a subquery, so it is a column first, used once; Spark folds the two selections
    into one, and no row carries the table. The result is made by a generator and so never made anew.
    """
    own = [F.col(f"`{c}`") for c in rows.columns]
    made = F.get(F.transform(F.array("_table"), use), F.lit(0))
    done = rows.select(*own, table.alias("_table")).select(*own, made.alias("_made"))
    return done.select(*own, F.explode(F.array("_made")).alias(name))


def packed_weights(coarse: DataFrame, fine: DataFrame, buckets: int) -> DataFrame:
    """(bucket, weight): for each fine class its weight, ``SPAN`` times, plus that of the coarse class it lies in.

    Sums over a few n-grams are sums of both, see :func:`fine_part` and :func:`coarse_part`.
    """
    none = F.lit(0).cast("long")
    ids = fine.sparkSession.range(buckets * FINER).withColumnRenamed("id", "bucket")
    both = ids.join(fine.withColumnRenamed("weight", "_fine"), "bucket", "left")
    heavy = coarse.select(F.col("bucket").alias("_coarse_bucket"), F.col("weight").alias("_coarse"))
    both = both.join(heavy, F.col("bucket") % buckets == F.col("_coarse_bucket"), "left")
    return both.select("bucket", (F.coalesce("_fine", none) * SPAN + F.coalesce("_coarse", none)).alias("weight"))


def fine_part(packed: Column) -> Column:
    return F.shiftright(packed + SPAN // 2, SPAN.bit_length() - 1)


def coarse_part(packed: Column) -> Column:
    return (packed + SPAN // 2).bitwiseAND(F.lit(SPAN - 1)) - SPAN // 2


def scored(rows: DataFrame, table: Column, buckets: int) -> DataFrame:
    """``score``, ``worst_word`` and ``worst_passage`` of rows that have ``_hashes``, by packed weights.

    Each array that is used more than once is made by a generator, or it would be made anew for
    every use inside of a lambda.
    """
    n, half, none = F.size("_hashes"), PASSAGE // 2, F.lit(0).cast("long")
    hashes, place = F.col("_hashes"), lambda h: F.pmod(h, F.lit(buckets * FINER)).cast("int")

    def with_pair(t: Column, x: Column, i: Column) -> Column:
        pair = F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1))
        return x + F.when(i < n - 1, F.get(t, place(pair))).otherwise(none)

    parted = looked_up(rows, table, lambda t: F.transform(hashes, lambda h: F.get(t, place(h))), "_light")
    parted = looked_up(parted, table, lambda t: F.transform("_light", lambda x, i: with_pair(t, x, i)), "_sums")

    def block(start: Column) -> Column:
        """A pair belongs to the block of its first word."""
        room, sums = F.least(F.lit(half), n - start), F.col("_sums")
        # single elements: a slice would copy the whole array for every block
        total = F.aggregate(F.sequence(start, start + room - 1), none, lambda a, k: a + F.get(sums, k))
        return F.struct(total.alias("total"), (room + F.least(room, n - 1 - start)).alias("count"))

    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1, F.lit(half)), block)).otherwise(
        F.array(F.struct(F.lit(0).cast("long").alias("total"), F.lit(1).alias("count")))
    )
    parts, last = F.col("_blocks"), F.size("_blocks") - 1

    def window(i: Column) -> Column:
        a, b = F.get(parts, i), F.get(parts, F.least(i + 1, last))
        both = fine_part(a["total"] + b["total"]) / (a["count"] + b["count"])
        return F.when(last == 0, fine_part(a["total"]) / a["count"]).otherwise(both)

    windows = F.transform(F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))), window)
    parted = parted.select("*", F.explode(F.array(blocks)).alias("_blocks"))
    heavy = F.aggregate(parts, none, lambda a, x: a + coarse_part(x["total"]))
    part = F.lit(float(PARTS))
    return parted.withColumns(
        {
            "score": heavy / part / F.greatest(2 * n - 1, F.lit(1)),
            # the least packed weight has the least fine part
            "worst_word": fine_part(F.coalesce(F.array_min("_light"), none)) / part,
            "worst_passage": F.array_min(windows) / part,
        }
    ).drop("_light", "_sums", "_blocks")


def with_words(docs: DataFrame, *given: Column) -> DataFrame:
    """The given columns with ``_words`` and their ``_hashes``."""
    # made by generators, so that a filter on the results can't be moved below them, where the text
    # would be split anew for every word
    split = docs.select(*given, F.explode(F.array(words_of(F.col("text")))).alias("_words"))
    return split.select("*", F.explode(F.array(hashed(F.col("_words")))).alias("_hashes"))


def best_cut(good: dict[int, int], bad: dict[int, int], prior: int) -> int:
    """The cut with the largest share of ``bad`` below it, less ``COST`` times that of ``good``.

    Both count documents by whole scores; ``BELIEF`` of each come to them right beside ``prior``.
    """
    good, bad = Counter(good), Counter(bad)
    good[prior] += BELIEF
    bad[prior - 1] += BELIEF
    n_good, n_bad = sum(good.values()), sum(bad.values())
    best, low, high, lost, caught = -COST, prior, prior, 0, 0
    at = sorted({*good, *bad})
    for x, after in zip(at, [*at[1:], at[-1] + 1], strict=True):
        lost, caught = lost + good.get(x, 0), caught + bad.get(x, 0)
        gain = caught / n_bad - COST * lost / n_good
        if gain > best:
            best, low, high = gain, x + 1, after
    return (low + high) // 2


#: Steps a unit in which scores held out are counted, and the largest that is told apart.
STEPS, FAR = 200, 20


def thresholds(docs: DataFrame, labels: DataFrame, table: Column, buckets: int) -> dict[str, float]:
    """The cut of each score, fitted on the documents held out."""
    rows = with_marks(columns(docs, "doc_id", "text"), held_ids(labels), "_junk", "_toxic", how="inner")
    # texts too short are rejected whatever their score
    rows = with_words(rows, F.col("_junk"), F.col("_toxic")).filter(F.size("_words") >= MIN_WORDS)
    rows = scored(rows, table, buckets)
    kinds = {"score": "_junk", "worst_word": "_toxic", "worst_passage": "_junk"}
    prior = {"score": round(THRESHOLD * STEPS), "worst_word": -FAR * STEPS, "worst_passage": -FAR * STEPS}
    step = lambda c: F.floor(F.greatest(F.lit(-FAR), F.least(F.lit(FAR), F.col(c))) * STEPS)
    each = F.inline(F.array(*(F.struct(F.lit(c).alias("what"), step(c).alias("at")) for c in kinds)))
    counts = rows.select("_junk", "_toxic", each).groupBy("what", "at", "_junk", "_toxic").count().collect()
    cuts = {}
    for what, kind in kinds.items():
        good, bad = Counter(), Counter()
        for r in counts:
            if r["what"] == what and (r[kind] or not (r["_junk"] or r["_toxic"])):
                (bad if r[kind] else good)[r["at"]] += r["count"]
        cuts[what] = best_cut(good, bad, prior[what]) / STEPS
    return cuts


def quality(
    docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, threshold: float | None = None
) -> DataFrame:
    """doc_id, counts, base_failed, kept and scores of every row, with ``text`` and what else it has.

    A ``threshold`` that is given stands in place of the fitted one of the mean.
    Columns of the input that have the names of results are replaced.
    """
    counts = gram_counts(docs, labels, buckets * FINER)
    table = weight_list(packed_weights(weights(counts, buckets), fine_weights(counts), buckets), buckets * FINER)
    cuts = thresholds(docs, labels, table, buckets)
    if threshold is not None:
        cuts["score"] = threshold
    names = (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "score", "worst_word", "worst_passage", "base_failed", "kept",
    )
    others = [F.col(f"`{c}`") for c in docs.columns if c not in names]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.col("_words")
    counted = scored(with_words(docs, *others), table, buckets).withColumns(
        {
            "n_words": F.size(words).cast("long"),
            "word_chars": F.char_length(F.array_join(words, "")).cast("long"),
            "n_symbols": (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long"),
            "n_dup_lines": duplicate_lines(text).cast("long"),
            "n_repeat_words": repeated_words(F.col("_hashes")).cast("long"),
        }
    ).drop("_words", "_hashes")
    passed = F.lit(True)
    for name, cut in cuts.items():
        passed = passed & (F.col(name) >= F.lit(cut))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    return counted.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & passed)

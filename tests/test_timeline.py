import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lifeloom.operators import timeline

HOUR = 3600


def _random_points(seed, n, keys, span_seconds):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    out = []
    for i in range(n):
        key = keys[0] if rng.random() < 0.4 else rng.choice(keys)  # one busy key
        at = start + timedelta(microseconds=rng.randrange(span_seconds * 1_000_000))
        out.append((key, at, i))
    return out


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    first = timeline.first_per_key(df, ["k"], ["v"])
    assert rows(first, "k", "v") == [("a", 1), ("b", 5)]
    plan = first._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("slice_seconds", [1, 60, HOUR, 30 * 24 * HOUR])
def test_neighbours_equal_a_sorted_scan(spark, slice_seconds):
    points = _random_points(1, 400, ["a", "b", "c", "d"], 6 * HOUR)
    df = spark.createDataFrame(points, "k string, at timestamp_ntz, id int").withColumn("at", F.col("at").cast("timestamp"))
    got = {
        r["id"]: (r["prev"] and r["prev"]["id"], r["next"] and r["next"]["id"])
        for r in timeline.with_neighbours(df, ["k"], "at", ["at", "id"], ["id"], slice_seconds).collect()
    }
    want = {}
    for key in "abcd":
        ids = [p[2] for p in sorted((p for p in points if p[0] == key), key=lambda p: (p[1], p[2]))]
        for i, x in enumerate(ids):
            want[x] = (ids[i - 1] if i else None, ids[i + 1] if i + 1 < len(ids) else None)
    assert got == want


def test_neighbours_before_1970(spark):
    df = spark.createDataFrame([("a", -5_000_000), ("a", -1), ("a", 3_000_000)], "k string, us long").withColumn(
        "at", F.timestamp_micros("us")
    )
    got = timeline.with_neighbours(df, ["k"], "at", ["at"], ["us"], 2)
    assert [(r["us"], r["prev"] and r["prev"]["us"]) for r in got.orderBy("us").collect()] == [
        (-5_000_000, None), (-1, -5_000_000), (3_000_000, -1),
    ]


def test_neighbours_order_must_start_with_time(spark):
    df = spark.createDataFrame([("a", 1)], "k string, id int").withColumn("at", F.current_timestamp())
    with pytest.raises(ValueError):
        timeline.with_neighbours(df, ["k"], "at", ["id", "at"], ["id"], HOUR)


@pytest.mark.parametrize("slice_seconds", [60, HOUR, 24 * HOUR])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_interval_join_equals_nested_loops(spark, slice_seconds, how):
    rng = random.Random(7)
    points = _random_points(2, 300, ["a", "b", "c", None], 12 * HOUR)
    start = datetime(2024, 1, 1)
    spans = []
    for i in range(60):
        lo = start + timedelta(seconds=rng.randrange(-3 * HOUR, 12 * HOUR))
        length = rng.choice([0, 1, 59, 600, 2 * HOUR, 9 * HOUR])
        hi = None if rng.random() < 0.15 else lo + timedelta(seconds=length)
        spans.append((rng.choice(["a", "b", "c"]), i, lo, hi))
    left = spark.createDataFrame(points, "k string, at timestamp_ntz, id int").withColumn("at", F.col("at").cast("timestamp"))
    right = spark.createDataFrame(spans, "k string, span int, lo timestamp_ntz, hi timestamp_ntz").select(
        "k", "span", F.col("lo").cast("timestamp").alias("valid_from"), F.col("hi").cast("timestamp").alias("valid_to")
    )
    got = sorted(
        (r["id"], -1 if r["span"] is None else r["span"])
        for r in timeline.interval_join(left, right, ["k"], "at", slice_seconds, how).collect()
    )
    want = []
    for k, at, i in points:
        hits = [s for key, s, lo, hi in spans if key == k and lo <= at and (hi is None or at < hi)]
        want += [(i, s) for s in hits] or ([(i, -1)] if how == "left" else [])
    assert got == sorted(want)


def _owners(seed, hours, gap_hours):
    """One device that changes owner every ``gap_hours``; an owner may leave early or stay until the next."""
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    turns = [start + timedelta(hours=h) for h in range(0, hours, gap_hours)]
    return [
        ("a", i, lo, rng.choice([hi, hi, lo + (hi - lo) / 2]) if hi else None)
        for i, (lo, hi) in enumerate(zip(turns, [*turns[1:], None], strict=True))
    ]


def _spans(spark, spans):
    return spark.createDataFrame(spans, "k string, span int, lo timestamp_ntz, hi timestamp_ntz").select(
        "k", "span", F.col("lo").cast("timestamp").alias("valid_from"), F.col("hi").cast("timestamp").alias("valid_to")
    )


@pytest.mark.parametrize("slice_seconds", [600, HOUR, 24 * HOUR])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_sweep_equals_nested_loops(spark, slice_seconds, how):
    points = _random_points(5, 400, ["a", "b", "c", None], 90 * HOUR) + [("a", None, 900), (None, None, 901)]
    start = datetime(2024, 1, 1)
    spans = _owners(3, 80, 7) + [("b", 100 + i, start + timedelta(minutes=i), start + timedelta(minutes=i + 1)) for i in range(0, 4000, 2)]
    spans += [("c", 7000, start - timedelta(days=3), start + timedelta(hours=1)), ("b", 7001, start, start)]
    points += [("a", lo, 1000 + i) for i, (_, _, lo, _) in enumerate(spans[:12])]  # exactly at a start
    points += [("a", hi, 1100 + i) for i, (_, _, _, hi) in enumerate(spans[:11])]  # exactly at an end
    left = spark.createDataFrame(points, "k string, at timestamp_ntz, id int").withColumn("at", F.col("at").cast("timestamp"))
    joined = timeline.interval_join(left, _spans(spark, spans), ["k"], "at", slice_seconds, how, disjoint=True)
    assert joined.columns == ["k", "at", "id", "span", "valid_from", "valid_to"]
    want = []
    for k, at, i in points:
        hits = [s for key, s, lo, hi in spans if at and key == k and lo <= at and (hi is None or at < hi)]
        want += [(i, s) for s in hits] or ([(i, -1)] if how == "left" else [])
    assert sorted((r["id"], -1 if r["span"] is None else r["span"]) for r in joined.collect()) == sorted(want)


def test_candidates_grow_with_the_history(spark):
    """A busy device that changes owner every 30 hours: twice the history makes twice the candidates."""
    made = []
    for days in (60, 120, 240):
        spans = _spans(spark, _owners(1, 24 * days, 30)).withColumns(
            {"_from": F.unix_micros("valid_from"), "_to": F.unix_micros(F.coalesce("valid_to", F.lit("9999-12-31").cast("timestamp")))}
        )
        hours = spark.range(24 * days).select(
            F.lit("a").alias("k"), (F.unix_micros(F.lit("2024-01-01").cast("timestamp")) + F.col("id") * HOUR * 1_000_000).alias("_slice")
        )
        made.append(timeline.spans_by_slice(hours, spans, ["k"], HOUR).count())
        # an hour is reached by one owner, or by two where the owner changes within it
        assert made[-1] <= 24 * days + spans.count()
    assert made[1] < 2.2 * made[0] and made[2] < 2.2 * made[1]


def test_the_sweep_makes_no_pairs(spark):
    left = spark.range(100).select(F.lit("a").alias("k"), F.timestamp_seconds("id").alias("at"))
    joined = timeline.interval_join(left, _spans(spark, _owners(1, 300, 30)), ["k"], "at", HOUR, disjoint=True)
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("timeout", [60, 1800])
def test_sessionize_equals_a_sorted_scan(spark, timeout):
    points = _random_points(3, 500, ["a", "b", "c"], 10 * HOUR)
    df = spark.createDataFrame(points, "k string, at timestamp_ntz, id int").withColumn("at", F.col("at").cast("timestamp"))
    got = {r["id"]: r["session_seq"] for r in timeline.sessionize(df, ["k"], "at", timeout).collect()}
    want = {}
    for key in "abc":
        seq, last = 0, None
        for _, at, i in sorted((p for p in points if p[0] == key), key=lambda p: p[1]):
            if last is None or int((at - last).total_seconds()) > timeout:
                seq += 1
            want[i], last = seq, at
    assert got == want


def test_overlaps_equal_the_self_join(spark):
    rng = random.Random(11)
    spans = []
    for i in range(200):
        lo = datetime(2024, 1, 1) + timedelta(seconds=rng.randrange(20) * 900)
        spans.append((rng.choice("ab"), i, lo, None if rng.random() < 0.05 else lo + timedelta(seconds=rng.choice([0, 300, 900, 5000]))))
    df = spark.createDataFrame(spans, "k string, id int, lo timestamp_ntz, hi timestamp_ntz").select(
        "k", "id", F.col("lo").cast("timestamp").alias("valid_from"), F.col("hi").cast("timestamp").alias("valid_to")
    )
    got = {r["id"] for r in timeline.overlapping_intervals(df, ["k"], HOUR).collect()}
    want = {
        i for k, i, lo, _ in spans for k2, _, lo2, hi2 in spans if k == k2 and lo2 < lo and (hi2 is None or hi2 > lo)
    }
    assert got == want and got


def test_mutual_best_leaves_losers_unmatched(spark):
    pairs = spark.createDataFrame(
        [("l1", "r1", 1, 1), ("l2", "r1", 1, 2), ("l2", "r2", 2, 1)], "l string, r string, lo int, ro int"
    )
    best = timeline.mutual_best(pairs, "l", ["lo"], "r", ["ro"])
    # l2 prefers r1, r1 prefers l1: l2 stays alone although r2 would take it.
    assert rows(best, "l", "r") == [("l1", "r1")]


def test_week_spine_starts_on_monday(spark):
    df = spark.sql("select date'2024-01-10' a, date'2024-01-29' b")
    weeks = df.select(F.explode(timeline.week_spine(F.col("a"), F.col("b"))).alias("w"))
    assert rows(weeks, "w") == [("2024-01-08",), ("2024-01-15",), ("2024-01-22",), ("2024-01-29",)]
    assert df.select(F.explode(timeline.week_spine(F.col("b"), F.col("a")))).count() == 0

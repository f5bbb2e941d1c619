"""Building blocks for ordered, per-key event data.

One key may own a large share of all rows (a shared kiosk, a crawler, a test account), so
nothing here sends such a key to one task. Order-dependent steps first work inside
(key, time slice) groups and then join up the slice edges; lookups by time interval
match on (key, time slice) instead of on the key alone. All keys but the busy ones fit one
task whole, and are worked on in one pass over one shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import all_of, open_end, slice_start, whole_units_between


# Rows above which a key is busy, and the share of the rows that are counted to tell: one of so many.
BUSY_ROWS = 1 << 18
COUNTED = 16


def busy_keys(rows: DataFrame, keys: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Hashes (``_key``) of the keys with more than about ``BUSY_ROWS`` rows.

    They are few, whatever the size of ``rows``. Only every ``COUNTED``-th row by hash of ``by`` is
    counted: the answer says how a key is worked on and never what comes out.
    """
    counted = rows.filter(F.pmod(F.xxhash64(*by), F.lit(COUNTED)) == 0)
    return (
        counted.groupBy(F.xxhash64(*keys).alias("_key"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > BUSY_ROWS // COUNTED)
        .select("_key")
    )


def quiet_rows(rows: DataFrame, keys: Sequence[str], busy: DataFrame) -> DataFrame:
    """Rows of all keys that are not busy, with the key's hash as ``_key``."""
    return rows.withColumn("_key", F.xxhash64(*keys)).join(F.broadcast(busy), "_key", "left_anti")


def busy_rows(rows: DataFrame, keys: Sequence[str], busy: DataFrame) -> DataFrame:
    """Rows of the busy keys."""
    return rows.withColumn("_key", F.xxhash64(*keys)).join(F.broadcast(busy), "_key", "left_semi").drop("_key")


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark trims every input partition to one row per key before the shuffle, so a key with
    very many copies costs one row per task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def with_neighbours(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    order: Sequence[str],
    carry: Sequence[str],
    slice_seconds: int,
    skip: Column | None = None,
    whole_keys: bool = True,
) -> DataFrame:
    """Add ``prev`` and ``next``: structs of ``carry`` from the adjacent rows of the key.

    ``order`` lists the sort columns and must begin with ``time``. Keys that are not busy are
    sorted whole. ``whole_keys=False`` treats all keys as busy, for a ``df`` that is small but
    costly to make, as it is read once for the count and once for either kind.

    Neighbours of busy keys are found inside each (key, slice). The rows at the slice edges then meet once more per key: at
    most two per slice, a number set by the length of the history and not by its density.
    All other rows stay grouped by slice in that second step, so it is one plain pass.

    ``skip`` may name rows the caller does not want, in terms of ``prev`` and ``next``. Those
    away from slice edges are dropped before the second step; the caller still filters.
    """
    if order[0] != time:
        raise ValueError("order must begin with the time column")
    row = F.struct(*carry)
    if whole_keys:
        busy = busy_keys(df, keys, order)
        by_key = Window.partitionBy("_key", *keys).orderBy(*order)
        quiet = quiet_rows(df, keys, busy).select(
            *df.columns, F.lag(row).over(by_key).alias("prev"), F.lead(row).over(by_key).alias("next")
        )
        rest = busy_rows(df, keys, busy)
        return quiet.unionByName(with_neighbours(rest, keys, time, order, carry, slice_seconds, skip, False))
    inner = Window.partitionBy(*keys, "_slice").orderBy(*order)
    local = (
        df.withColumn("_slice", slice_start(time, slice_seconds))
        .withColumn("prev", F.lag(row).over(inner))
        .withColumn("next", F.lead(row).over(inner))
    )
    at_edge = F.col("prev").isNull() | F.col("next").isNull()
    if skip is not None:
        local = local.filter(at_edge | ~skip)
    lanes = local.withColumn("_lane", F.when(~at_edge, F.col("_slice")))
    outer = Window.partitionBy(*keys, "_lane").orderBy(*order)
    return lanes.select(
        *df.columns,
        F.coalesce("prev", F.lag(row).over(outer)).alias("prev"),
        F.coalesce("next", F.lead(row).over(outer)).alias("next"),
    )


def interval_join(
    left: DataFrame,
    intervals: DataFrame,
    keys: Sequence[str],
    time: str,
    slice_seconds: int,
    how: str = "left",
    start: str = "valid_from",
    end: str = "valid_to",
    occupied: DataFrame | None = None,
    disjoint: bool = False,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Match rows to the half-open ``[start, end)`` intervals of their key holding ``time``.

    Work grows with rows plus intervals, also for a key that holds most of both. With
    ``disjoint`` the intervals of a key never overlap, which the caller promises; rows are then
    matched by one sweep per (key, slice), or by one per key for all keys but those in ``busy``
    (see :func:`busy_keys`) when it is given. Else the intervals are listed under the slices they
    reach into and joined by equality on (key, slice) with the bounds checked on top.

    Only slices in which a key has rows count. They are taken from ``occupied`` when given:
    any frame with the keys and ``time`` covering at least the slices of ``left``, useful when
    ``left`` is expensive. Rows with a NULL key or time match nothing.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type: {how!r}")
    if disjoint and busy is not None:
        quiet = _swept_whole(
            quiet_rows(left, keys, busy), quiet_rows(intervals, keys, busy), keys, time, how, start, end
        )
        at = None if occupied is None else busy_rows(occupied, keys, busy)
        rest = interval_join(
            busy_rows(left, keys, busy), busy_rows(intervals, keys, busy), keys, time, slice_seconds, how,
            start, end, at, disjoint,
        )
        return quiet.unionByName(rest)
    slices = (left if occupied is None else occupied).select(
        *keys, slice_start(time, slice_seconds).alias("_slice")
    ).dropna().distinct()
    spans = (
        intervals.withColumn("_from", F.unix_micros(start))
        .withColumn("_to", F.unix_micros(open_end(end)))
        .filter(F.col("_from") < F.col("_to"))
    )
    extra = [c for c in intervals.columns if c not in keys]
    if disjoint:
        return _swept(left, slices, spans, extra, keys, time, slice_seconds, how)

    rows = left.withColumn("_slice", slice_start(time, slice_seconds))
    r, c = rows.alias("r"), spans_by_slice(slices, spans, keys, slice_seconds).alias("c")
    at = F.unix_micros(F.col(f"r.{time}"))
    match = all_of(
        [F.col(f"r.{k}") == F.col(f"c.{k}") for k in (*keys, "_slice")]
        + [F.col("c._from") <= at, at < F.col("c._to")]
    )
    return r.join(c, match, how).select(
        *[F.col(f"r.{x}") for x in left.columns], *[F.col(f"c.{x}") for x in extra]
    )


def spans_by_slice(slices: DataFrame, spans: DataFrame, keys: Sequence[str], slice_seconds: int) -> DataFrame:
    """``spans`` (keys, ``_from``, ``_to``, ...) once for every slice of ``slices`` they reach into.

    A span inside one slice is listed under it. For the others the key's slices are numbered,
    and two running counts tell the numbers of the first and the last slice that a span
    reaches; it is repeated for the numbers between. So nothing is made that is then thrown away:
    with d spans open at a time there are d rows a slice. The counts run over a key's slices
    and long spans, a number set by the length of its history.
    """
    width = slice_seconds * 1_000_000
    floor = lambda c: c - F.pmod(c, F.lit(width))
    placed = spans.withColumn("_first", floor(F.col("_from"))).withColumn("_last", floor(F.col("_to") - 1))
    is_short = F.col("_first") == F.col("_last")
    short = placed.filter(is_short).withColumnRenamed("_first", "_slice").drop("_last")

    slices = slices.select(*keys, "_slice")

    def counted(frame: DataFrame, at: str, name: str, after: bool) -> DataFrame:
        """How many slices of the key begin before ``at``, or with ``after`` at or before it."""
        points = frame.withColumn("_at", F.col(at)).unionByName(
            slices.withColumn("_at", F.col("_slice")), allowMissingColumns=True
        )
        turn = F.col("_slice").isNull() == after  # which of a slice and a span at it comes first
        running = Window.partitionBy(*keys).orderBy("_at", turn).rowsBetween(Window.unboundedPreceding, 0)
        found = points.withColumn(name, F.count("_slice").over(running))
        return found.filter(F.col("_slice").isNull()).drop("_slice", "_at")

    long = counted(placed.filter(~is_short), "_first", "_before", False)
    long = counted(long, "_last", "_through", True).filter(F.col("_before") < F.col("_through"))
    numbers = F.sequence(F.col("_before") + 1, F.col("_through"))
    long = long.withColumn("_number", F.explode(numbers)).drop("_before", "_through", "_first", "_last")
    number = F.row_number().over(Window.partitionBy(*keys).orderBy("_slice")).cast("bigint")
    return long.join(slices.withColumn("_number", number), [*keys, "_number"]).drop("_number").unionByName(short)


def _swept(
    left: DataFrame,
    slices: DataFrame,
    spans: DataFrame,
    extra: Sequence[str],
    keys: Sequence[str],
    time: str,
    slice_seconds: int,
    how: str,
) -> DataFrame:
    """Rows with the last interval that began at or before them, if it is still open.

    Rows and interval starts of a (key, slice) are merged by time and the last start is
    carried along. What is open when a slice begins comes from a running maximum over the
    key's slices, one row per slice.
    """
    width = slice_seconds * 1_000_000
    span = F.struct("_from", "_to", *extra).alias("_span")
    spans = spans.dropna(subset=list(keys))
    starts = spans.select(*keys, F.col("_from").alias("_at"), (F.col("_from") - F.pmod("_from", F.lit(width))).alias("_slice"), span)
    last = starts.groupBy(*keys, "_slice").agg(F.max_by("_span", "_at").alias("_span"))
    marks = slices.select(*keys, "_slice", F.lit(True).alias("_seen")).unionByName(last, allowMissingColumns=True)
    earlier = Window.partitionBy(*keys).orderBy("_slice").rangeBetween(Window.unboundedPreceding, -1)
    carried = marks.withColumn("_span", F.last("_span", ignorenulls=True).over(earlier)).filter(
        F.col("_seen") & (F.col("_span._to") > F.col("_slice"))
    )
    # rows without a key or time stay: no interval begins in their group
    rows = (left.dropna(subset=[*keys, time]) if how == "inner" else left).select(
        *keys,
        F.unix_micros(time).alias("_at"),
        slice_start(time, slice_seconds).alias("_slice"),
        F.struct(*left.columns).alias("_row"),
    )
    merged = (
        rows.unionByName(starts, allowMissingColumns=True)
        .unionByName(carried.select(*keys, F.col("_slice").alias("_at"), "_slice", "_span"), allowMissingColumns=True)
    )
    is_row = F.col("_row").isNotNull()
    # at one time a carried interval comes first, then a start, then rows
    turn = F.when(is_row, F.lit(None).cast("bigint")).otherwise(F.col("_span._from"))
    so_far = (
        Window.partitionBy(*keys, "_slice")
        .orderBy("_at", turn.asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    matched = merged.withColumn("_span", F.last("_span", ignorenulls=True).over(so_far)).filter(is_row)
    is_open = F.col("_at") < F.col("_span._to")
    if how == "inner":
        matched = matched.filter(is_open)
    return matched.select(
        *[F.col(f"_row.{c}").alias(c) for c in left.columns],
        *[F.when(is_open, F.col(f"_span.{c}")).alias(c) for c in extra],
    )


def _swept_whole(
    left: DataFrame, intervals: DataFrame, keys: Sequence[str], time: str, how: str, start: str, end: str
) -> DataFrame:
    """Rows with the last interval of the key that began at or before them, if it is still open.

    ``left`` and ``intervals`` carry the key's hash as ``_key``, and every key fits one task.
    """
    columns = [c for c in left.columns if c != "_key"]
    extra = [c for c in intervals.columns if c not in (*keys, "_key")]
    spans = (
        intervals.dropna(subset=list(keys))
        .withColumn("_from", F.unix_micros(start))
        .withColumn("_to", F.unix_micros(open_end(end)))
        .filter(F.col("_from") < F.col("_to"))
    )
    starts = spans.select("_key", *keys, F.col("_from").alias("_at"), F.struct("_to", *extra).alias("_span"))
    rows = (left.dropna(subset=[*keys, time]) if how == "inner" else left).select(
        "*", F.unix_micros(time).alias("_at"), F.lit(True).alias("_is_row")
    )
    merged = rows.unionByName(starts, allowMissingColumns=True)
    # at one time a start comes before rows
    so_far = (
        Window.partitionBy("_key", *keys)
        .orderBy("_at", F.col("_is_row").asc_nulls_first())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    matched = merged.withColumn("_span", F.last("_span", ignorenulls=True).over(so_far)).filter("_is_row")
    is_open = F.col("_at") < F.col("_span._to")
    if how == "inner":
        matched = matched.filter(is_open)
    return matched.select(*columns, *[F.when(is_open, F.col(f"_span.{c}")).alias(c) for c in extra])


def activity_runs(
    rows: DataFrame, keys: Sequence[str], time: str, timeout_seconds: int, aggregates: Sequence[Column] = ()
) -> DataFrame:
    """Rows reduced to one per (key, slice of ``timeout_seconds``) and numbered by run.

    Rows sharing a slice are closer than the timeout, so they always belong to the same run
    and can be combined before the shuffle. What is left per key is bounded by the length
    of its history. Adds ``first_at``, ``last_at`` and ``session_seq``.
    """
    slots = (
        rows.withColumn("_slice", slice_start(time, timeout_seconds))
        .groupBy(*keys, "_slice")
        .agg(F.min(time).alias("first_at"), F.max(time).alias("last_at"), *aggregates)
    )
    by_key = Window.partitionBy(*keys).orderBy("_slice")
    idle = whole_units_between("SECOND", F.lag("last_at").over(by_key), "first_at")
    opens = F.coalesce((idle > timeout_seconds).cast("int"), F.lit(1))
    return slots.withColumn("_opens", opens).withColumn(
        "session_seq",
        F.sum("_opens").over(by_key.rowsBetween(Window.unboundedPreceding, 0)).cast("bigint"),
    ).drop("_opens")


def sessionize(rows: DataFrame, keys: Sequence[str], time: str, timeout_seconds: int) -> DataFrame:
    """Add ``session_seq``: the running number of the activity run each row belongs to.

    A run ends when more than ``timeout_seconds`` whole seconds pass without a row.
    """
    runs = activity_runs(rows.select(*keys, time), keys, time, timeout_seconds)
    slots = runs.select(*keys, "_slice", "session_seq")
    r = rows.withColumn("_slice", slice_start(time, timeout_seconds)).alias("r")
    s = slots.alias("s")
    # rows with a NULL key are a key of their own, as in the runs
    same = all_of([F.col(f"r.`{k}`").eqNullSafe(F.col(f"s.`{k}`")) for k in (*keys, "_slice")])
    return r.join(s, same).select(*(F.col(f"r.`{c}`") for c in rows.columns), "s.session_seq")


def mutual_best(
    pairs: DataFrame,
    left_key: str,
    left_order: Sequence[str | Column],
    right_key: str,
    right_order: Sequence[str | Column],
) -> DataFrame:
    """Candidate pairs that are the first choice of both their left and their right side.

    The orders should be unique per side, else the choice among ties is Spark's. Each side
    is trimmed to one pair per key and input partition before it is shuffled.
    """
    left_choice = first_per_key(pairs, [left_key], left_order)
    right_choice = first_per_key(pairs, [right_key], right_order).select(left_key, right_key)
    return left_choice.join(right_choice, [left_key, right_key], "left_semi")


def overlapping_intervals(
    intervals: DataFrame,
    keys: Sequence[str],
    slice_seconds: int,
    start: str = "valid_from",
    end: str = "valid_to",
) -> DataFrame:
    """Intervals whose start lies strictly inside an earlier-starting interval of the key.

    Compares each start with the latest end among strictly earlier starts, first within the
    slice and then against a running maximum over earlier slices (one row per slice).
    """
    # Microsecond numbers: a range frame over timestamps would need an interval bound.
    sliced = (
        intervals.withColumn("_slice", slice_start(start, slice_seconds))
        .withColumn("_from", F.unix_micros(start))
        .withColumn("_to", F.unix_micros(open_end(end)))
    )
    earlier_in_slice = (
        Window.partitionBy(*keys, "_slice").orderBy("_from").rangeBetween(Window.unboundedPreceding, -1)
    )
    earlier_slices = (
        Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    reach = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max("_to").alias("_slice_to"))
        .select(*keys, "_slice", F.max("_slice_to").over(earlier_slices).alias("_reach"))
    )
    return (
        sliced.withColumn("_local_reach", F.max("_to").over(earlier_in_slice))
        .join(reach, [*keys, "_slice"])
        .filter(F.greatest("_local_reach", "_reach") > F.col("_from"))
        .select(*intervals.columns)
    )


def week_spine(start: Column, end: Column) -> Column:
    """Array of Mondays from the week of ``start`` up to ``end``; NULL when there are none."""
    monday = F.trunc(start, "week")
    return F.when(monday <= end, F.sequence(monday, end, F.expr("interval 7 days")))

"""Visits: runs of device activity without a long pause."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import whole_units_between
from ..functions.keys import surrogate_key
from ..policy import DAY, Policy
from .timeline import activity_runs, busy_keys, busy_rows, interval_join, quiet_rows

ENTRY_ATTRIBUTES = ("utm_source", "utm_medium", "utm_campaign", "platform", "device_type", "browser")


def device_sessions(events: DataFrame, policy: Policy, busy: DataFrame | None = None) -> DataFrame:
    """One row per device session, with the attributes of its first event.

    The events of a device are sorted once and cut where it was idle. Events of busy devices
    (:func:`busy_keys`, found here if not given) are combined to half-hour slots before they are shuffled.
    """
    if busy is None:
        busy = busy_keys(events, ["anon_id"], ["event_time"])
    quiet = _whole_visits(quiet_rows(events, ["anon_id"], busy), policy)
    return session_columns(quiet.unionByName(_slotted_visits(busy_rows(events, ["anon_id"], busy), policy)))


def _whole_visits(events: DataFrame, policy: Policy) -> DataFrame:
    """Visits of devices that fit one task (rows with ``_key``).

    Of each visit the first and the last row are kept, with running counts; both windows share
    one sort.
    """
    by_time = Window.partitionBy("_key", "anon_id").orderBy("event_time", "event_id", *ENTRY_ATTRIBUTES)
    is_view = F.coalesce(F.col("event_type") == "page_view", F.lit(False)).cast("bigint")

    def cut(before: str, after: str) -> Column:
        """Whether two neighbours belong to different visits; rows without a time are one visit."""
        idle = whole_units_between("SECOND", before, after) > policy.session_timeout_seconds
        return F.coalesce(idle, F.col(before).isNull() != F.col(after).isNull())

    numbered = events.select(
        "_key",
        "anon_id",
        "event_time",
        "event_id",
        *ENTRY_ATTRIBUTES,
        is_view.alias("_is_view"),
        F.row_number().over(by_time).cast("bigint").alias("_row"),
        F.sum(is_view).over(by_time.rowsBetween(Window.unboundedPreceding, 0)).alias("_views"),
        F.lag("event_time").over(by_time).alias("_prev"),
        F.lead("event_time").over(by_time).alias("_next"),
        F.lead(F.lit(True)).over(by_time).alias("_has_next"),
    )
    edges = numbered.select(
        "*",
        ((F.col("_row") == 1) | cut("_prev", "event_time")).alias("_opens"),
        (F.col("_has_next").isNull() | cut("event_time", "_next")).alias("_closes"),
    ).filter(F.col("_opens") | F.col("_closes"))
    row = F.struct("event_time", "_row", "_views")
    return (
        edges.withColumn("_end", F.when(F.col("_closes"), row).otherwise(F.lead(row).over(by_time)))
        .filter("_opens")
        .select(
            "anon_id",
            F.struct("event_time", "event_id", *ENTRY_ATTRIBUTES).alias("entry"),
            F.col("event_time").alias("session_start_at"),
            F.col("_end.event_time").alias("session_end_at"),
            (F.col("_end._row") - F.col("_row") + 1).alias("event_count"),
            (F.col("_end._views") - F.col("_views") + F.col("_is_view")).alias("page_view_count"),
        )
    )


def _slotted_visits(events: DataFrame, policy: Policy) -> DataFrame:
    """Visits by half-hour slots, however many events a device has."""
    entry = F.struct("event_time", "event_id", *ENTRY_ATTRIBUTES)
    slots = activity_runs(
        events,
        ["anon_id"],
        "event_time",
        policy.session_timeout_seconds,
        [
            F.min(entry).alias("entry"),
            F.count(F.lit(1)).alias("events"),
            F.count_if(F.col("event_type") == "page_view").alias("page_views"),
        ],
    )
    return slots.groupBy("anon_id", "session_seq").agg(
        F.min("entry").alias("entry"),
        F.min("first_at").alias("session_start_at"),
        F.max("last_at").alias("session_end_at"),
        F.sum("events").alias("event_count"),
        F.sum("page_views").alias("page_view_count"),
    ).drop("session_seq")


def session_columns(visits: DataFrame) -> DataFrame:
    """The columns of device sessions from their first event (``entry``), bounds and counts."""
    return visits.select(
        surrogate_key(F.concat("anon_id", "entry.event_id")).cast("string").alias("session_id"),
        "anon_id",
        "session_start_at",
        "session_end_at",
        whole_units_between("SECOND", "session_start_at", "session_end_at").alias(
            "session_duration_seconds"
        ),
        "event_count",
        "page_view_count",
        *[F.col(f"entry.{c}").alias(c) for c in ENTRY_ATTRIBUTES],
        F.to_date("session_start_at").alias("session_date"),
    )


def with_owners(
    device: DataFrame, intervals: DataFrame, policy: Policy, occupied: DataFrame | None = None,
    busy: DataFrame | None = None,
) -> DataFrame:
    """Device sessions with the device's owner at session start; NULL when it has none."""
    owners = intervals.select(
        "anon_id", F.col("user_id").alias("stitched_user_id"), "valid_from", "valid_to"
    )
    return interval_join(
        device, owners, ["anon_id"], "session_start_at", DAY, "left", occupied=occupied,
        disjoint=policy.identity_intervals == "disjoint", busy=busy,
    ).drop("valid_from", "valid_to")


def sessions(events: DataFrame, intervals: DataFrame, policy: Policy) -> DataFrame:
    """Sessions of devices and their owners."""
    # Days with events cover the days with session starts, and are cheaper to list.
    seen = events.select("anon_id", F.col("event_time").alias("session_start_at"))
    busy = busy_keys(events, ["anon_id"], ["event_time"])
    return with_owners(device_sessions(events, policy, busy), intervals, policy, seen, busy)

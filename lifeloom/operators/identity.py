"""Which user owned a device when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import shift_time
from ..policy import Policy
from .timeline import busy_keys, interval_join, with_neighbours


def identity_transitions(events: DataFrame, policy: Policy) -> DataFrame:
    """Moments at which a device's authenticated user differs from the one before."""
    logins = events.filter(F.col("user_id").isNotNull()).select("anon_id", "user_id", "event_time")
    ordered = with_neighbours(
        logins, ["anon_id"], "event_time", ["event_time", "user_id"], ["user_id"],
        policy.event_slice_seconds, skip=F.col("prev.user_id") == F.col("user_id"),
    )
    changed = F.col("prev").isNull() | (F.col("prev.user_id") != F.col("user_id"))
    return ordered.filter(changed).select(
        "anon_id",
        "user_id",
        F.col("event_time").alias("transition_time"),
        F.col("prev.user_id").alias("prev_user_id"),
    )


def stitch_identity(events: DataFrame, policy: Policy) -> DataFrame:
    """Half-open ownership intervals per device.

    The first owner's interval reaches back by the stitching lookback. A later owner's
    starts at its own transition (``disjoint``), or reaches back to the previous transition
    within the lookback (``overlapping``).
    """
    changes = identity_transitions(events, policy).drop("prev_user_id")
    ordered = with_neighbours(
        changes, ["anon_id"], "transition_time", ["transition_time", "user_id"],
        ["transition_time"], policy.event_slice_seconds, whole_keys=False,
    )
    lookback = shift_time("transition_time", "DAY", -policy.identity_stitching_lookback_days)
    previous = F.col("prev.transition_time")
    if policy.identity_intervals == "disjoint":
        valid_from = F.when(previous.isNull(), lookback).otherwise(F.col("transition_time"))
    else:
        valid_from = F.greatest(lookback, previous)
    return ordered.select(
        "anon_id",
        "user_id",
        valid_from.alias("valid_from"),
        F.col("next.transition_time").alias("valid_to"),
        F.when(F.col("next").isNull(), "last_touch").otherwise("historical").alias("stitch_source"),
    ).filter(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))


def resolve_identity(
    events: DataFrame, intervals: DataFrame, policy: Policy, keep_anonymous: bool = False
) -> DataFrame:
    """Add ``resolved_user_id``: the event's own user, else the device owner at that time."""
    owners = intervals.select("anon_id", F.col("user_id").alias("_owner"), "valid_from", "valid_to")

    def matched(rows: DataFrame, how: str, busy: DataFrame | None = None) -> DataFrame:
        return interval_join(
            rows, owners, ["anon_id"], "event_time", policy.lookup_slice_seconds, how,
            disjoint=policy.identity_intervals == "disjoint", busy=busy,
        ).select(*events.columns, F.coalesce("user_id", "_owner").alias("resolved_user_id"))

    if policy.identity_intervals == "overlapping":
        # Every event takes part: one event may fall into two owners' intervals.
        resolved = matched(events, "left")
        return resolved if keep_anonymous else resolved.filter(F.col("resolved_user_id").isNotNull())
    # With one owner at a time an authenticated event cannot change or multiply.
    known = events.filter(F.col("user_id").isNotNull()).withColumn("resolved_user_id", F.col("user_id"))
    unknown = events.filter(F.col("user_id").isNull())
    busy = busy_keys(events, ["anon_id"], ["event_time"])
    return known.unionByName(matched(unknown, "left" if keep_anonymous else "inner", busy))

"""Who belonged to which account when."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..policy import Policy
from .timeline import with_neighbours


def account_memberships(events: DataFrame, policy: Policy) -> DataFrame:
    """Membership intervals: from each join to the next join or removal of the same pair."""
    moves = events.filter(
        F.col("event_type").isin("member_joined", "member_removed")
        & F.col("user_id").isNotNull()
        & F.col("account_id").isNotNull()
    ).select("user_id", "account_id", "event_type", "event_time", "event_id", "member_role")
    ordered = with_neighbours(
        moves,
        ["user_id", "account_id"],
        "event_time",
        ["event_time", "event_type", "event_id"],
        ["event_time"],
        policy.billing_slice_seconds,
    )
    until = F.col("next.event_time")
    return ordered.filter(F.col("event_type") == "member_joined").select(
        "user_id",
        "account_id",
        F.col("member_role").alias("role"),
        F.col("event_time").alias("valid_from"),
        until.alias("valid_to"),
        F.datediff(F.to_date(F.coalesce(until, policy.as_of_time())), F.to_date("event_time"))
        .cast("bigint")
        .alias("membership_duration_days"),
    )

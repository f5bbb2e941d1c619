"""Weekly engagement snapshots."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import week_start
from ..policy import Policy
from .timeline import week_spine


def last_activity(resolved: DataFrame, policy: Policy) -> DataFrame:
    """Per user and week since the first event in the log, the last activity by week end.

    Events shrink to one row per (user, week) before the shuffle. A running maximum over
    each user's weeks then carries the last activity forward, so events never meet the
    week list.
    """
    known = resolved.filter(F.col("resolved_user_id").isNotNull()).select(
        F.col("resolved_user_id").alias("user_id"), "event_time", "event_type"
    )
    first_day = known.select(F.min(F.to_date("event_time")).alias("first_day"))
    weekly = known.groupBy("user_id", week_start(F.to_date("event_time")).alias("week")).agg(
        F.max("event_time").alias("last_at"),
        F.min(F.when(F.col("event_type") == "activation", F.col("event_time"))).alias("activated_at"),
    )
    # A user's weeks fit one map: it has at most one entry per calendar week.
    by_user = weekly.groupBy("user_id").agg(
        F.min("activated_at").alias("activation_at"),
        F.map_from_entries(F.collect_list(F.struct("week", "last_at"))).alias("active_weeks"),
    )
    weeks = by_user.select(
        "user_id",
        "activation_at",
        "active_weeks",
        F.explode(week_spine(first_day.scalar(), policy.as_of_date())).alias("snapshot_week_start"),
    )
    so_far = (
        Window.partitionBy("user_id")
        .orderBy("snapshot_week_start")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    active_at = F.try_element_at("active_weeks", F.col("snapshot_week_start"))
    return weeks.select(
        "user_id",
        "activation_at",
        "snapshot_week_start",
        F.date_add("snapshot_week_start", 6).alias("snapshot_week_end"),
        F.max(active_at).over(so_far).alias("last_activity_at"),
    )


def engagement_states(resolved: DataFrame, policy: Policy) -> DataFrame:
    """Weekly state of every user: pre_active, active, dormant or disengaged."""
    week_end = F.col("snapshot_week_end")
    idle = F.datediff(week_end, F.to_date("last_activity_at"))
    # A week ends at midnight on its Sunday: an activation later that day counts next week.
    not_yet = F.col("activation_at").isNull() | (F.col("activation_at") > week_end.cast("timestamp"))
    state = (
        F.when(not_yet, "pre_active")
        .when(idle <= policy.engagement_active_threshold_days, "active")
        .when(idle <= policy.engagement_dormant_threshold_days, "dormant")
        .otherwise("disengaged")
    )
    classified = last_activity(resolved, policy).withColumn("engagement_state", state)
    was = F.lag("engagement_state").over(
        Window.partitionBy("user_id").orderBy("snapshot_week_start")
    )
    back = was.isin("dormant", "disengaged") & (F.col("engagement_state") == "active")
    return classified.select(
        "user_id",
        "snapshot_week_start",
        "engagement_state",
        F.coalesce(back, F.lit(False)).alias("is_re_engaged"),
        F.coalesce(idle, F.datediff(week_end, policy.project_start()))
        .cast("bigint")
        .alias("days_since_last_activity"),
        "last_activity_at",
    )

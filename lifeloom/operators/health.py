"""Account health: activity, billing and support blended to 0-100."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import shift_time
from ..policy import DAY, Policy
from .timeline import interval_join

# The scoring tables.
SESSIONS_FOR_FULL_SCORE = 10.0
RECENT_BILLING_DAYS = 90
BILLING_SCORES = {"active_recent": 100, "active": 70, "inactive": 20, "none": 0}
SUPPORT_SCORES = {"no_tickets": 70, "happy": 100, "steady": 70, "strained": 40, "poor": 10}
WEIGHTS = {"activity_score": 0.4, "billing_score": 0.3, "support_score": 0.3}


def _window_start(policy: Policy) -> Column:
    return shift_time(policy.as_of_time(), "DAY", -policy.account_health_trailing_days)


def account_activity(sessions: DataFrame, memberships: DataFrame, policy: Policy) -> DataFrame:
    """Distinct sessions and events of an account's members in the trailing window."""
    recent = sessions.filter(
        (F.col("session_start_at") >= _window_start(policy)) & F.col("stitched_user_id").isNotNull()
    ).select(F.col("stitched_user_id").alias("user_id"), "session_id", "session_start_at", "event_count")
    members = memberships.select("user_id", "account_id", "valid_from", "valid_to")
    joined = interval_join(recent, members, ["user_id"], "session_start_at", DAY, "inner")
    return joined.groupBy("account_id").agg(
        F.countDistinct("session_id").alias("session_count"), F.sum("event_count").alias("total_events")
    )


def account_billing(lifecycle: DataFrame, policy: Policy) -> DataFrame:
    """Ever-active flag over all time and the last billing event in the trailing window."""
    recent = F.col("event_time") >= _window_start(policy)
    return lifecycle.groupBy("account_id").agg(
        F.max(F.col("is_active").cast("int")).alias("has_active_sub"),
        F.max(F.when(recent, F.col("event_time"))).alias("last_billing_event"),
    )


def account_support(tickets: DataFrame, policy: Policy) -> DataFrame:
    """Open tickets and the averages over resolved ones in the trailing window."""
    done = F.col("is_resolved")
    return tickets.filter(F.col("created_at") >= _window_start(policy)).groupBy("account_id").agg(
        F.count_if(~done).alias("open_tickets"),
        F.avg(F.when(done, F.col("csat_score"))).alias("avg_csat"),
        F.avg(F.when(done, F.col("resolution_time_hours"))).alias("avg_resolution_hours"),
    )


def account_health(
    sessions: DataFrame, memberships: DataFrame, lifecycle: DataFrame, tickets: DataFrame, policy: Policy
) -> DataFrame:
    """Health score of every account that has ever had a subscription event."""
    scored = (
        account_billing(lifecycle, policy)
        .join(account_activity(sessions, memberships, policy), "account_id", "left")
        .join(account_support(tickets, policy), "account_id", "left")
    )
    visits = F.coalesce("session_count", F.lit(0)).cast("double")
    activity = F.least(visits / F.lit(SESSIONS_FOR_FULL_SCORE) * F.lit(100.0), F.lit(100.0))

    active = F.col("has_active_sub") == 1
    age = F.datediff(policy.as_of_date(), F.to_date("last_billing_event"))
    billing = (
        F.when(active & (age <= RECENT_BILLING_DAYS), BILLING_SCORES["active_recent"])
        .when(active, BILLING_SCORES["active"])
        .when(F.col("has_active_sub") == 0, BILLING_SCORES["inactive"])
        .otherwise(BILLING_SCORES["none"])
    )

    waiting, csat = F.coalesce("open_tickets", F.lit(0)), F.col("avg_csat")
    support = (
        F.when(csat.isNull() & (waiting == 0), SUPPORT_SCORES["no_tickets"])
        .when((waiting == 0) & (csat >= 4), SUPPORT_SCORES["happy"])
        .when((waiting <= 2) & (F.coalesce(csat, F.lit(3.0)) >= 3), SUPPORT_SCORES["steady"])
        .when(waiting <= 5, SUPPORT_SCORES["strained"])
        .otherwise(SUPPORT_SCORES["poor"])
    )
    parts = scored.select(
        "account_id",
        activity.alias("activity_score"),
        billing.cast("double").alias("billing_score"),
        support.cast("double").alias("support_score"),
    )
    a, b, s = (F.lit(w) * F.col(c) for c, w in WEIGHTS.items())
    return parts.select(
        "account_id",
        F.greatest(F.lit(0.0), F.least(F.lit(100.0), a + b + s)).alias("health_score"),
        "activity_score",
        "billing_score",
        "support_score",
        policy.as_of_time().alias("calculated_at"),
        F.lit(policy.account_health_trailing_days).cast("bigint").alias("trailing_window_days"),
    )

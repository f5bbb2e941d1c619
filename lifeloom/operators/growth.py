"""Marketing spend, attribution and support tickets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY, shift_time, whole_units_between
from ..policy import Policy
from .events import first_event_time

# Ticket states that count as resolved.
RESOLVED_STATUSES = ("resolved", "closed")

TOUCH_FIELDS = {
    "channel": "channel",
    "utm_source": "source",
    "utm_medium": "medium",
    "utm_campaign": "campaign",
}


def spend_prep(spend: DataFrame) -> DataFrame:
    """Spend rows with cost per click and click-through rate; NULL instead of division by 0."""
    clicks, impressions = F.col("clicks"), F.col("impressions")
    return spend.select(
        "*",
        F.try_divide("spend_amount", clicks).cast(MONEY).alias("cost_per_click"),
        F.try_divide(clicks.cast("double"), impressions.cast("double")).alias("click_through_rate"),
    )


def ticket_metrics(tickets: DataFrame) -> DataFrame:
    """Tickets with resolution and first-response hours and a resolved flag."""
    hours = F.lit(3600.0)
    return tickets.select(
        *[c for c in tickets.columns if c not in ("_loaded_at", "first_response_seconds")],
        (whole_units_between("SECOND", "created_at", "resolved_at") / hours).alias("resolution_time_hours"),
        (F.col("first_response_seconds") / hours).alias("first_response_hours"),
        F.col("status").isin(*RESOLVED_STATUSES).alias("is_resolved"),
    )


def activations(resolved: DataFrame) -> DataFrame:
    """First activation per resolved user."""
    return first_event_time(resolved, "activation", "resolved_user_id", "activation_at")


def attribution_touches(resolved: DataFrame, activated: DataFrame, policy: Policy) -> DataFrame:
    """Events of activated users in the lookback before their activation."""
    opens = shift_time("activation_at", "DAY", -policy.attribution_lookback_days)
    return (
        resolved.select("resolved_user_id", "event_id", "event_time", *TOUCH_FIELDS)
        .join(activated, "resolved_user_id")
        .filter((F.col("event_time") < F.col("activation_at")) & (F.col("event_time") >= opens))
    )


def attribution(resolved: DataFrame, policy: Policy) -> DataFrame:
    """First and last touch before activation, for users with at least one touch.

    Both touches come from one aggregation by user, combined before the shuffle; equal
    times are settled by event id.
    """
    touches = attribution_touches(resolved, activations(resolved), policy)
    touch = F.struct("event_time", "event_id", *TOUCH_FIELDS)
    ends = touches.groupBy("resolved_user_id").agg(
        F.min(touch).alias("first"), F.max(touch).alias("last"), F.min("activation_at").alias("activation_at")
    )

    def side(end: str) -> list:
        fields = [F.col(f"{end}.{c}").alias(f"{end}_touch_{name}") for c, name in TOUCH_FIELDS.items()]
        return [*fields, F.col(f"{end}.event_time").alias(f"{end}_touch_at")]

    return ends.select(
        F.col("resolved_user_id").alias("user_id"), *side("first"), *side("last"), "activation_at"
    )

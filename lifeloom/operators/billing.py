"""Subscriptions, recurring revenue, invoices and checkout conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import MONEY, minus, shift_time
from ..policy import Policy
from .timeline import with_neighbours

# Subscription events after which the subscription is running.
ACTIVE_EVENTS = ("subscription_start", "upgrade", "downgrade", "renewal", "reactivation")
TRIAL_EVENTS = ("trial_start", "trial_end")

SUBSCRIPTION_KEY = ["account_id", "subscription_id"]
SUBSCRIPTION_ORDER = ["event_time", "subscription_event_id"]


def subscription_lifecycle(subscriptions: DataFrame, policy: Policy) -> DataFrame:
    """Subscription events with an active flag and the days since the event before."""
    columns = [c for c in subscriptions.columns if c != "_loaded_at"]
    ordered = with_neighbours(
        subscriptions.select(*columns), SUBSCRIPTION_KEY, "event_time", SUBSCRIPTION_ORDER,
        ["event_time"], policy.billing_slice_seconds,
    )
    return ordered.select(
        *columns,
        F.col("event_type").isin(*ACTIVE_EVENTS).alias("is_active"),
        F.datediff(F.to_date("event_time"), F.to_date("prev.event_time"))
        .cast("bigint")
        .alias("days_since_previous_event"),
    )


def mrr_movements(lifecycle: DataFrame, policy: Policy) -> DataFrame:
    """Classified changes of monthly recurring revenue.

    Trial events are removed first, so a paid start after a trial still counts as new.
    Events that change nothing, such as a renewal at the same price, are dropped.
    """
    paid = lifecycle.filter(~F.col("event_type").isin(*TRIAL_EVENTS)).select(
        "account_id", "subscription_event_id", "subscription_id", "event_type", "event_time", "mrr_amount"
    )
    ordered = with_neighbours(
        paid, SUBSCRIPTION_KEY, "event_time", SUBSCRIPTION_ORDER, ["mrr_amount"],
        policy.billing_slice_seconds,
    )
    kind, after = F.col("event_type"), F.col("mrr_amount")
    before = F.coalesce(F.col("prev.mrr_amount"), F.lit(0).cast(MONEY))
    is_first = F.col("prev.mrr_amount").isNull()
    movement = (
        F.when(is_first & (kind == "subscription_start"), "new")
        .when(kind == "reactivation", "reactivation")
        .when(kind == "cancellation", "churn")
        .when(after > before, "expansion")
        .when((after < before) & (after > 0), "contraction")
    )
    return ordered.select(
        "account_id",
        "subscription_event_id",
        "subscription_id",
        F.to_date("event_time").alias("movement_date"),
        movement.alias("movement_type"),
        before.alias("mrr_before"),
        after.alias("mrr_after"),
        minus(after, before).alias("mrr_delta"),
    ).filter(F.col("movement_type").isNotNull())


def invoices_prep(invoices: DataFrame) -> DataFrame:
    """Invoices with a paid flag and the amount left after refunds."""
    return invoices.select(
        "*",
        (F.col("status") == "paid").alias("is_paid"),
        minus("amount", "refund_amount").alias("net_amount"),
    )


def checkout_conversion(events: DataFrame, lifecycle: DataFrame, policy: Policy) -> DataFrame:
    """Known users' checkouts with the subscription start each one led to, if any.

    A checkout and a subscription start belong together when each is the other's nearest
    (earliest start after the checkout, latest checkout before the start) and they are at
    most the conversion window apart. On the merged timeline of an (account, user) these
    are exactly the checkouts directly followed by a start, so no pairs are built.
    """
    checkouts = events.filter(
        (F.col("event_type") == "checkout_start") & F.col("user_id").isNotNull()
    ).select(
        F.col("event_id").alias("checkout_event_id"),
        "user_id",
        "account_id",
        F.col("event_time").alias("checkout_at"),
        "target_plan",
    )
    moments = checkouts.filter(F.col("account_id").isNotNull()).select(
        "account_id",
        "user_id",
        F.col("checkout_at").alias("at"),
        F.lit(0).alias("kind"),
        F.col("checkout_event_id").alias("id"),
        "target_plan",
    ).unionByName(
        lifecycle.filter(F.col("event_type") == "subscription_start").select(
            "account_id",
            "user_id",
            F.col("event_time").alias("at"),
            F.lit(1).alias("kind"),
            F.col("subscription_event_id").alias("id"),
            F.lit(None).cast("string").alias("target_plan"),
        )
    )
    ordered = with_neighbours(
        moments, ["account_id", "user_id"], "at", ["at", "kind", "id"], ["kind", "at", "id"],
        policy.billing_slice_seconds,
    )
    deadline = shift_time("at", "DAY", policy.checkout_conversion_window_days)
    converted = F.coalesce((F.col("next.kind") == 1) & (F.col("next.at") <= deadline), F.lit(False))
    matched = ordered.filter(F.col("kind") == 0).select(
        F.col("id").alias("checkout_event_id"),
        "user_id",
        "account_id",
        F.col("at").alias("checkout_at"),
        "target_plan",
        F.when(converted, F.col("next.id")).alias("subscription_event_id"),
        F.when(converted, F.col("next.at")).alias("subscription_at"),
    )
    no_account = checkouts.filter(F.col("account_id").isNull()).select(
        "*",
        F.lit(None).cast("string").alias("subscription_event_id"),
        F.lit(None).cast("timestamp").alias("subscription_at"),
    )
    return matched.unionByName(no_account).select(
        "*",
        F.col("subscription_event_id").isNotNull().alias("converted"),
        F.datediff(F.to_date("subscription_at"), F.to_date("checkout_at"))
        .cast("bigint")
        .alias("time_to_conversion_days"),
    )

"""The star schema: dimensions, facts and the user-experiment bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import week_start
from ..functions.keys import date_key, surrogate_key
from ..operators.events import first_event_time
from ..policy import Policy

# Retention periods and their offset in days from the cohort's Monday.
RETENTION_PERIODS = (
    ("W1", 7), ("W2", 14), ("W3", 21), ("W4", 28), ("M2", 60), ("M3", 91), ("M6", 182), ("M12", 365),
)
MEASUREMENT_DAYS = 7
# Subscription events that leave an account in the "active" stage.
ACTIVE_STAGE_EVENTS = ("subscription_start", "renewal", "upgrade", "downgrade")

ENTRY = ("platform", "device_type", "browser", "utm_source", "utm_medium", "utm_campaign")


def _flagged(name: str, source: DataFrame, column: str, flags: Sequence[str]) -> DataFrame:
    """Keys of a source with one flag set, combined map-side later by ``max``."""
    return source.filter(F.col(column).isNotNull()).select(
        column, *[F.lit(f == name).alias(f) for f in flags]
    )


def dim_users(
    events: DataFrame,
    lifecycle: DataFrame,
    tickets: DataFrame,
    engagement: DataFrame,
    memberships: DataFrame,
    attribution: DataFrame,
) -> DataFrame:
    """Every user seen by product, billing or support, with current attributes.

    One aggregation by user yields both the list of users and the three source flags.
    """
    flags = ["is_product_user", "is_billing_user", "is_support_user"]
    users = (
        _flagged("is_product_user", events, "user_id", flags)
        .unionByName(_flagged("is_billing_user", lifecycle, "user_id", flags))
        .unionByName(_flagged("is_support_user", tickets, "user_id", flags))
        .groupBy("user_id")
        .agg(*[F.max(f).alias(f) for f in flags])
    )
    signups = first_event_time(events, "signup", "user_id", "signup_at")
    # Latest start first, then the smallest account id.
    current = (
        memberships.filter(F.col("valid_to").isNull())
        .groupBy("user_id", "valid_from")
        .agg(F.min("account_id").alias("account_id"))
        .groupBy("user_id")
        .agg(F.max_by("account_id", "valid_from").alias("account_id"))
    )
    latest = engagement.groupBy("user_id").agg(
        F.max(F.struct("snapshot_week_start", "engagement_state", "is_re_engaged")).alias("latest")
    )
    touches = attribution.select("user_id", "first_touch_channel", "last_touch_channel", "activation_at")
    wide = users
    for side in (signups, current, touches, latest):
        wide = wide.join(side, "user_id", "left")
    return wide.select(
        surrogate_key("user_id").alias("user_key"),
        "user_id",
        "account_id",
        "signup_at",
        "activation_at",
        surrogate_key("first_touch_channel").alias("first_touch_channel_key"),
        surrogate_key("last_touch_channel").alias("last_touch_channel_key"),
        F.coalesce("latest.engagement_state", F.lit("pre_active")).alias("engagement_state"),
        F.coalesce("latest.is_re_engaged", F.lit(False)).alias("is_re_engaged"),
        *flags,
    )


def dim_accounts(
    memberships: DataFrame,
    lifecycle: DataFrame,
    health: DataFrame,
    tickets: DataFrame,
    attribution: DataFrame,
) -> DataFrame:
    """Every account seen anywhere, with its current subscription, health and acquisition."""
    accounts = memberships.select("account_id")
    for source in (lifecycle, health, tickets):
        accounts = accounts.unionByName(source.select("account_id"))
    accounts = accounts.distinct()

    state = ["plan", "billing_cycle", "mrr_amount", "currency", "event_type", "is_active"]
    current = lifecycle.groupBy("account_id").agg(
        F.max(F.struct("event_time", "subscription_event_id", *state)).alias("sub")
    )
    members = (
        memberships.filter(F.col("valid_to").isNull())
        .groupBy("account_id")
        .agg(F.countDistinct("user_id").alias("user_count"))
    )
    acquired = (
        memberships.select("user_id", "account_id", "valid_from")
        .join(attribution.select("user_id", "first_touch_channel", "activation_at"), "user_id")
        .filter(F.col("valid_from") <= F.col("activation_at"))
        .groupBy("account_id")
        .agg(F.min(F.struct("activation_at", "user_id", "first_touch_channel")).alias("first"))
    )
    scores = health.select("account_id", "health_score", "activity_score", "billing_score", "support_score")
    wide = accounts
    for side in (current, scores, members, acquired):
        wide = wide.join(side, "account_id", "left")
    kind = F.col("sub.event_type")
    stage = (
        F.when(F.col("sub.is_active") & kind.isin(*ACTIVE_STAGE_EVENTS), "active")
        .when(kind == "reactivation", "reactivated")
        .when(kind == "cancellation", "churned")
        .when(kind == "trial_start", "trial")
        .otherwise("unknown")
    )
    return wide.select(
        surrogate_key("account_id").alias("account_key"),
        "account_id",
        *[F.col(f"sub.{c}").alias(c) for c in ("plan", "billing_cycle", "mrr_amount", "currency")],
        "user_count",
        "health_score",
        "activity_score",
        "billing_score",
        "support_score",
        surrogate_key("first.first_touch_channel").alias("acquisition_channel_key"),
        F.to_date("first.activation_at").alias("acquisition_date"),
        stage.alias("lifecycle_stage"),
    )


def dim_channels(attribution: DataFrame, spend: DataFrame) -> DataFrame:
    """Every channel named by a touch or by spend."""
    touched = attribution.select(
        F.explode(F.array_distinct(F.array("first_touch_channel", "last_touch_channel"))).alias("channel")
    )
    channels = touched.unionByName(spend.select("channel")).filter(F.col("channel").isNotNull())
    return channels.distinct().select(surrogate_key("channel").alias("channel_key"), "channel")


def dim_experiments(metadata: DataFrame) -> DataFrame:
    return metadata.select(surrogate_key("experiment_id").alias("experiment_key"), "*")


def dim_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        surrogate_key("session_id").alias("session_key"),
        "session_id",
        date_key("session_date").alias("session_date_key"),
        *ENTRY,
        "session_duration_seconds",
        "event_count",
        "page_view_count",
    )


def fct_sessions(sessions: DataFrame) -> DataFrame:
    return sessions.select(
        surrogate_key("session_id").alias("session_key"),
        "session_id",
        F.col("stitched_user_id").alias("user_id"),
        surrogate_key("stitched_user_id").alias("user_key"),
        date_key("session_date").alias("session_date_key"),
        "session_start_at",
        "session_end_at",
        "session_duration_seconds",
        "event_count",
        "page_view_count",
        *ENTRY,
    )


def fct_invoices(invoices: DataFrame) -> DataFrame:
    return invoices.select(
        surrogate_key("invoice_id").alias("invoice_key"),
        "invoice_id",
        "subscription_id",
        "user_id",
        surrogate_key("user_id").alias("user_key"),
        "account_id",
        surrogate_key("account_id").alias("account_key"),
        date_key("issued_at").alias("issued_date_key"),
        "issued_at",
        "paid_at",
        "amount",
        "currency",
        "status",
        "refund_amount",
        "net_amount",
        "is_paid",
    )


def fct_mrr_movements(movements: DataFrame) -> DataFrame:
    return movements.select(
        surrogate_key("account_id", "subscription_event_id").alias("mrr_movement_key"),
        "account_id",
        surrogate_key("account_id").alias("account_key"),
        "subscription_event_id",
        "subscription_id",
        date_key("movement_date").alias("movement_date_key"),
        "movement_date",
        "movement_type",
        "mrr_before",
        "mrr_after",
        "mrr_delta",
    )


def fct_subscriptions(lifecycle: DataFrame) -> DataFrame:
    return lifecycle.select(
        surrogate_key("subscription_event_id").alias("subscription_event_key"),
        "subscription_event_id",
        "subscription_id",
        "user_id",
        surrogate_key("user_id").alias("user_key"),
        "account_id",
        surrogate_key("account_id").alias("account_key"),
        date_key("event_time").alias("event_date_key"),
        "event_time",
        "event_type",
        "plan",
        "previous_plan",
        "billing_cycle",
        "mrr_amount",
        "currency",
        "cancel_reason",
        "is_voluntary",
        "is_active",
        "days_since_previous_event",
    )


def fct_signups(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "signup").select(
        surrogate_key("event_id").alias("signup_key"),
        "event_id",
        "user_id",
        surrogate_key("user_id").alias("user_key"),
        date_key("event_date").alias("signup_date_key"),
        F.col("event_time").alias("signup_at"),
        "signup_method",
        "channel",
        surrogate_key("channel").alias("channel_key"),
        *ENTRY,
    )


def fct_activations(attribution: DataFrame) -> DataFrame:
    return attribution.select(
        surrogate_key("user_id", F.to_date("activation_at")).alias("activation_key"),
        "user_id",
        surrogate_key("user_id").alias("user_key"),
        date_key("activation_at").alias("activation_date_key"),
        "activation_at",
        surrogate_key("first_touch_channel").alias("first_touch_channel_key"),
        surrogate_key("last_touch_channel").alias("last_touch_channel_key"),
        "first_touch_channel",
        "last_touch_channel",
    )


def fct_retention_cohorts(
    attribution: DataFrame,
    resolved: DataFrame,
    policy: Policy,
    periods: Sequence[tuple[str, int]] = RETENTION_PERIODS,
) -> DataFrame:
    """Share of each activation week's users active in the 7 days of every period.

    Activity shrinks to (user, day) before it meets the cohorts, each day is mapped to the
    periods holding it, and users are counted once per period. No user-by-period grid is
    built: cohort sizes come from a plain count per week.
    """
    table = F.array(
        *[
            F.struct(F.lit(p).alias("retention_period"), F.lit(d).cast("bigint").alias("period_offset_days"))
            for p, d in periods
        ]
    )
    cohort = attribution.select(
        "user_id", week_start(F.to_date("activation_at")).alias("cohort_week_start_date")
    )
    active_days = resolved.select(
        F.col("resolved_user_id").alias("user_id"), F.to_date("event_time").alias("day")
    ).distinct()
    day_offset = F.datediff("day", "cohort_week_start_date")
    retained = (
        active_days.join(cohort, "user_id")
        .select(
            "user_id",
            "cohort_week_start_date",
            F.explode(
                F.filter(
                    table,
                    lambda p: (day_offset >= p.period_offset_days)
                    & (day_offset < p.period_offset_days + MEASUREMENT_DAYS),
                )
            ).alias("p"),
        )
        .select("user_id", "cohort_week_start_date", "p.retention_period")
        .distinct()
        .groupBy("cohort_week_start_date", "retention_period")
        .agg(F.count(F.lit(1)).alias("retained_count"))
    )
    sizes = (
        cohort.groupBy("cohort_week_start_date")
        .agg(F.count(F.lit(1)).alias("cohort_size"))
        .select("cohort_week_start_date", "cohort_size", F.inline(table))
    )
    week = F.col("cohort_week_start_date")
    period_end = F.date_add(week, (F.col("period_offset_days") + (MEASUREMENT_DAYS - 1)).cast("int"))
    kept = F.coalesce("retained_count", F.lit(0).cast("bigint"))
    return sizes.join(retained, ["cohort_week_start_date", "retention_period"], "left").select(
        surrogate_key(week, "retention_period").alias("retention_cohort_key"),
        "cohort_week_start_date",
        date_key(week).alias("cohort_week_date_key"),
        "retention_period",
        "period_offset_days",
        period_end.alias("period_end_date"),
        date_key(period_end).alias("period_end_date_key"),
        "cohort_size",
        kept.alias("retained_count"),
        F.try_divide(kept.cast("double"), F.col("cohort_size").cast("double")).alias("retention_rate"),
        (F.date_add(period_end, policy.retention_maturity_guard_days) <= policy.as_of_date()).alias(
            "is_period_complete"
        ),
    )


def fct_marketing_spend(spend: DataFrame) -> DataFrame:
    return spend.select(
        surrogate_key("spend_id").alias("spend_key"),
        "spend_id",
        date_key("spend_date").alias("spend_date_key"),
        "channel",
        surrogate_key("channel").alias("channel_key"),
        "campaign_id",
        "campaign_name",
        "spend_amount",
        "currency",
        "impressions",
        "clicks",
    )


def fct_experiment_exposures(results: DataFrame) -> DataFrame:
    return results.select(
        "user_id",
        surrogate_key("user_id").alias("user_key"),
        "experiment_id",
        surrogate_key("experiment_id").alias("experiment_key"),
        "variant",
        "first_exposure_at",
        date_key("first_exposure_at").alias("exposure_date_key"),
        "converted",
        "conversion_at",
        "exposure_duration_hours",
    )


def bridge_user_experiments(results: DataFrame) -> DataFrame:
    return results.select(
        surrogate_key("user_id").alias("user_key"),
        "user_id",
        surrogate_key("experiment_id").alias("experiment_key"),
        "variant",
        "first_exposure_at",
    )


def fct_feature_usage(events: DataFrame) -> DataFrame:
    used = events.filter((F.col("event_type") == "feature_use") & F.col("user_id").isNotNull())
    return used.select(
        surrogate_key("event_id").alias("feature_usage_key"),
        "event_id",
        "user_id",
        surrogate_key("user_id").alias("user_key"),
        "account_id",
        surrogate_key("account_id").alias("account_key"),
        date_key("event_date").alias("usage_date_key"),
        F.col("event_time").alias("usage_at"),
        "feature_name",
        "feature_duration_seconds",
        "platform",
        "device_type",
    )


def fct_support_tickets(tickets: DataFrame) -> DataFrame:
    return tickets.select(
        surrogate_key("ticket_id").alias("ticket_key"),
        "ticket_id",
        "user_id",
        surrogate_key("user_id").alias("user_key"),
        "account_id",
        surrogate_key("account_id").alias("account_key"),
        date_key("created_at").alias("created_date_key"),
        "created_at",
        "resolved_at",
        "category",
        "priority",
        "status",
        "csat_score",
        "resolution_time_hours",
        "first_response_hours",
        "is_resolved",
    )

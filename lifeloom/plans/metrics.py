"""The metric catalogue: named aggregates over marts, by any dimensions and time grain."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import MONEY
from ..policy import Policy

GRAINS = ("DAY", "WEEK", "MONTH", "QUARTER", "YEAR")

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class Metric:
    table: str
    how: str  # sum | count_distinct | average
    column: str
    time: str  # SQL expression giving the row's time

    def aggregate(self) -> Column:
        make = {"sum": F.sum, "count_distinct": F.count_distinct, "average": F.avg}[self.how]
        return make(F.col(self.column))


_SPEND_DAY = "to_date(cast(spend_date_key as string), 'yyyyMMdd')"

# The declared metrics.
METRICS: dict[str, Metric] = {
    "subscription_mrr": Metric("fct_subscriptions", "sum", "mrr_amount", "event_time"),
    "net_mrr": Metric("fct_mrr_movements", "sum", "mrr_delta", "movement_date"),
    "invoices": Metric("fct_invoices", "count_distinct", "invoice_key", "issued_at"),
    "invoice_amount": Metric("fct_invoices", "sum", "amount", "issued_at"),
    "net_revenue": Metric("fct_invoices", "sum", "net_amount", "issued_at"),
    "total_mrr": Metric("dim_accounts", "sum", "mrr_amount", "acquisition_date"),
    "total_users": Metric("dim_accounts", "sum", "user_count", "acquisition_date"),
    "avg_health_score": Metric("dim_accounts", "average", "health_score", "acquisition_date"),
    "signups": Metric("fct_signups", "count_distinct", "signup_key", "signup_at"),
    "activations": Metric("fct_activations", "count_distinct", "activation_key", "activation_at"),
    "total_cohort_size": Metric("fct_retention_cohorts", "sum", "cohort_size", "cohort_week_start_date"),
    "total_retained_users": Metric("fct_retention_cohorts", "sum", "retained_count", "cohort_week_start_date"),
    "avg_retention_rate": Metric("fct_retention_cohorts", "average", "retention_rate", "cohort_week_start_date"),
    "marketing_spend": Metric("fct_marketing_spend", "sum", "spend_amount", _SPEND_DAY),
    "total_impressions": Metric("fct_marketing_spend", "sum", "impressions", _SPEND_DAY),
    "total_clicks": Metric("fct_marketing_spend", "sum", "clicks", _SPEND_DAY),
    "feature_usages": Metric("fct_feature_usage", "count_distinct", "feature_usage_key", "usage_at"),
    "sessions": Metric("fct_sessions", "count_distinct", "session_key", "session_start_at"),
    "avg_session_duration_seconds": Metric("fct_sessions", "average", "session_duration_seconds", "session_start_at"),
    "events": Metric("fct_sessions", "sum", "event_count", "session_start_at"),
    "tickets": Metric("fct_support_tickets", "count_distinct", "ticket_key", "created_at"),
    "avg_csat": Metric("fct_support_tickets", "average", "csat_score", "created_at"),
    "avg_resolution_time_hours": Metric("fct_support_tickets", "average", "resolution_time_hours", "created_at"),
}

# The metrics shown together on each dashboard.
METRIC_SETS: dict[str, tuple[str, ...]] = {
    "product_analytics": (
        "sessions", "avg_session_duration_seconds", "events", "feature_usages", "signups",
        "activations", "total_users", "avg_health_score",
    ),
    "revenue": ("net_mrr", "subscription_mrr", "invoices", "invoice_amount", "net_revenue", "total_mrr"),
    "growth_and_retention": (
        "total_cohort_size", "total_retained_users", "avg_retention_rate", "marketing_spend",
        "total_impressions", "total_clicks",
    ),
}


def period(time: str | Column, grain: str) -> Column:
    """First day of the period holding ``time``; weeks start on Monday."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain: {grain!r}")
    return F.to_date(F.date_trunc(grain, F.expr(time) if isinstance(time, str) else time)).alias("period")


def metrics(
    tables: Tables, names: Sequence[str], by: Sequence[str] = (), grain: str | None = None
) -> DataFrame:
    """Several metrics of one mart in a single aggregation, one column each."""
    specs = [METRICS[n] for n in names]
    if len({s.table for s in specs}) != 1 or len({s.time for s in specs}) != 1:
        raise ValueError("metrics computed together must share a mart")
    keys = [F.col(c) for c in by]
    if grain is not None:
        keys.insert(0, period(specs[0].time, grain))
    return (
        tables[specs[0].table].groupBy(*keys).agg(*[s.aggregate().alias(n) for n, s in zip(names, specs)])
    )


def metric(tables: Tables, name: str, by: Sequence[str] = (), grain: str | None = None) -> DataFrame:
    """One metric by the given dimensions and, with ``grain``, by ``period``."""
    return metrics(tables, [name], by, grain)


def metric_set(tables: Tables, name: str, grain: str) -> DataFrame:
    """A dashboard's metrics as rows of ``metric``, ``period`` and ``value``.

    Each mart is read and aggregated once for all of its metrics.
    """
    by_mart: dict[str, list[str]] = {}
    for m in METRIC_SETS[name]:
        by_mart.setdefault(METRICS[m].table, []).append(m)
    parts = []
    for names in by_mart.values():
        wide = metrics(tables, names, grain=grain)
        wide = wide.select("period", *[F.col(n).cast("double").alias(n) for n in names])
        parts.append(wide.unpivot("period", names, "metric", "value"))
    return reduce(DataFrame.unionByName, parts)


def weighted_retention_rate(cohorts: DataFrame, by: Sequence[str] = ("retention_period",)) -> DataFrame:
    """Retention weighted by cohort size instead of averaged over cohorts."""
    return cohorts.groupBy(*by).agg(
        F.try_divide(F.sum("retained_count").cast("double"), F.sum("cohort_size").cast("double")).alias(
            "weighted_retention_rate"
        )
    )


def activation_rate(signups: DataFrame, activations: DataFrame, grain: str = "WEEK") -> DataFrame:
    """Activated share of the users who first signed up in each period."""
    cohort = (
        signups.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.min("signup_at").alias("signup_at"))
    )
    activated = activations.select("user_id", F.lit(1).alias("activated")).distinct()
    return (
        cohort.join(activated, "user_id", "left")
        .groupBy(period("signup_at", grain))
        .agg(F.count(F.lit(1)).alias("signed_up_users"), F.count("activated").alias("activated_users"))
        .withColumn(
            "activation_rate",
            F.try_divide(F.col("activated_users").cast("double"), F.col("signed_up_users").cast("double")),
        )
    )


def cumulative_net_mrr(movements: DataFrame, grain: str = "MONTH", by: Sequence[str] = ()) -> DataFrame:
    """Net MRR per period and its running total, in total or per dimension.

    Movements are summed per period first, so the running total sees one row per period.
    """
    per_period = movements.groupBy(period("movement_date", grain), *by).agg(F.sum("mrr_delta").alias("net_mrr"))
    so_far = Window.partitionBy(*by).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return per_period.withColumn("cumulative_mrr", F.sum("net_mrr").over(so_far))


def net_revenue_retention(movements: DataFrame, policy: Policy, grain: str = "MONTH") -> DataFrame:
    """(Starting MRR + expansion - contraction - churn) / starting MRR.

    One row per account cohort (period of the account's first movement) and later period up
    to ``as_of``. Only accounts with MRR at the start of a period take part in it.
    """
    zero = F.lit(0).cast(MONEY)
    kind, delta = F.col("movement_type"), F.col("mrr_delta")
    monthly = movements.groupBy("account_id", period("movement_date", grain)).agg(
        F.sum(delta).alias("net"),
        *[
            F.sum(F.when(kind == k, delta).otherwise(zero)).alias(k)
            for k in ("expansion", "contraction", "churn")
        ],
    )
    account = Window.partitionBy("account_id")
    before = account.orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    started = monthly.withColumn("cohort", F.min("period").over(account)).withColumn(
        "start_mrr", F.coalesce(F.sum("net").over(before), zero)
    )
    had_mrr = F.col("start_mrr") > 0
    moved = started.groupBy("cohort", "period").agg(
        F.sum("net").alias("net"),
        *[F.sum(F.when(had_mrr, F.col(k)).otherwise(zero)).alias(k) for k in ("expansion", "contraction", "churn")],
    )
    # Periods without movements keep their starting MRR: list all periods of each cohort.
    step = {"DAY": "1 day", "WEEK": "7 days", "MONTH": "1 month", "QUARTER": "3 months", "YEAR": "1 year"}[grain]
    last = F.to_date(F.date_trunc(grain, policy.as_of_time()))
    grid = (
        moved.groupBy("cohort")
        .agg(F.max("period").alias("last_move"))
        .select("cohort", F.explode(F.sequence("cohort", F.greatest("last_move", last), F.expr(f"interval {step}"))).alias("period"))
    )
    full = grid.join(moved, ["cohort", "period"], "left")
    earlier = Window.partitionBy("cohort").orderBy("period").rowsBetween(Window.unboundedPreceding, -1)
    named = full.select(
        "cohort",
        "period",
        F.sum("net").over(earlier).alias("starting_mrr"),
        F.coalesce("expansion", zero).alias("expansion"),
        (-F.coalesce("contraction", zero)).alias("contraction"),
        (-F.coalesce("churn", zero)).alias("churn"),
    ).filter(F.col("period") > F.col("cohort"))
    money = [F.col(c).cast("double") for c in ("starting_mrr", "expansion", "contraction", "churn")]
    start, expansion, contraction, churn = money
    return named.withColumn(
        "net_revenue_retention", F.try_divide(start + expansion - contraction - churn, start)
    )


def variant_conversion(exposures: DataFrame) -> DataFrame:
    """Converted share of the users exposed to each variant."""
    return exposures.groupBy("experiment_id", "variant").agg(
        F.count(F.lit(1)).alias("exposed_users"),
        F.count_if("converted").alias("converted_users"),
        F.avg(F.col("converted").cast("double")).alias("conversion_rate"),
    )


def time_to_activate(events: DataFrame, grain: str = "WEEK") -> DataFrame:
    """Average hours to activate, as carried on activation events."""
    return events.filter(F.col("event_type") == "activation").groupBy(period("event_time", grain)).agg(
        F.count("time_to_activate_hours").alias("measured"),
        F.avg("time_to_activate_hours").alias("avg_time_to_activate_hours"),
    )

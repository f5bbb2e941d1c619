"""What is declared about every table's columns and keys, and how it is checked in few passes.

Row rules (required columns, accepted values, ranges, named rules) are counted while a table is
written, by an observation on the rows that pass through; where a table is not written they take
one pass over it. Uniqueness takes one scan per table for all its keys, and the foreign keys of all
tables one scan per child and a single anti-join against the keys of all parents.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import all_of
from ..sources.contracts import MARTS, STAGED, required

# --- fixed values: declarations ---------------------------------------------------------------

#: Required columns of tables that have no contract of their own.
REQUIRED = {
    "experiments": "experiment_id experiment_name status start_date",
    "events_normalized": "event_id anon_id event_time _loaded_at event_date event_type",
    "identity_stitched": "anon_id user_id valid_from stitch_source",
    "sessions": "session_id anon_id session_start_at session_end_at session_duration_seconds event_count session_date",
    "account_memberships": "user_id account_id valid_from membership_duration_days",
    "funnel_staged": "user_id stage stage_ordinal stage_reached_at is_current_stage",
    "subscription_lifecycle": "subscription_event_id subscription_id user_id account_id event_type event_time plan "
    "billing_cycle mrr_amount currency is_active",
    "mrr_movements": "account_id subscription_event_id subscription_id movement_date movement_type mrr_before mrr_after mrr_delta",
    "invoices_prep": "invoice_id subscription_id user_id account_id issued_at _loaded_at amount currency status "
    "refund_amount is_paid net_amount",
    "checkout_conversion": "checkout_event_id user_id checkout_at converted",
    "spend_prep": "spend_id spend_date channel campaign_id spend_amount currency _loaded_at",
    "ticket_metrics": "ticket_id user_id account_id created_at category priority status is_resolved",
    "attribution": "user_id first_touch_at last_touch_channel last_touch_at activation_at",
    "engagement_states": "user_id snapshot_week_start engagement_state is_re_engaged",
    "experiment_results": "user_id experiment_id variant first_exposure_at converted exposure_duration_hours",
    "account_health": "account_id health_score activity_score billing_score support_score calculated_at trailing_window_days",
}
#: Columns required only where a condition holds.
REQUIRED_WHERE = {"attribution": {"first_touch_channel": "activation_at is not null"}}

PLANS = "free starter pro enterprise"
CYCLES = "monthly annual"
CHANNELS = "organic paid_search paid_social referral email direct"
METHODS = "email google github"
MOVEMENTS = "new expansion contraction churn reactivation"
STATES = "pre_active active dormant disengaged"
BILLING_EVENTS = "trial_start trial_end subscription_start upgrade downgrade renewal cancellation reactivation"
CATEGORIES = "bug feature_request billing onboarding other"
PRIORITIES = "low medium high critical"
TICKET_STATES = "open in_progress resolved closed"
INVOICE_STATES = "paid pending failed refunded"
CURRENCIES = "USD EUR"

#: Accepted values; NULL passes.
ACCEPTED = {
    "stg_events": {
        "event_type": "page_view signup activation feature_use paywall_view checkout_start upgrade_click "
        "member_invited member_joined member_removed",
        "platform": "web ios android",
        "channel": CHANNELS,
        "plan_context": PLANS,
        "device_type": "desktop mobile tablet",
        "signup_method": METHODS,
        "billing_cycle": CYCLES,
    },
    "stg_subscriptions": {"event_type": BILLING_EVENTS, "plan": PLANS, "previous_plan": PLANS, "billing_cycle": CYCLES},
    "stg_invoices": {"status": INVOICE_STATES},
    "stg_spend": {"channel": CHANNELS},
    "stg_tickets": {"category": CATEGORIES, "priority": PRIORITIES, "status": TICKET_STATES},
    "mrr_movements": {"movement_type": MOVEMENTS},
    "engagement_states": {"engagement_state": STATES},
    "identity_stitched": {"stitch_source": "last_touch historical"},
    "funnel_staged": {"stage": "page_view signup activation feature_use checkout_start"},
    "dim_users": {"engagement_state": STATES},
    "dim_accounts": {"lifecycle_stage": "trial active churned reactivated unknown"},
    "dim_experiments": {"status": "active completed paused"},
    "fct_subscriptions": {
        "event_type": BILLING_EVENTS, "plan": PLANS, "previous_plan": PLANS, "billing_cycle": CYCLES, "currency": CURRENCIES,
    },
    "fct_mrr_movements": {"movement_type": MOVEMENTS},
    "fct_invoices": {"currency": CURRENCIES, "status": INVOICE_STATES},
    "fct_signups": {"signup_method": METHODS},
    "fct_retention_cohorts": {"retention_period": "W1 W2 W3 W4 M2 M3 M6 M12"},
    "fct_experiment_exposures": {"variant": "control treatment"},
    "fct_feature_usage": {
        "feature_name": "alert_create api_call chart_edit dashboard_view data_export filter_apply integration_setup "
        "report_create share_report template_use"
    },
    "fct_support_tickets": {"category": CATEGORIES, "priority": PRIORITIES, "status": TICKET_STATES},
}
#: Lowest and highest value; NULL passes.
RANGES: dict[str, dict[str, tuple[int, int | None]]] = {
    "stg_subscriptions": {"mrr_amount": (0, None)},
    "stg_invoices": {"amount": (0, None), "refund_amount": (0, None)},
    "stg_spend": {"spend_amount": (0, None)},
    "stg_tickets": {"csat_score": (1, 5)},
    "subscription_lifecycle": {"days_since_previous_event": (0, None)},
    "ticket_metrics": {"resolution_time_hours": (0, None), "first_response_hours": (0, None)},
    "account_health": {c: (0, 100) for c in ("health_score", "activity_score", "billing_score", "support_score")},
    "experiment_results": {"exposure_duration_hours": (24, None)},
    "account_memberships": {"membership_duration_days": (0, None)},
    "sessions": {"session_duration_seconds": (0, None), "event_count": (1, None)},
}
#: Columns, or combinations of columns, that identify a row.
UNIQUE = {
    "stg_subscriptions": ["subscription_event_id"],
    "stg_invoices": ["invoice_id"],
    "stg_spend": ["spend_id"],
    "stg_tickets": ["ticket_id"],
    "experiments": ["experiment_id"],
    "events_normalized": ["event_id"],
    "identity_stitched": ["anon_id, valid_from"],
    "sessions": ["session_id"],
    "account_memberships": ["user_id, account_id, valid_from"],
    "funnel_staged": ["user_id, stage"],
    "subscription_lifecycle": ["subscription_event_id"],
    "mrr_movements": ["account_id, subscription_event_id"],
    "invoices_prep": ["invoice_id"],
    "checkout_conversion": ["checkout_event_id"],
    "spend_prep": ["spend_id"],
    "ticket_metrics": ["ticket_id"],
    "attribution": ["user_id"],
    "engagement_states": ["user_id, snapshot_week_start"],
    "experiment_results": ["user_id, experiment_id"],
    "account_health": ["account_id"],
    "dim_users": ["user_key", "user_id"],
    "dim_accounts": ["account_key", "account_id"],
    "dim_channels": ["channel_key", "channel"],
    "dim_experiments": ["experiment_key", "experiment_id"],
    "dim_sessions": ["session_key", "session_id"],
    "dim_date": ["date_key", "date_day"],
    "fct_sessions": ["session_key", "session_id"],
    "fct_invoices": ["invoice_key", "invoice_id"],
    "fct_mrr_movements": ["mrr_movement_key", "account_id, subscription_event_id"],
    "fct_subscriptions": ["subscription_event_key", "subscription_event_id"],
    "fct_signups": ["signup_key", "event_id"],
    "fct_activations": ["activation_key", "user_id"],
    "fct_retention_cohorts": ["retention_cohort_key", "cohort_week_start_date, retention_period"],
    "fct_marketing_spend": ["spend_key", "spend_id"],
    "fct_experiment_exposures": ["user_key, experiment_key"],
    "bridge_user_experiments": ["user_key, experiment_key"],
    "fct_feature_usage": ["feature_usage_key", "event_id"],
    "fct_support_tickets": ["ticket_key", "ticket_id"],
}
#: Key column of each parent.
PARENT_KEYS = {
    "dim_users": "user_key",
    "dim_accounts": "account_key",
    "dim_channels": "channel_key",
    "dim_experiments": "experiment_key",
    "dim_sessions": "session_key",
    "dim_date": "date_key",
}
#: Foreign keys of each child as column:parent; NULL passes.
FOREIGN_KEYS = {
    "dim_users": "first_touch_channel_key:dim_channels last_touch_channel_key:dim_channels",
    "dim_accounts": "acquisition_channel_key:dim_channels",
    "dim_sessions": "session_date_key:dim_date",
    "fct_sessions": "session_key:dim_sessions user_key:dim_users session_date_key:dim_date",
    "fct_invoices": "user_key:dim_users account_key:dim_accounts issued_date_key:dim_date",
    "fct_mrr_movements": "account_key:dim_accounts movement_date_key:dim_date",
    "fct_subscriptions": "user_key:dim_users account_key:dim_accounts event_date_key:dim_date",
    "fct_signups": "user_key:dim_users signup_date_key:dim_date channel_key:dim_channels",
    "fct_activations": "user_key:dim_users activation_date_key:dim_date first_touch_channel_key:dim_channels "
    "last_touch_channel_key:dim_channels",
    "fct_retention_cohorts": "cohort_week_date_key:dim_date period_end_date_key:dim_date",
    "fct_marketing_spend": "spend_date_key:dim_date channel_key:dim_channels",
    "fct_experiment_exposures": "user_key:dim_users experiment_key:dim_experiments exposure_date_key:dim_date",
    "bridge_user_experiments": "user_key:dim_users experiment_key:dim_experiments",
    "fct_feature_usage": "user_key:dim_users account_key:dim_accounts usage_date_key:dim_date",
    "fct_support_tickets": "user_key:dim_users account_key:dim_accounts created_date_key:dim_date",
}
#: Foreign keys that count only where a condition holds.
KEY_WHERE = {("fct_retention_cohorts", "period_end_date_key"): "is_period_complete"}
#: Age in hours from which a source warns and fails.
FRESHNESS = {f"stg_{name}": (24, 48) for name in STAGED}

TABLES = tuple(dict.fromkeys([*(f"stg_{n}" for n in STAGED), *REQUIRED, *MARTS]))

# --- row rules --------------------------------------------------------------------------------


def required_columns(table: str) -> list[str]:
    return REQUIRED[table].split() if table in REQUIRED else required(table)


def row_checks(table: str, rules: Mapping[str, str] | None = None) -> dict[str, Column]:
    """Name and violation of every row rule of a table; ``rules`` are further ones that must hold."""
    checks = {f"{table}.{c} not null": F.col(c).isNull() for c in required_columns(table)}
    for c, where in REQUIRED_WHERE.get(table, {}).items():
        checks[f"{table}.{c} not null"] = F.col(c).isNull() & F.expr(where)
    for c, values in ACCEPTED.get(table, {}).items():
        checks[f"{table}.{c} accepted"] = ~F.col(c).isin(*values.split())
    for c, (low, high) in RANGES.get(table, {}).items():
        checks[f"{table}.{c} range"] = (F.col(c) < low) if high is None else ~F.col(c).between(low, high)
    return checks | {name: ~F.expr(rule) for name, rule in (rules or {}).items()}


@dataclass
class Counted:
    """A table with an observation on it: once it is written, :meth:`failures` has the counts."""

    rows: DataFrame
    names: list[str]
    observation: Observation

    def failures(self) -> dict[str, int]:
        found = self.observation.get
        return {name: int(found[f"c{i}"]) for i, name in enumerate(self.names)}


def counted(table: str, df: DataFrame, rules: Mapping[str, str] | None = None) -> Counted:
    """``df`` with its row rules counted on the way of the next action over all of it.

    Also counts whether there is any row at all, as ``<table> populated`` for the marts.
    """
    checks = _counts(table, rules)
    observation = Observation()
    rows = df.observe(observation, *(c.alias(f"c{i}") for i, c in enumerate(checks.values())))
    return Counted(rows, list(checks), observation)


def _counts(table: str, rules: Mapping[str, str] | None) -> dict[str, Column]:
    counts = {name: F.count_if(bad) for name, bad in row_checks(table, rules).items()}
    if table in MARTS:
        counts[f"{table} populated"] = F.when(F.count(F.lit(1)) == 0, 1).otherwise(0)
    return counts


def row_failures(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    names: Iterable[str] = TABLES,
    observed: Mapping[str, Mapping[str, int]] | None = None,
    rules: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """``check_name`` and ``failures`` of all row rules; tables without observed counts take one pass each."""
    observed, rules = observed or {}, rules or {}
    known = [(n, f) for t in names if t in observed for n, f in observed[t].items()]
    parts = [spark.createDataFrame(known, "check_name string, failures bigint")]
    for t in names:
        if t not in observed:
            counts = _counts(t, rules.get(t))
            found = tables[t].agg(*(c.cast("bigint").alias(n) for n, c in counts.items()))
            parts.append(found.unpivot([], [F.col(f"`{n}`") for n in counts], "check_name", "failures"))
    return reduce(DataFrame.unionByName, parts)


# --- keys -------------------------------------------------------------------------------------


def _named(spark: SparkSession, found: DataFrame, names: Sequence[str]) -> DataFrame:
    """``found`` with a zero for every check that found nothing."""
    every = spark.createDataFrame([(n,) for n in names], "check_name string")
    return every.join(found, "check_name", "left").select("check_name", F.coalesce("failures", F.lit(0)).alias("failures"))


def unique_failures(
    spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Rows whose key another row has too, for all keys of all tables; one scan per table.

    A single column's NULLs are left out, as part of a combination NULL is a value. Keys are compared
    by 128 bits of hash.
    """
    names, parts = [], []
    for table, combinations in (UNIQUE if keys is None else keys).items():
        tagged = []
        for combination in combinations:
            columns = combination.split(", ")
            names.append(f"{table}.{combination} unique")
            texts = [F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in columns]
            key = F.struct(
                F.lit(names[-1]).alias("check_name"), F.xxhash64(*texts).alias("high"), F.xxhash64(F.lit(1), *texts).alias("low")
            )
            tagged.append(key if len(columns) > 1 else F.when(F.col(columns[0]).isNotNull(), key))
        parts.append(tables[table].select(F.explode(F.array(*tagged)).alias("k")).filter("k is not null").select("k.*"))
    n = reduce(DataFrame.unionByName, parts).groupBy("check_name", "high", "low").agg(F.count(F.lit(1)).alias("n"))
    return _named(spark, n.filter("n > 1").groupBy("check_name").agg(F.sum("n").alias("failures")), names)


def orphans(
    spark: SparkSession, tables: Mapping[str, DataFrame], keys: Mapping[str, str] | None = None
) -> DataFrame:
    """Rows whose foreign key no parent has, for all foreign keys.

    Every child is scanned once and its rows counted per key before they are compared, so a frequent
    key costs one row; the keys of all parents meet them in a single anti-join.
    """
    names, parts, parents = [], [], set()
    for child, pairs in (FOREIGN_KEYS if keys is None else keys).items():
        tagged = []
        for column, _, parent in (p.partition(":") for p in pairs.split()):
            names.append(f"{child}.{column} -> {parent}")
            parents.add(parent)
            counts = F.expr(KEY_WHERE.get((child, column), "true"))
            key = F.struct(F.lit(names[-1]).alias("check_name"), F.lit(parent).alias("parent"), F.col(column).alias("key"))
            tagged.append(F.when(all_of([F.col(column).isNotNull(), counts]), key))
        rows = tables[child].select(F.explode(F.array(*tagged)).alias("k")).filter("k is not null").select("k.*")
        parts.append(rows.groupBy("check_name", "parent", "key").agg(F.count(F.lit(1)).alias("n")))
    known = [
        tables[p].select(F.lit(p).alias("parent"), F.col(PARENT_KEYS[p]).alias("key")).distinct() for p in sorted(parents)
    ]
    missing = reduce(DataFrame.unionByName, parts).join(reduce(DataFrame.unionByName, known), ["parent", "key"], "left_anti")
    return _named(spark, missing.groupBy("check_name").agg(F.sum("n").alias("failures")), names)

"""Table contracts: column names and types of sources and marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import MONEY

# The column contracts, as Spark DDL.
RAW = {
    "events": """
        event_id string, event_time timestamp, ingest_time timestamp, _loaded_at timestamp,
        event_date date, event_type string, user_id string, anon_id string, account_id string,
        platform string, channel string, plan_context string, utm_source string,
        utm_medium string, utm_campaign string, utm_term string, utm_content string,
        device_type string, browser string, os string, user_agent string,
        properties string, experiment_flags string""",
    "subscriptions": f"""
        subscription_event_id string, subscription_id string, user_id string, account_id string,
        event_type string, event_time timestamp, _loaded_at timestamp, plan string,
        previous_plan string, billing_cycle string, mrr_amount {MONEY}, currency string,
        cancel_reason string, is_voluntary boolean""",
    "invoices": f"""
        invoice_id string, subscription_id string, user_id string, account_id string,
        issued_at timestamp, paid_at timestamp, _loaded_at timestamp, amount {MONEY},
        currency string, status string, refund_amount {MONEY}, line_items string""",
    "spend": f"""
        spend_id string, date date, channel string, campaign_id string, campaign_name string,
        impressions bigint, clicks bigint, spend_amount {MONEY}, currency string,
        _loaded_at timestamp""",
    "tickets": """
        ticket_id string, user_id string, account_id string, created_at timestamp,
        resolved_at timestamp, _loaded_at timestamp, category string, priority string,
        status string, csat_score bigint, first_response_seconds bigint""",
}

EXPERIMENT_METADATA = """
    experiment_id string, experiment_name string, status string, start_date date,
    end_date date, description string"""

STAGED_EVENTS = """
    event_id string, user_id string, anon_id string, account_id string, event_time timestamp,
    ingest_time timestamp, _loaded_at timestamp, event_date date, event_type string,
    platform string, channel string, plan_context string, utm_source string,
    utm_medium string, utm_campaign string, utm_term string, utm_content string,
    device_type string, browser string, os string, user_agent string, page_url string,
    referrer string, signup_method string, activation_action string,
    time_to_activate_hours double, feature_name string, feature_duration_seconds bigint,
    source_page string, target_plan string, billing_cycle string, member_role string,
    member_reason string, experiment_flags string"""

STAGED = {
    "events": STAGED_EVENTS,
    "subscriptions": RAW["subscriptions"],
    "invoices": RAW["invoices"],
    "spend": RAW["spend"].replace(" date date,", " spend_date date,"),
    "tickets": RAW["tickets"],
}

ENTRY = """platform string, device_type string, browser string, utm_source string,
    utm_medium string, utm_campaign string"""

MARTS = {
    "dim_users": """
        user_key bigint, user_id string, account_id string, signup_at timestamp,
        activation_at timestamp, first_touch_channel_key bigint, last_touch_channel_key bigint,
        engagement_state string, is_re_engaged boolean, is_product_user boolean,
        is_billing_user boolean, is_support_user boolean""",
    "dim_accounts": f"""
        account_key bigint, account_id string, plan string, billing_cycle string,
        mrr_amount {MONEY}, currency string, user_count bigint, health_score double,
        activity_score double, billing_score double, support_score double,
        acquisition_channel_key bigint, acquisition_date date, lifecycle_stage string""",
    "dim_channels": "channel_key bigint, channel string",
    "dim_experiments": f"experiment_key bigint, {EXPERIMENT_METADATA}",
    "dim_sessions": f"""
        session_key bigint, session_id string, session_date_key bigint, {ENTRY},
        session_duration_seconds bigint, event_count bigint, page_view_count bigint""",
    "dim_date": """
        date_key bigint, date_day date, day_of_week bigint, day_name string, day_of_month bigint,
        day_of_year bigint, week_start_date date, month_start_date date, month_name string,
        month_number bigint, quarter_number bigint, quarter_start_date date, year_number bigint,
        is_weekend boolean""",
    "fct_sessions": f"""
        session_key bigint, session_id string, user_id string, user_key bigint,
        session_date_key bigint, session_start_at timestamp, session_end_at timestamp,
        session_duration_seconds bigint, event_count bigint, page_view_count bigint, {ENTRY}""",
    "fct_invoices": f"""
        invoice_key bigint, invoice_id string, subscription_id string, user_id string,
        user_key bigint, account_id string, account_key bigint, issued_date_key bigint,
        issued_at timestamp, paid_at timestamp, amount {MONEY}, currency string, status string,
        refund_amount {MONEY}, net_amount {MONEY}, is_paid boolean""",
    "fct_mrr_movements": f"""
        mrr_movement_key bigint, account_id string, account_key bigint,
        subscription_event_id string, subscription_id string, movement_date_key bigint,
        movement_date date, movement_type string, mrr_before {MONEY}, mrr_after {MONEY},
        mrr_delta {MONEY}""",
    "fct_subscriptions": f"""
        subscription_event_key bigint, subscription_event_id string, subscription_id string,
        user_id string, user_key bigint, account_id string, account_key bigint,
        event_date_key bigint, event_time timestamp, event_type string, plan string,
        previous_plan string, billing_cycle string, mrr_amount {MONEY}, currency string,
        cancel_reason string, is_voluntary boolean, is_active boolean,
        days_since_previous_event bigint""",
    "fct_signups": f"""
        signup_key bigint, event_id string, user_id string, user_key bigint,
        signup_date_key bigint, signup_at timestamp, signup_method string, channel string,
        channel_key bigint, {ENTRY}""",
    "fct_activations": """
        activation_key bigint, user_id string, user_key bigint, activation_date_key bigint,
        activation_at timestamp, first_touch_channel_key bigint, last_touch_channel_key bigint,
        first_touch_channel string, last_touch_channel string""",
    "fct_retention_cohorts": """
        retention_cohort_key bigint, cohort_week_start_date date, cohort_week_date_key bigint,
        retention_period string, period_offset_days bigint, period_end_date date,
        period_end_date_key bigint, cohort_size bigint, retained_count bigint,
        retention_rate double, is_period_complete boolean""",
    "fct_marketing_spend": f"""
        spend_key bigint, spend_id string, spend_date_key bigint, channel string,
        channel_key bigint, campaign_id string, campaign_name string, spend_amount {MONEY},
        currency string, impressions bigint, clicks bigint""",
    "fct_experiment_exposures": """
        user_id string, user_key bigint, experiment_id string, experiment_key bigint,
        variant string, first_exposure_at timestamp, exposure_date_key bigint,
        converted boolean, conversion_at timestamp, exposure_duration_hours bigint""",
    "bridge_user_experiments": """
        user_key bigint, user_id string, experiment_key bigint, variant string,
        first_exposure_at timestamp""",
    "fct_feature_usage": """
        feature_usage_key bigint, event_id string, user_id string, user_key bigint,
        account_id string, account_key bigint, usage_date_key bigint, usage_at timestamp,
        feature_name string, feature_duration_seconds bigint, platform string,
        device_type string""",
    "fct_support_tickets": """
        ticket_key bigint, ticket_id string, user_id string, user_key bigint, account_id string,
        account_key bigint, created_date_key bigint, created_at timestamp,
        resolved_at timestamp, category string, priority string, status string,
        csat_score bigint, resolution_time_hours double, first_response_hours double,
        is_resolved boolean""",
}

# The columns that may be NULL; all others of a contract may not.
NULLABLE = {
    "stg_events": """user_id account_id ingest_time plan_context utm_source utm_medium utm_campaign utm_term
        utm_content device_type browser os user_agent page_url referrer signup_method activation_action
        time_to_activate_hours feature_name feature_duration_seconds source_page target_plan billing_cycle
        member_role member_reason experiment_flags""",
    "stg_subscriptions": "previous_plan cancel_reason is_voluntary",
    "stg_invoices": "paid_at line_items",
    "stg_spend": "campaign_name impressions clicks",
    "stg_tickets": "resolved_at csat_score first_response_seconds",
    "dim_users": "account_id signup_at activation_at first_touch_channel_key last_touch_channel_key",
    "dim_accounts": """plan billing_cycle mrr_amount currency user_count health_score activity_score billing_score
        support_score acquisition_channel_key acquisition_date lifecycle_stage""",
    "dim_experiments": "end_date description",
    "dim_sessions": """platform device_type browser utm_source utm_medium utm_campaign session_duration_seconds
        event_count page_view_count""",
    "fct_sessions": "user_id user_key page_view_count platform device_type browser utm_source utm_medium utm_campaign",
    "fct_invoices": "paid_at",
    "fct_subscriptions": "previous_plan cancel_reason is_voluntary days_since_previous_event",
    "fct_signups": "platform device_type browser utm_source utm_medium utm_campaign",
    "fct_marketing_spend": "campaign_name impressions clicks",
    "fct_experiment_exposures": "conversion_at",
    "fct_feature_usage": "account_id account_key feature_duration_seconds platform device_type",
    "fct_support_tickets": "resolved_at csat_score resolution_time_hours first_response_hours",
}


class ContractError(ValueError):
    """A table does not have the columns or types it was promised with."""


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(" ".join(ddl.split()))


def contract(table: str) -> str:
    """The contract of a mart or of a staged table (``stg_...``)."""
    return MARTS[table] if table in MARTS else STAGED[table.removeprefix("stg_")]


def required(table: str) -> list[str]:
    """The columns of a contract that may not be NULL."""
    optional = NULLABLE.get(table, "").split()
    return [f.name for f in struct(contract(table)) if f.name not in optional]


def contract_problems(df: DataFrame, ddl: str) -> list[str]:
    """Missing, unexpected and wrongly typed columns; empty when the contract holds."""
    want = {f.name: f.dataType for f in struct(ddl)}
    have = {f.name: f.dataType for f in df.schema}
    problems = [f"missing column {c}" for c in want if c not in have]
    problems += [f"unexpected column {c}" for c in have if c not in want]
    problems += [
        f"column {c} is {have[c].simpleString()}, expected {want[c].simpleString()}"
        for c in want
        if c in have and have[c] != want[c]
    ]
    return problems


def assert_schema(df: DataFrame, ddl: str, name: str = "table") -> DataFrame:
    """Return ``df`` unchanged, or raise :class:`ContractError`."""
    problems = contract_problems(df, ddl)
    if problems:
        raise ContractError(f"{name}: " + "; ".join(problems))
    return df


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Select and cast to the contract's columns, in its order."""
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in struct(ddl)])

"""The gate's checks as SQL, typed from the rules and not from the library's declarations."""

from __future__ import annotations

from .tables_sql import AS_OF

# Tables and the columns in them that may be empty; every other column may not.
MAY_BE_NULL = """
stg_events: user_id account_id ingest_time plan_context utm_source utm_medium utm_campaign utm_term utm_content device_type browser os user_agent page_url referrer signup_method activation_action time_to_activate_hours feature_name feature_duration_seconds source_page target_plan billing_cycle member_role member_reason experiment_flags
stg_subscriptions: previous_plan cancel_reason is_voluntary
stg_invoices: paid_at line_items
stg_spend: campaign_name impressions clicks
stg_tickets: resolved_at csat_score first_response_seconds
experiments: end_date description
events_normalized: user_id account_id ingest_time platform channel plan_context utm_source utm_medium utm_campaign utm_term utm_content device_type browser os user_agent page_url referrer signup_method activation_action time_to_activate_hours feature_name feature_duration_seconds source_page target_plan billing_cycle member_role member_reason experiment_flags
identity_stitched: valid_to
sessions: page_view_count utm_source utm_medium utm_campaign platform device_type browser stitched_user_id
account_memberships: role valid_to
funnel_staged:
subscription_lifecycle: previous_plan cancel_reason is_voluntary days_since_previous_event
mrr_movements:
invoices_prep: paid_at line_items
checkout_conversion: account_id target_plan subscription_event_id subscription_at time_to_conversion_days
spend_prep: campaign_name impressions clicks cost_per_click click_through_rate
ticket_metrics: resolved_at csat_score resolution_time_hours first_response_hours
attribution: first_touch_channel first_touch_source first_touch_medium first_touch_campaign last_touch_source last_touch_medium last_touch_campaign
engagement_states: last_activity_at days_since_last_activity
experiment_results: conversion_at
account_health:
dim_users: account_id signup_at activation_at first_touch_channel_key last_touch_channel_key
dim_accounts: plan billing_cycle mrr_amount currency user_count health_score activity_score billing_score support_score acquisition_channel_key acquisition_date lifecycle_stage
dim_channels:
dim_experiments: end_date description
dim_sessions: platform device_type browser utm_source utm_medium utm_campaign session_duration_seconds event_count page_view_count
dim_date:
fct_sessions: user_id user_key page_view_count platform device_type browser utm_source utm_medium utm_campaign
fct_invoices: paid_at
fct_mrr_movements:
fct_subscriptions: previous_plan cancel_reason is_voluntary days_since_previous_event
fct_signups: platform device_type browser utm_source utm_medium utm_campaign
fct_activations:
fct_retention_cohorts:
fct_marketing_spend: campaign_name impressions clicks
fct_experiment_exposures: conversion_at
bridge_user_experiments:
fct_feature_usage: account_id account_key feature_duration_seconds platform device_type
fct_support_tickets: resolved_at csat_score resolution_time_hours first_response_hours
"""

# check name | table | condition of a failure
ROWS = """
attribution.first_touch_channel not null | attribution | first_touch_channel IS NULL AND activation_at IS NOT NULL
stg_events.event_type accepted | stg_events | event_type NOT IN ('page_view', 'signup', 'activation', 'feature_use', 'paywall_view', 'checkout_start', 'upgrade_click', 'member_invited', 'member_joined', 'member_removed')
stg_events.platform accepted | stg_events | platform NOT IN ('web', 'ios', 'android')
stg_events.channel accepted | stg_events | channel NOT IN ('organic', 'paid_search', 'paid_social', 'referral', 'email', 'direct')
stg_events.plan_context accepted | stg_events | plan_context NOT IN ('free', 'starter', 'pro', 'enterprise')
stg_events.device_type accepted | stg_events | device_type NOT IN ('desktop', 'mobile', 'tablet')
stg_events.signup_method accepted | stg_events | signup_method NOT IN ('email', 'google', 'github')
stg_events.billing_cycle accepted | stg_events | billing_cycle NOT IN ('monthly', 'annual')
stg_subscriptions.event_type accepted | stg_subscriptions | event_type NOT IN ('trial_start', 'trial_end', 'subscription_start', 'upgrade', 'downgrade', 'renewal', 'cancellation', 'reactivation')
stg_subscriptions.plan accepted | stg_subscriptions | plan NOT IN ('free', 'starter', 'pro', 'enterprise')
stg_subscriptions.previous_plan accepted | stg_subscriptions | previous_plan NOT IN ('free', 'starter', 'pro', 'enterprise')
stg_subscriptions.billing_cycle accepted | stg_subscriptions | billing_cycle NOT IN ('monthly', 'annual')
stg_subscriptions.mrr_amount range | stg_subscriptions | mrr_amount < 0
stg_invoices.status accepted | stg_invoices | status NOT IN ('paid', 'pending', 'failed', 'refunded')
stg_invoices.amount range | stg_invoices | amount < 0
stg_invoices.refund_amount range | stg_invoices | refund_amount < 0
stg_spend.channel accepted | stg_spend | channel NOT IN ('organic', 'paid_search', 'paid_social', 'referral', 'email', 'direct')
stg_spend.spend_amount range | stg_spend | spend_amount < 0
stg_tickets.category accepted | stg_tickets | category NOT IN ('bug', 'feature_request', 'billing', 'onboarding', 'other')
stg_tickets.priority accepted | stg_tickets | priority NOT IN ('low', 'medium', 'high', 'critical')
stg_tickets.status accepted | stg_tickets | status NOT IN ('open', 'in_progress', 'resolved', 'closed')
stg_tickets.csat_score range | stg_tickets | csat_score < 1 OR csat_score > 5
subscription_lifecycle.days_since_previous_event range | subscription_lifecycle | days_since_previous_event < 0
mrr_movements.movement_type accepted | mrr_movements | movement_type NOT IN ('new', 'expansion', 'contraction', 'churn', 'reactivation')
ticket_metrics.resolution_time_hours range | ticket_metrics | resolution_time_hours < 0
ticket_metrics.first_response_hours range | ticket_metrics | first_response_hours < 0
account_health.health_score range | account_health | health_score < 0 OR health_score > 100
account_health.activity_score range | account_health | activity_score < 0 OR activity_score > 100
account_health.billing_score range | account_health | billing_score < 0 OR billing_score > 100
account_health.support_score range | account_health | support_score < 0 OR support_score > 100
engagement_states.engagement_state accepted | engagement_states | engagement_state NOT IN ('pre_active', 'active', 'dormant', 'disengaged')
experiment_results.exposure_duration_hours range | experiment_results | exposure_duration_hours < 24
identity_stitched.stitch_source accepted | identity_stitched | stitch_source NOT IN ('last_touch', 'historical')
account_memberships.membership_duration_days range | account_memberships | membership_duration_days < 0
sessions.session_duration_seconds range | sessions | session_duration_seconds < 0
sessions.event_count range | sessions | event_count < 1
funnel_staged.stage accepted | funnel_staged | stage NOT IN ('page_view', 'signup', 'activation', 'feature_use', 'checkout_start')
dim_users.engagement_state accepted | dim_users | engagement_state NOT IN ('pre_active', 'active', 'dormant', 'disengaged')
dim_accounts.lifecycle_stage accepted | dim_accounts | lifecycle_stage NOT IN ('trial', 'active', 'churned', 'reactivated', 'unknown')
dim_experiments.status accepted | dim_experiments | status NOT IN ('active', 'completed', 'paused')
fct_subscriptions.event_type accepted | fct_subscriptions | event_type NOT IN ('trial_start', 'trial_end', 'subscription_start', 'upgrade', 'downgrade', 'renewal', 'cancellation', 'reactivation')
fct_subscriptions.plan accepted | fct_subscriptions | plan NOT IN ('free', 'starter', 'pro', 'enterprise')
fct_subscriptions.previous_plan accepted | fct_subscriptions | previous_plan NOT IN ('free', 'starter', 'pro', 'enterprise')
fct_subscriptions.billing_cycle accepted | fct_subscriptions | billing_cycle NOT IN ('monthly', 'annual')
fct_subscriptions.currency accepted | fct_subscriptions | currency NOT IN ('USD', 'EUR')
fct_mrr_movements.movement_type accepted | fct_mrr_movements | movement_type NOT IN ('new', 'expansion', 'contraction', 'churn', 'reactivation')
fct_invoices.currency accepted | fct_invoices | currency NOT IN ('USD', 'EUR')
fct_invoices.status accepted | fct_invoices | status NOT IN ('paid', 'pending', 'failed', 'refunded')
fct_signups.signup_method accepted | fct_signups | signup_method NOT IN ('email', 'google', 'github')
fct_retention_cohorts.retention_period accepted | fct_retention_cohorts | retention_period NOT IN ('W1', 'W2', 'W3', 'W4', 'M2', 'M3', 'M6', 'M12')
fct_experiment_exposures.variant accepted | fct_experiment_exposures | variant NOT IN ('control', 'treatment')
fct_feature_usage.feature_name accepted | fct_feature_usage | feature_name NOT IN ('alert_create', 'api_call', 'chart_edit', 'dashboard_view', 'data_export', 'filter_apply', 'integration_setup', 'report_create', 'share_report', 'template_use')
fct_support_tickets.category accepted | fct_support_tickets | category NOT IN ('bug', 'feature_request', 'billing', 'onboarding', 'other')
fct_support_tickets.priority accepted | fct_support_tickets | priority NOT IN ('low', 'medium', 'high', 'critical')
fct_support_tickets.status accepted | fct_support_tickets | status NOT IN ('open', 'in_progress', 'resolved', 'closed')
invoice_paid_flag | fct_invoices | is_paid <> (status = 'paid')
invoice_prep_paid_flag | invoices_prep | is_paid <> (status = 'paid')
invoice_net_amount | fct_invoices | net_amount <> amount - refund_amount
refund_has_amount | fct_invoices | status = 'refunded' AND coalesce(refund_amount, 0) <= 0
movement_delta | fct_mrr_movements | abs(mrr_delta - mrr_after + mrr_before) > 0.01
resolved_has_time | fct_support_tickets | is_resolved AND resolution_time_hours IS NULL
cancellation_has_no_mrr | stg_subscriptions | event_type = 'cancellation' AND mrr_amount <> 0
retention_rate_bounds | fct_retention_cohorts | retention_rate < 0 OR retention_rate > 1 OR retained_count < 0 OR retained_count > cohort_size OR cohort_size <= 0
cohort_starts_monday | fct_retention_cohorts | dayname(cohort_week_start_date) <> 'Monday'
idle_days_not_negative | engagement_states | last_activity_at IS NOT NULL AND days_since_last_activity < 0
lifecycle_days_not_negative | subscription_lifecycle | days_since_previous_event < 0
session_boundaries | sessions | session_end_at < session_start_at OR session_duration_seconds < 0 OR abs(session_duration_seconds - date_sub('second', session_start_at, session_end_at)) > 1
health_score_bounds | account_health | health_score < 0 OR health_score > 100 OR activity_score < 0 OR activity_score > 100 OR billing_score < 0 OR billing_score > 100 OR support_score < 0 OR support_score > 100 OR abs(health_score - (activity_score * 0.4 + billing_score * 0.3 + support_score * 0.3)) > 0.01
conversion within window | checkout_conversion | time_to_conversion_days > 30
"""

# Table, and what identifies a row of it; several keys are separated by semicolons.
KEYS = """
stg_subscriptions: subscription_event_id
stg_invoices: invoice_id
stg_spend: spend_id
stg_tickets: ticket_id
experiments: experiment_id
events_normalized: event_id
identity_stitched: anon_id, valid_from
sessions: session_id
account_memberships: user_id, account_id, valid_from
funnel_staged: user_id, stage
subscription_lifecycle: subscription_event_id
mrr_movements: account_id, subscription_event_id
invoices_prep: invoice_id
checkout_conversion: checkout_event_id
spend_prep: spend_id
ticket_metrics: ticket_id
attribution: user_id
engagement_states: user_id, snapshot_week_start
experiment_results: user_id, experiment_id
account_health: account_id
dim_users: user_key; user_id
dim_accounts: account_key; account_id
dim_channels: channel_key; channel
dim_experiments: experiment_key; experiment_id
dim_sessions: session_key; session_id
dim_date: date_key; date_day
fct_sessions: session_key; session_id
fct_invoices: invoice_key; invoice_id
fct_mrr_movements: mrr_movement_key; account_id, subscription_event_id
fct_subscriptions: subscription_event_key; subscription_event_id
fct_signups: signup_key; event_id
fct_activations: activation_key; user_id
fct_retention_cohorts: retention_cohort_key; cohort_week_start_date, retention_period
fct_marketing_spend: spend_key; spend_id
fct_experiment_exposures: user_key, experiment_key
bridge_user_experiments: user_key, experiment_key
fct_feature_usage: feature_usage_key; event_id
fct_support_tickets: ticket_key; ticket_id
"""

# Parent, its key, and the child columns that point to it.
REFERENCES = """
dim_users.user_key: fct_sessions.user_key fct_signups.user_key fct_activations.user_key fct_feature_usage.user_key fct_invoices.user_key fct_subscriptions.user_key fct_support_tickets.user_key fct_experiment_exposures.user_key bridge_user_experiments.user_key
dim_accounts.account_key: fct_feature_usage.account_key fct_invoices.account_key fct_mrr_movements.account_key fct_subscriptions.account_key fct_support_tickets.account_key
dim_channels.channel_key: dim_users.first_touch_channel_key dim_users.last_touch_channel_key dim_accounts.acquisition_channel_key fct_signups.channel_key fct_activations.first_touch_channel_key fct_activations.last_touch_channel_key fct_marketing_spend.channel_key
dim_experiments.experiment_key: fct_experiment_exposures.experiment_key bridge_user_experiments.experiment_key
dim_sessions.session_key: fct_sessions.session_key
dim_date.date_key: dim_sessions.session_date_key fct_sessions.session_date_key fct_invoices.issued_date_key fct_mrr_movements.movement_date_key fct_subscriptions.event_date_key fct_signups.signup_date_key fct_activations.activation_date_key fct_retention_cohorts.cohort_week_date_key fct_retention_cohorts.period_end_date_key fct_marketing_spend.spend_date_key fct_experiment_exposures.exposure_date_key fct_feature_usage.usage_date_key fct_support_tickets.created_date_key
"""

# check name | number of failures; a check that only warns is marked
OTHERS = f"""
identity overlap | SELECT count(*) FROM identity_stitched b WHERE EXISTS (FROM identity_stitched a WHERE a.anon_id = b.anon_id AND a.valid_from < b.valid_from AND (a.valid_to IS NULL OR a.valid_to > b.valid_from))
membership overlap | SELECT count(*) FROM account_memberships b WHERE EXISTS (FROM account_memberships a WHERE a.user_id = b.user_id AND a.account_id = b.account_id AND a.valid_from < b.valid_from AND (a.valid_to IS NULL OR a.valid_to > b.valid_from))
session overlap | SELECT count(*) FROM sessions b WHERE EXISTS (FROM sessions a WHERE a.anon_id = b.anon_id AND a.session_start_at < b.session_start_at AND a.session_end_at > b.session_start_at)
one current stage | SELECT count(*) FROM (SELECT user_id FROM funnel_staged GROUP BY 1 HAVING sum(CASE WHEN is_current_stage THEN 1 ELSE 0 END) <> 1)
one last touch | SELECT count(*) FROM (SELECT anon_id FROM identity_stitched GROUP BY 1 HAVING sum(CASE WHEN stitch_source = 'last_touch' THEN 1 ELSE 0 END) <> 1)
funnel order (warns) | SELECT count(*) FROM funnel_staged b WHERE stage_reached_at < (SELECT stage_reached_at FROM funnel_staged a WHERE a.user_id = b.user_id AND a.stage_ordinal < b.stage_ordinal ORDER BY a.stage_ordinal DESC LIMIT 1)
activation implies signup | SELECT count(DISTINCT user_id) FROM funnel_staged WHERE stage = 'activation' AND user_id NOT IN (SELECT user_id FROM funnel_staged WHERE stage = 'signup')
sessions fan-out | SELECT CASE WHEN (SELECT count(*) FROM fct_sessions) = (SELECT count(*) FROM sessions) THEN 0 ELSE 1 END
movements fan-out | SELECT CASE WHEN (SELECT count(*) FROM fct_mrr_movements) = (SELECT count(*) FROM mrr_movements) THEN 0 ELSE 1 END
periods per cohort | SELECT count(*) FROM (SELECT 1 FROM fct_retention_cohorts GROUP BY cohort_week_start_date HAVING count(*) <> 8)
movement totals | SELECT count(*) FROM (SELECT account_id, sum(mrr_delta) AS s FROM mrr_movements GROUP BY 1) a FULL JOIN (SELECT account_id, sum(mrr_delta) AS s FROM fct_mrr_movements GROUP BY 1) b ON a.account_id = b.account_id WHERE a.account_id IS NULL OR b.account_id IS NULL OR abs(a.s - b.s) > 0.01
final mrr | SELECT count(*) FROM (SELECT account_id, sum(mrr_delta) AS s FROM mrr_movements GROUP BY 1) m FULL JOIN (SELECT account_id, sum(mrr) AS f FROM (SELECT account_id, subscription_id, max_by(mrr_amount, (event_time, subscription_event_id)) AS mrr FROM subscription_lifecycle WHERE event_type NOT IN ('trial_start', 'trial_end') GROUP BY 1, 2) GROUP BY 1) l ON m.account_id = l.account_id WHERE abs(coalesce(s, 0) - coalesce(f, 0)) > 0.01
cohort sizes | SELECT count(*) FROM (SELECT CAST(date_trunc('week', activation_at) AS DATE) AS w, count(*) AS n FROM attribution GROUP BY 1) a FULL JOIN (SELECT DISTINCT cohort_week_start_date AS w, cohort_size AS n FROM fct_retention_cohorts) r ON a.w = r.w WHERE a.n IS NULL OR r.n IS NULL OR a.n <> r.n
dedup rate | SELECT CASE WHEN s = 0 OR n > s OR 1 - n / s > 0.01 THEN 1 ELSE 0 END FROM (SELECT (SELECT count(*) FROM stg_events WHERE _loaded_at >= c)::DOUBLE AS s, (SELECT count(*) FROM events_normalized WHERE _loaded_at >= c)::DOUBLE AS n FROM (SELECT max(_loaded_at) - INTERVAL 30 DAY AS c FROM stg_events))
active accounts scored | SELECT count(*) FROM account_health WHERE billing_score = 0 AND account_id IN (SELECT account_id FROM subscription_lifecycle WHERE is_active)
neutral support score | SELECT count(*) FROM account_health WHERE support_score > 100 OR (support_score <> 70 AND account_id NOT IN (SELECT account_id FROM ticket_metrics WHERE created_at >= {AS_OF} - INTERVAL 28 DAY))
conversions exist (warns) | SELECT CASE WHEN count_if(converted) = 0 THEN 1 ELSE 0 END FROM experiment_results
events volume | SELECT CASE WHEN count(*) < 100 THEN 1 ELSE 0 END FROM stg_events
"""


def _lines(text: str) -> list[str]:
    return [line for line in text.strip().splitlines() if line]


def gate_sql() -> str:
    error = "CASE WHEN failures > 0 THEN 'error' ELSE 'pass' END"
    orphan = "CASE WHEN failures > 10 THEN 'error' WHEN failures > 0 THEN 'warn' ELSE 'pass' END"
    parts = []

    def add(name: str, failures: str, status: str = error) -> None:
        parts.append(f"SELECT check_name, failures, {status} AS status FROM (SELECT {name} AS check_name, CAST({failures} AS BIGINT) AS failures)")

    for line in _lines(MAY_BE_NULL):
        table, _, optional = line.partition(":")
        names = "|".join(optional.split()) or "-"
        parts.append(
            f"SELECT '{table}.' || c || ' not null' AS check_name, CAST(n AS BIGINT) AS failures, CASE WHEN n > 0 THEN 'error' ELSE 'pass' END AS status FROM (UNPIVOT "
            f"(SELECT count_if(COLUMNS(lambda c: NOT regexp_full_match(c, '{names}')) IS NULL) AS \"\\0\" FROM {table}) ON COLUMNS(*) INTO NAME c VALUE n)"
        )
        if table.startswith(("dim_", "fct_", "bridge_")):
            add(f"'{table} populated'", f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {table})")
    for line in _lines(ROWS):
        name, table, bad = (x.strip() for x in line.split("|", 2))
        add(f"'{name}'", f"(SELECT count(*) FROM {table} WHERE {bad})")
    for line in _lines(KEYS):
        table, _, keys = line.partition(": ")
        for key in keys.split("; "):
            where = "" if "," in key else f"WHERE {key} IS NOT NULL"
            again = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {table} {where} GROUP BY {key} HAVING count(*) > 1))"
            add(f"'{table}.{key} unique'", again)
    for line in _lines(REFERENCES):
        parent, _, children = line.partition(": ")
        table, key = parent.split(".")
        for child in children.split():
            t, c = child.split(".")
            only = "AND is_period_complete" if c == "period_end_date_key" else ""
            lost = f"(SELECT count(*) FROM {t} WHERE {c} IS NOT NULL {only} AND {c} NOT IN (SELECT {key} FROM {table}))"
            add(f"'{child} -> {table}'", lost, orphan)
    for source in ("stg_events", "stg_subscriptions", "stg_invoices", "stg_spend", "stg_tickets"):
        age = f"date_sub('second', latest, {AS_OF})"
        status = f"CASE WHEN latest IS NULL OR {age} > 172800 THEN 'error' WHEN {age} > 86400 THEN 'warn' ELSE 'pass' END"
        parts.append(
            f"SELECT '{source} fresh', CAST(CASE WHEN s = 'pass' THEN 0 ELSE 1 END AS BIGINT), s "
            f"FROM (SELECT {status} AS s FROM (SELECT max(_loaded_at) AS latest FROM {source}))"
        )
    for line in _lines(OTHERS):
        name, failures = (x.strip() for x in line.split("|", 1))
        warns = name.endswith(" (warns)")
        add(f"'{name.removesuffix(' (warns)')}'", f"({failures})", "CASE WHEN failures > 0 THEN 'warn' ELSE 'pass' END" if warns else error)
    return "\nUNION ALL\n".join(parts)

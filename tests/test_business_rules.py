"""Hand-computed cases for billing, growth, engagement, experiments and health."""

from decimal import Decimal

from conftest import rows
from lifeloom.operators import billing, engagement, experiments, growth, health
from lifeloom.plans import marts
from lifeloom.sources.contracts import STAGED

LIFE = "account_id string, subscription_id string, subscription_event_id string, user_id string, event_type string, event_time timestamp, mrr_amount decimal(28,9)"


def _lifecycle(frame, *events):
    return frame(LIFE, *[("a", "s", f"e{i:02d}", "u", kind, at, mrr) for i, (kind, at, mrr) in enumerate(events)])


def test_lifecycle_days_and_active_flag(frame, policy):
    subs = _lifecycle(
        frame, ("trial_start", "2024-01-01 23:00:00", 0), ("subscription_start", "2024-01-15 01:00:00", 50),
        ("cancellation", "2024-03-20 00:00:00", 0),
    )
    got = billing.subscription_lifecycle(subs, policy)
    assert rows(got, "subscription_event_id", "is_active", "days_since_previous_event") == [
        ("e00", False, None), ("e01", True, 14), ("e02", False, 65),
    ]


def test_movement_classes(frame, policy):
    events = _lifecycle(
        frame,
        ("trial_start", "2024-01-01 00:00:00", 0),
        ("subscription_start", "2024-01-15 00:00:00", 50),  # new: the trial does not count
        ("upgrade", "2024-02-01 00:00:00", 80),
        ("renewal", "2024-03-01 00:00:00", 80),  # same price: dropped
        ("downgrade", "2024-04-01 00:00:00", 30),
        ("downgrade", "2024-05-01 00:00:00", 0),  # down to nothing: dropped
        ("renewal", "2024-06-01 00:00:00", 30),
        ("cancellation", "2024-07-01 00:00:00", 0),
        ("reactivation", "2024-08-01 00:00:00", 40),
        ("subscription_start", "2024-09-01 00:00:00", 60),  # not the first event
    )
    got = billing.mrr_movements(events, policy)
    assert rows(got, "subscription_event_id", "movement_type", "mrr_before", "mrr_delta") == [
        (i, m, Decimal(b), Decimal(d)) for i, m, b, d in [
            ("e01", "new", 0, 50), ("e02", "expansion", 50, 30), ("e04", "contraction", 80, -50),
            ("e06", "expansion", 0, 30), ("e07", "churn", 30, -30), ("e08", "reactivation", 0, 40),
            ("e09", "expansion", 40, 20),
        ]
    ]


def test_first_event_that_is_no_start_is_expansion(frame, policy):
    got = billing.mrr_movements(_lifecycle(frame, ("renewal", "2024-01-01 00:00:00", 10)), policy)
    assert rows(got, "movement_type") == [("expansion",)]


def _checkout(make_events, frame, policy, checkouts, starts):
    events = make_events(
        *[{"event_id": i, "event_type": "checkout_start", "user_id": "u", "account_id": a, "event_time": t} for i, a, t in checkouts]
    )
    life = frame(LIFE, *[("a", "s", i, "u", "subscription_start", t, 1) for i, t in starts])
    got = billing.checkout_conversion(events, life, policy)
    return rows(got, "checkout_event_id", "subscription_event_id", "converted", "time_to_conversion_days")


def test_checkout_matching(make_events, frame, policy):
    got = _checkout(
        make_events, frame, policy,
        [("c1", "a", "2024-01-01 00:00:00"), ("c2", "a", "2024-01-05 00:00:00"), ("c3", "a", "2024-03-01 00:00:00"),
         ("c4", None, "2024-01-05 00:00:00"), ("c5", "a", "2024-06-01 00:00:00")],
        [("s1", "2024-01-06 12:00:00"), ("s2", "2024-01-07 00:00:00"), ("s3", "2024-03-31 00:00:00"), ("s4", "2024-07-01 00:00:01")],
    )
    # c1 and c2 compete for s1: the later checkout wins, c1 stays open, s2 stays alone.
    assert got == [
        ("c1", None, False, None), ("c2", "s1", True, 1), ("c3", "s3", True, 30), ("c4", None, False, None),
        ("c5", None, False, None),
    ]


def test_checkout_and_start_in_the_same_instant(make_events, frame, policy):
    got = _checkout(
        make_events, frame, policy,
        [("c1", "a", "2024-01-01 00:00:00"), ("c2", "a", "2024-01-01 00:00:00")],
        [("s2", "2024-01-01 00:00:00"), ("s1", "2024-01-01 00:00:00")],
    )
    assert got == [("c1", None, False, None), ("c2", "s1", True, 0)]


def test_invoices_and_spend(frame):
    inv = frame(STAGED["invoices"], ("i", "s", "u", "a", "2024-01-01", None, "2024-01-01", "10.50", "USD", "refunded", "4.25", None))
    assert rows(billing.invoices_prep(inv), "is_paid", "net_amount") == [(False, Decimal("6.25"))]
    spend = frame(
        STAGED["spend"],
        ("x", "2024-01-01", "email", "c", "C", 1000, 0, "10", "USD", "2024-01-02"),
        ("y", "2024-01-01", "email", "c", "C", 0, 4, "10", "USD", "2024-01-02"),
    )
    assert rows(growth.spend_prep(spend), "spend_id", "cost_per_click", "click_through_rate") == [
        ("x", None, 0.0), ("y", Decimal("2.5"), None),
    ]


def test_ticket_hours(frame):
    tickets = frame(
        STAGED["tickets"],
        ("t1", "u", "a", "2024-01-01 00:00:00", "2024-01-01 01:30:00", "2024-01-02", "bug", "low", "closed", 5, 1800),
        ("t2", "u", "a", "2024-01-01 00:00:00", None, "2024-01-02", "bug", "low", "open", None, None),
    )
    assert rows(growth.ticket_metrics(tickets), "ticket_id", "resolution_time_hours", "first_response_hours", "is_resolved") == [
        ("t1", 1.5, 0.5, True), ("t2", None, None, False),
    ]


def _resolved(make_events, *events):
    from pyspark.sql import functions as F

    return make_events(*[{"user_id": "u"} | e for e in events]).withColumn("resolved_user_id", F.col("user_id"))


def test_attribution_window_and_ties(make_events, policy):
    resolved = _resolved(
        make_events,
        {"event_id": "old", "event_time": "2023-12-15 11:59:59", "channel": "direct"},
        {"event_id": "b", "event_time": "2023-12-15 12:00:00", "channel": "paid_search", "utm_source": "g"},
        {"event_id": "a", "event_time": "2023-12-15 12:00:00", "channel": "email"},
        {"event_id": "m", "event_time": "2024-01-14 11:00:00", "channel": "referral"},
        {"event_id": "n", "event_time": "2024-01-14 11:00:00", "channel": "paid_social"},
        {"event_id": "act", "event_time": "2024-01-14 12:00:00", "event_type": "activation", "channel": "organic"},
        {"event_id": "act2", "event_time": "2024-01-20 12:00:00", "event_type": "activation"},
        {"event_id": "only", "user_id": "v", "event_type": "activation"},
    )
    assert rows(growth.attribution(resolved, policy), "user_id", "first_touch_channel", "last_touch_channel", "activation_at") == [
        ("u", "email", "paid_social", "2024-01-14 12:00:00")
    ]


def test_engagement_weeks(make_events, policy):
    resolved = _resolved(
        make_events,
        {"event_time": "2024-01-02 09:00:00"},
        # Sunday: the week that ends that day still counts as not activated.
        {"event_time": "2024-01-07 00:00:01", "event_type": "activation"},
        {"event_time": "2024-02-13 00:00:00"},
    )
    got = engagement.engagement_states(resolved, policy)
    assert rows(got, "snapshot_week_start", "engagement_state", "is_re_engaged", "days_since_last_activity") == [
        ("2024-01-01", "pre_active", False, 0),
        ("2024-01-08", "active", False, 7),
        ("2024-01-15", "active", False, 14),
        ("2024-01-22", "dormant", False, 21),
        ("2024-01-29", "dormant", False, 28),
        ("2024-02-05", "dormant", False, 35),
        ("2024-02-12", "active", True, 5),
    ]


def test_engagement_before_a_users_first_event(make_events, policy):
    resolved = _resolved(
        make_events, {"event_time": "2024-01-02 09:00:00"}, {"user_id": "v", "event_time": "2024-02-12 09:00:00"}
    )
    first = engagement.engagement_states(resolved, policy).filter("user_id = 'v' and snapshot_week_start = '2024-01-08'")
    assert rows(first, "engagement_state", "days_since_last_activity", "last_activity_at") == [("pre_active", 13, None)]


def test_experiment_exposure_and_conversion(make_events, policy):
    def flags(*pairs):
        return "[" + ",".join(f'{{"experiment_id":"{e}","variant":"{v}"}}' for e, v in pairs) + "]"

    resolved = _resolved(
        make_events,
        {"event_time": "2024-01-01 00:00:00", "experiment_flags": flags(("x", "a"))},
        {"event_time": "2024-01-02 00:00:00", "experiment_flags": flags(("x", "a"), ("y", "b"))},
        {"event_time": "2024-01-02 23:59:59", "experiment_flags": flags(("y", "b"))},  # 23.99 h: too short
        {"event_time": "2024-01-03 00:00:00", "experiment_flags": flags(("x", "c"))},
        {"event_time": "2024-01-05 00:00:00", "experiment_flags": flags(("x", "c"))},
        {"event_time": "2024-01-01 00:00:00", "event_type": "activation"},  # not strictly after exposure
        {"event_time": "2024-01-04 00:00:00", "event_type": "activation"},
        {"experiment_flags": "[]"}, {"experiment_flags": "oops"}, {"experiment_flags": None},
    )
    assert rows(experiments.experiment_results(resolved, policy), "experiment_id", "variant", "conversion_at", "exposure_duration_hours") == [
        ("x", "a", "2024-01-04 00:00:00", 24), ("x", "c", "2024-01-04 00:00:00", 48),
    ]


def test_account_health_tables(frame, policy):
    life = "account_id string, event_time timestamp, is_active boolean"
    lifecycle = frame(
        life, ("fresh", "2024-02-10", True), ("stale", "2023-06-01", True), ("ended", "2024-02-10", False),
        ("strained", "2024-02-10", True), ("happy", "2024-02-10", True), ("poor", "2024-02-10", True),
    )
    tick = "account_id string, created_at timestamp, is_resolved boolean, csat_score bigint, resolution_time_hours double"
    tickets = frame(
        tick, ("happy", "2024-02-01", True, 5, 1), ("happy", "2023-02-01", False, None, None),
        *[("strained", "2024-02-01", False, None, None)] * 3, *[("poor", "2024-02-01", False, None, None)] * 6,
    )
    visits = frame(
        "session_id string, stitched_user_id string, session_start_at timestamp, event_count bigint",
        *[(f"s{i}", "u", "2024-02-05", 2) for i in range(5)], ("old", "u", "2024-01-01", 9), ("none", None, "2024-02-05", 1),
    )
    members = frame(
        "user_id string, account_id string, valid_from timestamp, valid_to timestamp",
        ("u", "fresh", "2024-01-01", None), ("u", "ended", "2024-01-01", "2024-02-05"),
    )
    got = health.account_health(visits, members, lifecycle, tickets, policy)
    assert rows(got, "account_id", "activity_score", "billing_score", "support_score") == [
        ("ended", 0.0, 20.0, 70.0), ("fresh", 50.0, 100.0, 70.0), ("happy", 0.0, 100.0, 100.0),
        ("poor", 0.0, 100.0, 10.0), ("stale", 0.0, 70.0, 70.0), ("strained", 0.0, 100.0, 40.0),
    ]
    fresh = got.filter("account_id = 'fresh'").first()
    assert fresh["health_score"] == 0.4 * 50.0 + 0.3 * 100.0 + 0.3 * 70.0


def test_retention_periods(make_events, frame, policy):
    resolved = _resolved(
        make_events,
        {"event_time": "2024-01-08 00:00:00"},  # day 7: W1
        {"event_time": "2024-01-14 23:00:00"},  # day 13: W1 again
        {"event_time": "2024-01-28 00:00:00"},  # day 27: W3
        {"event_time": "2024-02-05 00:00:00"},  # day 35: no period
        {"user_id": "v", "event_time": "2024-01-15 00:00:00"},  # day 14: W2
    )
    attribution = frame("user_id string, activation_at timestamp", ("u", "2024-01-03"), ("v", "2024-01-01"))
    got = marts.fct_retention_cohorts(attribution, resolved, policy)
    assert rows(got.filter("retained_count > 0"), "cohort_week_start_date", "retention_period", "retained_count", "retention_rate") == [
        ("2024-01-01", "W1", 1, 0.5), ("2024-01-01", "W2", 1, 0.5), ("2024-01-01", "W3", 1, 0.5),
    ]
    assert got.count() == 8 and got.filter("cohort_size = 2").count() == 8
    assert rows(got.filter("is_period_complete"), "retention_period") == [("W1",), ("W2",), ("W3",), ("W4",)]

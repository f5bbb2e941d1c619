"""Edge cases of the event log, identity, sessions, funnel and memberships."""

from dataclasses import replace

from pyspark.sql import functions as F

from conftest import rows
from lifeloom.operators import funnel, identity, memberships, sessions
from lifeloom.operators.events import dedup_events


def test_earliest_load_wins(make_events):
    events = make_events(
        {"event_id": "late", "_loaded_at": "2024-01-17 10:05:00"},
        {"event_id": "late", "_loaded_at": "2024-01-15 10:05:00"},
        {"event_id": "dup", "_loaded_at": "2024-01-15 20:05:00"},
        {"event_id": "dup", "_loaded_at": "2024-01-15 12:05:00"},
        {"event_id": "replay", "_loaded_at": "2024-01-16 08:00:00"},
        {"event_id": "replay", "_loaded_at": "2024-01-15 10:05:00"},
        {"event_id": "tie", "_loaded_at": "2024-01-15 10:00:00", "ingest_time": "2024-01-15 09:00:02"},
        {"event_id": "tie", "_loaded_at": "2024-01-15 10:00:00", "ingest_time": "2024-01-15 09:00:01"},
    )
    kept = dedup_events(events)
    assert rows(kept, "event_id", "_loaded_at") == [
        ("dup", "2024-01-15 12:05:00"), ("late", "2024-01-15 10:05:00"),
        ("replay", "2024-01-15 10:05:00"), ("tie", "2024-01-15 10:00:00"),
    ]
    assert rows(kept.filter("event_id = 'tie'"), "ingest_time") == [("2024-01-15 09:00:01",)]


def test_out_of_order_events_are_all_kept(make_events):
    events = make_events(
        *[{"event_id": f"ord{i}", "event_time": t, "_loaded_at": "2024-01-15 15:00:00"}
          for i, t in enumerate(["2024-01-10 09:00:00", "2024-01-11 09:00:00", "2024-01-08 09:00:00"])]
    )
    assert dedup_events(events).count() == 3


def test_two_devices_stitch_to_one_user(make_events, policy):
    events = make_events(
        {"user_id": "u6", "anon_id": "a6"}, {"user_id": "u6", "anon_id": "a7"}, {"user_id": "u6", "anon_id": "a6"}
    )
    assert rows(identity.stitch_identity(events, policy), "anon_id", "user_id", "valid_to", "stitch_source") == [
        ("a6", "u6", None, "last_touch"), ("a7", "u6", None, "last_touch"),
    ]


def test_stitching_reaches_back_ninety_days(make_events, policy):
    events = make_events({"user_id": "u", "event_time": "2024-07-19 00:00:00"})
    assert rows(identity.stitch_identity(events, policy), "valid_from") == [("2024-04-20 00:00:00",)]


ALTERNATING = (
    {"user_id": "u1", "event_time": "2024-01-10 10:00:00"},
    {"user_id": "u1", "event_time": "2024-01-10 11:00:00"},
    {"user_id": "u2", "event_time": "2024-01-10 12:00:00"},
    {"user_id": "u1", "event_time": "2024-01-10 13:00:00"},
)


def test_alternating_owners_get_disjoint_intervals(make_events, policy):
    intervals = identity.stitch_identity(make_events(*ALTERNATING), policy)
    assert rows(intervals, "valid_from", "valid_to", "user_id", "stitch_source") == [
        ("2023-10-12 10:00:00", "2024-01-10 12:00:00", "u1", "historical"),
        ("2024-01-10 12:00:00", "2024-01-10 13:00:00", "u2", "historical"),
        ("2024-01-10 13:00:00", None, "u1", "last_touch"),
    ]


def test_overlapping_mode_reaches_back_to_the_previous_owner(make_events, policy):
    loose = replace(policy, identity_intervals="overlapping")
    events = make_events(*ALTERNATING, {"event_time": "2024-01-10 11:30:00", "event_id": "anon"})
    intervals = identity.stitch_identity(events, loose)
    assert rows(intervals, "valid_from", "valid_to", "user_id") == [
        ("2023-10-12 10:00:00", "2024-01-10 12:00:00", "u1"),
        ("2024-01-10 10:00:00", "2024-01-10 13:00:00", "u2"),
        ("2024-01-10 12:00:00", None, "u1"),
    ]
    resolved = identity.resolve_identity(events, intervals, loose)
    assert rows(resolved.filter("event_id = 'anon'"), "resolved_user_id") == [("u1",), ("u2",)]


def test_two_users_in_the_same_instant(make_events, policy):
    events = make_events(
        {"user_id": "u2", "event_time": "2024-01-10 10:00:00"}, {"user_id": "u1", "event_time": "2024-01-10 10:00:00"}
    )
    intervals = identity.stitch_identity(events, policy)
    assert rows(intervals, "user_id", "valid_from", "valid_to") == [
        ("u1", "2023-10-12 10:00:00", "2024-01-10 10:00:00"), ("u2", "2024-01-10 10:00:00", None),
    ]


def test_resolution_bounds_are_half_open(make_events, policy):
    events = make_events(
        *ALTERNATING,
        {"event_id": "x1", "event_time": "2023-10-12 10:00:00"},
        {"event_id": "x2", "event_time": "2023-10-12 09:59:59"},
        {"event_id": "x3", "event_time": "2024-01-10 12:00:00"},
        {"event_id": "x4", "event_time": "2024-03-01 00:00:00"},
        {"event_id": "x5", "anon_id": "nobody"},
    )
    intervals = identity.stitch_identity(events, policy)
    got = identity.resolve_identity(events, intervals, policy)
    assert rows(got.filter("event_id like 'x%'"), "event_id", "resolved_user_id") == [
        ("x1", "u1"), ("x3", "u2"), ("x4", "u1"),
    ]
    kept = identity.resolve_identity(events, intervals, policy, keep_anonymous=True)
    assert kept.count() == events.count()
    assert kept.filter("resolved_user_id is null").count() == 2


def test_session_boundary(make_events, policy):
    events = make_events(
        {"anon_id": "a8", "event_time": "2024-01-15 10:00:00"}, {"anon_id": "a8", "event_time": "2024-01-15 10:30:00"},
        {"anon_id": "a9", "event_time": "2024-01-15 10:00:00"}, {"anon_id": "a9", "event_time": "2024-01-15 10:30:01"},
        {"anon_id": "a10", "event_time": "2024-01-15 10:00:00"}, {"anon_id": "a10", "event_time": "2024-01-15 10:30:00.7"},
    )
    got = sessions.device_sessions(events, policy)
    assert rows(got.groupBy("anon_id").count(), "anon_id", "count") == [("a10", 1), ("a8", 1), ("a9", 2)]


def test_session_takes_attributes_of_its_first_event(make_events, policy):
    events = make_events(
        {"event_id": "b", "event_time": "2024-01-15 10:00:00", "utm_source": "second"},
        {"event_id": "a", "event_time": "2024-01-15 10:00:00", "utm_source": None, "platform": "ios"},
        {"event_id": "c", "event_time": "2024-01-15 10:20:00", "utm_source": "third", "event_type": "signup"},
        {"event_id": "d", "event_time": "2024-01-15 10:20:00", "user_id": "u"},
    )
    got = sessions.sessions(events, identity.stitch_identity(events, policy), policy)
    assert rows(got, "utm_source", "platform", "event_count", "page_view_count", "session_duration_seconds", "stitched_user_id") == [
        (None, "ios", 4, 3, 1200, "u")
    ]


def test_anonymous_sessions_are_kept(make_events, policy):
    events = make_events({"anon_id": "ghost"})
    got = sessions.sessions(events, identity.stitch_identity(events, policy), policy)
    assert rows(got, "anon_id", "stitched_user_id") == [("ghost", None)]


def _stages(make_events, policy, *steps):
    events = make_events(*[{"user_id": "u", "event_type": k, "event_time": f"2024-01-15 {t}:00"} for k, t in steps])
    resolved = identity.resolve_identity(events, identity.stitch_identity(events, policy), policy)
    return rows(funnel.funnel_stages(resolved), "stage_ordinal", "stage", "stage_reached_at", "is_current_stage")


def test_skipped_stage(make_events, policy):
    got = _stages(make_events, policy, ("page_view", "08:00"), ("signup", "08:05"), ("feature_use", "08:10"))
    assert [(g[1], g[3]) for g in got] == [("page_view", False), ("signup", False), ("feature_use", True)]


def test_a_later_visit_does_not_move_a_stage(make_events, policy):
    got = _stages(
        make_events, policy, ("page_view", "08:00"), ("signup", "08:05"), ("activation", "08:10"),
        ("checkout_start", "08:15"), ("page_view", "09:00"),
    )
    assert got[0] == (1, "page_view", "2024-01-15 08:00:00", False)
    assert [g[0] for g in got if g[3]] == [5]


def test_membership_intervals(make_events, policy):
    who = {"user_id": "u", "account_id": "a", "member_role": "admin"}
    events = make_events(
        who | {"event_type": "member_joined", "event_time": "2024-01-01 00:00:00"},
        who | {"event_type": "member_removed", "event_time": "2024-01-11 12:00:00"},
        who | {"event_type": "member_joined", "event_time": "2024-02-05 00:00:00"},
        who | {"event_type": "member_joined", "event_time": "2024-02-01 00:00:00", "account_id": None},
    )
    assert rows(memberships.account_memberships(events, policy), "valid_from", "valid_to", "role", "membership_duration_days") == [
        ("2024-01-01 00:00:00", "2024-01-11 12:00:00", "admin", 10), ("2024-02-05 00:00:00", None, "admin", 10),
    ]


def test_a_single_busy_device_is_spread_over_slices(spark, policy):
    """Half of all rows sit on one device; results equal the plain window form."""
    n = 20_000
    ids = spark.range(n)
    events = ids.select(
        F.when(F.col("id") % 2 == 0, "busy").otherwise(F.concat(F.lit("a"), F.col("id") % 500)).alias("anon_id"),
        F.concat(F.lit("u"), F.floor(F.col("id") / 700) % 3).alias("user_id"),
        F.timestamp_add("SECOND", F.col("id") * 13, F.lit("2024-01-01").cast("timestamp")).alias("event_time"),
    )
    got = identity.identity_transitions(events, policy)
    events.createOrReplaceTempView("busy_events")
    want = spark.sql("""
        select anon_id, user_id, event_time from (select *, lag(user_id) over (partition by anon_id order by event_time, user_id) p
        from busy_events) where p is null or p <> user_id""")
    assert rows(got, "anon_id", "user_id", "transition_time") == rows(want, "anon_id", "user_id", "event_time")


def test_flags_are_read_element_by_element(spark):
    from lifeloom.functions.json import parse_flags

    good = '{"experiment_id":"e","variant":"v"}'
    texts = [f'["z",{good}]', f"[{good},7]", '[{"experiment_id":{"a":1},"variant":"{x"}]', "no json", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select(parse_flags("t").alias("f"))
    got = [None if r.f is None else [tuple(x) for x in r.f] for r in df.collect()]
    assert got[0] == [(None, None), ("e", "v")] and got[1] == [("e", "v"), (None, None)]
    assert got[2] == [(None, "{x")] and got[4] is None


def test_sessionize_keeps_rows_without_a_key(spark):
    from lifeloom.operators.timeline import sessionize

    df = spark.createDataFrame([(None, "2024-01-01 00:00:00"), ("k", "2024-01-01 00:00:00")], "k string, t string")
    got = sessionize(df.withColumn("t", F.to_timestamp("t")), ["k"], "t", 1800).collect()
    assert sorted((r.k or "", r.session_seq) for r in got) == [("", 1), ("k", 1)]


def test_as_of_with_a_time_zone(spark):
    from datetime import datetime, timedelta, timezone

    from lifeloom import Policy

    at = datetime(2024, 2, 15, 1, tzinfo=timezone(timedelta(hours=3)))
    assert spark.range(1).select(F.date_format(Policy(as_of=at).as_of_time(), "yyyy-MM-dd HH")).first()[0] == "2024-02-14 22"


def test_exposures_parse_a_list_once_per_user(spark, frame):
    """Events are reduced to one row per user and list of flags before any list is parsed."""
    from lifeloom.operators import experiments

    flags = '[{"experiment_id":"a","variant":"x"},{"experiment_id":"b","variant":"y"}]'
    resolved = frame(
        "resolved_user_id string, event_id string, event_time timestamp, event_type string, experiment_flags string",
        *[("u", f"e{i}", f"2024-01-{i:02d} 10:00:00", "page_view", flags if i % 2 else flags.replace("b", "c")) for i in range(1, 9)],
        ("u", "e9", "2024-01-09 10:00:00", "page_view", None),
    )
    exposed = experiments.exposures(resolved)
    assert rows(exposed, "experiment_id", "variant", "first_exposure_at", "last_exposure_at") == [
        ("a", "x", "2024-01-01 10:00:00", "2024-01-08 10:00:00"),
        ("b", "y", "2024-01-01 10:00:00", "2024-01-07 10:00:00"),
        ("c", "y", "2024-01-02 10:00:00", "2024-01-08 10:00:00"),
    ]
    plan = exposed._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Generate") :]

"""Keys that fit one task are worked on whole, busy ones by time slices; both give the same rows."""

import re
from datetime import datetime, timedelta

import pytest
from conftest import rows

from lifeloom.operators import timeline
from lifeloom.operators.events import dedup_events
from lifeloom.operators.identity import resolve_identity, stitch_identity
from lifeloom.operators.sessions import device_sessions, sessions


@pytest.fixture(scope="module")
def events(make_events):
    start = datetime(2024, 1, 10)
    made = []
    for i in range(240):
        device = i % 4
        at = start + timedelta(seconds=(i * i * 37) % (2 * 86400))
        made.append(
            {
                "event_id": f"e{i:03d}", "anon_id": f"anon_{device}", "event_time": str(at),
                "user_id": None if i % 3 else f"user_{(i // 24 + device) % 3}",
                "event_type": "page_view" if i % 5 else "activation", "platform": ("web", "ios")[i % 2],
            }
        )
    return make_events(*made).cache()


def _sliced_and_whole(monkeypatch, make):
    whole = make()
    monkeypatch.setattr(timeline, "BUSY_ROWS", 0)  # every device that is counted is busy
    monkeypatch.setattr(timeline, "COUNTED", 1)
    return make(), whole


def test_sessions_of_busy_and_quiet_devices_are_the_same(events, policy, monkeypatch):
    def make():
        out = sessions(events, stitch_identity(events, policy), policy)
        return rows(out, *out.columns)

    sliced, whole = _sliced_and_whole(monkeypatch, make)
    assert sliced == whole and len(whole) > 20


def test_resolved_users_of_busy_and_quiet_devices_are_the_same(events, policy, monkeypatch):
    def make():
        out = resolve_identity(events, stitch_identity(events, policy), policy, keep_anonymous=True)
        return rows(out, "event_id", "resolved_user_id")

    sliced, whole = _sliced_and_whole(monkeypatch, make)
    assert sliced == whole and len(whole) == 240


def test_events_without_a_time_are_one_session(make_events, policy, monkeypatch):
    made = make_events({"event_id": "a"}, {"event_id": "b"}, {"event_id": "c", "event_time": "2024-01-10 12:00:00"})
    made = made.withColumn("event_time", made["event_time"]).selectExpr(
        *[c if c != "event_time" else "if(event_id = 'c', event_time, null) as event_time" for c in made.columns]
    )

    def make():
        out = device_sessions(made, policy)
        return rows(out, "session_start_at", "session_end_at", "event_count", "page_view_count")

    sliced, whole = _sliced_and_whole(monkeypatch, make)
    assert sliced == whole and [r[2] for r in whole] == [1, 2]


def _shuffles(df) -> list[str]:
    """The keys of all hash shuffles of the plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


def test_neighbours_of_quiet_keys_take_one_shuffle_of_the_rows(events, policy):
    out = timeline.with_neighbours(events, ["anon_id"], "event_time", ["event_time", "event_id"], ["event_id"], 60)
    assert sum(s.startswith("_key") and "anon_id" in s for s in _shuffles(out)) == 1
    visits = device_sessions(events, policy)
    assert sum(s.startswith("_key") and "anon_id" in s for s in _shuffles(visits)) == 1


def test_events_without_copies_are_not_shuffled(events):
    out = dedup_events(events)
    plan = out._jdf.queryExecution().optimizedPlan()
    passing, compared = plan.children().apply(0).toString(), plan.children().apply(1).toString()
    assert "Window" not in passing and "Window" in compared and "scalar-subquery" in passing
    assert out.count() == 240


def test_copies_are_found_among_all_rows(events):
    twice = events.unionByName(events.filter("event_id < 'e100'").selectExpr(
        *[c if c != "_loaded_at" else "_loaded_at - interval 1 hour as _loaded_at" for c in events.columns]
    ))
    out = dedup_events(twice)
    early = out.filter("_loaded_at < event_time")
    assert out.count() == 240 and early.count() == 100

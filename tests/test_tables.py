"""Sources, contracts, metrics, checks, incremental upkeep and streaming."""

import glob
import json
import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lifeloom.functions.keys import date_key, surrogate_key
from lifeloom.operators.events import dedup_events
from lifeloom.plans import declared, incremental, key_index, metrics, quality
from lifeloom.plans.build import Build
from lifeloom.sources import contracts, files, staging
from lifeloom.sources.tables import TableCatalog, shared_folder
from lifeloom.streaming import events as streams


@pytest.fixture()
def raw_event(spark):
    def make(properties):
        schema = contracts.struct(contracts.RAW["events"])
        base = spark.createDataFrame([(properties,)], "properties string")
        return base.select(*[
            F.col("properties") if f.name == "properties" else F.lit(None).cast(f.dataType).alias(f.name) for f in schema
        ])

    return make


@pytest.mark.parametrize(
    ("properties", "page", "seconds", "hours"),
    [
        ('{"page_url":"/p","duration_seconds":"12","time_to_activate_hours":2.5}', "/p", 12, 2.5),
        ('{"page_url":{"path":"/p"},"duration_seconds":2.5,"time_to_activate_hours":"n/a"}', None, None, None),
        ('{"page_url":["/p"],"duration_seconds":null}', None, None, None),
        ('{"page_url":"{braces} in a string"}', "{braces} in a string", None, None),
        ('{"page_url":"[list] in a string","duration_seconds":7}', "[list] in a string", 7, None),
        ('{"duration_seconds":"12x"}', None, None, None),
        ("not json", None, None, None),
        ("", None, None, None),
        (None, None, None, None),
    ],
)
def test_event_properties(raw_event, properties, page, seconds, hours):
    got = staging.stage_events(raw_event(properties)).first()
    assert (got["page_url"], got["feature_duration_seconds"], got["time_to_activate_hours"]) == (page, seconds, hours)


def test_keys(spark):
    got = spark.createDataFrame([("a", "b"), (None, "b")], "x string, y string").select(
        surrogate_key("x").alias("k"), surrogate_key("x", "y").alias("xy"), date_key(F.lit("2024-03-05")).alias("d")
    ).collect()
    assert got[0]["k"] == int("0cc175b9c0f1b6a831c399e269772661"[:15], 16) and got[0]["xy"] != got[0]["k"]
    assert (got[1]["k"], got[1]["xy"], got[1]["d"]) == (None, None, 20240305)


def test_seed_with_windows_line_ends(spark, tmp_path):
    path = tmp_path / "experiments.csv"
    path.write_bytes(
        b"experiment_id,experiment_name,status,start_date,end_date,description\r\n"
        b"e1,First,completed,2024-01-01,2024-02-01,\"Steps, fewer\"\r\ne2,Second,running,2024-03-01,,\r\n"
    )
    assert rows(files.read_seed(spark, str(path)), "experiment_id", "end_date", "description") == [
        ("e1", "2024-02-01", "Steps, fewer"), ("e2", None, None),
    ]


def test_calendar(spark):
    days = files.dim_date(spark)
    assert days.count() == 2192
    contracts.assert_schema(days, contracts.MARTS["dim_date"])
    got = days.filter("date_day = '2024-02-29'").first()
    assert (got["date_key"], got["day_name"], got["day_of_year"], str(got["week_start_date"]), got["is_weekend"]) == (
        20240229, "Thursday", 60, "2024-02-26", False,
    )


def test_contract_names_every_problem(spark):
    df = spark.sql("select 1 a, 'x' c")
    problems = contracts.contract_problems(df, "a string, b bigint")
    assert problems == ["missing column b", "unexpected column c", "column a is int, expected string"]
    with pytest.raises(contracts.ContractError):
        contracts.assert_schema(df, "a string")


def test_catalog_keeps_environments_apart(spark, tmp_path):
    prod, dev = (TableCatalog(spark, str(tmp_path), e) for e in ("prod", "dev"))
    assert prod.path("t") == f"{tmp_path}/marts/t"
    assert dev.path("t") == f"{tmp_path}/dev_marts/t"
    assert dev.schema_name(None) == "dev"
    dev.write("t", spark.range(3))
    dev.write("t", spark.range(2))
    assert dev.read("t").count() == 2 and not os.path.exists(prod.path("t"))


def test_shared_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == configured if configured else os.path.isdir(folder)


# --- incremental ----------------------------------------------------------------------------


def _load(spark, path, events, policy, conflict="earliest"):
    incremental.upsert_events(spark, path, events, policy, conflict)
    return incremental.read_events(spark, path)


def test_lookback_limits_the_batch(spark, make_events, policy, tmp_path):
    path = str(tmp_path / "events")
    _load(spark, path, make_events({"event_id": "seen", "_loaded_at": "2024-06-20 12:00:00"}), policy)
    batch = make_events(*[
        {"event_id": f"x{i}", "_loaded_at": t}
        for i, t in enumerate(["2024-06-20 12:00:00", "2024-06-19 12:00:00", "2024-06-18 12:00:00", "2024-06-16 08:00:00"])
    ])
    newest = incremental.read_events(spark, path).agg(F.max(F.unix_micros("_loaded_at"))).first()[0]
    got = incremental.fresh_rows(batch, newest, policy.events_incremental_lookback_hours)
    assert rows(got, "event_id") == [("x0",), ("x1",)]


@pytest.mark.parametrize(("conflict", "kept"), [("earliest", "2024-01-10 10:00:00"), ("replace", "2024-01-14 00:00:00")])
def test_replay_after_the_lookback(spark, make_events, policy, tmp_path, conflict, kept):
    path = str(tmp_path / "events")
    _load(spark, path, make_events({"event_id": "a"}, {"event_id": "b", "_loaded_at": "2024-01-13 00:00:00"}), policy)
    got = _load(spark, path, make_events({"event_id": "a", "_loaded_at": "2024-01-14 00:00:00"}), policy, conflict)
    assert rows(got.filter("event_id = 'a'"), "_loaded_at") == [(kept,)]
    assert got.count() == 2


def test_event_that_moves_to_another_day(spark, make_events, policy, tmp_path):
    path = str(tmp_path / "events")
    _load(spark, path, make_events(
        {"event_id": "a", "event_time": "2024-01-10 10:00:00"}, {"event_id": "b", "event_time": "2024-01-12 10:00:00"}
    ), policy)
    moved = make_events({"event_id": "a", "event_time": "2024-01-11 10:00:00", "_loaded_at": "2024-01-13 00:00:00"})
    got = _load(spark, path, moved, policy, "replace")
    assert rows(got, "event_id", "event_date") == [("a", "2024-01-11"), ("b", "2024-01-12")]
    incremental.vacuum(spark, path)
    assert not glob.glob(f"{path}/loads/*/days/_day=2024-01-10")
    assert incremental.read_events(spark, path).count() == 2


def test_untouched_days_are_not_rewritten(spark, make_events, policy, tmp_path):
    path = str(tmp_path / "events")
    _load(spark, path, make_events({"event_id": "a", "event_time": "2024-01-01 00:00:00"}, {"event_id": "b"}), policy)
    before = glob.glob(f"{path}/loads/*/days/_day=2024-01-01/*.parquet")
    _load(spark, path, make_events({"event_id": "c"}), policy)
    assert before and glob.glob(f"{path}/loads/*/days/_day=2024-01-01/*.parquet") == before
    assert incremental.read_events(spark, path).count() == 3


def test_empty_first_batch_does_not_block_later_ones(spark, make_events, policy, tmp_path):
    path = str(tmp_path / "events")
    assert _load(spark, path, make_events({}).limit(0), policy).count() == 0
    assert _load(spark, path, make_events({"event_id": "a"}, {"event_id": "b"}), policy).count() == 2


def test_rows_without_a_day_stay(spark, make_events, policy, tmp_path):
    path = str(tmp_path / "events")
    undated = lambda i: make_events({"event_id": i}).withColumn("event_date", F.lit(None).cast("date"))
    _load(spark, path, undated("a"), policy)
    assert rows(_load(spark, path, undated("b"), policy), "event_id") == [("a",), ("b",)]


def test_load_that_dies_before_its_end_changes_nothing(spark, make_events, policy, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    _load(spark, path, make_events({"event_id": "a"}), policy)

    def fail(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(incremental, "_commit", fail)
        with pytest.raises(RuntimeError):
            _load(spark, path, make_events({"event_id": "b"}), policy)
    assert rows(incremental.read_events(spark, path), "event_id") == [("a",)]
    assert rows(_load(spark, path, make_events({"event_id": "b"}), policy), "event_id") == [("a",), ("b",)]


def _files_read(spark, monkeypatch, path, batch, policy):
    """Folders of the index and of days that one load reads."""
    seen = {"index": [], "days": []}
    read_index, read_days, merges = key_index.read, incremental._read, key_index.extended

    def index(spark, paths):
        seen["index"] += paths
        return read_index(spark, paths)

    def days(spark, path, folders):
        seen["days"] += folders
        return read_days(spark, path, folders)

    with monkeypatch.context() as m:
        m.setattr(key_index, "read", index)
        m.setattr(incremental, "_read", days)
        # merges are paid for over many loads; they are counted by the number of segments
        m.setattr(key_index, "extended", lambda *a: (m.setattr(key_index, "read", read_index), merges(*a))[1])
        incremental.upsert_events(spark, path, batch, policy, lookback=False)
    return seen


def test_a_load_reads_its_own_buckets_and_days_however_long_the_history(spark, make_events, policy, tmp_path, monkeypatch):
    path = str(tmp_path / "events")
    read, segments = [], []
    for i in range(9):
        day = f"2024-01-{i + 1:02d} 10:00:00"
        batch = make_events(*({"event_id": f"d{i}-{j}", "event_time": day} for j in range(5)), {"event_id": "d0-1", "event_time": day, "_loaded_at": day})
        seen = _files_read(spark, monkeypatch, path, batch, policy)
        buckets = {r[0] for r in key_index.entries(batch, "event_id", "event_date").select(key_index.bucket(key_index.BUCKETS)).collect()}
        index = incremental._manifest(spark, path)["index"]["segments"]
        assert {int(p.rpartition("=")[2]) for p in seen["index"]} <= buckets
        # the day on which the replayed event is stored, and the two days just written
        assert len([d for d in seen["days"] if f"/{i + 1}-" not in f"/{d.split('/')[1]}"]) <= 1 and len(seen["days"]) <= 3
        segments.append(len(index))
        read.append(len(seen["index"]))
    assert max(segments) <= 2 * (key_index.FAN - 1)  # two levels for 4 to 15 loads
    assert max(read) <= len(buckets) * max(segments)
    stored = incremental.read_events(spark, path)
    assert stored.count() == 9 * 5 and rows(stored.filter("event_id = 'd0-1'"), "event_date") == [("2024-01-01",)]
    incremental.vacuum(spark, path)
    assert incremental.read_events(spark, path).count() == 9 * 5
    again = make_events({"event_id": "d3-2", "event_time": "2024-03-01 00:00:00", "_loaded_at": "2024-03-01 00:00:00"})
    incremental.upsert_events(spark, path, again, policy, "replace")  # found by the index after the vacuum
    moved = incremental.read_events(spark, path)
    assert moved.count() == 9 * 5 and rows(moved.filter("event_id = 'd3-2'"), "event_date") == [("2024-03-01",)]


def test_an_older_table_gets_its_index_with_the_next_load(spark, make_events, policy, tmp_path):
    path = str(tmp_path / "events")
    _load(spark, path, make_events({"event_id": "a", "event_time": "2024-01-01 00:00:00"}, {"event_id": "b"}), policy)
    before = incremental._manifest(spark, path)
    del before["index"]
    incremental._commit(spark, path, before | {"number": 2})
    moved = make_events({"event_id": "a", "event_time": "2024-01-05 00:00:00", "_loaded_at": "2024-02-01 00:00:00"})
    got = _load(spark, path, moved, policy, "replace")
    assert rows(got, "event_id", "event_date") == [("a", "2024-01-05"), ("b", "2024-01-10")]
    incremental.vacuum(spark, path)
    assert rows(_load(spark, path, make_events({"event_id": "a"}), policy), "event_id") == [("a",), ("b",)]


@pytest.mark.parametrize("conflict", ["earliest", "replace"])
def test_many_loads_equal_the_rule_applied_to_all_rows(spark, make_events, policy, tmp_path, conflict):
    """Random replays that may change the day, load after load."""
    rng, path, stored = random.Random(8), str(tmp_path / "events"), {}
    for load in range(6):
        at = f"2024-01-{load + 1:02d}"
        ids = rng.sample(range(30), 8)
        batch = {f"e{i}": f"2024-01-{rng.randint(1, 9):02d}" for i in ids}
        upserted = make_events(*({"event_id": e, "event_time": f"{d} 01:00:00", "_loaded_at": f"{at} 12:00:00"} for e, d in batch.items()))
        incremental.upsert_events(spark, path, upserted, policy, conflict)
        stored = stored | batch if conflict == "replace" else batch | stored
    assert rows(incremental.read_events(spark, path), "event_id", "event_date") == sorted(stored.items())


def test_build_reads_the_kept_events(spark, make_events, policy, tmp_path):
    kept = _load(spark, str(tmp_path / "events"), make_events({"event_id": "a"}), policy)
    assert Build({}, policy, events=kept)["events_normalized"].count() == 1


def test_batch_with_other_columns_is_refused(spark, make_events, policy, tmp_path):
    with pytest.raises(contracts.ContractError):
        incremental.upsert_events(spark, str(tmp_path / "events"), make_events({}).withColumn("extra", F.lit(1)), policy)


# --- streaming ------------------------------------------------------------------------------


def _stream(spark, folder, *batches):
    for i, b in enumerate(batches):
        b.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        for f in glob.glob(f"{folder}/in/*.parquet"):
            if not os.path.basename(f).startswith("batch"):
                os.rename(f, f"{folder}/in/batch{i}.parquet")
    schema = contracts.struct(contracts.STAGED_EVENTS)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("pathGlobFilter", "batch*").parquet(f"{folder}/in")


def test_stream_upsert_converges_to_a_rebuild(spark, make_events, policy, tmp_path):
    first = make_events({"event_id": "a"}, {"event_id": "b", "_loaded_at": "2024-01-10 12:00:00"})
    second = make_events({"event_id": "b", "_loaded_at": "2024-01-10 11:00:00"}, {"event_id": "c", "_loaded_at": "2024-01-10 13:00:00"})
    stream = _stream(spark, tmp_path, first, second)
    path = str(tmp_path / "out")
    streams.upsert_stream(spark, stream, path, str(tmp_path / "progress"), policy)
    got = incremental.read_events(spark, path)
    want = dedup_events(first.unionByName(second))
    assert rows(got, "event_id", "_loaded_at") == rows(want, "event_id", "_loaded_at")


def test_stream_upsert_of_files_in_any_order(spark, make_events, policy, tmp_path):
    loaded = ["2024-01-20 00:00:00", "2024-01-10 00:00:00", "2024-01-15 00:00:00"]
    parts = [make_events({"event_id": f"e{i}", "_loaded_at": t}) for i, t in enumerate(loaded)]
    stream, path = _stream(spark, tmp_path, *parts), str(tmp_path / "out")
    streams.upsert_stream(spark, stream, path, str(tmp_path / "progress"), policy)
    assert rows(incremental.read_events(spark, path), "event_id") == [("e0",), ("e1",), ("e2",)]


def test_stream_dedup_across_batches(spark, make_events, policy, tmp_path):
    stream = _stream(
        spark, tmp_path,
        make_events({"event_id": "a"}, {"event_id": "a"}),
        make_events({"event_id": "a", "_loaded_at": "2024-01-10 18:00:00"}, {"event_id": "b", "_loaded_at": "2024-01-10 18:00:00"}),
    )
    out = str(tmp_path / "out")
    streams.drain(streams.dedup_stream(stream, policy), str(tmp_path / "progress"), out)
    assert rows(spark.read.parquet(out), "event_id", "_loaded_at") == [
        ("a", "2024-01-10 10:00:00"), ("b", "2024-01-10 18:00:00"),
    ]


def test_stream_sessions_truncate_to_whole_seconds(spark, make_events, policy, tmp_path):
    stream = _stream(
        spark, tmp_path,
        make_events(
            {"anon_id": "a", "event_time": "2024-01-01 10:00:00"}, {"anon_id": "a", "event_time": "2024-01-01 10:30:00.7"},
            {"anon_id": "b", "event_time": "2024-01-01 10:00:00"}, {"anon_id": "b", "event_time": "2024-01-01 10:30:01"},
            {"anon_id": "z", "event_time": "2024-01-09 10:00:00"},
        ),
    )
    out = str(tmp_path / "out")
    streams.drain(streams.session_stream(stream, policy), str(tmp_path / "progress"), out)
    assert rows(spark.read.parquet(out), "anon_id", "event_count", "session_duration_seconds") == [
        ("a", 2, 1800), ("b", 1, 0), ("b", 1, 0),
    ]


# --- metrics --------------------------------------------------------------------------------


def test_metric_by_dimension_and_grain(frame):
    t = {"fct_mrr_movements": frame(
        "account_id string, movement_date date, movement_type string, mrr_delta decimal(28,9)",
        ("a", "2024-01-31", "new", 10), ("a", "2024-02-01", "expansion", 5), ("b", "2024-02-28", "new", 7),
    )}
    assert rows(metrics.metric(t, "net_mrr", grain="MONTH"), "period", "net_mrr") == [
        ("2024-01-01", Decimal(10)), ("2024-02-01", Decimal(12)),
    ]
    assert rows(metrics.metric(t, "net_mrr", ["movement_type"]), "movement_type", "net_mrr") == [
        ("expansion", Decimal(5)), ("new", Decimal(17)),
    ]
    assert rows(metrics.cumulative_net_mrr(t["fct_mrr_movements"]), "period", "cumulative_mrr") == [
        ("2024-01-01", Decimal(10)), ("2024-02-01", Decimal(22)),
    ]
    with pytest.raises(ValueError):
        metrics.metric(t, "net_mrr", grain="HOUR")


def test_every_metric_set_member_is_declared():
    assert all(m in metrics.METRICS for names in metrics.METRIC_SETS.values() for m in names)
    assert len(metrics.METRICS) == 23


def test_net_revenue_retention(frame, policy):
    moves = frame(
        "account_id string, movement_date date, movement_type string, mrr_delta decimal(28,9)",
        ("a", "2023-11-05", "new", 100), ("b", "2023-11-20", "new", 50),
        ("a", "2023-12-01", "expansion", 20), ("b", "2023-12-15", "churn", -50),
        ("b", "2024-02-01", "reactivation", 30), ("b", "2024-02-03", "expansion", 10),  # had no MRR in between
        ("a", "2024-02-10", "contraction", -60),
    )
    assert rows(metrics.net_revenue_retention(moves, policy), "cohort", "period", "starting_mrr", "net_revenue_retention") == [
        ("2023-11-01", "2023-12-01", Decimal(150), 120 / 150),
        ("2023-11-01", "2024-01-01", Decimal(120), 1.0),
        ("2023-11-01", "2024-02-01", Decimal(120), 0.5),
    ]


# --- checks ---------------------------------------------------------------------------------


def test_checks_report_status_by_threshold(spark):
    two = spark.sql("select * from values (1), (2) t(x)")
    got = quality.run_checks([
        quality.Check("fails", two), quality.Check("warns", two, warn_if=0, error_if=10),
        quality.Check("passes", two.filter("x > 5")), quality.Check("never fails", two, warn_if=0, error_if=None),
        quality.Check("weighted", spark.sql("select 11L n_rows"), warn_if=0, error_if=10, weight="n_rows"),
    ])
    assert rows(got, "check_name", "failures", "status") == [
        ("fails", 2, "error"), ("never fails", 2, "warn"), ("passes", 0, "pass"), ("warns", 2, "warn"), ("weighted", 11, "error"),
    ]


def test_column_checks(frame):
    df = frame("id bigint, kind string, n double", (1, "a", 5), (1, "b", None), (None, "z", -1), (None, None, 200))
    assert rows(quality.unique(df, "id"), "id", "n_rows") == [(1, 2)]
    assert rows(quality.not_null(df), "column_name", "n_rows") == [("id", 2), ("kind", 1), ("n", 1)]
    assert rows(quality.accepted_values(df, "kind", ["a", "b"]), "value", "n_rows") == [("z", 1)]
    assert rows(quality.outside(df, "n", 0, 100), "n") == [(-1.0,), (200.0,)]
    assert rows(quality.violating(df, "n > 0"), "n") == [(-1.0,)]
    parent = frame("id bigint", (7,))
    assert rows(quality.relationships(df, "id", parent, "id"), "value", "n_rows") == [(1, 2)]
    assert quality.uncovered(df, parent, "id").count() == 1


def test_keys_of_many_tables_in_one_pass(spark, frame):
    t = {
        "a": frame("k bigint, x string, y string", (1, "p", None), (1, None, "p"), (None, "p", None), (None, "q", "r")),
        "b": frame("k bigint", (1,), (2,)),
        "c": frame("k bigint").limit(0),
    }
    got = declared.unique_failures(spark, t, {"a": ["k", "x, y"], "b": ["k"], "c": ["k"]})
    # (p, NULL) occurs twice, (NULL, p) is another combination; NULL alone is no key
    assert rows(got, "check_name", "failures") == [("a.k unique", 2), ("a.x, y unique", 2), ("b.k unique", 0), ("c.k unique", 0)]


def test_an_orphan_is_seen_for_every_foreign_key(spark, frame):
    children, keys = {}, {}
    for child, pairs in declared.FOREIGN_KEYS.items():
        columns = [p.partition(":")[0] for p in pairs.split()]
        keys |= {(child, c): i + 2 for i, c in enumerate(columns)}
        # key 1 is known; column i has i + 2 orphans, nulls besides, and one row that its condition leaves out
        ddl = ", ".join(f"{c} bigint" for c in columns) + ", is_period_complete boolean"
        known = [tuple([1] * len(columns)) + (True,)] * 3 + [tuple([None] * len(columns)) + (True,)]
        lost = [tuple(999 if j == i else 1 for j in range(len(columns))) + (True,) for i in range(len(columns)) for _ in range(i + 2)]
        left_out = [(1, 999, False)] if child == "fct_retention_cohorts" else []
        children[child] = frame(ddl, *known, *lost, *left_out)
    parents = {p: frame(f"{c} bigint", (1,), (2,)) for p, c in declared.PARENT_KEYS.items()}
    tables = {t: children[t] if t not in parents else children[t].crossJoin(parents[t]) if t in children else parents[t] for t in {*children, *parents}}
    # some parents are children as well; each of their rows stands there twice
    got = {r.check_name: r.failures for r in declared.orphans(spark, tables).collect()}
    assert len(got) == 37
    for name, failures in got.items():
        child, _, column = name.partition(" -> ")[0].partition(".")
        assert failures == keys[child, column] * (2 if child in parents else 1), name


def test_declared_rules_are_complete():
    """As many as the tables promise, each on a column that exists."""
    rules = [n for t in declared.TABLES for n in declared.row_checks(t)]
    kinds = Counter(n.rpartition(" ")[2] if not n.endswith("not null") else "not null" for n in rules)
    assert kinds == {"not null": 302 - 4, "accepted": 38, "range": 16}
    assert sum("," in k for keys in declared.UNIQUE.values() for k in keys) == 10
    assert len(declared.TABLES) == 39 and set(contracts.NULLABLE) <= set(declared.TABLES)


def test_rules_counted_while_writing_equal_a_pass_of_their_own(spark, frame, tmp_path):
    df = frame(
        "invoice_id string, subscription_id string, user_id string, account_id string, issued_at timestamp, paid_at timestamp, "
        "_loaded_at timestamp, amount decimal(28,9), currency string, status string, refund_amount decimal(28,9), line_items string",
        ("i1", "s", None, "a", "2024-01-01 00:00:00", None, None, -1, "USD", "paid", 0, None),
        ("i2", "s", None, "a", None, None, None, 5, None, "lost", -2, None),
    )
    passing = declared.counted("stg_invoices", df, {"odd": "amount > 0"})
    passing.rows.write.parquet(str(tmp_path / "t"))
    counts = passing.failures()
    assert {k: v for k, v in counts.items() if v} == {
        "stg_invoices.user_id not null": 2, "stg_invoices.issued_at not null": 1, "stg_invoices._loaded_at not null": 2,
        "stg_invoices.currency not null": 1, "stg_invoices.status accepted": 1, "stg_invoices.amount range": 1,
        "stg_invoices.refund_amount range": 1, "odd": 1,
    }
    read = declared.row_failures(spark, {"stg_invoices": df}, ["stg_invoices"], rules={"stg_invoices": {"odd": "amount > 0"}})
    told = declared.row_failures(spark, {}, ["stg_invoices"], {"stg_invoices": counts})
    assert rows(read, "check_name", "failures") == rows(told, "check_name", "failures")


def test_table_checks(spark, frame, policy):
    a, b = spark.range(3), spark.range(5)
    assert rows(quality.row_count_difference(a, b), "mart_count", "source_count", "row_delta") == [(3, 5, -2)]
    assert quality.row_count_difference(a, a).count() == 0
    assert rows(quality.empty_tables({"a": a, "none": a.limit(0)}), "table_name") == [("none",)]
    assert quality.too_few_rows(a, 4).count() == 1 and quality.too_few_rows(b, 4).count() == 0
    ages = [("2024-02-14 12:00:00", "pass"), ("2024-02-13 12:00:00", "warn"), ("2024-02-12 12:00:00", "error"), (None, "error")]
    for at, status in ages:
        got = quality.freshness(frame("_loaded_at timestamp", (at,)), policy).first()
        assert got["status"] == status


def test_dedup_rate_fails_on_an_empty_window(make_events, policy):
    staged = make_events({"event_id": "a"}, {"event_id": "a"}, {"event_id": "b"})
    assert quality.dedup_rate_too_high(staged, dedup_events(staged), policy).count() == 1
    nothing = staged.filter("false")
    assert quality.dedup_rate_too_high(nothing, nothing, policy).count() == 1
    assert quality.dedup_rate_too_high(staged.filter("event_id = 'b'"), staged.filter("event_id = 'b'"), policy).count() == 0


def test_reconciliation(frame):
    left = frame("account_id string, mrr_delta decimal(28,9)", ("a", 1), ("a", 2), ("b", 5), ("c", 1))
    right = frame("account_id string, mrr_delta decimal(28,9)", ("a", 3), ("b", 4), ("d", 1))
    assert rows(quality.totals_differ(left, right, "account_id", "mrr_delta"), "account_id") == [("b",), ("c",), ("d",)]


# --- registry -------------------------------------------------------------------------------


def test_registry_needs_no_session_and_covers_the_inventory():
    import __spark_entry__ as entry_points

    queries, oracle = entry_points.queries(), entry_points.oracle_sql()
    assert set(oracle) <= set(queries)
    idents = {q.split("_")[0] for q in queries}
    want = [f"src{i}" for i in range(1, 9)] + [f"snk{i}" for i in range(1, 5)] + [f"e{i}" for i in range(1, 12)]
    want += [f"b{i}" for i in range(1, 6)] + [f"c{i}" for i in range(1, 19)] + ["k1", "k2", "br1"]
    want += [f"d{i}" for i in range(1, 7)] + [f"f{i}" for i in range(1, 12)] + [f"m{i}" for i in range(1, 29)]
    want += [f"q{i}" for i in range(1, 26)] + ["st1", "st2", "st3"]
    assert [w for w in want if w not in idents] == []
    json.dumps(oracle)


def test_core_queries_match_duckdb(spark):
    from verification.catalog import ORACLE, QUERIES
    from verification.compare import differences, duck

    sf_dir = "/root/testdata/sf0.001"
    if not os.path.isdir(sf_dir):
        pytest.skip("no driver tables here")
    con = duck(sf_dir)
    names = ["e9_sessions", "b4_checkout_conversion", "c5_attribution", "c9_engagement_states", "d1_dim_users",
             "d2_dim_accounts", "f6_fct_retention_cohorts", "m26_net_revenue_retention", "q14_overlaps"]
    assert {n: differences(con, QUERIES[n](spark, sf_dir), ORACLE[n]) for n in names} == dict.fromkeys(names)


# --- reference files ------------------------------------------------------------------------


def _seed(spark, tmp_path, text):
    path = tmp_path / "seed.csv"
    path.write_text(text)
    return files.read_seed(spark, str(path), "id bigint, at timestamp").collect()


def test_seed_refuses_what_it_cannot_read(spark, tmp_path):
    assert _seed(spark, tmp_path, "id,at\n1,2024-01-01 00:00:00.250000\n")[0].at.microsecond == 250000
    assert _seed(spark, tmp_path, "id,at\n1,2024-01-01 00:00:01\n")[0].at.second == 1
    for bad in ("at,id\n2024-01-01 00:00:00,1\n", "id,at\nx,2024-01-01 00:00:00\n", "id,at\n1,soon\n"):
        with pytest.raises(Exception):  # noqa: B017
            _seed(spark, tmp_path, bad)


def test_registered_calendar_follows_the_subscriptions(spark, frame, monkeypatch):
    """The days come from the subscription events, not from fixed bounds."""
    from verification import catalog

    staged = frame("event_time timestamp", ("2019-12-31 10:00:00",), ("2020-02-03 10:00:00",))
    monkeypatch.setattr(catalog, "build_for", lambda spark, sf_dir: {"stg_subscriptions": staged})
    got = catalog.QUERIES["d6_dim_date"](spark, "")
    assert tuple(got.agg(F.min("first_key"), F.max("year_number"), F.sum("days")).first()) == (20190101, 2020, 365 + 366)
    assert "stg_subscriptions" in catalog.ORACLE["d6_dim_date"]


def test_streams_get_their_loads_in_parallel(spark, make_events, tmp_path, monkeypatch):
    """No load is one file of one task, and every load is one run of the stream."""
    from verification import catalog

    days = [{"event_time": f"2024-01-{d:02d} {h:02d}:00:00"} for d in range(1, 10) for h in range(20)]
    staged = make_events(*days).repartition(4)
    monkeypatch.setattr(catalog, "scratch", lambda b, name: str(tmp_path / name))
    seen = []

    def run(stream, path):
        got = f"{path}-got"
        streams.drain(stream.select("event_id", "event_time"), f"{path}-progress", got)
        seen.append((len(glob.glob(f"{path}-files/*.parquet")), spark.read.parquet(got).count()))

    catalog._in_loads({"stg_events": staged}, "loads", run)
    assert [n for _, n in seen] == [60, 120, 180] and [f > 2 * i for i, (f, _) in enumerate(seen, 1)] == [True] * 3

"""Every registered query, next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lifeloom.functions.columns import MONEY
from lifeloom.functions.keys import date_key, surrogate_key
from lifeloom.operators import billing, engagement, experiments, funnel, growth, health, identity, memberships, sessions, timeline
from lifeloom.operators.events import dedup_events
from lifeloom.plans import incremental, marts, metrics, quality
from lifeloom.plans.build import MART_NAMES, RESOLVED_COLUMNS, Build
from lifeloom.sources import contracts, files
from lifeloom.sources.tables import TableCatalog, write_table
from lifeloom.streaming import events as streams

from .context import POLICY, build_for, comparable, scratch
from .gate_sql import gate_sql
from .tables_sql import AS_OF, EVENT_COLUMNS, MONEY_COLUMNS, day_key, key, whole_table, with_tables

Recipe = Callable[[Build], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, recipe: Recipe, sql: str | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(recipe(build_for(spark, sf_dir)))

    run.__name__ = name
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = with_tables(sql)


def register_table(name: str, table: str, money: tuple[str, ...] = ()) -> None:
    """A table computed by its own operator, compared row by row."""
    register(name, lambda b: b.compute(table), None)
    ORACLE[name] = whole_table(table, money)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Averages of doubles depend on summation order in the last bits; compare the rest."""
    return df.select(*[F.round(c, digits).alias(c) if c in columns else F.col(c) for c in df.columns])


# --- sources and sinks ----------------------------------------------------------------------

register_table("src1_stage_events", "stg_events")
register_table("src2_stage_subscriptions", "stg_subscriptions", ("mrr_amount",))
register_table("src3_stage_invoices", "stg_invoices", ("amount", "refund_amount"))
register_table("src4_stage_spend", "stg_spend", ("spend_amount",))
register_table("src5_stage_tickets", "stg_tickets")


def _seed_round_trip(b: Build) -> DataFrame:
    path = scratch(b, "seed")
    b["experiments"].write.csv(path, header=True)
    return files.read_seed(b["experiments"].sparkSession, path)


def _event_file_round_trip(b: Build) -> DataFrame:
    path = scratch(b, "event-files")
    spark = b["stg_events"].sparkSession
    b["stg_events"].write.csv(path, header=True, timestampFormat="yyyy-MM-dd HH:mm:ss")
    return files.read_seed(spark, path, contracts.STAGED_EVENTS)


register("src6_read_seed", _seed_round_trip, "SELECT * FROM experiments")
register("src7_read_event_files", _event_file_round_trip, "SELECT * FROM stg_events")
register(
    "src8_calendar_days",
    lambda b: files.calendar_days(
        b["stg_tickets"].agg(
            F.min(F.to_date("created_at")).alias("first"), F.max(F.to_date("created_at")).alias("last")
        ),
        "first",
        "last",
    ),
    f"""
SELECT {day_key('d')} AS date_key, d AS date_day, CAST(isodow(d) AS BIGINT) AS day_of_week, dayname(d) AS day_name,
 CAST(day(d) AS BIGINT) AS day_of_month, CAST(dayofyear(d) AS BIGINT) AS day_of_year,
 CAST(date_trunc('week', d) AS DATE) AS week_start_date, CAST(date_trunc('month', d) AS DATE) AS month_start_date,
 monthname(d) AS month_name, CAST(month(d) AS BIGINT) AS month_number, CAST(quarter(d) AS BIGINT) AS quarter_number,
 CAST(date_trunc('quarter', d) AS DATE) AS quarter_start_date, CAST(year(d) AS BIGINT) AS year_number,
 isodow(d) >= 6 AS is_weekend
FROM (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(min(created_at) AS DATE) AS lo, CAST(max(created_at) AS DATE) AS hi FROM stg_tickets) AS b) AS s""",
)


def _rebuilt_table(b: Build) -> DataFrame:
    path = scratch(b, "rebuilt")
    for _ in range(2):  # the second full rebuild must replace the first
        write_table(b["fct_invoices"], path)
    return b["fct_invoices"].sparkSession.read.parquet(path)


def _view(b: Build) -> DataFrame:
    b["ticket_metrics"].createOrReplaceTempView("lifeloom_ticket_metrics")
    return b["ticket_metrics"].sparkSession.sql(
        "SELECT priority, status, count(*) AS tickets FROM lifeloom_ticket_metrics GROUP BY ALL"
    )


def _catalog(b: Build) -> DataFrame:
    spark = b["stg_spend"].sparkSession
    catalog = TableCatalog(spark, scratch(b, "catalog"), "dev")
    paths = b.write(catalog, ["fct_marketing_spend", "spend_prep"])
    expected = {
        "fct_marketing_spend": f"{catalog.root}/dev_marts/fct_marketing_spend",
        "spend_prep": f"{catalog.root}/dev_intermediate/spend_prep",
    }
    if paths != expected:
        raise AssertionError(paths)
    return catalog.read("fct_marketing_spend")


register("snk1_rebuild_table", _rebuilt_table, None)
ORACLE["snk1_rebuild_table"] = whole_table("fct_invoices", ("amount", "refund_amount", "net_amount"))
register(
    "snk2_view", _view, "SELECT priority, status, count(*) AS tickets FROM ticket_metrics GROUP BY ALL"
)
register("snk4_catalog", _catalog, None)
ORACLE["snk4_catalog"] = whole_table("fct_marketing_spend", ("spend_amount",))

# --- event log ------------------------------------------------------------------------------

register_table("e1_dedup_events", "events_normalized")


def _upsert(on_conflict: str) -> Recipe:
    """Load all but the last ten days, then a batch that overlaps the load by three days."""

    def run(b: Build) -> DataFrame:
        staged, path = b["stg_events"], scratch(b, "events")
        spark = staged.sparkSession
        cut = F.timestamp_add("DAY", F.lit(-10), staged.agg(F.max("_loaded_at")).scalar())
        incremental.upsert_events(spark, path, staged.filter(F.col("_loaded_at") < cut), POLICY)
        overlap = staged.filter(F.col("_loaded_at") >= F.timestamp_add("HOUR", F.lit(-72), cut))
        incremental.upsert_events(spark, path, overlap, POLICY, on_conflict)
        return incremental.read_events(spark, path)

    return run


register(
    "e2_upsert_earliest",
    _upsert("earliest"),
    f"SELECT {EVENT_COLUMNS} FROM events_normalized",
)
register(
    "e2_upsert_replace",
    _upsert("replace"),
    """SELECT * FROM first_load WHERE event_id NOT IN (SELECT event_id FROM fresh_batch)
UNION ALL SELECT * FROM fresh_batch""",
)


def _mart_of_kept_events(b: Build) -> DataFrame:
    """Load, upsert, and a mart of the table that is kept, without the raw event log."""
    raw = {name: df for name, df in b.raw.items() if name != "events"}
    return Build(raw, b.policy, events=_upsert("earliest")(b))["fct_signups"]


register("e2_build_from_kept_events", _mart_of_kept_events, None)
ORACLE["e2_build_from_kept_events"] = whole_table("fct_signups")

register(
    "snk3_incremental_sink",
    lambda b: _upsert("earliest")(b).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("_loaded_at").alias("newest")
    ),
    "SELECT event_date, count(*) AS n_rows, max(_loaded_at) AS newest FROM events_normalized GROUP BY 1",
)
register(
    "e3_identity_transitions",
    lambda b: identity.identity_transitions(b["events_normalized"], b.policy),
    "SELECT * FROM transitions",
)
register_table("e4_stitch_identity", "identity_stitched")


def _overlapping(b: Build):
    from dataclasses import replace

    return replace(b.policy, identity_intervals="overlapping")


register(
    "e4_stitch_identity_overlapping",
    lambda b: identity.stitch_identity(b["events_normalized"], _overlapping(b)),
    "SELECT * FROM identity_overlapping",
)
register(
    "e5_resolve_identity",
    lambda b: identity.resolve_identity(b["events_normalized"], b["identity_stitched"], b.policy),
    "SELECT * FROM resolved_events",
)
register(
    "e5_resolved_events",
    lambda b: b.compute("resolved_events"),
    f"SELECT {', '.join(RESOLVED_COLUMNS)}, resolved_user_id FROM resolved_events",
)
register(
    "e5_resolve_identity_overlapping",
    lambda b: identity.resolve_identity(
        b["events_normalized"], identity.stitch_identity(b["events_normalized"], _overlapping(b)), _overlapping(b)
    ),
    "SELECT * FROM resolved_overlapping",
)
register(
    "e5_keep_anonymous",
    lambda b: identity.resolve_identity(b["events_normalized"], b["identity_stitched"], b.policy, True)
    .groupBy("event_type")
    .agg(F.count(F.lit(1)).alias("n_rows"), F.count("resolved_user_id").alias("resolved")),
    """
SELECT e.event_type, count(*) AS n_rows, count(r.resolved_user_id) AS resolved
FROM events_normalized AS e LEFT JOIN resolved_events AS r USING (event_id) GROUP BY 1""",
)
register(
    "e6_sessionize",
    lambda b: timeline.sessionize(
        b["events_normalized"].select("event_id", "anon_id", "event_time"),
        ["anon_id"],
        "event_time",
        b.policy.session_timeout_seconds,
    ),
    "SELECT event_id, anon_id, event_time, session_seq FROM numbered_events",
)
register(
    "e7_session_entry",
    lambda b: sessions.device_sessions(b["events_normalized"], b.policy).select(
        "session_id", "anon_id", *sessions.ENTRY_ATTRIBUTES
    ),
    """SELECT session_id, anon_id, utm_source, utm_medium, utm_campaign, platform, device_type, browser
FROM device_sessions""",
)
register(
    "e8_device_sessions",
    lambda b: sessions.device_sessions(b["events_normalized"], b.policy),
    "SELECT * FROM device_sessions",
)
register_table("e9_sessions", "sessions")
register_table("e10_account_memberships", "account_memberships")
register_table("e11_funnel_stages", "funnel_staged")

# --- billing --------------------------------------------------------------------------------

register_table("b1_subscription_lifecycle", "subscription_lifecycle", ("mrr_amount",))
register_table("b2_mrr_movements", "mrr_movements", ("mrr_before", "mrr_after", "mrr_delta"))
register_table("b3_invoices_prep", "invoices_prep", ("amount", "refund_amount", "net_amount"))
register_table("b4_checkout_conversion", "checkout_conversion")


def _mutual_best_exposures(b: Build) -> DataFrame:
    """Users and experiments that are each other's earliest and latest exposure."""
    pairs = b["fct_experiment_exposures"].groupBy("user_id", "experiment_id").agg(
        F.min("first_exposure_at").alias("exposed_at")
    )
    return timeline.mutual_best(
        pairs, "user_id", ["exposed_at", "experiment_id"], "experiment_id", [F.desc("exposed_at"), F.desc("user_id")]
    )


register(
    "b5_mutual_best",
    _mutual_best_exposures,
    """
SELECT * FROM (SELECT user_id, experiment_id, min(first_exposure_at) AS exposed_at
               FROM fct_experiment_exposures GROUP BY 1, 2) AS p
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY exposed_at, experiment_id) = 1
 AND row_number() OVER (PARTITION BY experiment_id ORDER BY exposed_at DESC, user_id DESC) = 1""",
)

# --- growth, engagement, experiments, health ------------------------------------------------

register_table("c1_spend_prep", "spend_prep", ("spend_amount",))
register_table("c2_ticket_metrics", "ticket_metrics")
register("c3_first_activation", lambda b: growth.activations(b["resolved_events"]), "SELECT * FROM activations")
register(
    "c4_attribution_touches",
    lambda b: growth.attribution_touches(b["resolved_events"], growth.activations(b["resolved_events"]), b.policy),
    "SELECT * FROM touches",
)
register_table("c5_attribution", "attribution")
register(
    "c6_week_spine",
    lambda b: b["resolved_events"]
    .agg(F.min(F.to_date("event_time")).alias("first_day"))
    .select(F.explode(timeline.week_spine(F.col("first_day"), b.policy.as_of_date())).alias("week_start")),
    "SELECT * FROM spine",
)
register(
    "c7_user_weeks",
    lambda b: engagement.last_activity(b["resolved_events"], b.policy).select(
        "user_id", "snapshot_week_start", "snapshot_week_end"
    ),
    "SELECT * FROM user_weeks",
)
register(
    "c8_last_activity",
    lambda b: engagement.last_activity(b["resolved_events"], b.policy),
    "SELECT * FROM last_activity",
)
register_table("c9_engagement_states", "engagement_states")
register_table("c10_experiment_metadata", "experiments")
register("c11_explode_flags", lambda b: experiments.explode_flags(b["resolved_events"]), "SELECT * FROM flag_rows")
register("c12_exposures", lambda b: experiments.exposures(b["resolved_events"]), "SELECT * FROM exposed")
register(
    "c13_conversions",
    lambda b: experiments.conversions(experiments.exposures(b["resolved_events"]), b["resolved_events"]),
    "SELECT * FROM exposure_conversions",
)
register_table("c14_experiment_results", "experiment_results")
register(
    "c15_account_activity",
    lambda b: health.account_activity(b["sessions"], b["account_memberships"], b.policy),
    "SELECT * FROM health_activity",
)
register(
    "c16_account_billing",
    lambda b: health.account_billing(b["subscription_lifecycle"], b.policy),
    "SELECT * FROM health_billing",
)
register(
    "c17_account_support",
    lambda b: rounded(health.account_support(b["ticket_metrics"], b.policy), "avg_csat", "avg_resolution_hours"),
    """SELECT account_id, open_tickets, round(avg_csat, 6) AS avg_csat,
 round(avg_resolution_hours, 6) AS avg_resolution_hours FROM health_support""",
)
register_table("c18_account_health", "account_health")

# --- keys, dimensions, facts, bridge --------------------------------------------------------

register(
    "k1_surrogate_key",
    lambda b: b["stg_events"].select(
        "event_id",
        "_loaded_at",
        surrogate_key("user_id").alias("user_key"),
        surrogate_key("user_id", "event_type").alias("user_event_key"),
    ),
    f"""SELECT event_id, _loaded_at, {key('user_id')} AS user_key,
 {key("user_id || '|' || event_type")} AS user_event_key FROM stg_events""",
)
register(
    "k2_date_key",
    lambda b: b["stg_invoices"].select("invoice_id", date_key("issued_at").alias("issued"), date_key("paid_at").alias("paid")),
    f"SELECT invoice_id, {day_key('issued_at')} AS issued, {day_key('paid_at')} AS paid FROM stg_invoices",
)

_MART_IDS = {
    "dim_users": "d1", "dim_accounts": "d2", "dim_channels": "d3", "dim_experiments": "d4", "dim_sessions": "d5",
    "fct_invoices": "f1", "fct_mrr_movements": "f2", "fct_subscriptions": "f3", "fct_signups": "f4",
    "fct_activations": "f5", "fct_retention_cohorts": "f6", "fct_marketing_spend": "f7",
    "fct_experiment_exposures": "f8", "fct_feature_usage": "f9", "fct_sessions": "f10", "fct_support_tickets": "f11",
    "bridge_user_experiments": "br1",
}
for _mart, _id in _MART_IDS.items():
    register_table(f"{_id}_{_mart}", _mart, tuple(c for c in MONEY_COLUMNS if f" {c} {MONEY}" in contracts.MARTS[_mart]))
# The calendar of all years with subscription events, and the rows of the build's calendar that invoices use.
register(
    "d6_dim_date",
    lambda b: files.calendar_days(
        b["stg_subscriptions"].agg(
            F.trunc(F.min("event_time"), "year").alias("first"),
            F.date_sub(F.add_months(F.trunc(F.max("event_time"), "year"), 12), 1).alias("last"),
        ),
        "first",
        "last",
    ).groupBy("year_number", "quarter_number", "is_weekend").agg(
        F.count(F.lit(1)).alias("days"), F.min("date_key").alias("first_key"), F.max("week_start_date").alias("last_week")
    ),
    f"""
SELECT CAST(year(d) AS BIGINT) AS year_number, CAST(quarter(d) AS BIGINT) AS quarter_number, isodow(d) >= 6 AS is_weekend,
 count(*) AS days, min({day_key('d')}) AS first_key, CAST(max(date_trunc('week', d)) AS DATE) AS last_week
FROM (SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT min(event_time) AS lo, max(event_time) AS hi FROM stg_subscriptions) AS b) AS s
GROUP BY 1, 2, 3""",
)
register(
    "d6_used_days",
    lambda b: b["fct_invoices"].join(b["dim_date"], F.col("issued_date_key") == F.col("date_key"))
    .groupBy("year_number", "quarter_number", "month_name", "is_weekend", "day_name").agg(F.count(F.lit(1)).alias("n_invoices")),
    """SELECT CAST(year(issued_at) AS BIGINT) AS year_number, CAST(quarter(issued_at) AS BIGINT) AS quarter_number,
 monthname(issued_at) AS month_name, isodow(issued_at) > 5 AS is_weekend, dayname(issued_at) AS day_name, count(*) AS n_invoices
FROM fct_invoices WHERE issued_at >= TIMESTAMP '2024-01-01' AND issued_at < TIMESTAMP '2030-01-01' GROUP BY ALL""",
)

# --- metrics --------------------------------------------------------------------------------

_TRUNC = "CAST(date_trunc('{grain}', {time}) AS DATE)"
_SPEND_DAY = "strptime(CAST(spend_date_key AS VARCHAR), '%Y%m%d')"


def register_metric(ident: str, name: str, by: tuple[str, ...] = (), grain: str | None = "MONTH") -> None:
    spec = metrics.METRICS[name]
    table, column = spec.table, spec.column
    time = _SPEND_DAY if table == "fct_marketing_spend" else spec.time
    value = {
        "sum": f"CAST(sum({column}) AS {{kind}})",
        "count_distinct": f"count(DISTINCT {column})",
        "average": f"round(avg({column}), 6)",
    }[spec.how].format(kind="DOUBLE" if column in MONEY_COLUMNS else "BIGINT")
    keys = ([_TRUNC.format(grain=grain, time=time) + " AS period"] if grain else []) + list(by)
    sql = f"SELECT {', '.join([*keys, f'{value} AS {name}'])} FROM {table} GROUP BY ALL"

    def recipe(b: Build) -> DataFrame:
        df = metrics.metric(b, name, by, grain)
        return rounded(df, name) if spec.how == "average" else df

    register(f"{ident}_{name}", recipe, sql)


register_metric("m1", "subscription_mrr", ("plan", "currency"))
register_metric("m2", "net_mrr", ("movement_type",))
register_metric("m3", "invoices", ("status",), "WEEK")
register_metric("m4", "invoice_amount", ("currency",))
register_metric("m5", "net_revenue", ("currency",), "QUARTER")
register_metric("m6", "total_mrr", ("lifecycle_stage", "currency"), None)
register_metric("m7", "total_users", ("plan",), None)
register_metric("m8", "avg_health_score", ("lifecycle_stage",), None)
register_metric("m9", "signups", ("channel",), "WEEK")
register_metric("m10", "activations", ("first_touch_channel",), "WEEK")
register_metric("m11", "total_cohort_size", ("retention_period",), "MONTH")
register_metric("m12", "total_retained_users", ("retention_period",), "WEEK")
register_metric("m13", "avg_retention_rate", ("retention_period", "is_period_complete"), None)
register(
    "m13_weighted_retention_rate",
    lambda b: metrics.weighted_retention_rate(b["fct_retention_cohorts"]),
    """SELECT retention_period, CAST(sum(retained_count) AS DOUBLE) / CAST(sum(cohort_size) AS DOUBLE)
 AS weighted_retention_rate FROM fct_retention_cohorts GROUP BY 1""",
)
register_metric("m14", "marketing_spend", ("channel",))
register_metric("m15", "total_impressions", ("channel", "campaign_id"), "QUARTER")
register_metric("m16", "total_clicks", ("campaign_name",), "WEEK")
register_metric("m17", "feature_usages", ("feature_name",), "WEEK")
register_metric("m18", "sessions", ("platform",), "WEEK")
register_metric("m19", "avg_session_duration_seconds", ("device_type",), "DAY")
register_metric("m20", "events", ("browser",), "DAY")
register_metric("m21", "tickets", ("category", "priority"))
register_metric("m22", "avg_csat", ("category",))
register_metric("m23", "avg_resolution_time_hours", ("priority",), "YEAR")
register(
    "m24_activation_rate",
    lambda b: metrics.activation_rate(b["fct_signups"], b["fct_activations"]),
    """
SELECT period, count(*) AS signed_up_users, count(a.user_id) AS activated_users,
 CAST(count(a.user_id) AS DOUBLE) / count(*) AS activation_rate
FROM (SELECT user_id, CAST(date_trunc('week', min(signup_at)) AS DATE) AS period FROM fct_signups
      WHERE user_id IS NOT NULL GROUP BY 1) AS s
LEFT JOIN (SELECT DISTINCT user_id FROM fct_activations) AS a USING (user_id) GROUP BY 1""",
)
register(
    "m25_cumulative_net_mrr",
    lambda b: metrics.cumulative_net_mrr(b["fct_mrr_movements"], "WEEK"),
    """
SELECT period, CAST(net AS DOUBLE) AS net_mrr, CAST(sum(net) OVER (ORDER BY period) AS DOUBLE) AS cumulative_mrr
FROM (SELECT CAST(date_trunc('week', movement_date) AS DATE) AS period, sum(mrr_delta) AS net
      FROM fct_mrr_movements GROUP BY 1) AS p""",
)
register(
    "m26_net_revenue_retention",
    lambda b: metrics.net_revenue_retention(b["fct_mrr_movements"], b.policy),
    f"""
SELECT cohort, period, CAST(starting AS DOUBLE) AS starting_mrr, CAST(expansion AS DOUBLE) AS expansion,
 CAST(contraction AS DOUBLE) AS contraction, CAST(churn AS DOUBLE) AS churn,
 (CAST(starting AS DOUBLE) + CAST(expansion AS DOUBLE) - CAST(contraction AS DOUBLE) - CAST(churn AS DOUBLE))
  / nullif(CAST(starting AS DOUBLE), 0) AS net_revenue_retention
FROM (
 SELECT g.cohort, g.period, sum(a.starting) AS starting,
  coalesce(sum(CASE WHEN a.starting > 0 THEN a.expansion END), 0) AS expansion,
  -coalesce(sum(CASE WHEN a.starting > 0 THEN a.contraction END), 0) AS contraction,
  -coalesce(sum(CASE WHEN a.starting > 0 THEN a.churn END), 0) AS churn
 FROM (
  SELECT c.cohort, CAST(unnest(generate_series(CAST(c.cohort AS TIMESTAMP),
    greatest(date_trunc('month', {AS_OF}), CAST(max(c.last_period) AS TIMESTAMP)), INTERVAL 1 MONTH)) AS DATE) AS period
  FROM (SELECT CAST(date_trunc('month', min(movement_date)) AS DATE) AS cohort,
         CAST(date_trunc('month', max(movement_date)) AS DATE) AS last_period
        FROM fct_mrr_movements GROUP BY account_id) AS c GROUP BY c.cohort) AS g
 JOIN (
  SELECT o.account_id, o.cohort, p.period,
   coalesce(sum(CASE WHEN m.movement_date < p.period THEN m.mrr_delta END), 0) AS starting,
   sum(CASE WHEN m.movement_date >= p.period AND m.movement_date < p.period + INTERVAL 1 MONTH AND m.movement_type = 'expansion' THEN m.mrr_delta END) AS expansion,
   sum(CASE WHEN m.movement_date >= p.period AND m.movement_date < p.period + INTERVAL 1 MONTH AND m.movement_type = 'contraction' THEN m.mrr_delta END) AS contraction,
   sum(CASE WHEN m.movement_date >= p.period AND m.movement_date < p.period + INTERVAL 1 MONTH AND m.movement_type = 'churn' THEN m.mrr_delta END) AS churn
  FROM (SELECT account_id, CAST(date_trunc('month', min(movement_date)) AS DATE) AS cohort FROM fct_mrr_movements GROUP BY 1) AS o
  JOIN fct_mrr_movements AS m USING (account_id)
  CROSS JOIN (SELECT CAST(unnest(generate_series(date_trunc('month', lo), greatest(date_trunc('month', {AS_OF}), hi), INTERVAL 1 MONTH)) AS DATE) AS period
              FROM (SELECT CAST(min(movement_date) AS TIMESTAMP) AS lo, CAST(max(movement_date) AS TIMESTAMP) AS hi FROM fct_mrr_movements) AS r) AS p
  GROUP BY 1, 2, 3) AS a ON a.cohort = g.cohort AND a.period = g.period
 WHERE g.period > g.cohort GROUP BY 1, 2) AS n""",
)
register(
    "m27_variant_conversion",
    lambda b: metrics.variant_conversion(b["fct_experiment_exposures"]),
    """SELECT experiment_id, variant, count(*) AS exposed_users, count(*) FILTER (WHERE converted) AS converted_users,
 avg(CASE WHEN converted THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS conversion_rate
FROM fct_experiment_exposures GROUP BY 1, 2""",
)
register(
    "m28_time_to_activate",
    lambda b: rounded(metrics.time_to_activate(b["events_normalized"]), "avg_time_to_activate_hours"),
    """SELECT CAST(date_trunc('week', event_time) AS DATE) AS period, count(time_to_activate_hours) AS measured,
 round(avg(time_to_activate_hours), 6) AS avg_time_to_activate_hours
FROM events_normalized WHERE event_type = 'activation' GROUP BY 1""",
)


def _set_sql(name: str, grain: str) -> str:
    parts = []
    for m in metrics.METRIC_SETS[name]:
        spec = metrics.METRICS[m]
        time = _SPEND_DAY if spec.table == "fct_marketing_spend" else spec.time
        agg = {"sum": "sum({c})", "count_distinct": "count(DISTINCT {c})", "average": "avg({c})"}[spec.how]
        parts.append(
            f"SELECT '{m}' AS metric, {_TRUNC.format(grain=grain, time=time)} AS period, "
            f"round(CAST({agg.format(c=spec.column)} AS DOUBLE), 6) AS value FROM {spec.table} GROUP BY 2"
        )
    return "\nUNION ALL\n".join(parts)


for _name, _grain in (("product_analytics", "WEEK"), ("revenue", "MONTH"), ("growth_and_retention", "MONTH")):
    register(
        f"set_{_name}",
        lambda b, n=_name, g=_grain: rounded(metrics.metric_set(b, n, g), "value"),
        _set_sql(_name, _grain),
    )

# --- data quality ---------------------------------------------------------------------------
# Mostly run on tables or rules with known violations, so that the rows compared are not empty.

register(
    "q1_unique",
    lambda b: quality.unique(b["stg_events"], "event_id"),
    "SELECT event_id, count(*) AS n_rows FROM stg_events GROUP BY 1 HAVING count(*) > 1",
)
register(
    "q2_not_null",
    lambda b: quality.not_null(b["stg_events"]),
    "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows FROM stg_events WHERE {c} IS NULL HAVING count(*) > 0"
        for c in [x.strip() for x in EVENT_COLUMNS.split(",")]
    ),
)
register(
    "q3_accepted_values",
    lambda b: quality.accepted_values(b["stg_events"], "platform", ["web", "ios"], "user_id is not null"),
    """SELECT platform AS value, count(*) AS n_rows FROM stg_events
WHERE user_id IS NOT NULL AND platform NOT IN ('web', 'ios') GROUP BY 1""",
)
register(
    "q4_relationships",
    lambda b: quality.relationships(b["stg_invoices"], "user_id", b["events_normalized"], "user_id"),
    """SELECT i.user_id AS value, count(*) AS n_rows FROM stg_invoices AS i
WHERE i.user_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM events_normalized AS e WHERE e.user_id = i.user_id) GROUP BY 1""",
)
register(
    "q5_unique_combination",
    lambda b: quality.duplicated(b["stg_subscriptions"], ["account_id", "subscription_id", "event_type"]),
    """SELECT account_id, subscription_id, event_type, count(*) AS n_rows FROM stg_subscriptions
GROUP BY 1, 2, 3 HAVING count(*) > 1""",
)
register(
    "q6_between",
    lambda b: quality.outside(b["account_health"], "health_score", 40, 60, "billing_score > 20"),
    """SELECT * FROM account_health WHERE billing_score > 20 AND (health_score < 40 OR health_score > 60)""",
)
register(
    "q7_expression",
    lambda b: quality.violating(
        b["checkout_conversion"], "time_to_conversion_days <= 7 or time_to_conversion_days is null"
    ),
    "SELECT * FROM checkout_conversion WHERE time_to_conversion_days > 7",
)
register(
    "q8_freshness",
    lambda b: quality.freshness(b["stg_events"], b.policy).unionByName(quality.freshness(b["stg_subscriptions"], b.policy))
    .unionByName(quality.freshness(b["stg_invoices"], b.policy)),
    "\nUNION ALL\n".join(
        f"""SELECT latest, date_sub('second', latest, {AS_OF}) / 3600.0::DOUBLE AS age_hours,
 CASE WHEN latest IS NULL OR date_sub('second', latest, {AS_OF}) > 48 * 3600 THEN 'error'
  WHEN date_sub('second', latest, {AS_OF}) > 24 * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM (SELECT max(_loaded_at) AS latest FROM {t}) AS m"""
        for t in ("stg_events", "stg_subscriptions", "stg_invoices")
    ),
)


def _contracts(b: Build) -> DataFrame:
    """Row counts of all marts that keep their contract; a broken contract raises."""
    return quality.row_counts(
        {n: contracts.assert_schema(b[n], contracts.MARTS[n], n) for n in MART_NAMES}
    )


_MART_COUNTS = "\nUNION ALL\n".join(f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM {n}" for n in MART_NAMES)
register("q9_contracts", _contracts, _MART_COUNTS)
register(
    "q10_minimum_volume",
    lambda b: quality.too_few_rows(b["stg_spend"], 1_000_000_000),
    "SELECT count(*) AS n_rows FROM stg_spend HAVING count(*) < 1000000000",
)
register(
    "q11_empty_tables",
    lambda b: quality.empty_tables(
        {n: b[n] for n in MART_NAMES} | {"fct_invoices": b["fct_invoices"].filter("amount < 0"), "dim_date": b["dim_date"].limit(0)}
    ),
    f"""SELECT table_name FROM (
 SELECT * REPLACE (CASE WHEN table_name IN ('fct_invoices', 'dim_date') THEN 0 ELSE n_rows END AS n_rows) FROM ({_MART_COUNTS}) AS c) AS t
WHERE n_rows = 0""",
)
register(
    "q12_row_count_difference",
    lambda b: quality.row_count_difference(b["events_normalized"], b["stg_events"]),
    """SELECT m AS mart_count, s AS source_count, m - s AS row_delta
FROM (SELECT (SELECT count(*) FROM events_normalized) AS m, (SELECT count(*) FROM stg_events) AS s) AS c WHERE m <> s""",
)
register(
    "q13_group_size",
    lambda b: quality.wrong_group_size(b["engagement_states"].groupBy("user_id", "engagement_state").count(), ["user_id"], 2),
    """SELECT user_id, count(*) AS n_rows FROM (SELECT DISTINCT user_id, engagement_state FROM engagement_states) AS s
GROUP BY 1 HAVING count(*) <> 2""",
)
register(
    "q14_overlaps",
    lambda b: quality.overlaps(
        identity.stitch_identity(b["events_normalized"], _overlapping(b)), ["anon_id"], b.policy
    ),
    """
SELECT b.* FROM identity_overlapping AS b WHERE EXISTS (
 SELECT 1 FROM identity_overlapping AS a WHERE a.anon_id = b.anon_id AND a.valid_from < b.valid_from
  AND coalesce(a.valid_to, TIMESTAMP '9999-12-31 00:00:00') > b.valid_from)""",
)
register(
    "q14_no_identity_overlap",
    lambda b: quality.overlaps(b["identity_stitched"], ["anon_id"], b.policy),
    """
SELECT b.* FROM identity_stitched AS b WHERE EXISTS (
 SELECT 1 FROM identity_stitched AS a WHERE a.anon_id = b.anon_id AND a.valid_from < b.valid_from
  AND coalesce(a.valid_to, TIMESTAMP '9999-12-31 00:00:00') > b.valid_from)""",
)
register(
    "q15_exactly_one",
    lambda b: quality.not_exactly_one(b["funnel_staged"], "user_id", "stage = 'activation'"),
    """SELECT user_id, count(*) FILTER (WHERE stage = 'activation') AS n_flagged FROM funnel_staged GROUP BY 1
HAVING count(*) FILTER (WHERE stage = 'activation') <> 1""",
)
register(
    "q16_monotone",
    lambda b: quality.out_of_order(b["funnel_staged"]),
    """SELECT * FROM (SELECT user_id, stage_ordinal, stage_reached_at,
 lag(stage_reached_at) OVER (PARTITION BY user_id ORDER BY stage_ordinal) AS prev_stage_reached_at FROM funnel_staged) AS f
WHERE stage_reached_at < prev_stage_reached_at""",
)
register(
    "q17_stage_implication",
    lambda b: quality.stage_without(
        funnel.funnel_stages(b["resolved_events"], ("activation", "member_joined")), "activation", "member_joined"
    ),
    """SELECT user_id, true AS has_stage, false AS has_required FROM (
 SELECT resolved_user_id AS user_id, count(*) FILTER (WHERE event_type = 'activation') AS a,
  count(*) FILTER (WHERE event_type = 'member_joined') AS j FROM resolved_events GROUP BY 1) AS u WHERE a > 0 AND j = 0""",
)
register(
    "q18_arithmetic",
    lambda b: quality.unequal(b["fct_invoices"], "net_amount", "amount").select("invoice_id", "amount", "net_amount"),
    """SELECT invoice_id, CAST(amount AS DOUBLE) AS amount, CAST(net_amount AS DOUBLE) AS net_amount
FROM fct_invoices WHERE abs(net_amount - amount) > 0.01""",
)
register(
    "q19_totals_differ",
    lambda b: quality.totals_differ(
        b["mrr_movements"], b["fct_mrr_movements"].filter("movement_type <> 'churn'"), "account_id", "mrr_delta"
    ),
    """SELECT coalesce(a.account_id, b.account_id) AS account_id, CAST(l AS DOUBLE) AS left_total, CAST(r AS DOUBLE) AS right_total
FROM (SELECT account_id, sum(mrr_delta) AS l FROM mrr_movements GROUP BY 1) AS a
FULL JOIN (SELECT account_id, sum(mrr_delta) AS r FROM fct_mrr_movements WHERE movement_type <> 'churn' GROUP BY 1) AS b
 ON a.account_id = b.account_id
WHERE a.account_id IS NULL OR b.account_id IS NULL OR abs(l - r) > 0.01""",
)
register(
    "q20_final_mrr",
    lambda b: quality.movements_miss_final_mrr(
        b["mrr_movements"].filter("movement_type <> 'contraction'"), b["subscription_lifecycle"]
    ),
    """SELECT coalesce(m.account_id, l.account_id) AS account_id, CAST(total AS DOUBLE) AS total_mrr_delta,
 CAST(final AS DOUBLE) AS final_mrr, CAST(abs(coalesce(total, 0) - coalesce(final, 0)) AS DOUBLE) AS difference
FROM (SELECT account_id, sum(mrr_delta) AS total FROM mrr_movements WHERE movement_type <> 'contraction' GROUP BY 1) AS m
FULL JOIN (SELECT account_id, sum(mrr_amount) AS final FROM (
  SELECT * FROM subscription_lifecycle WHERE event_type NOT IN ('trial_start', 'trial_end')
  QUALIFY row_number() OVER (PARTITION BY account_id, subscription_id ORDER BY event_time DESC, subscription_event_id DESC) = 1) AS x
  GROUP BY 1) AS l ON m.account_id = l.account_id
WHERE abs(coalesce(total, 0) - coalesce(final, 0)) > 0.01""",
)
register(
    "q21_cohort_sizes",
    lambda b: quality.cohort_sizes_differ(
        b["attribution"], b["fct_retention_cohorts"].withColumn("cohort_size", F.col("retained_count"))
    ),
    """SELECT coalesce(a.w, r.w) AS cohort_week_start_date, expected_cohort_size, actual_cohort_size
FROM (SELECT CAST(date_trunc('week', activation_at) AS DATE) AS w, count(*) AS expected_cohort_size FROM attribution GROUP BY 1) AS a
FULL JOIN (SELECT DISTINCT cohort_week_start_date AS w, retained_count AS actual_cohort_size FROM fct_retention_cohorts) AS r ON a.w = r.w
WHERE expected_cohort_size IS NULL OR actual_cohort_size IS NULL OR expected_cohort_size <> actual_cohort_size""",
)
register(
    "q22_dedup_rate",
    lambda b: quality.dedup_rate(b["stg_events"], b["events_normalized"], b.policy),
    """SELECT s AS staging_count, n AS normalized_count, 1.0::DOUBLE - CAST(n AS DOUBLE) / CAST(s AS DOUBLE) AS dedup_rate FROM (
 SELECT (SELECT count(*) FROM stg_events WHERE _loaded_at >= cutoff) AS s,
  (SELECT count(*) FROM events_normalized WHERE _loaded_at >= cutoff) AS n
 FROM (SELECT max(_loaded_at) - INTERVAL 30 DAY AS cutoff FROM stg_events) AS w) AS c""",
)
register(
    "q23_coverage",
    lambda b: quality.uncovered(b["stg_subscriptions"], b["dim_users"].filter("is_product_user"), "user_id"),
    """SELECT DISTINCT user_id FROM stg_subscriptions
WHERE user_id NOT IN (SELECT user_id FROM dim_users WHERE is_product_user)""",
)
register(
    "q24_row_rules",
    quality.row_rule_failures,
    "\nUNION ALL\n".join(
        f"SELECT '{n}' AS check_name, count(*) AS failures, CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END AS status "
        f"FROM {t} WHERE NOT ({r.replace('weekday(cohort_week_start_date) = 0', 'isodow(cohort_week_start_date) = 1').replace('timestampdiff(SECOND, session_start_at, session_end_at)', 'date_sub({0}, session_start_at, session_end_at)'.format(repr('second'))).replace('0.4D', '0.4').replace('0.3D', '0.3')})"
        for n, (t, r) in quality.ROW_RULES.items()
    ),
)
register(
    "q24_account_rules",
    lambda b: quality.run_checks(
        [
            quality.Check("active", quality.active_but_unscored(b["account_health"], b["subscription_lifecycle"])),
            quality.Check("neutral", quality.untouched_but_rescored(b["account_health"], b["ticket_metrics"], b.policy)),
            quality.Check("conversions", quality.no_conversions(b["experiment_results"]), warn_if=0, error_if=None),
        ]
    ),
    f"""
SELECT 'active' AS check_name, count(*) AS failures, CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END AS status
FROM account_health WHERE billing_score = 0 AND account_id IN (SELECT account_id FROM subscription_lifecycle WHERE is_active)
UNION ALL
SELECT 'neutral', count(*), CASE WHEN count(*) > 0 THEN 'error' ELSE 'pass' END FROM account_health
WHERE support_score > 100 OR (support_score <> 70 AND account_id NOT IN (
 SELECT account_id FROM ticket_metrics WHERE created_at >= {AS_OF} - INTERVAL 28 DAY))
UNION ALL
SELECT 'conversions', CASE WHEN n = 0 THEN 1 ELSE 0 END, CASE WHEN n = 0 THEN 'warn' ELSE 'pass' END
FROM (SELECT count(*) FILTER (WHERE converted) AS n FROM experiment_results) AS r""",
)
register(
    "q25_residual_duplicates",
    lambda b: quality.run_checks(
        [
            quality.Check("normalized events", quality.unique(b["events_normalized"], "event_id"), weight="n_rows"),
            quality.Check("staged events", quality.unique(b["stg_events"], "event_id"), weight="n_rows"),
            quality.Check("identity", quality.duplicated(b["identity_stitched"], ["anon_id", "valid_from"]), weight="n_rows"),
        ]
    ),
    "\nUNION ALL\n".join(
        f"""SELECT '{n}' AS check_name, CAST(coalesce(sum(c), 0) AS BIGINT) AS failures,
 CASE WHEN coalesce(sum(c), 0) > 0 THEN 'error' ELSE 'pass' END AS status
FROM (SELECT count(*) AS c FROM {t} GROUP BY {k} HAVING count(*) > 1) AS d"""
        for n, t, k in (
            ("normalized events", "events_normalized", "event_id"),
            ("staged events", "stg_events", "event_id"),
            ("identity", "identity_stitched", "anon_id, valid_from"),
        )
    ),
)


def _gate(b: Build) -> DataFrame:
    """All checks over the marts as written, row rules counted while they were."""
    tables = b.publish(TableCatalog(b.spark, scratch(b, "gate"), "dev"))
    return quality.gate(tables, b.policy, b.observed)


register("q_gate", _gate, gate_sql())

# --- streaming ------------------------------------------------------------------------------


def _in_loads(b: Build, name: str, run: Callable[[DataFrame, str], object]) -> str:
    """Run a stream over the staged events in three loads by load time, each after a restart.

    ``run`` gets the stream and a path, and goes over all files there are: one micro-batch a load, in
    as many files as its tasks wrote. The events are staged once. Returns the path.
    """
    path, schema = scratch(b, name), b["stg_events"].schema
    spark, rank = b["stg_events"].sparkSession, F.ntile(3).over(Window.orderBy("day"))  # one row per day
    b["stg_events"].write.parquet(f"{path}-staged")
    staged = spark.read.schema(schema).parquet(f"{path}-staged")
    days = staged.groupBy(F.to_date("_loaded_at").alias("day")).count().select("day", rank.alias("part"))
    parted = staged.join(F.broadcast(days), F.to_date("_loaded_at") == F.col("day")).drop("day")
    files = f"{path}-files"
    for part in (1, 2, 3):
        parted.filter(F.col("part") == part).drop("part").write.mode("append").parquet(files)
        run(spark.readStream.schema(schema).parquet(files), path)
    return path


def register_stream(name: str, recipe: Callable[[Build, str], DataFrame], sql: str | None) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(recipe(build_for(spark, sf_dir), sf_dir))

    run.__name__ = name
    QUERIES[name] = run
    if sql is not None:
        ORACLE[name] = with_tables(sql)


def _st1(b: Build, sf_dir: str) -> DataFrame:
    def run(stream: DataFrame, path: str) -> None:
        streams.upsert_stream(stream.sparkSession, stream, path, f"{path}-progress", b.policy)

    return incremental.read_events(b.spark, _in_loads(b, "stream-events", run))


def _st2(b: Build, sf_dir: str) -> DataFrame:
    def run(stream: DataFrame, path: str) -> None:
        streams.drain(streams.dedup_stream(stream, b.policy), f"{path}-progress", path)

    path = _in_loads(b, "stream-dedup", run)
    return b.spark.read.schema(b["stg_events"].schema).parquet(path).select("event_id", "event_type", "event_time")


def _st3(b: Build, sf_dir: str) -> DataFrame:
    def run(stream: DataFrame, path: str) -> None:
        streams.owned_session_stream(stream, lambda: b["identity_stitched"], path, f"{path}-progress", b.policy)

    return streams.read_sessions(b.spark, _in_loads(b, "stream-sessions", run))


register_stream("st1_upsert_stream", _st1, f"SELECT {EVENT_COLUMNS} FROM events_normalized")
register_stream("st2_dedup_stream", _st2, "SELECT event_id, event_type, event_time FROM events_normalized")
# Only sessions that the watermark has closed come out.
register_stream(
    "st3_session_stream",
    _st3,
    """
SELECT * FROM sessions WHERE session_end_at + INTERVAL 1800 SECOND + INTERVAL 999999 MICROSECOND
 <= (SELECT max(event_time) FROM stg_events) - INTERVAL 36 HOUR""",
)

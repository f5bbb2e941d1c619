"""Data-quality checks: each returns the rows, groups or totals that break a rule."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import shift_time, week_start, whole_units_between
from ..operators.billing import SUBSCRIPTION_KEY, TRIAL_EVENTS
from ..operators.timeline import overlapping_intervals
from ..policy import Policy
from . import declared

TOLERANCE = 0.01


# --- column and row rules -----------------------------------------------------------------


def _kept(df: DataFrame, where: str | None) -> DataFrame:
    return df.filter(where) if where else df


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once."""
    return duplicated(df.filter(F.col(column).isNotNull()), [column])


def duplicated(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations of columns that occur more than once."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def not_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Columns holding NULLs and how many; all columns are counted in one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counts.unpivot([], columns, "column_name", "n_rows").filter(F.col("n_rows") > 0)


def accepted_values(
    df: DataFrame, column: str, values: Sequence[str], where: str | None = None
) -> DataFrame:
    """Values outside the accepted list and how often they occur."""
    return (
        _kept(df, where)
        .filter(~F.col(column).isin(*values))
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Key values of ``child`` missing from ``parent``, with the number of orphan rows.

    Child rows are counted per key before they are compared, so a frequent key costs one row.
    """
    keys = (
        child.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    known = parent.select(F.col(parent_column).alias("value")).distinct()
    return keys.join(known, "value", "left_anti")


def uncovered(source: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Distinct source keys that the dimension does not hold."""
    return relationships(source, key, dimension, key).select(F.col("value").alias(key))


def outside(
    df: DataFrame, column: str, low: float | None = None, high: float | None = None, where: str | None = None
) -> DataFrame:
    """Rows whose value lies outside [low, high]; NULL passes."""
    value, bad = F.col(column), F.lit(False)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return _kept(df, where).filter(bad)


def violating(df: DataFrame, rule: str | Column, where: str | None = None) -> DataFrame:
    """Rows for which ``rule`` is false."""
    holds = F.expr(rule) if isinstance(rule, str) else rule
    return _kept(df, where).filter(~holds)


def unequal(df: DataFrame, left: str, right: str, tolerance: float = TOLERANCE) -> DataFrame:
    """Rows where two expressions differ by more than the tolerance."""
    return df.filter(F.abs(F.expr(left) - F.expr(right)) > tolerance)


# --- table rules ---------------------------------------------------------------------------


def freshness(
    df: DataFrame, policy: Policy, column: str = "_loaded_at", warn_hours: int = 24, error_hours: int = 48
) -> DataFrame:
    """One row: newest load time, its age in hours at ``as_of``, and pass / warn / error."""
    age = whole_units_between("SECOND", "latest", policy.as_of_time()) / F.lit(3600.0)
    status = (
        F.when(F.col("latest").isNull() | (age > error_hours), "error")
        .when(age > warn_hours, "warn")
        .otherwise("pass")
    )
    return df.agg(F.max(column).alias("latest")).select(
        "latest", age.alias("age_hours"), status.alias("status")
    )


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``table_name`` and ``n_rows`` of several tables."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def too_few_rows(df: DataFrame, minimum: int = 100) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") < minimum)


def empty_tables(tables: Mapping[str, DataFrame]) -> DataFrame:
    return row_counts(tables).filter(F.col("n_rows") == 0).select("table_name")


def row_count_difference(mart: DataFrame, source: DataFrame) -> DataFrame:
    """One row when two tables that must map one to one differ in size."""
    counts = row_counts({"mart": mart, "source": source})
    return (
        counts.agg(
            F.max(F.when(F.col("table_name") == "mart", F.col("n_rows"))).alias("mart_count"),
            F.max(F.when(F.col("table_name") == "source", F.col("n_rows"))).alias("source_count"),
        )
        .withColumn("row_delta", F.col("mart_count") - F.col("source_count"))
        .filter(F.col("row_delta") != 0)
    )


def wrong_group_size(df: DataFrame, keys: Sequence[str], expected: int) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") != expected)


# --- per-key rules -------------------------------------------------------------------------


def overlaps(
    df: DataFrame, keys: Sequence[str], policy: Policy, start: str = "valid_from", end: str = "valid_to"
) -> DataFrame:
    """Intervals reaching into which an earlier interval of the same key extends."""
    return overlapping_intervals(df, keys, policy.lookup_slice_seconds, start, end)


def not_exactly_one(df: DataFrame, key: str, flag: str | Column) -> DataFrame:
    """Keys without exactly one flagged row."""
    cond = F.expr(flag) if isinstance(flag, str) else flag
    return df.groupBy(key).agg(F.count_if(cond).alias("n_flagged")).filter(F.col("n_flagged") != 1)


def out_of_order(funnel: DataFrame) -> DataFrame:
    """Funnel stages reached before the stage below them (at most one row per stage and user)."""
    before = F.lag("stage_reached_at").over(Window.partitionBy("user_id").orderBy("stage_ordinal"))
    return (
        funnel.select("user_id", "stage_ordinal", "stage_reached_at", before.alias("prev_stage_reached_at"))
        .filter(F.col("stage_reached_at") < F.col("prev_stage_reached_at"))
    )


def stage_without(funnel: DataFrame, stage: str = "activation", required: str = "signup") -> DataFrame:
    """Users who reached ``stage`` but never ``required``."""
    return (
        funnel.groupBy("user_id")
        .agg(
            F.bool_or(F.col("stage") == stage).alias("has_stage"),
            F.bool_or(F.col("stage") == required).alias("has_required"),
        )
        .filter(F.col("has_stage") & ~F.col("has_required"))
    )


# --- reconciliation ------------------------------------------------------------------------


def totals_differ(
    left: DataFrame, right: DataFrame, key: str, column: str, tolerance: float = TOLERANCE
) -> DataFrame:
    """Keys whose totals differ between two tables, or that only one of them holds."""
    a = left.groupBy(key).agg(F.sum(column).alias("left_total"), F.lit(True).alias("in_left"))
    b = right.groupBy(key).agg(F.sum(column).alias("right_total"), F.lit(True).alias("in_right"))
    gap = F.abs(F.col("left_total") - F.col("right_total")) > tolerance
    return (
        a.join(b, key, "full_outer")
        .filter(F.col("in_left").isNull() | F.col("in_right").isNull() | gap)
        .select(key, "left_total", "right_total")
    )


def movements_miss_final_mrr(movements: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Accounts whose summed movements are not their final MRR."""
    moved = movements.groupBy("account_id").agg(F.sum("mrr_delta").alias("total_mrr_delta"))
    final = (
        lifecycle.filter(~F.col("event_type").isin(*TRIAL_EVENTS))
        .groupBy(*SUBSCRIPTION_KEY)
        .agg(F.max_by("mrr_amount", F.struct("event_time", "subscription_event_id")).alias("final_mrr"))
        .groupBy("account_id")
        .agg(F.sum("final_mrr").alias("final_mrr"))
    )
    gap = F.abs(F.coalesce("total_mrr_delta", F.lit(0)) - F.coalesce("final_mrr", F.lit(0)))
    return (
        moved.join(final, "account_id", "full_outer")
        .withColumn("difference", gap)
        .filter(F.col("difference") > TOLERANCE)
    )


def cohort_sizes_differ(attribution: DataFrame, cohorts: DataFrame) -> DataFrame:
    """Cohort weeks whose size is not the number of users activated that week."""
    week = "cohort_week_start_date"
    expected = attribution.groupBy(week_start(F.to_date("activation_at")).alias(week)).agg(
        F.count(F.lit(1)).alias("expected_cohort_size")
    )
    actual = cohorts.select(week, F.col("cohort_size").alias("actual_cohort_size")).distinct()
    same = F.col("expected_cohort_size") == F.col("actual_cohort_size")
    return expected.join(actual, week, "full_outer").filter(~F.coalesce(same, F.lit(False)))


def dedup_rate(staged: DataFrame, normalized: DataFrame, policy: Policy) -> DataFrame:
    """Rows before and after de-duplication in the days before the newest load, and the rate."""
    newest = staged.agg(F.max("_loaded_at").alias("newest"))
    cutoff = shift_time(newest.scalar(), "DAY", -policy.reconciliation_dedup_test_window_days)
    recent = F.col("_loaded_at") >= cutoff
    counts = row_counts({"staged": staged.filter(recent), "normalized": normalized.filter(recent)})
    both = counts.agg(
        F.max(F.when(F.col("table_name") == "staged", F.col("n_rows"))).alias("staging_count"),
        F.max(F.when(F.col("table_name") == "normalized", F.col("n_rows"))).alias("normalized_count"),
    )
    kept = F.try_divide(F.col("normalized_count").cast("double"), F.col("staging_count").cast("double"))
    return both.withColumn("dedup_rate", F.lit(1.0) - kept)


def dedup_rate_too_high(
    staged: DataFrame, normalized: DataFrame, policy: Policy, max_rate: float = 0.01
) -> DataFrame:
    """The row of :func:`dedup_rate` when the rate is too high or the window is empty."""
    return dedup_rate(staged, normalized, policy).filter(
        (F.col("staging_count") == 0)
        | (F.col("dedup_rate") > max_rate)
        | (F.col("normalized_count") > F.col("staging_count"))
    )


# --- named row rules -----------------------------------------------------------------------

# Table and rule that every one of its rows must satisfy.
ROW_RULES: dict[str, tuple[str, str]] = {
    "invoice_paid_flag": ("fct_invoices", "is_paid = (status = 'paid')"),
    "invoice_prep_paid_flag": ("invoices_prep", "is_paid = (status = 'paid')"),
    "invoice_net_amount": ("fct_invoices", "net_amount = amount - refund_amount"),
    "refund_has_amount": ("fct_invoices", "status <> 'refunded' or coalesce(refund_amount, 0) > 0"),
    "movement_delta": ("fct_mrr_movements", "abs(mrr_delta - (mrr_after - mrr_before)) <= 0.01"),
    "resolved_has_time": ("fct_support_tickets", "not is_resolved or resolution_time_hours is not null"),
    "cancellation_has_no_mrr": ("stg_subscriptions", "event_type <> 'cancellation' or mrr_amount = 0"),
    "retention_rate_bounds": (
        "fct_retention_cohorts",
        "coalesce(retention_rate, 0) between 0 and 1 and retained_count between 0 and cohort_size and cohort_size > 0",
    ),
    "cohort_starts_monday": ("fct_retention_cohorts", "weekday(cohort_week_start_date) = 0"),
    "idle_days_not_negative": (
        "engagement_states",
        "last_activity_at is null or days_since_last_activity >= 0",
    ),
    "lifecycle_days_not_negative": (
        "subscription_lifecycle",
        "coalesce(days_since_previous_event, 0) >= 0",
    ),
    "session_boundaries": (
        "sessions",
        "session_end_at >= session_start_at and session_duration_seconds >= 0 and "
        "abs(session_duration_seconds - timestampdiff(SECOND, session_start_at, session_end_at)) <= 1",
    ),
    "health_score_bounds": (
        "account_health",
        "health_score between 0 and 100 and activity_score between 0 and 100 and "
        "billing_score between 0 and 100 and support_score between 0 and 100 and "
        "abs(health_score - (0.4D * activity_score + 0.3D * billing_score + 0.3D * support_score)) <= 0.01",
    ),
}


def row_rule_failures(tables: Mapping[str, DataFrame], names: Sequence[str] = tuple(ROW_RULES)) -> DataFrame:
    """``check_name``, ``failures`` and ``status`` of row rules; each table is read once."""
    by_table: dict[str, list[str]] = {}
    for name in names:
        by_table.setdefault(ROW_RULES[name][0], []).append(name)
    parts = [
        tables[table]
        .agg(*[F.count_if(~F.expr(ROW_RULES[n][1])).alias(n) for n in rules])
        .unpivot([], rules, "check_name", "failures")
        for table, rules in by_table.items()
    ]
    failures = reduce(DataFrame.unionByName, parts)
    return failures.withColumn("status", F.when(F.col("failures") > 0, "error").otherwise("pass"))


def rules_of(table: str) -> dict[str, str]:
    """The named row rules of a table."""
    return {name: rule for name, (t, rule) in ROW_RULES.items() if t == table}


def row_rule(tables: Mapping[str, DataFrame], name: str) -> DataFrame:
    table, rule = ROW_RULES[name]
    return violating(tables[table], rule)


def active_but_unscored(health: DataFrame, lifecycle: DataFrame) -> DataFrame:
    """Accounts that had a running subscription but a billing score of 0."""
    active = lifecycle.filter("is_active").select("account_id").distinct()
    return (
        health.filter(F.col("billing_score") == 0)
        .join(active, "account_id", "left_semi")
        .select("account_id", "billing_score")
    )


def untouched_but_rescored(health: DataFrame, tickets: DataFrame, policy: Policy) -> DataFrame:
    """Accounts without recent tickets whose support score is not neutral, or any above 100."""
    since = shift_time(policy.as_of_time(), "DAY", -policy.account_health_trailing_days)
    recent = tickets.filter(F.col("created_at") >= since).select("account_id").distinct()
    quiet = health.join(recent, "account_id", "left_anti").filter(F.col("support_score") != 70)
    above = health.filter(F.col("support_score") > 100)
    return quiet.unionByName(above).select("account_id", "support_score").distinct()


def no_conversions(results: DataFrame) -> DataFrame:
    """One row when no experiment has a single conversion."""
    return results.agg(F.count_if("converted").alias("converted_count")).filter(
        F.col("converted_count") == 0
    )


# --- running checks ------------------------------------------------------------------------


@dataclass(frozen=True)
class Check:
    """Violations of one rule and the number of failures above which it warns or fails."""

    name: str
    violations: DataFrame
    warn_if: int | None = None
    error_if: int | None = 0
    weight: str | None = None  # column holding the failures a row stands for

    def result(self) -> DataFrame:
        failures = F.count(F.lit(1)) if self.weight is None else F.coalesce(F.sum(self.weight), F.lit(0))
        count = F.col("failures")
        status = F.lit("pass")
        if self.warn_if is not None:
            status = F.when(count > self.warn_if, "warn").otherwise(status)
        if self.error_if is not None:
            status = F.when(count > self.error_if, "error").otherwise(status)
        return (
            self.violations.agg(failures.cast("bigint").alias("failures"))
            .select(F.lit(self.name).alias("check_name"), "failures", status.alias("status"))
        )


def foreign_key(
    name: str, child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> Check:
    """A relationship check: any orphan row warns, more than ten fail."""
    orphans = relationships(child, column, parent, parent_column)
    return Check(name, orphans, warn_if=0, error_if=10, weight="n_rows")


def run_checks(checks: Iterable[Check]) -> DataFrame:
    """``check_name``, ``failures`` and ``status`` of every check, as one DataFrame."""
    return reduce(DataFrame.unionByName, [c.result() for c in checks])


def freshness_failures(tables: Mapping[str, DataFrame], policy: Policy) -> DataFrame:
    """One row per source: whether it is older than its declared limits."""
    parts = [
        freshness(tables[t], policy, warn_hours=warn, error_hours=error).select(
            F.lit(f"{t} fresh").alias("check_name"), (F.col("status") != "pass").cast("bigint").alias("failures"), "status"
        )
        for t, (warn, error) in declared.FRESHNESS.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def gate(
    tables: Mapping[str, DataFrame], policy: Policy, observed: Mapping[str, Mapping[str, int]] | None = None
) -> DataFrame:
    """All results that decide whether a full build may be published.

    ``observed`` has the row rules' failures that were counted while tables were written
    (``Build.observed``); other tables are read once for theirs. Best over written tables
    (``Build.publish``), as every check names the tables anew.
    """
    spark = tables["stg_events"].sparkSession
    rules = {t: rules_of(t) for t in declared.TABLES}
    failing = F.when(F.col("failures") > 0, "error").otherwise("pass").alias("status")
    rows = declared.row_failures(spark, tables, observed=observed, rules=rules)
    exact = rows.unionByName(declared.unique_failures(spark, tables)).select("check_name", "failures", failing)
    # any orphan row warns, more than ten fail
    status = F.when(F.col("failures") > 10, "error").when(F.col("failures") > 0, "warn").otherwise("pass").alias("status")
    keys = declared.orphans(spark, tables).select("check_name", "failures", status)
    return (
        exact.unionByName(keys)
        .unionByName(freshness_failures(tables, policy))
        .unionByName(run_checks(standard_checks(tables, policy)))
    )


def standard_checks(tables: Mapping[str, DataFrame], policy: Policy) -> list[Check]:
    """Intervals, fan-out and reconciliation of a full build."""
    t = tables
    checks = [
        Check("identity overlap", overlaps(t["identity_stitched"], ["anon_id"], policy)),
        Check("membership overlap", overlaps(t["account_memberships"], ["account_id", "user_id"], policy)),
        Check("session overlap", overlaps(t["sessions"], ["anon_id"], policy, "session_start_at", "session_end_at")),
        Check("one current stage", not_exactly_one(t["funnel_staged"], "user_id", "is_current_stage")),
        Check("one last touch", not_exactly_one(t["identity_stitched"], "anon_id", "stitch_source = 'last_touch'")),
        Check("funnel order", out_of_order(t["funnel_staged"]), warn_if=0, error_if=None),
        Check("activation implies signup", stage_without(t["funnel_staged"])),
        Check("sessions fan-out", row_count_difference(t["fct_sessions"], t["sessions"])),
        Check("movements fan-out", row_count_difference(t["fct_mrr_movements"], t["mrr_movements"])),
        Check("periods per cohort", wrong_group_size(t["fct_retention_cohorts"], ["cohort_week_start_date"], 8)),
        Check("movement totals", totals_differ(t["mrr_movements"], t["fct_mrr_movements"], "account_id", "mrr_delta")),
        Check("final mrr", movements_miss_final_mrr(t["mrr_movements"], t["subscription_lifecycle"])),
        Check("cohort sizes", cohort_sizes_differ(t["attribution"], t["fct_retention_cohorts"])),
        Check("dedup rate", dedup_rate_too_high(t["stg_events"], t["events_normalized"], policy)),
        Check("active accounts scored", active_but_unscored(t["account_health"], t["subscription_lifecycle"])),
        Check("neutral support score", untouched_but_rescored(t["account_health"], t["ticket_metrics"], policy)),
        Check("conversions exist", no_conversions(t["experiment_results"]), warn_if=0, error_if=None),
        Check("events volume", too_few_rows(t["stg_events"])),
        Check(
            "conversion within window",
            outside(t["checkout_conversion"], "time_to_conversion_days", high=policy.checkout_conversion_window_days),
        ),
    ]
    return checks


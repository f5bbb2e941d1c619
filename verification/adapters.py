"""The generic retail tables (events, orders, lineitem) seen as the five source tables.

A fixed, row-wise mapping: no column depends on another row, except that spend is a sum
over line items. It gives every event type, subscription event and status some rows, and
about 0.5 % replayed events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeloom.functions.columns import MONEY

# Fixed values of the mapping.
CHANNELS = ("organic", "paid_search", "paid_social", "referral", "email", "direct")
PLANS = ("free", "starter", "pro", "enterprise")
ACTIVATION_ACTIONS = ("open_board", "share_link", "import_file", "set_goal")
SUBSCRIPTION_EVENTS = (
    "trial_start", "trial_end", "subscription_start", "subscription_start", "subscription_start",
    "upgrade", "downgrade", "renewal", "renewal", "cancellation", "reactivation", "renewal",
)
TICKET_CATEGORIES = ("bug", "feature_request", "billing", "onboarding", "other")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _text(prefix: str, *parts: Column) -> Column:
    return F.concat(F.lit(prefix), *[p.cast("string") for p in parts])


def events_from(driver: DataFrame) -> DataFrame:
    """Map a driver ``events`` frame, batch or streaming."""
    i, n, kind = F.col("id"), F.col("n"), F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("bigint")
    base = driver.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("n"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("value"),
        k.alias("k"),
        F.when(F.col("event_type") == "view", "page_view")
        .when(F.col("event_type") == "signup", "signup")
        .when(
            F.col("event_type") == "error",
            _pick(("activation", "member_joined", "member_removed", "paywall_view"), F.col("event_id") % 4),
        )
        .when(F.col("event_type") == "click", F.when(F.col("event_id") % 5 != 0, "feature_use").otherwise("upgrade_click"))
        .when(F.col("event_id") % 5 != 0, "checkout_start")
        .otherwise("member_invited")
        .alias("event_type"),
    )
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    at = F.timestamp_add("SECOND", F.floor(seconds / 8).cast("int"), F.date_trunc("day", "ts"))
    anonymous = (kind == "page_view") & (i % 3 != 0)
    late = F.when(i % 20 == 0, 26 * 3600).otherwise(0)
    replays = F.when(i % 200 == 0, F.array(F.lit(0), F.lit(8 * 3600))).otherwise(F.array(F.lit(0)))
    placed = base.select(
        "*",
        at.alias("event_time"),
        anonymous.alias("anonymous"),
        late.alias("late"),
        _pick(CHANNELS, (i + n) % 6).alias("channel"),
        F.explode(replays).alias("replay"),
    )
    channel, device = F.col("channel"), i % 3
    bad_number = i % 97 == 0
    page = F.when(i % 103 == 0, '{"path":"/x"}').otherwise(F.concat(F.lit('"'), _text("/p/", F.col("k")), F.lit('"')))

    def prop(name: str, value: Column, *types: str) -> Column:
        quoted = F.concat(F.lit(f'"{name}":"'), value.cast("string"), F.lit('"'))
        return F.when(kind.isin(*types), quoted)

    pairs = [
        F.when(kind == "page_view", F.concat(F.lit('"page_url":'), page)),
        prop("referrer", _text("https://r", F.col("k") % 5), "page_view"),
        prop("signup_method", _pick(("email", "google", "sso"), device), "signup"),
        prop("activation_action", _pick(ACTIVATION_ACTIONS, F.floor(i / 4) % 4), "activation"),
        prop("time_to_activate_hours", F.when(bad_number, "n/a").otherwise(F.col("value").cast("string")), "activation"),
        prop("feature_name", _text("feature_", F.col("k") % 7), "feature_use"),
        prop("duration_seconds", F.when(bad_number, "12x").otherwise(F.col("k").cast("string")), "feature_use"),
        prop("source_page", _text("/s/", F.col("k") % 4), "paywall_view", "upgrade_click"),
        prop("target_plan", _pick(PLANS, F.col("k") % 4), "paywall_view", "upgrade_click", "checkout_start"),
        prop("billing_cycle", _pick(("monthly", "annual"), F.col("k") % 2), "checkout_start"),
        prop("role", _pick(("member", "admin"), F.col("k") % 2), "member_invited", "member_joined", "member_removed"),
        prop("reason", _text("reason_", F.col("k") % 3), "member_removed"),
    ]
    properties = F.concat(F.lit("{"), F.concat_ws(",", *pairs), F.lit("}"))

    def flag(offset: int) -> Column:
        return F.concat(
            F.lit('{"experiment_id":"exp_'), (n % 5 + offset).cast("string"),
            F.lit('","variant":"'), F.when(n % 2 == 0, "control").otherwise("treatment"), F.lit('"}'),
        )

    flags = (
        F.when(i % 211 == 0, "[]")
        .when(i % 223 == 0, "oops")
        .when(n % 3 == 0, F.concat(F.lit("["), flag(0), F.lit("]")))
        .when(n % 3 == 1, F.concat(F.lit("["), flag(0), F.lit(","), flag(5), F.lit("]")))
    )
    arrived = F.col("late") + 1
    loaded = F.col("late") + 5 + F.col("replay")
    return placed.select(
        _text("evt_", i).alias("event_id"),
        "event_time",
        F.timestamp_add("SECOND", arrived, F.col("event_time")).alias("ingest_time"),
        F.timestamp_add("SECOND", loaded, F.col("event_time")).alias("_loaded_at"),
        F.to_date("event_time").alias("event_date"),
        "event_type",
        F.when(~F.col("anonymous"), _text("user_", n)).alias("user_id"),
        F.when(F.col("anonymous") & (n % 10 == 9), _text("anon_x", n))
        .when(n % 10 <= 1, _text("anon_s", F.floor(n / 10)))
        .otherwise(_text("anon_", n))
        .alias("anon_id"),
        F.when(~F.col("anonymous"), _text("acct_", n)).alias("account_id"),
        _pick(("web", "ios", "android"), device).alias("platform"),
        "channel",
        _pick(PLANS, n % 4).alias("plan_context"),
        F.when(channel == "paid_search", "google").when(channel == "paid_social", "facebook")
        .when(channel == "email", "newsletter").alias("utm_source"),
        F.when(channel == "paid_search", "cpc").when(channel == "paid_social", "paid")
        .when(channel == "email", "email").alias("utm_medium"),
        F.when(channel.isin("paid_search", "paid_social", "email"), _text("camp_", n % 4)).alias("utm_campaign"),
        F.when(channel == "paid_search", _text("kw_", i % 5)).alias("utm_term"),
        F.when(channel == "paid_social", _text("ad_", device)).alias("utm_content"),
        _pick(("desktop", "mobile", "tablet"), device).alias("device_type"),
        _pick(("chrome", "safari", "firefox"), device).alias("browser"),
        _pick(("macos", "ios", "android"), device).alias("os"),
        _text("ua/", device).alias("user_agent"),
        F.when(i % 101 != 0, properties).alias("properties"),
        flags.alias("experiment_flags"),
    )


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_from(_table(spark, sf_dir, "events"))


def _order_time() -> Column:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    early = F.timestamp_add("SECOND", (o * 7919) % (135 * 86400), F.lit("2023-10-01").cast("timestamp"))
    near = F.timestamp_add("SECOND", (o * 7919) % (40 * 86400), F.lit("2024-01-05").cast("timestamp"))
    return F.when(c < 200, near).otherwise(early)


def _order_ids() -> list[Column]:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    return [
        F.concat(_text("sub_", c), _text("_", o % 2)).alias("subscription_id"),
        _text("user_", c).alias("user_id"),
        _text("acct_", c).alias("account_id"),
    ]


def _currency() -> Column:
    return F.when(F.col("o_custkey") % 8 == 0, "EUR").otherwise("USD").alias("currency")


def raw_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = _pick(SUBSCRIPTION_EVENTS, F.floor(o / 2) % 12)
    free = F.col("event_type").isin("trial_start", "trial_end", "cancellation")
    ended = F.col("event_type") == "cancellation"
    orders = _table(spark, sf_dir, "orders").select(
        "*", kind.alias("event_type"), _order_time().alias("event_time")
    )
    return orders.select(
        _text("se_", o).alias("subscription_event_id"),
        *_order_ids(),
        "event_type",
        "event_time",
        F.timestamp_add("HOUR", F.lit(1), F.col("event_time")).alias("_loaded_at"),
        _pick(PLANS, o % 4).alias("plan"),
        F.when(F.col("event_type") != "subscription_start", _pick(PLANS, (o + 1) % 4)).alias("previous_plan"),
        F.when(c % 2 == 0, "annual").otherwise("monthly").alias("billing_cycle"),
        F.when(free, F.lit(0)).otherwise(F.floor(F.col("o_totalprice") / 1000)).cast(MONEY).alias("mrr_amount"),
        _currency(),
        F.when(ended, _text("why_", o % 3)).alias("cancel_reason"),
        F.when(ended, o % 3 != 0).alias("is_voluntary"),
    )


def raw_invoices(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    status = (
        F.when(o % 50 == 0, "refunded")
        .when(F.col("o_orderstatus") == "F", "paid")
        .when(F.col("o_orderstatus") == "O", "pending")
        .otherwise("failed")
    )
    orders = _table(spark, sf_dir, "orders").select("*", status.alias("status"), _order_time().alias("issued_at"))
    half = F.floor(F.col("o_totalprice") / 2)
    return orders.select(
        _text("inv_", o).alias("invoice_id"),
        *_order_ids(),
        "issued_at",
        F.when(F.col("status").isin("paid", "refunded"), F.timestamp_add("DAY", (o % 5).cast("int"), F.col("issued_at"))).alias("paid_at"),
        F.timestamp_add("HOUR", F.lit(1), F.col("issued_at")).alias("_loaded_at"),
        F.col("o_totalprice").cast("decimal(18,2)").cast(MONEY).alias("amount"),
        _currency(),
        "status",
        F.when(F.col("status") == "refunded", half).otherwise(F.lit(0)).cast(MONEY).alias("refund_amount"),
        F.concat(F.lit('[{"description":"plan","amount":'), F.floor("o_totalprice").cast("string"), F.lit(',"quantity":1}]')).alias("line_items"),
    )


def raw_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.unix_date(F.to_date("l_shipdate")) % 180
    totals = (
        _table(spark, sf_dir, "lineitem")
        .groupBy(day.alias("d"), (F.col("l_suppkey") % 6).alias("c"), (F.col("l_partkey") % 4).alias("m"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).alias("price"),
        )
    )
    d, c, m = F.col("d"), F.col("c"), F.col("m")
    date = F.date_add(F.lit("2023-09-01").cast("date"), d.cast("int"))
    idle = (c == 5) & (m == 3)
    return totals.select(
        F.concat(_text("sp_", d), _text("_", c), _text("_", m)).alias("spend_id"),
        date.alias("date"),
        _pick(CHANNELS, c).alias("channel"),
        _text("cmp_", m).alias("campaign_id"),
        _text("Campaign ", m).alias("campaign_name"),
        (F.col("quantity") * 1000).alias("impressions"),
        F.when(idle, F.lit(0)).otherwise(F.col("quantity")).cast("bigint").alias("clicks"),
        F.col("price").cast(MONEY).alias("spend_amount"),
        F.lit("USD").alias("currency"),
        F.timestamp_add("HOUR", F.lit(30), date.cast("timestamp")).alias("_loaded_at"),
    )


def raw_tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    q = F.floor(o / 4)
    status = (
        F.when(F.col("o_orderstatus") == "F", "resolved")
        .when(F.col("o_orderstatus") == "P", "closed")
        .when(o % 8 == 0, "open")
        .otherwise("in_progress")
    )
    created = F.timestamp_add("SECOND", (o * 6151) % (105 * 86400), F.lit("2023-11-01").cast("timestamp"))
    orders = _table(spark, sf_dir, "orders").select(
        "*", status.alias("status"), created.alias("created_at")
    )
    done = F.col("status").isin("resolved", "closed")
    return orders.select(
        _text("tkt_", o).alias("ticket_id"),
        _text("user_", F.col("o_custkey")).alias("user_id"),
        _text("acct_", F.col("o_custkey")).alias("account_id"),
        "created_at",
        F.when(done, F.timestamp_add("HOUR", (o % 96).cast("int"), F.col("created_at"))).alias("resolved_at"),
        F.timestamp_add("HOUR", F.lit(1), F.col("created_at")).alias("_loaded_at"),
        _pick(TICKET_CATEGORIES, q % 5).alias("category"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "critical")
        .when(F.col("o_orderpriority") == "2-HIGH", "high")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "medium")
        .otherwise("low")
        .alias("priority"),
        "status",
        F.when(q % 3 != 0, 1 + q % 5).cast("bigint").alias("csat_score"),
        F.when(o % 7 != 0, (o * 37) % 7200).cast("bigint").alias("first_response_seconds"),
    )


def experiment_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Experiment reference rows: one per user group, running over the group's event days."""
    days = (
        _table(spark, sf_dir, "events")
        .groupBy((F.col("user_id") % 5).alias("g"))
        .agg(F.min(F.to_date("ts")).alias("start_date"), F.max(F.to_date("ts")).alias("end_date"))
    )
    numbered = days.select(F.explode(F.array("g", F.col("g") + 5)).alias("x"), "start_date", "end_date")
    return numbered.select(
        _text("exp_", F.col("x")).alias("experiment_id"),
        _text("Experiment ", F.col("x")).alias("experiment_name"),
        F.lit("completed").alias("status"),
        "start_date",
        "end_date",
        _text("Variant test ", F.col("x")).alias("description"),
    )


SOURCES = {
    "events": raw_events,
    "subscriptions": raw_subscriptions,
    "invoices": raw_invoices,
    "spend": raw_spend,
    "tickets": raw_tickets,
    "experiments": experiment_seed,
}

"""Names of all tables, how each is made from others, and the full build."""

from __future__ import annotations

from collections import ChainMap
from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from ..operators import billing, engagement, experiments, funnel, growth, health, identity, memberships, sessions
from ..operators.events import dedup_events
from ..policy import Policy
from ..sources.contracts import MARTS, STAGED, STAGED_EVENTS, assert_schema
from ..sources.files import dim_date
from ..sources.staging import STAGES
from ..sources.tables import SharedTables, TableCatalog
from . import declared, marts
from .quality import rules_of

Recipe = Callable[["Build"], DataFrame]

# What the consumers of resolved events read; the other event columns stay behind.
RESOLVED_COLUMNS = (
    "event_id", "anon_id", "user_id", "event_time", "event_type", "channel", "utm_source", "utm_medium",
    "utm_campaign", "experiment_flags",
)

RECIPES: dict[str, Recipe] = {
    **{f"stg_{name}": (lambda b, n=name: STAGES[n](b.raw[n])) for name in STAGES},
    "experiments": lambda b: experiments.experiment_metadata(b.raw["experiments"]),
    "events_normalized": lambda b: dedup_events(b["stg_events"]),
    "identity_stitched": lambda b: identity.stitch_identity(b["events_normalized"], b.policy),
    "resolved_events": lambda b: identity.resolve_identity(
        b["events_normalized"].select(*RESOLVED_COLUMNS), b["identity_stitched"], b.policy
    ),
    "sessions": lambda b: sessions.sessions(b["events_normalized"], b["identity_stitched"], b.policy),
    "account_memberships": lambda b: memberships.account_memberships(b["events_normalized"], b.policy),
    "funnel_staged": lambda b: funnel.funnel_stages(b["resolved_events"]),
    "subscription_lifecycle": lambda b: billing.subscription_lifecycle(b["stg_subscriptions"], b.policy),
    "mrr_movements": lambda b: billing.mrr_movements(b["subscription_lifecycle"], b.policy),
    "invoices_prep": lambda b: billing.invoices_prep(b["stg_invoices"]),
    "checkout_conversion": lambda b: billing.checkout_conversion(
        b["events_normalized"], b["subscription_lifecycle"], b.policy
    ),
    "spend_prep": lambda b: growth.spend_prep(b["stg_spend"]),
    "ticket_metrics": lambda b: growth.ticket_metrics(b["stg_tickets"]),
    "attribution": lambda b: growth.attribution(b["resolved_events"], b.policy),
    "engagement_states": lambda b: engagement.engagement_states(b["resolved_events"], b.policy),
    "experiment_results": lambda b: experiments.experiment_results(b["resolved_events"], b.policy),
    "account_health": lambda b: health.account_health(
        b["sessions"], b["account_memberships"], b["subscription_lifecycle"], b["ticket_metrics"], b.policy
    ),
    "dim_users": lambda b: marts.dim_users(
        b["events_normalized"], b["subscription_lifecycle"], b["ticket_metrics"],
        b["engagement_states"], b["account_memberships"], b["attribution"],
    ),
    "dim_accounts": lambda b: marts.dim_accounts(
        b["account_memberships"], b["subscription_lifecycle"], b["account_health"],
        b["ticket_metrics"], b["attribution"],
    ),
    "dim_channels": lambda b: marts.dim_channels(b["attribution"], b["spend_prep"]),
    "dim_experiments": lambda b: marts.dim_experiments(b["experiments"]),
    "dim_sessions": lambda b: marts.dim_sessions(b["sessions"]),
    "dim_date": lambda b: dim_date(b.spark),
    "fct_sessions": lambda b: marts.fct_sessions(b["sessions"]),
    "fct_invoices": lambda b: marts.fct_invoices(b["invoices_prep"]),
    "fct_mrr_movements": lambda b: marts.fct_mrr_movements(b["mrr_movements"]),
    "fct_subscriptions": lambda b: marts.fct_subscriptions(b["subscription_lifecycle"]),
    "fct_signups": lambda b: marts.fct_signups(b["events_normalized"]),
    "fct_activations": lambda b: marts.fct_activations(b["attribution"]),
    "fct_retention_cohorts": lambda b: marts.fct_retention_cohorts(
        b["attribution"], b["resolved_events"], b.policy
    ),
    "fct_marketing_spend": lambda b: marts.fct_marketing_spend(b["spend_prep"]),
    "fct_experiment_exposures": lambda b: marts.fct_experiment_exposures(b["experiment_results"]),
    "bridge_user_experiments": lambda b: marts.bridge_user_experiments(b["experiment_results"]),
    "fct_feature_usage": lambda b: marts.fct_feature_usage(b["events_normalized"]),
    "fct_support_tickets": lambda b: marts.fct_support_tickets(b["ticket_metrics"]),
}

MART_NAMES = tuple(n for n in RECIPES if n.startswith(("dim_", "fct_", "bridge_")))

# Tables with several consumers: written once when a shared folder is available.
SHARED = (
    "events_normalized", "identity_stitched", "resolved_events", "sessions", "account_memberships",
    "subscription_lifecycle", "attribution", "engagement_states", "experiment_results", "account_health",
)

# Intermediate tables that checks and marts read, written when the build is published.
CHECKED = tuple(
    n for n in declared.TABLES if n in RECIPES and n not in SHARED and n not in MART_NAMES and not n.startswith("stg_")
)

# Row order inside the files of a written mart. The event tables have none: their rows come straight
# from the files of the log, and a sort would hold all that one task reads.
CLUSTERED_BY = {
    "fct_sessions": ("session_date_key",),
    "fct_invoices": ("issued_date_key",),
    "fct_mrr_movements": ("movement_date_key",),
    "fct_subscriptions": ("event_date_key",),
    "fct_feature_usage": ("feature_name", "usage_date_key"),
    "fct_support_tickets": ("created_date_key",),
}


class Build:
    """Composes tables lazily from raw sources; ``build["dim_users"]`` is a DataFrame.

    Without ``shared`` everything stays one lazy plan. With it, the tables in ``SHARED`` are
    written on first use and read back by their consumers. ``events`` is the event table kept
    by ``upsert_events``; with it, the raw event log is not read again.
    """

    def __init__(
        self,
        raw: Mapping[str, DataFrame],
        policy: Policy,
        shared: SharedTables | None = None,
        events: DataFrame | None = None,
    ) -> None:
        self.raw, self.policy, self.shared = raw, policy, shared
        self._made: dict[str, DataFrame] = {}
        #: Failures of the row rules of every table that was written, by table and rule.
        self.observed: dict[str, dict[str, int]] = {}
        if events is not None:
            assert_schema(events, STAGED_EVENTS, "events")
            self._made["events_normalized"] = events

    @property
    def spark(self) -> SparkSession:
        return next(iter([*self.raw.values(), *self._made.values()])).sparkSession

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            df = RECIPES[name](self)
            if name.startswith("stg_"):
                assert_schema(df, STAGED[name.removeprefix("stg_")], name)
            if self.shared is not None and name in SHARED:
                df = self._observing(name, df, lambda rows: self.shared.keep(name, rows, CLUSTERED_BY.get(name, ())))
            self._made[name] = df
        return self._made[name]

    def _observing(self, name: str, df: DataFrame, put: Callable[[DataFrame], object]):
        """Write a table with ``put`` and keep the failures of its row rules, counted on the way."""
        if name not in declared.TABLES:
            return put(df)
        passing = declared.counted(name, df, rules_of(name))
        done = put(passing.rows)
        self.observed[name] = passing.failures()
        return done

    def compute(self, name: str) -> DataFrame:
        """The table's own plan over its inputs, even when a written copy exists."""
        return RECIPES[name](self)

    def write(
        self, catalog: TableCatalog, names: Iterable[str] = MART_NAMES, concurrency: int = 4
    ) -> dict[str, str]:
        """Check each mart's contract and replace it in the catalog; returns the paths.

        Contracts are checked before anything is written, row rules while it is (see
        ``observed``). ``concurrency`` tables are written at a time, so that the tail of one
        leaves no executors idle.
        """
        tables = {name: self[name] for name in names}
        for name, df in tables.items():
            if name in MARTS:
                assert_schema(df, MARTS[name], name)

        def put(name: str) -> str:
            schema = "marts" if name in MART_NAMES else "intermediate"
            by = CLUSTERED_BY.get(name, ())
            return self._observing(name, tables[name], lambda rows: catalog.write(name, rows, schema, by))

        with ThreadPoolExecutor(max_workers=concurrency) as pool:
            return dict(zip(tables, pool.map(put, tables)))

    def publish(self, catalog: TableCatalog, concurrency: int = 8) -> Mapping[str, DataFrame]:
        """Write the intermediate tables that are checked and then all marts.

        Returns the tables of this build, those written in place of their plans; later
        tables of the build read the written intermediate ones too.
        """
        self.write(catalog, CHECKED, concurrency)
        self._made |= {name: catalog.read(name, "intermediate") for name in CHECKED}
        self.write(catalog, MART_NAMES, concurrency)
        return ChainMap({name: catalog.read(name) for name in MART_NAMES}, self)

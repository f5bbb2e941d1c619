"""Business policy: every window, threshold and clock the operators depend on."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR = 3600
DAY = 24 * HOUR


@dataclass(frozen=True)
class Policy:
    """Arguments shared by all operators.

    ``as_of`` is the evaluation time. Nothing in the library reads the wall clock, so a
    rebuild of an old day gives the old result.
    """

    as_of: datetime

    session_timeout_seconds: int = 1800
    attribution_lookback_days: int = 30
    account_health_trailing_days: int = 28
    engagement_active_threshold_days: int = 14
    engagement_dormant_threshold_days: int = 42
    events_incremental_lookback_hours: int = 36
    identity_stitching_lookback_days: int = 90
    checkout_conversion_window_days: int = 30
    retention_maturity_guard_days: int = 7
    project_start_date: date = date(2024, 1, 1)
    reconciliation_dedup_test_window_days: int = 30
    min_exposure_hours: int = 24

    # "disjoint": one owner per device at any instant. "overlapping": a later owner's
    # interval reaches back into the earlier owner's, up to the stitching lookback.
    identity_intervals: str = "disjoint"

    # Width of the time slices that spread one busy device, user or subscription over
    # many tasks (see operators/timeline.py). Results do not depend on these. A narrow
    # event slice costs little: only two rows per slice and key meet again.
    event_slice_seconds: int = 60
    billing_slice_seconds: int = HOUR
    lookup_slice_seconds: int = HOUR

    def __post_init__(self) -> None:
        if self.identity_intervals not in ("disjoint", "overlapping"):
            raise ValueError(f"unknown identity_intervals: {self.identity_intervals!r}")

    def as_of_time(self) -> Column:
        # A string cast follows the session time zone; a Python datetime would be
        # shifted by the time zone of the client machine.
        if self.as_of.tzinfo is not None:
            return F.lit(self.as_of.isoformat()).cast("timestamp")
        return F.lit(self.as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")

    def as_of_date(self) -> Column:
        return F.to_date(self.as_of_time())

    def project_start(self) -> Column:
        return F.lit(self.project_start_date.isoformat()).cast("date")

"""Experiment exposure and conversion."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import whole_units_between
from ..functions.json import parse_flags
from ..policy import Policy

METADATA_COLUMNS = ("experiment_id", "experiment_name", "status", "start_date", "end_date", "description")


def experiment_metadata(seed: DataFrame) -> DataFrame:
    return seed.select(*METADATA_COLUMNS)


def explode_flags(resolved: DataFrame) -> DataFrame:
    """One row per event and experiment flag; missing, empty or broken flag lists give none."""
    return (
        resolved.filter(F.col("experiment_flags").isNotNull())
        .select(
            "resolved_user_id",
            "event_id",
            "event_time",
            "event_type",
            F.explode(parse_flags("experiment_flags")).alias("flag"),
        )
        .select("resolved_user_id", "event_id", "event_time", "event_type", "flag.*")
    )


def exposures(resolved: DataFrame) -> DataFrame:
    """First and last exposure per user, experiment and variant.

    A user carries the same few flag lists all the time: events are reduced to one row per user and
    list before the lists are parsed.
    """
    spans = (
        resolved.filter(F.col("experiment_flags").isNotNull())
        .groupBy("resolved_user_id", "experiment_flags")
        .agg(F.min("event_time").alias("first_at"), F.max("event_time").alias("last_at"))
    )
    flags = spans.select(
        "resolved_user_id", "first_at", "last_at", F.explode(parse_flags("experiment_flags")).alias("flag")
    ).select("resolved_user_id", "first_at", "last_at", "flag.*")
    return flags.groupBy("resolved_user_id", "experiment_id", "variant").agg(
        F.min("first_at").alias("first_exposure_at"), F.max("last_at").alias("last_exposure_at")
    )


def conversions(exposed: DataFrame, resolved: DataFrame) -> DataFrame:
    """First activation strictly after a user's first exposure to each experiment."""
    began = exposed.groupBy("resolved_user_id", "experiment_id").agg(
        F.min("first_exposure_at").alias("first_exposure_at")
    )
    # A user's experiments travel as one list (at most one entry per experiment), and each
    # activation is joined to that list once.
    per_user = began.groupBy("resolved_user_id").agg(
        F.collect_list(F.struct("experiment_id", "first_exposure_at")).alias("began")
    )
    return (
        resolved.filter(F.col("event_type") == "activation")
        .select("resolved_user_id", "event_time")
        .join(per_user, "resolved_user_id")
        .select("resolved_user_id", "event_time", F.inline("began"))
        .filter(F.col("first_exposure_at") < F.col("event_time"))
        .groupBy("resolved_user_id", "experiment_id")
        .agg(F.min("event_time").alias("conversion_at"))
    )


def experiment_results(resolved: DataFrame, policy: Policy) -> DataFrame:
    """Exposures lasting at least the minimum, with the conversion that followed, if any."""
    exposed = exposures(resolved)
    hours = whole_units_between("HOUR", "first_exposure_at", "last_exposure_at")
    return (
        exposed.join(conversions(exposed, resolved), ["resolved_user_id", "experiment_id"], "left")
        .select(
            F.col("resolved_user_id").alias("user_id"),
            "experiment_id",
            "variant",
            "first_exposure_at",
            F.col("conversion_at").isNotNull().alias("converted"),
            "conversion_at",
            hours.alias("exposure_duration_hours"),
        )
        .filter(F.col("exposure_duration_hours") >= policy.min_exposure_hours)
    )

"""Typed views of the five source tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.json import parse_object, scalar_field
from .contracts import RAW, STAGED, conform, struct

# JSON property -> column.
EVENT_PROPERTIES = {
    "page_url": "page_url",
    "referrer": "referrer",
    "signup_method": "signup_method",
    "activation_action": "activation_action",
    "time_to_activate_hours": "time_to_activate_hours",
    "feature_name": "feature_name",
    "duration_seconds": "feature_duration_seconds",
    "source_page": "source_page",
    "target_plan": "target_plan",
    "billing_cycle": "billing_cycle",
    "role": "member_role",
    "reason": "member_reason",
}


def stage_events(raw: DataFrame) -> DataFrame:
    """Events with the JSON properties as typed columns; unreadable numbers become NULL."""
    typed = struct(STAGED["events"])
    parsed = conform(raw, RAW["events"]).withColumn("_p", parse_object("properties", list(EVENT_PROPERTIES)))
    shredded = [
        scalar_field("_p", "properties", key).try_cast(typed[name].dataType).alias(name)
        for key, name in EVENT_PROPERTIES.items()
    ]
    return parsed.select("*", *shredded).select(*typed.names)


def stage_subscriptions(raw: DataFrame) -> DataFrame:
    return conform(raw, RAW["subscriptions"])


def stage_invoices(raw: DataFrame) -> DataFrame:
    return conform(raw, RAW["invoices"])


def stage_spend(raw: DataFrame) -> DataFrame:
    return conform(raw, RAW["spend"]).withColumnRenamed("date", "spend_date")


def stage_tickets(raw: DataFrame) -> DataFrame:
    return conform(raw, RAW["tickets"])


STAGES = {
    "events": stage_events,
    "subscriptions": stage_subscriptions,
    "invoices": stage_invoices,
    "spend": stage_spend,
    "tickets": stage_tickets,
}


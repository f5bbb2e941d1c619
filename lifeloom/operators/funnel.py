"""How far each user got."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The funnel, in order.
FUNNEL_STAGES = ("page_view", "signup", "activation", "feature_use", "checkout_start")


def funnel_stages(resolved: DataFrame, stages: Sequence[str] = FUNNEL_STAGES) -> DataFrame:
    """First time each user reached each stage; the highest one reached is current.

    All stages are taken in one aggregation by user, combined before the shuffle.
    """
    reached = (
        resolved.filter(F.col("event_type").isin(*stages) & F.col("resolved_user_id").isNotNull())
        .groupBy(F.col("resolved_user_id").alias("user_id"))
        .agg(*[F.min(F.when(F.col("event_type") == s, F.col("event_time"))).alias(s) for s in stages])
    )
    steps = F.array(
        *[
            F.struct(
                F.lit(s).alias("stage"),
                F.lit(i).cast("bigint").alias("stage_ordinal"),
                F.col(s).alias("stage_reached_at"),
            )
            for i, s in enumerate(stages, start=1)
        ]
    )
    done = reached.select("user_id", F.filter(steps, lambda x: x.stage_reached_at.isNotNull()).alias("done"))
    highest = F.element_at("done", -1).stage_ordinal
    return done.select("user_id", highest.alias("_highest"), F.inline("done")).select(
        "user_id",
        "stage",
        "stage_ordinal",
        "stage_reached_at",
        (F.col("stage_ordinal") == F.col("_highest")).alias("is_current_stage"),
    )

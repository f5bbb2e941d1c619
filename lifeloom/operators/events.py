"""The de-duplicated event log."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .timeline import first_per_key

EVENT_KEY = "event_id"
ARRIVAL_ORDER = ("_loaded_at", "ingest_time")


# Bits that tell ids with copies from those without, in words of 64.
_WORDS = 1 << 17


def _word(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(_WORDS)).cast("int")


def _bit(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 58).cast("int")


def _marks(spark: SparkSession, hashes: DataFrame) -> Column:
    """The bits of the hashes (``_hash``) that occur more than once, as one array of words."""
    copied = hashes.groupBy("_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    words = copied.groupBy(_word(F.col("_hash")).cast("bigint").alias("id")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(shiftrightunsigned(_hash, 58) as int))")).alias("bits")
    )
    every = spark.range(0, _WORDS, 1, 1).join(words, "id", "left").select(
        F.struct("id", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits")).alias("word")
    )
    return every.agg(F.transform(F.array_sort(F.collect_list("word")), lambda w: w.bits).alias("words")).scalar()


def first_copies(
    events: DataFrame, key: str = EVENT_KEY, order: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    """What :func:`dedup_events` keeps, comparing all rows in one pass; for events that are costly to read twice."""
    ties = F.xxhash64(*(F.col(f"`{c}`") for c in sorted(events.columns)))
    return first_per_key(events, [key], [*(F.col(c).asc() for c in order), ties.asc()])


def dedup_events(
    events: DataFrame, key: str = EVENT_KEY, order: Sequence[str] = ARRIVAL_ORDER
) -> DataFrame:
    """Keep the earliest-loaded copy of every event.

    Copies with equal times are told apart by a hash of their columns, so the choice never
    depends on how rows are spread. Hashes of the ids are counted first: those that occur once
    need no shuffle of their rows. Ids that share a bit with one that has copies are compared as well,
    so with very many copies all rows are.
    """
    hashed = F.xxhash64(key)
    marks = _marks(events.sparkSession, events.select(hashed.alias("_hash")))
    copied = F.getbit(F.get(marks, _word(hashed)), _bit(hashed)) == 1
    return events.filter(~copied).unionByName(first_copies(events.filter(copied), key, order))


def first_event_time(events: DataFrame, event_type: str, user: str, name: str) -> DataFrame:
    """First time each user did ``event_type``."""
    return (
        events.filter((F.col("event_type") == event_type) & F.col(user).isNotNull())
        .groupBy(user)
        .agg(F.min("event_time").alias(name))
    )

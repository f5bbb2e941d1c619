"""The event rules on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.sessions import ENTRY_ATTRIBUTES, session_columns, with_owners
from ..plans.incremental import upsert_events
from ..policy import Policy


def drain(
    stream: DataFrame, checkpoint: str, sink: Callable[[DataFrame, int], None] | str, mode: str = "append"
) -> StreamingQuery:
    """Run a stream over all data available now, into a batch function or a parquet folder."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if isinstance(sink, str):
        query = writer.format("parquet").start(sink)
    else:
        query = writer.foreachBatch(sink).start()
    query.awaitTermination()
    return query


def upsert_stream(
    spark: SparkSession, staged: DataFrame, path: str, checkpoint: str, policy: Policy, on_conflict: str = "earliest"
) -> StreamingQuery:
    """Keep the event table at ``path`` up to date from a stream of staged events.

    With ``earliest`` a batch that is run again after a failure changes nothing. Every row of
    a stream arrives once, so no batch is cut by a lookback, however files fall into batches.
    """

    def merge(batch: DataFrame, _: int) -> None:
        upsert_events(batch.sparkSession, path, batch, policy, on_conflict, lookback=False)

    return drain(staged, checkpoint, merge)


def dedup_stream(staged: DataFrame, policy: Policy) -> DataFrame:
    """Drop repeated events among those loaded within the lookback of each other.

    The copy that arrives first wins. State is bounded by the watermark on load time.
    """
    delay = f"{policy.events_incremental_lookback_hours} hours"
    return staged.withWatermark("_loaded_at", delay).dropDuplicatesWithinWatermark(["event_id"])


def session_stream(events: DataFrame, policy: Policy) -> DataFrame:
    """Device sessions, emitted once no earlier event can extend them any more.

    The columns are those of the batch rule but for the owner. A replayed event counts once.

    The gap is one microsecond short of the next whole second: like the batch rule, a pause
    ends a session only when more than the timeout has passed in whole seconds.
    """
    gap = f"{policy.session_timeout_seconds} seconds 999999 microseconds"
    visits = (
        events.withWatermark("event_time", f"{policy.events_incremental_lookback_hours} hours")
        .dropDuplicatesWithinWatermark(["event_id"])
        .groupBy("anon_id", F.session_window("event_time", gap))
        .agg(
            F.min(F.struct("event_time", "event_id", *ENTRY_ATTRIBUTES)).alias("entry"),
            F.min("event_time").alias("session_start_at"),
            F.max("event_time").alias("session_end_at"),
            F.count(F.lit(1)).alias("event_count"),
            F.count_if(F.col("event_type") == "page_view").alias("page_view_count"),
        )
    )
    return session_columns(visits)


def owned_session_stream(
    events: DataFrame, intervals: Callable[[], DataFrame], path: str, checkpoint: str, policy: Policy
) -> StreamingQuery:
    """Write closed device sessions with their device's owner to ``path``, over all data available now.

    ``intervals`` gives the ownership intervals as they are known when a batch of sessions closes;
    sessions close after the lookback, so logins that arrive within it are counted. Every batch has
    a folder of its own, which a batch that is run again after a failure replaces.
    """

    def put(closed: DataFrame, batch: int) -> None:
        owned = with_owners(closed, intervals(), policy)
        owned.write.mode("overwrite").parquet(f"{path}/_batch={batch}")

    return drain(session_stream(events, policy), checkpoint, put)


def read_sessions(spark: SparkSession, path: str) -> DataFrame:
    """The sessions written by :func:`owned_session_stream`."""
    return spark.read.option("basePath", path).parquet(f"{path}/_batch=*").drop("_batch")

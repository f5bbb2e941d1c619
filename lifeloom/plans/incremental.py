"""Incremental upkeep of the de-duplicated event table.

The table is a folder of loads and a folder of manifests. A load holds the days it has written,
a manifest names the folder of every day, and the manifest with the highest number is the table.
A load writes new folders only and ends with a new manifest, so readers see all of it or none,
and a load that dies on the way leaves the table as it was. One writer at a time is assumed; of
two that collide the later one fails where the store can refuse to replace a file.

Which days hold the events of a batch is looked up in an index by id (``key_index``), so a load
reads its own index buckets and the days it touches, never the whole table.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.events import ARRIVAL_ORDER, EVENT_KEY, first_copies
from ..policy import Policy
from ..sources.contracts import STAGED_EVENTS, assert_schema, conform, struct
from ..sources.tables import grouped_by_day, hadoop_path
from . import key_index

PARTITION = "event_date"
#: Folders are named by a copy of the event's day, so that the day stays a column of the files.
_DAY = "_day"


def _manifests(spark: SparkSession, path: str) -> list[int]:
    fs, folder = hadoop_path(spark, f"{path}/manifests")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and not n.startswith("_"))


def _manifest(spark: SparkSession, path: str) -> dict:
    """Number, newest load time in microseconds, folder by day and index of the table as it is now."""
    numbers = _manifests(spark, path)
    if not numbers:
        return {"number": 0, "newest": None, "days": {}, "index": {"buckets": key_index.BUCKETS, "segments": []}}
    fs, file = hadoop_path(spark, f"{path}/manifests/{numbers[-1]}.json")
    stream = fs.open(file)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    fs, draft = hadoop_path(spark, f"{path}/manifests/_{uuid.uuid4().hex}")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    _, final = hadoop_path(spark, f"{path}/manifests/{manifest['number']}.json")
    if fs.exists(final) or not fs.rename(draft, final):
        raise RuntimeError(f"another load has replaced {path} meanwhile")


def _folders(spark: SparkSession, path: str, load: str) -> dict[str, str]:
    """Folder by day of what a load has written."""
    fs, folder = hadoop_path(spark, f"{path}/{load}")
    names = [f.getPath().getName() for f in fs.listStatus(folder) if f.isDirectory()]
    return {n.partition("=")[2]: f"{load}/{n}" for n in names if n.startswith(f"{_DAY}=")}


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    schema = struct(STAGED_EVENTS)
    if not folders:
        return spark.createDataFrame([], schema)
    files = spark.read.schema(schema).option("recursiveFileLookup", "true")
    return files.parquet(*(f"{path}/{f}" for f in sorted(folders)))


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """The event table as of its last finished load."""
    return _read(spark, path, list(_manifest(spark, path)["days"].values()))


def _write(rows: DataFrame, path: str) -> None:
    grouped_by_day(rows.withColumn(_DAY, F.col(PARTITION)), _DAY).write.partitionBy(_DAY).parquet(path)


def fresh_rows(batch: DataFrame, newest: int | None, lookback_hours: int | None) -> DataFrame:
    """De-duplicated batch rows loaded since ``newest`` (microseconds) minus the lookback.

    Without a newest load or without a lookback, all rows of the batch.
    """
    if newest is not None and lookback_hours is not None:
        since = newest - lookback_hours * 3_600_000_000
        batch = batch.filter(F.unix_micros("_loaded_at") >= since)
    return first_copies(batch)


def upsert_events(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    policy: Policy,
    on_conflict: str = "earliest",
    lookback: bool = True,
) -> None:
    """Merge staged events into the event table at ``path``.

    Only the days that a fresh row enters or leaves are rewritten; rows without a day are a day
    of their own. For an event that is already stored, ``earliest`` keeps the copy loaded first,
    so repeated runs converge to a full rebuild; ``replace`` lets the new copy win. With
    ``lookback``, batch rows loaded before the policy's lookback are left out; pass False where
    every row arrives once, as in a stream. The table's columns may not change.
    """
    if on_conflict not in ("earliest", "replace"):
        raise ValueError(f"unknown on_conflict: {on_conflict!r}")
    assert_schema(batch, STAGED_EVENTS, "event batch")
    now = _manifest(spark, path)
    load = f"loads/{now['number'] + 1}-{uuid.uuid4().hex[:12]}"
    hours = policy.events_incremental_lookback_hours if lookback else None
    fresh_rows(batch, now["newest"], hours).write.parquet(f"{path}/{load}/fresh")
    fresh = spark.read.schema(struct(STAGED_EVENTS)).parquet(f"{path}/{load}/fresh")
    newest = fresh.agg(F.max(F.unix_micros("_loaded_at"))).first()[0]

    if "index" not in now:  # a table from before it had one
        now["index"] = _indexed(spark, path, now["days"], load)
    arriving = key_index.entries(fresh, EVENT_KEY, PARTITION)
    key_index.lookup(spark, path, now["index"], arriving).write.parquet(f"{path}/{load}/found")
    found = spark.read.schema(key_index.SCHEMA).parquet(f"{path}/{load}/found")
    undated = fresh.select(key_index.day_name(F.col(PARTITION)).alias("_day"))
    days = {r[0] for r in found.select("_day").union(undated).distinct().collect()}  # calendar days
    stored = _read(spark, path, [f for d, f in now["days"].items() if d in days])
    if on_conflict == "replace":
        merged = stored.join(fresh.select(EVENT_KEY), EVENT_KEY, "left_anti").unionByName(fresh)
    else:
        both = stored.withColumn("_new", F.lit(1)).unionByName(fresh.withColumn("_new", F.lit(2)))
        merged = first_copies(both, EVENT_KEY, [*ARRIVAL_ORDER, "_new"]).drop("_new")
    _write(conform(merged, STAGED_EVENTS), f"{path}/{load}/days")

    written = _folders(spark, path, f"{load}/days")
    lying = _read(spark, path, list(written.values())).select(EVENT_KEY, PARTITION)
    lying = key_index.entries(lying.join(fresh.select(EVENT_KEY), EVENT_KEY, "left_semi"), EVENT_KEY, PARTITION)
    index = key_index.extended(spark, path, now["index"], lying.join(found, ["_hash", "_day"], "left_anti"), load)

    kept = {d: f for d, f in now["days"].items() if d not in days}
    times = [t for t in (now["newest"], newest) if t is not None]
    _commit(
        spark,
        path,
        {
            "number": now["number"] + 1,
            "newest": max(times, default=None),
            "days": kept | written,
            "index": index,
        },
    )


def _indexed(spark: SparkSession, path: str, days: dict[str, str], load: str) -> dict:
    """An index of all that is stored."""
    index = {"buckets": key_index.BUCKETS, "segments": []}
    stored = key_index.entries(_read(spark, path, list(days.values())), EVENT_KEY, PARTITION)
    return key_index.extended(spark, path, index, stored, f"{load}/all")


def vacuum(spark: SparkSession, path: str) -> None:
    """Delete what the table no longer uses; not while a load or a long read is running."""
    now = _manifest(spark, path)
    used = {*now["days"].values(), *(s["folder"] for s in now.get("index", {"segments": []})["segments"])}

    def clean(folder: str) -> bool:
        """Delete the unused parts of a folder; whether anything of it is used."""
        if folder in used:
            return True
        fs, place = hadoop_path(spark, f"{path}/{folder}")
        below = [f"{folder}/{f.getPath().getName()}" for f in fs.listStatus(place) if f.isDirectory()]
        in_use = [any(u.startswith(f"{b}/") or u == b for u in used) for b in below]
        if not any(in_use):
            fs.delete(place, True)
            return False
        for b in below:
            clean(b)
        return True

    fs, loads = hadoop_path(spark, f"{path}/loads")
    for f in fs.listStatus(loads) if fs.exists(loads) else []:
        clean(f"loads/{f.getPath().getName()}")

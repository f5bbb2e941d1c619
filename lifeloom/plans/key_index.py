"""Where each stored event lies: an index from event ids to days.

The index has one narrow row (hash of the id, day) for every event and day it was ever stored in,
in buckets by hash. Every load appends a segment; ``FAN`` segments of one level are merged into
one of the next, so a table of n loads has at most ``FAN - 1`` segments for each of log(n) levels
and every row is rewritten once a level. A lookup reads the buckets that its own ids fall into and
nothing else of the table: a batch of a few rows reads a few buckets, however long the history.

An event that was moved to another day keeps its old row, and different ids may share a hash.
Both only make a load look at a day more; what is stored is decided by the ids themselves.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import hadoop_path

#: Segments of one level that are merged into one.
FAN = 4
#: Buckets of a new index; a table keeps those it began with. Choose some per million ids.
BUCKETS = 16
SCHEMA = "_hash bigint, _day string"
NO_DAY = "__HIVE_DEFAULT_PARTITION__"
_BUCKET = "_bucket"


def day_name(day: Column) -> Column:
    return F.coalesce(day.cast("string"), F.lit(NO_DAY))


def entries(rows: DataFrame, key: str, day: str) -> DataFrame:
    """The distinct index rows of events; an event without an id is found by no lookup."""
    known = rows.filter(F.col(key).isNotNull())
    return known.select(F.xxhash64(key).alias("_hash"), day_name(F.col(day)).alias("_day")).distinct()


def bucket(buckets: int) -> Column:
    return F.pmod("_hash", F.lit(buckets)).cast("int")


def write_segment(rows: DataFrame, path: str, buckets: int) -> None:
    placed = rows.select("_hash", "_day", bucket(buckets).alias(_BUCKET)).hint("rebalance", _BUCKET)
    placed.sortWithinPartitions(_BUCKET, "_hash").write.partitionBy(_BUCKET).parquet(path)


def folders(spark: SparkSession, root: str, segments: Sequence[dict], wanted: set[int] | None = None) -> list[str]:
    """Folders of the wanted buckets, or of all, in the given segments."""
    found = []
    for s in segments:
        fs, folder = hadoop_path(spark, f"{root}/{s['folder']}")
        for f in fs.listStatus(folder):
            name, _, number = f.getPath().getName().partition("=")
            if name == _BUCKET and (wanted is None or int(number) in wanted):
                found.append(f"{root}/{s['folder']}/{name}={number}")
    return found


def read(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).option("recursiveFileLookup", "true").parquet(*paths)


def lookup(spark: SparkSession, root: str, index: dict, hashes: DataFrame) -> DataFrame:
    """Index rows of the given ``_hash`` values. The driver learns which buckets these fall into."""
    wanted = {r[0] for r in hashes.select(bucket(index["buckets"])).distinct().collect()}
    stored = read(spark, folders(spark, root, index["segments"], wanted))
    return stored.join(hashes.select("_hash").distinct(), "_hash", "left_semi").distinct()


def extended(spark: SparkSession, root: str, index: dict, new: DataFrame, load: str) -> dict:
    """The index with ``new`` rows as a further segment, after the merges that are due."""
    buckets, segments = index["buckets"], list(index["segments"])
    write_segment(new, f"{root}/{load}/index0", buckets)
    segments.append({"folder": f"{load}/index0", "level": 0})
    level = 0
    while len(due := [s for s in segments if s["level"] == level]) >= FAN:
        merged = read(spark, folders(spark, root, due)).distinct()
        level += 1
        write_segment(merged, f"{root}/{load}/index{level}", buckets)
        segments = [s for s in segments if s not in due] + [{"folder": f"{load}/index{level}", "level": level}]
    return {"buckets": buckets, "segments": segments}

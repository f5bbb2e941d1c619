"""Intermediate tables of the operators in this subpackage.

Everything an operator reads more than once is written under the folder named by
``spark.checkpoint.dir`` and read back, so a lost executor costs the running stage only.
"""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeloom.sources.tables import hadoop_path

#: Runs of these characters separate words everywhere in this subpackage.
SPACE = r"[\x20\x09-\x0D]+"

_own: dict[str, str] = {}


def folder(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    It is read from ``spark.checkpoint.dir``. Where that is unset, a local session gets a
    temporary folder of its own; a cluster is refused, as its machines share no such folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="lifeloom-llm-")
    return _own[app]


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers of this application the package, whatever their search path."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        stem = os.path.join(tempfile.mkdtemp(prefix="lifeloom-code-"), "lifeloom_code")
        archive = shutil.make_archive(stem, "zip", os.path.dirname(package), os.path.basename(package))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)


def new_path(spark: SparkSession, name: str) -> str:
    return f"{folder(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a table once and read it back; cuts the lineage."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.kept_at = path
    return table


def discard(table: DataFrame) -> None:
    """Delete a table of :func:`keep` that no later plan reads."""
    fs, path = hadoop_path(table.sparkSession, table.kept_at)
    fs.delete(path, True)


def keep_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """Write a table once, hash-partitioned by ``key``, so that later joins on it stay in place.

    The catalog entry is dropped at once; the files stay in the shared folder.
    """
    spark = df.sparkSession
    path, entry = new_path(spark, name), f"llm_{name}_{uuid.uuid4().hex[:12]}"
    (
        df.repartition(buckets, key)
        .write.option("path", path)
        .bucketBy(buckets, key)
        .format("parquet")
        .saveAsTable(entry)
    )
    table = spark.table(entry)
    table.schema  # resolved while the entry exists
    spark.sql(f"DROP TABLE {entry}")
    return table


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns of the input can't clash with ours."""
    ship(df.sparkSession)
    return df.select(*(F.col(f"`{n}`").alias(n) for n in names))

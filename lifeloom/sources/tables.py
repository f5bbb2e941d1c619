"""Where tables are kept: named outputs per environment, and shared intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

PRODUCTION = "prod"


class TableCatalog:
    """Parquet tables under a root folder.

    In production a table lives in its own schema folder; any other environment prefixes
    the schema with the environment's name, so a trial run cannot touch production.
    """

    def __init__(self, spark: SparkSession, root: str, environment: str = PRODUCTION) -> None:
        self.spark, self.root, self.environment = spark, root.rstrip("/"), environment

    def schema_name(self, schema: str | None) -> str:
        if not schema:
            return self.environment
        if self.environment == PRODUCTION:
            return schema.strip()
        return f"{self.environment}_{schema.strip()}"

    def path(self, name: str, schema: str | None = "marts") -> str:
        return f"{self.root}/{self.schema_name(schema)}/{name}"

    def write(self, name: str, df: DataFrame, schema: str | None = "marts", cluster_by: Sequence[str] = ()) -> str:
        """Replace the whole table, rows of each file ordered by ``cluster_by``."""
        path = self.path(name, schema)
        write_table(df.sortWithinPartitions(*cluster_by) if cluster_by else df, path)
        return path

    def read(self, name: str, schema: str | None = "marts") -> DataFrame:
        return self.spark.read.parquet(self.path(name, schema))


def hadoop_path(spark: SparkSession, path: str):
    """The file system holding ``path`` and the path itself, as JVM objects."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Full rebuild of a parquet table."""
    df.write.mode(mode).parquet(path)


def grouped_by_day(df: DataFrame, day: str) -> DataFrame:
    """Shuffle rows by day before a write partitioned by day.

    Adaptive execution splits a busy day into pieces of the advisory size and merges quiet
    ones, so a day is neither one huge task nor one tiny file per upstream task.
    """
    return df.hint("rebalance", day)


def shared_folder(spark: SparkSession) -> str | None:
    """A folder every executor can reach, or None.

    Clusters name it in ``spark.checkpoint.dir``. Where that is unset, only a local master
    may use a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.startswith("local"):
        return tempfile.mkdtemp(prefix="lifeloom-")
    return None


class SharedTables:
    """Intermediate tables with several consumers, written once and then read column-wise.

    A written table survives the loss of executors and lets every consumer prune columns.
    """

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = f"{folder}/shared-{uuid.uuid4().hex[:12]}"

    def keep(self, name: str, df: DataFrame, cluster_by: Sequence[str] = ()) -> DataFrame:
        """Write the table, rows of each file ordered by ``cluster_by``, and read it back."""
        path = f"{self.folder}/{name}"
        rows = df.sortWithinPartitions(*cluster_by) if cluster_by else df
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def remove(self) -> None:
        """Delete all shared tables of this build."""
        fs, folder = hadoop_path(self.spark, self.folder)
        fs.delete(folder, True)

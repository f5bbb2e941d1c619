"""Builds of the driver tables, kept per Spark session and data folder."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lifeloom import Policy
from lifeloom.plans.build import Build
from lifeloom.session import tune
from lifeloom.sources.tables import SharedTables, shared_folder

from .adapters import SOURCES

POLICY = Policy(as_of=datetime(2024, 2, 15))

_builds: dict[tuple, Build] = {}


def lazy_build(spark: SparkSession, sf_dir: str) -> Build:
    """The build over a data folder as one lazy plan; writes nothing."""
    tune(spark)
    return Build({name: make(spark, sf_dir) for name, make in SOURCES.items()}, POLICY)


def build_for(spark: SparkSession, sf_dir: str) -> Build:
    """The build over a data folder; its shared tables are written on first use."""
    tune(spark)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir)
    if key not in _builds:
        raw = {name: make(spark, sf_dir) for name, make in SOURCES.items()}
        folder = shared_folder(spark)
        shared = SharedTables(spark, folder) if folder else None
        _builds[key] = Build(raw, POLICY, shared)
    return _builds[key]


def scratch(build: Build, name: str) -> str:
    """A new path in the shared folder for a query that writes tables."""
    if build.shared is None:
        raise RuntimeError("this query writes tables: set spark.checkpoint.dir to a shared folder")
    return f"{build.shared.folder}/{name}-{uuid.uuid4().hex[:12]}"


def comparable(df: DataFrame) -> DataFrame:
    """Decimals as doubles and instants as wall-clock UTC times, as other engines print them."""
    cols = []
    for f in df.schema:
        kind, col = f.dataType.typeName(), F.col(f"`{f.name}`")
        if kind == "decimal":
            col = col.cast("double")
        elif kind == "timestamp":
            col = col.cast("timestamp_ntz")
        cols.append(col.alias(f.name))
    return df.select(*cols)

import os
import sys
from datetime import datetime

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lifeloom import Policy  # noqa: E402
from lifeloom.session import tune  # noqa: E402
from lifeloom.sources.contracts import STAGED_EVENTS, struct  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .appName("lifeloom-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "4g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def policy():
    return Policy(as_of=datetime(2024, 2, 15))


@pytest.fixture(scope="session")
def make_events(spark):
    """Staged events from dicts; times are strings, everything else has a default."""

    def make(*rows: dict):
        schema = struct(STAGED_EVENTS)
        defaults = {
            "anon_id": "anon_1", "event_type": "page_view", "platform": "web", "channel": "organic",
            "plan_context": "free", "event_time": "2024-01-10 10:00:00",
        }
        full = []
        for i, row in enumerate(rows):
            r = {f.name: None for f in schema} | defaults | {"event_id": f"e{i:03d}"} | row
            r["ingest_time"] = r["ingest_time"] or r["event_time"]
            r["_loaded_at"] = r["_loaded_at"] or r["ingest_time"]
            r["event_date"] = r["event_date"] or r["event_time"][:10]
            full.append(r)
        text = ", ".join(f"{f.name} string" for f in schema)
        values = [tuple(None if r[f.name] is None else str(r[f.name]) for f in schema) for r in full]
        df = spark.createDataFrame(values, text)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])

    return make


@pytest.fixture(scope="session")
def frame(spark):
    """A DataFrame from a DDL schema and tuples; times and dates may be strings."""

    def make(ddl: str, *rows: tuple):
        schema = struct(ddl)
        loose = ", ".join(f"{f.name} string" for f in schema)
        values = [tuple(None if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in r) for r in rows]
        df = spark.createDataFrame(values, loose)
        return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema])

    return make


def rows(df, *columns):
    """Sorted tuples of the given columns, with times as text."""
    picked = df.select(*[df[c].cast("string") if df.schema[c].dataType.typeName() in ("timestamp", "date") else df[c] for c in columns])
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))

"""Runs registered queries against DuckDB: python -m verification.compare [folder] [name …]"""

from __future__ import annotations

import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

from .catalog import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("lifeloom-compare")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def differences(con: duckdb.DuckDBPyConnection, df, sql: str) -> str | None:
    """None when both sides have the same columns and rows, else what differs."""
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    columns = sorted(names)
    if sorted(df.columns) != columns:
        return f"columns {sorted(df.columns)} <> {columns}"
    ours = Counter(tuple(r[c] for c in columns) for r in df.collect())
    index = [names.index(c) for c in columns]
    theirs = Counter(tuple(r[i] for i in index) for r in want.fetchall())
    if ours == theirs:
        return None
    extra, missing = list((ours - theirs).items()), list((theirs - ours).items())
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows; {len(extra)} extra e.g. {extra[:2]}; {len(missing)} missing e.g. {missing[:2]} of {columns}"


def main(sf_dir: str = "/root/testdata/sf0.01", *names: str) -> int:
    spark, con = local_session(), duck(sf_dir)
    bad = 0
    for name in names or QUERIES:
        began = time.time()
        try:
            df = QUERIES[name](spark, sf_dir)
            if name in ORACLE:
                problem = differences(con, df, ORACLE[name])
                rows = con.execute(f"SELECT count(*) FROM ({ORACLE[name]}) AS o").fetchall()[0][0]
            else:
                problem, rows = None, df.count()
        except Exception as e:  # report and go on with the next query
            problem, rows = f"{type(e).__name__}: {str(e)[:900]}", -1
        bad += problem is not None
        mark = "ok  " if problem is None else "FAIL"
        print(f"{mark} {name} rows={rows} {time.time() - began:.2f}s {problem or ''}", flush=True)
    print(f"{bad} of {len(names or QUERIES)} differ")
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))

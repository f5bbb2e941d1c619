"""Small reference files and the calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import as_column
from ..functions.keys import date_key
from .contracts import EXPERIMENT_METADATA, struct


def read_seed(spark: SparkSession, path: str, ddl: str = EXPERIMENT_METADATA) -> DataFrame:
    """A headed CSV file with declared column types; blanks are NULL, line ends may be CRLF.

    Reading fails where the header names other columns or another order, and on values that
    are not of their column's type. Times may have fractions of a second.
    """
    return spark.read.csv(
        path,
        schema=struct(ddl),
        header=True,
        enforceSchema=False,
        mode="FAILFAST",
        timestampFormat="yyyy-MM-dd HH:mm:ss[.SSSSSS][.SSS]",
        dateFormat="yyyy-MM-dd",
    )


def calendar_days(bounds: DataFrame, first: str | Column, last: str | Column) -> DataFrame:
    """The calendar dimension for the days from ``first`` to ``last`` of a one-row frame."""
    days = bounds.select(
        F.explode(F.sequence(as_column(first), as_column(last), F.expr("interval 1 day"))).alias("date_day")
    )
    d = F.col("date_day")
    iso_day = F.weekday(d) + 1
    return days.select(
        date_key(d).alias("date_key"),
        d,
        iso_day.cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofmonth(d).cast("bigint").alias("day_of_month"),
        F.dayofyear(d).cast("bigint").alias("day_of_year"),
        F.trunc(d, "week").alias("week_start_date"),
        F.trunc(d, "month").alias("month_start_date"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.month(d).cast("bigint").alias("month_number"),
        F.quarter(d).cast("bigint").alias("quarter_number"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        F.year(d).cast("bigint").alias("year_number"),
        (iso_day >= 6).alias("is_weekend"),
    )


def dim_date(
    spark: SparkSession, first: date = date(2024, 1, 1), last: date = date(2029, 12, 31)
) -> DataFrame:
    """The calendar dimension for fixed bounds."""
    return calendar_days(
        spark.range(1), F.lit(first.isoformat()).cast("date"), F.lit(last.isoformat()).cast("date")
    )

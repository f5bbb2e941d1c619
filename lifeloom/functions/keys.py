"""Surrogate and date keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import as_column


def surrogate_key(*parts: str | Column) -> Column:
    """Non-negative int64 key of one or more strings joined by ``|``.

    NULL in any part gives NULL. 60 bits of md5 keep it JVM-side, stable across
    sessions and easy to reproduce in other SQL engines.
    """
    cols = [as_column(p).cast("string") for p in parts]
    text = cols[0]
    for col in cols[1:]:
        text = F.concat(text, F.lit("|"), col)
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def date_key(day: str | Column) -> Column:
    """``yyyymmdd`` as int64; timestamps are taken at their calendar day."""
    d = F.to_date(as_column(day))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("bigint")

"""Small column helpers used by several operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(28,9)"
END_OF_TIME = "9999-12-31 00:00:00"


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def all_of(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


_MICROS = {"SECOND": 1_000_000, "HOUR": 3_600_000_000}


def whole_units_between(unit: str, start: str | Column, end: str | Column) -> Column:
    """Elapsed whole units (``SECOND``, ``HOUR``) from start to end, truncated toward zero.

    Plain arithmetic on microseconds: ``timestampdiff`` goes through calendar objects for
    every row.
    """
    elapsed = F.unix_micros(as_column(end)) - F.unix_micros(as_column(start))
    size = F.lit(_MICROS[unit])
    return ((elapsed - elapsed % size) / size).cast("bigint")


def shift_time(ts: str | Column, unit: str, amount: int) -> Column:
    return F.timestamp_add(unit, F.lit(amount), as_column(ts))


def open_end(ts: str | Column) -> Column:
    """End of a half-open interval, with NULL meaning still open."""
    return F.coalesce(as_column(ts), F.lit(END_OF_TIME).cast("timestamp"))


def slice_start(ts: str | Column, seconds: int) -> Column:
    """Start of the fixed-width time slice holding ``ts``, in microseconds since 1970."""
    micros = F.unix_micros(as_column(ts))
    return micros - F.pmod(micros, F.lit(seconds * 1_000_000))


def week_start(day: str | Column) -> Column:
    """Monday of the week."""
    return F.trunc(as_column(day), "week")


def minus(a: str | Column, b: str | Column) -> Column:
    """Exact difference of two money columns."""
    return (as_column(a) - as_column(b)).cast(MONEY)

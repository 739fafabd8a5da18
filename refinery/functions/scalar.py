"""Scalar helpers shared by the layers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


# Representable instants, 0001-01-01 .. 9999-12-31 23:59:59.999, in epoch ms.
MIN_EPOCH_MS = -62135596800000
MAX_EPOCH_MS = 253402300799999


def epoch_ms_to_ts(ms: Column) -> Column:
    """Unix milliseconds -> TIMESTAMP_NTZ, keeping the milliseconds.

    Adding to the NTZ epoch keeps the result independent of the session zone.
    A value outside the representable range gives NULL (the row is then
    rejected) instead of failing the job with a datetime overflow.
    """
    return F.when(ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS),
                  F.timestamp_add("MILLISECOND", ms, ntz(dt.datetime(1970, 1, 1))))


def epoch_ms_year(ms: Column) -> Column:
    """Year of ``epoch_ms_to_ts``, from whole days: no time of day is made for it.

    The quotient is off by less than a millisecond of a day for every representable instant."""
    days = F.floor(ms / F.lit(86_400_000)).cast("int")
    return F.when(ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS), F.year(F.date_add(F.lit("1970-01-01").cast("date"), days)))


def ntz(value: dt.datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal.

    Built from its ISO text: a Python ``datetime`` literal would pass through
    the driver process's local zone before the cast.
    """
    text = value.isoformat(sep=" ") if isinstance(value, dt.datetime) else str(value)
    return F.lit(text).cast("timestamp_ntz")


def date_from_parts(year: Column | int, month: Column | int, day: Column | int) -> Column:
    """DATE_FROM_PARTS(y, m, d) (X10); a day that does not exist gives NULL or fails, as the session's ANSI mode says."""
    return F.make_date(*(F.lit(x) for x in (year, month, day)))


def bounded(c: Column, width: int) -> Column:
    """``::VARCHAR(width)``: keep the first ``width`` characters."""
    return F.substring(c, 1, width)


def md5_of(*parts: Column, sep: str = "") -> Column:
    """MD5 over ``p1 || sep || p2 ...``; NULL if any part is NULL."""
    pieces: list[Column] = []
    for i, p in enumerate(parts):
        if i and sep:
            pieces.append(F.lit(sep))
        pieces.append(p)
    return F.md5(F.concat(*pieces))


def round_half_up(c: Column, scale: int) -> Column:
    """ROUND(x, scale) on a decimal(18,6) image of x, back to double.

    Rounding a double directly can differ between engines at .xx5; the decimal
    step makes the result the same everywhere.
    """
    return F.round(c.cast("decimal(18,6)"), scale).cast("double")


def fingerprint(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row's columns, NULLs told apart by their place."""
    parts = [*[F.col(c) for c in columns], *[F.col(c).isNull() for c in columns]]
    return F.xxhash64(*parts), F.xxhash64(F.lit("second"), *parts)

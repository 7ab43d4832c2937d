"""Time columns: TIMESTAMP_NTZ in UTC throughout."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS = {
    "day": "INTERVAL '1' DAY",
    "hour": "INTERVAL '1' HOUR",
    "second": "INTERVAL '1' SECOND",
    "millisecond": "INTERVAL '0.001' SECOND",
    "microsecond": "INTERVAL '0.000001' SECOND",
}


def utc_now() -> datetime:
    """The wall clock, read once by the caller and passed on as a literal."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def ts(value: datetime) -> Column:
    """A TIMESTAMP_NTZ literal; partition pruning and pushdown need a literal."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")


def day(value: datetime) -> Column:
    return F.lit(value.date().isoformat()).cast("date")


def second_floor(value: datetime) -> datetime:
    return value.replace(microsecond=0)


def day_floor(value: datetime) -> datetime:
    return value.replace(hour=0, minute=0, second=0, microsecond=0)


def plus(column: Column, count: Column | int, unit: str) -> Column:
    """``column`` moved by a whole number of days, hours, seconds or milliseconds."""
    return column + F.expr(UNITS[unit]) * F.lit(count)


EPOCH = datetime(1970, 1, 1)


# Between wall clock and numbers without the session's time zone: a cast to
# TIMESTAMP would use it.


def from_epoch_ms(column: Column) -> Column:
    return plus(ts(EPOCH), column, "millisecond")


def from_epoch_us(column: Column) -> Column:
    return plus(ts(EPOCH), column, "microsecond")


def epoch_us(column: Column) -> Column:
    days = F.unix_date(column.cast("date")).cast("bigint")
    minutes = F.hour(column) * 60 + F.minute(column)
    second = (F.extract(F.lit("SECOND"), column) * 1_000_000).cast("bigint")
    return (days * 1440 + minutes) * 60_000_000 + second


def epoch_ms(column: Column) -> Column:
    us = epoch_us(column)
    return F.call_function("div", us - F.pmod(us, F.lit(1000)), F.lit(1000))


def floor_to(unit: str, column: Column) -> Column:
    return F.date_trunc(unit, column).cast("timestamp_ntz")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed, which is what DATEDIFF(minute) counts."""
    return F.timestamp_diff("MINUTE", floor_to("minute", start), floor_to("minute", end))


def millis_between(start: Column, end: Column) -> Column:
    return epoch_ms(end) - epoch_ms(start)

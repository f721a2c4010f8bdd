"""Calendar helpers. All timestamps are zone-free (TIMESTAMP_NTZ), session zone UTC."""

from __future__ import annotations

import calendar
from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col_of

MONTH_FORMAT = "yyyy-MM"
HOUR_TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss.SSS"


def hour_of(ts: Column | str) -> Column:
    """Timestamp cut to the hour, kept zone-free."""
    return F.date_trunc("hour", col_of(ts)).cast("timestamp_ntz")


def month_text(ts: Column | str) -> Column:
    return F.date_format(col_of(ts), MONTH_FORMAT)


def in_month(ts: Column | str, month: Column | str) -> Column:
    """Whether a timestamp lies in a month given as text (cheaper than formatting it)."""
    first = F.concat(col_of(month), F.lit("-01")).try_cast("date")
    return F.trunc(col_of(ts), "month") == first


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(col_of(ts).cast("timestamp"))


def micros_to_ntz(micros: Column | str) -> Column:
    return F.timestamp_micros(col_of(micros)).cast("timestamp_ntz")


def minutes_between(start: Column | str, end: Column | str) -> Column:
    """Minute boundaries crossed between two instants (10:00:59 to 10:01:01 is 1)."""
    per_minute = F.lit(60_000_000)

    def minute_index(ts: Column | str) -> Column:
        return F.floor(epoch_micros(ts) / per_minute)

    return minute_index(end) - minute_index(start)


def weekday_monday0(ts: Column | str) -> Column:
    return F.weekday(col_of(ts)).cast("int")


def day_number(d: Column | str) -> Column:
    """Days since 1970-01-01; the ordering column for calendar-day range frames."""
    return F.unix_date(col_of(d).cast("date"))


def hour_number(ts: Column | str) -> Column:
    return F.floor(epoch_micros(ts) / F.lit(3_600_000_000))


def month_start(d: date, back: int = 0) -> date:
    """First day of the month ``back`` months before ``d``."""
    index = d.year * 12 + (d.month - 1) - back
    return date(index // 12, index % 12 + 1, 1)


def month_end(d: date) -> date:
    return date(d.year, d.month, calendar.monthrange(d.year, d.month)[1])


def next_day(d: date) -> date:
    return d + timedelta(days=1)


def ntz_literal(d: date, hour: int = 0) -> Column:
    return F.lit(f"{d.isoformat()} {hour:02d}:00:00").cast("timestamp_ntz")

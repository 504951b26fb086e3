"""Calendar periods, on the driver (grid bounds) and as columns (data)."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

FIXED_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
CALENDAR_MONTHS = {"month": 1, "quarter": 3, "year": 12}
PERIODS = (*FIXED_SECONDS, *CALENDAR_MONTHS)

_PERIOD_TERM = re.compile(r"(\d+)\s*(second|minute|hour|day|week|month|quarter|year)s?", re.I)


def check_period(period: str) -> str:
    name = (period or "").lower()
    if name not in PERIODS:
        raise ValueError(f"period_length {period!r} is not one of {', '.join(PERIODS)}")
    return name


def as_utc(value: str | date | datetime) -> datetime:
    """A naive datetime in UTC from text, a date or a datetime."""
    if isinstance(value, datetime):
        return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    if isinstance(value, date):
        return datetime(value.year, value.month, value.day)
    return as_utc(datetime.fromisoformat(value.strip().replace("Z", "+00:00")))


def add_periods(start: datetime, count: int, period: str) -> datetime:
    """``start`` moved by whole periods; a missing day of month becomes its last."""
    period = check_period(period)
    if period in FIXED_SECONDS:
        return start + timedelta(seconds=FIXED_SECONDS[period] * count)
    months = start.year * 12 + start.month - 1 + CALENDAR_MONTHS[period] * count
    year, month = divmod(months, 12)
    month += 1
    last = (datetime(year + month // 12, month % 12 + 1, 1) - timedelta(days=1)).day
    return start.replace(year=year, month=month, day=min(start.day, last))


def floor_period(value: datetime, period: str) -> datetime:
    """Start of the period that holds ``value``; weeks start on Sunday."""
    period = check_period(period)
    midnight = value.replace(hour=0, minute=0, second=0, microsecond=0)
    if period == "second":
        return value.replace(microsecond=0)
    if period == "minute":
        return value.replace(second=0, microsecond=0)
    if period == "hour":
        return value.replace(minute=0, second=0, microsecond=0)
    if period == "day":
        return midnight
    if period == "week":
        return midnight - timedelta(days=(midnight.weekday() + 1) % 7)
    first = midnight.replace(day=1)
    if period == "month":
        return first
    if period == "quarter":
        return first.replace(month=(first.month - 1) // 3 * 3 + 1)
    return first.replace(month=1)


def count_periods(start: datetime, end: datetime, period: str) -> int:
    """How many of ``start, start+1, ...`` are not after ``end``."""
    period = check_period(period)
    if end < start:
        return 0
    if period in FIXED_SECONDS:
        return (end - start) // timedelta(seconds=FIXED_SECONDS[period]) + 1
    step = CALENDAR_MONTHS[period]
    count = ((end.year - start.year) * 12 + end.month - start.month) // step
    return count + 1 if add_periods(start, count, period) <= end else count


def date_or_period(text: str | date | datetime, reference: datetime) -> datetime:
    """A date as it is, or ``reference`` minus a span such as ``30 days``."""
    if not isinstance(text, str):
        return as_utc(text)
    try:
        return as_utc(text)
    except ValueError:
        pass
    terms = _PERIOD_TERM.findall(text)
    if not terms or _PERIOD_TERM.sub("", text).strip(" ,"):
        raise ValueError(f"{text!r} is neither a date nor a period")
    result = reference
    for amount, unit in terms:
        result = add_periods(result, -int(amount), unit)
    return result


def truncate(column: Column, period: str) -> Column:
    """Start of the period of a timestamp column; weeks start on Sunday."""
    period = check_period(period)
    if period == "week":
        day = F.expr("INTERVAL 1 DAY")
        return F.date_trunc("week", column + day) - day
    return F.date_trunc(period, column)


def period_at(start: datetime, index: Column, period: str) -> Column:
    """The ``index``-th period after ``start`` as a timestamp column."""
    period = check_period(period)
    base = timestamp_literal(start)
    if period in FIXED_SECONDS:
        return F.timestamp_seconds(F.unix_seconds(base) + index * FIXED_SECONDS[period])
    months = (index * CALENDAR_MONTHS[period]).cast("int")
    return base + F.make_interval(months=months)


def timestamp_literal(value: datetime, type_name: str = "timestamp") -> Column:
    """A literal in the type of the column it will be compared with.

    Comparing a column with a literal of another type wraps the column in a
    cast, and a filter on a cast is not pushed into the Parquet scan.
    """
    text = value.isoformat(sep=" ")
    if type_name == "timestamp_ntz":
        return F.expr(f"TIMESTAMP_NTZ '{text}'")
    if type_name == "date" and value == datetime(value.year, value.month, value.day):
        return F.expr(f"DATE '{value.date().isoformat()}'")
    return F.expr(f"TIMESTAMP '{text}+00:00'")

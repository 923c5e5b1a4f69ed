"""Dates and times as Column expressions. Bad input gives null, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.text import clean

#: Numbers beyond this are milliseconds since 1970, others seconds.
MILLIS_FROM = 10_000_000_000


def _number(text: Column) -> Column:
    return text.rlike(r"^[+-]?\d+(\.\d+)?$")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def _timestamp(text: Column) -> Column:
    def epoch(n: Column) -> Column:
        seconds = F.when(F.abs(n) > MILLIS_FROM, n / 1000).otherwise(n)
        return F.when(F.abs(n) < 2e14, F.timestamp_micros((seconds * 1_000_000).cast("long")))

    numeric = _let(text.try_cast("double"), epoch)
    return F.when(_number(text), numeric).otherwise(F.try_to_timestamp(F.regexp_replace(text, "Z$", "+00:00")))


def parse_timestamp(c: Column) -> Column:
    """Epoch seconds or milliseconds, or ISO text; without an offset it counts as UTC."""
    return _let(clean(c.cast("string")), _timestamp)


def _date(text: Column) -> Column:
    return (
        F.when(_number(text), _timestamp(text).cast("date"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_date(text, "M/d/yyyy"))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), F.try_to_date(text, "M/d/yy"))
        .when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"))
    )


def parse_date(c: Column, low: int | None = None, high: int | None = None) -> Column:
    """Epoch, ISO, MM/dd/yyyy or MM/dd/yy as a date; outside the years low..high it is null."""
    day = _let(clean(c.cast("string")), _date)
    if low is None and high is None:
        return day
    return _let(day, lambda d: F.when(F.year(d).between(low or 0, high or 9999), d))


def first_valid(*named: tuple[str, Column]) -> Column:
    """struct of the first date that is not null and its field name."""
    return F.coalesce(*[F.when(d.isNotNull(), F.struct(d.alias("date"), F.lit(n).alias("field"))) for n, d in named])


def local_date(ts: Column, zone: str) -> Column:
    """The calendar day of an instant in a zone."""
    return F.to_date(F.from_utc_timestamp(ts, zone))


def month_of(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def is_month_end(d: Column) -> Column:
    return d == F.last_day(d)


def adjacent_months(a: Column, b: Column) -> Column:
    return (F.year(b) * 12 + F.month(b)) - (F.year(a) * 12 + F.month(a)) == 1


def month_spine(first: Column, last: Column) -> Column:
    """The first days of all months from first to last, as an array."""
    return F.sequence(F.trunc(first, "month"), F.trunc(last, "month"), F.expr("interval 1 month"))


def period_bucket(d: Column, width: int = 3, origin: int = 2020) -> Column:
    """'2020_2022' and so on; unknown without a date, before the origin by name."""
    start = origin + F.floor((F.year(d) - origin) / width) * width
    named = F.concat_ws("_", start.cast("string"), (start + width - 1).cast("string"))
    return F.when(d.isNull(), "unknown").when(F.year(d) < origin, f"before_{origin}").otherwise(named)


def interval_kind(before: Column, after: Column, baseline: str, canonical_start: str) -> Column:
    """baseline_followup, month_end_to_month_end or manual_interval."""
    canonical = (before >= F.to_date(F.lit(canonical_start))) & is_month_end(before) & is_month_end(after) & adjacent_months(before, after)
    return (
        F.when(before.isNull() | after.isNull(), "unknown")
        .when(before == F.to_date(F.lit(baseline)), "baseline_followup")
        .when(canonical, "month_end_to_month_end")
        .otherwise("manual_interval")
    )

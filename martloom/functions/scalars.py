"""Scalar column helpers. Everything stays inside Spark expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TOKYO = "Asia/Tokyo"


def once(x: Column) -> Column:
    """x, evaluated once per row. For a costly expression (a parsed document) that later filters and columns
    refer to: the optimizer copies those into the filters it pushes down, but not through a generator.
    Use as the whole column of a select."""
    return F.explode(F.array(x))


def ratio(num: Column, den: Column) -> Column:
    """num / den as double; null when den is 0 or either side is null."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_at(x: Column, places: int = 0) -> Column:
    """Half away from zero. Scaling first keeps doubles such as 1.005 on the rule of the SQL dialects
    that round the binary value."""
    if places == 0:
        return F.round(x)
    scale = float(10**places)
    return F.round(x * F.lit(scale)) / F.lit(scale)


def pct(num: Column, den: Column, places: int = 1) -> Column:
    return round_at(ratio(num, den) * F.lit(100.0), places)


def growth_pct(now: Column, before: Column, places: int = 1) -> Column:
    return pct(now - before, before, places)


def mean_of(total: Column, n: Column) -> Column:
    """Mean from an exact integer total, so that the result does not depend on the order of addition."""
    return ratio(total, n)


def to_int_half_up(x: Column) -> Column:
    """Nearest integer, halves toward +infinity (JavaScript Math.round)."""
    return F.floor(x.cast("double") + F.lit(0.5)).cast("long")


def to_int_half_even(x: Column) -> Column:
    """Nearest integer, halves to even (Python round)."""
    return F.bround(x.cast("double")).cast("long")


def to_int_half_away(x: Column) -> Column:
    """Nearest integer, halves away from zero (SQL CAST(float AS INT64) of the source dialect)."""
    return F.round(x).cast("long")


def number(x: Column) -> Column:
    """Text to double, null when it is not a number; thousands separators are dropped."""
    return F.replace(x, F.lit(","), F.lit("")).try_cast("double")


def blank_to_null(x: Column) -> Column:
    return F.when(x != F.lit(""), x)


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def week_start(d: Column) -> Column:
    """Monday of the week."""
    return F.trunc(d, "WEEK")


def months_between_starts(later: Column, earlier: Column) -> Column:
    """Whole months between two month starts."""
    return ((F.year(later) - F.year(earlier)) * 12 + F.month(later) - F.month(earlier)).cast("long")


def jst_date(ts: Column) -> Column:
    """Tokyo calendar day of a UTC instant (session time zone UTC)."""
    return F.to_date(F.from_utc_timestamp(ts, TOKYO))


def jst_midnight(day: dt.date) -> Column:
    """UTC instant at which a Tokyo day starts. A literal, so a filter on it reaches the file scan."""
    utc = dt.datetime(day.year, day.month, day.day) - dt.timedelta(hours=9)
    return F.lit(utc.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def iso_z(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def days_before(as_of: dt.date, n: int) -> Column:
    return F.lit(as_of - dt.timedelta(days=n))


def stamp(generated_at: dt.datetime | None) -> list[Column]:
    """The trailing generated_at column, given explicitly so that reruns are reproducible."""
    if generated_at is None:
        return []
    text = generated_at.strftime("%Y-%m-%d %H:%M:%S.%f")
    return [F.lit(text).cast("timestamp").alias("generated_at")]


def last_segment(c: Column, sep: str = "/") -> Column:
    return F.substring_index(c, sep, -1)


def url_host(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:https?://)?([^/]*)", 1)


def url_path(url: Column) -> Column:
    """Path including the query string; null for anything that is not an absolute http(s) URL with a path."""
    return blank_to_null(F.regexp_extract(url, r"^https?://[^/]+(/.*)$", 1))


def before_query(landing: Column) -> Column:
    """Landing page without its query string; null when nothing is left."""
    return blank_to_null(F.regexp_extract(landing, r"^([^?]+)", 1))

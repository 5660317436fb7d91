"""ISO week and label expressions over naive UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_year(ts: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), ts).cast("int")


def iso_week(ts: Column) -> Column:
    return F.weekofyear(ts).cast("int")


def week_end(ts: Column) -> Column:
    """The Sunday that ends the week of a timestamp."""
    day = F.to_date(ts)
    return F.date_add(day, F.lit(6) - F.weekday(day))


def from_epoch(seconds: Column) -> Column:
    """Naive UTC timestamp of epoch seconds (the session time zone is UTC)."""
    return F.timestamp_seconds(seconds).cast("timestamp_ntz")


def stamp_text(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def span_label(first: Column, last: Column) -> Column:
    """`Mar 25 – Mar 31, 2026`."""
    return F.concat(F.date_format(first, "MMM dd"), F.lit(" – "), F.date_format(last, "MMM dd, yyyy"))


def row_label(ts: Column) -> Column:
    """`Week 13 (Mar 25 – Mar 29, 2026)`: the day of the row up to the Sunday of its week."""
    return F.concat(F.lit("Week "), iso_week(ts).cast("string"), F.lit(" ("), span_label(ts, week_end(ts)), F.lit(")"))


def summary_label(week: Column, first: Column, last: Column, posts: Column) -> Column:
    return F.concat(
        F.lit("Week "), week.cast("string"), F.lit("  |  "), span_label(first, last),
        F.lit("  |  "), F.format_number(posts, 0), F.lit(" posts"),
    )

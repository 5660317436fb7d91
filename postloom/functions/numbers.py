"""Numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import W_COMMENTS, W_SCORE, W_UPVOTE


def rounded(x: Column, digits: int) -> Column:
    """Round with a small guard, so that a value on a half step falls the same way everywhere."""
    return F.round(x + F.lit(1e-9), digits)


def to_number(x: Column) -> Column:
    """Number of a value of any type; bad or missing becomes 0."""
    return F.coalesce(x.try_cast("double"), F.lit(0.0))


def engagement(score: Column, comments: Column) -> Column:
    return F.coalesce(score, F.lit(0)) + F.coalesce(comments, F.lit(0))


def weighted_engagement(score: Column, comments: Column, ratio: Column) -> Column:
    return score * F.lit(W_SCORE) + comments * F.lit(W_COMMENTS) + ratio * F.lit(100) * F.lit(W_UPVOTE)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part, whole) * F.lit(100.0)


def with_thousands(x: Column, digits: int = 0) -> Column:
    """`1,234` style text."""
    return F.format_number(rounded(x, digits), digits)


def fixed(x: Column, digits: int) -> Column:
    """Text with a fixed number of decimals and no grouping."""
    return F.format_string(f"%.{digits}f", rounded(x.cast("double"), digits))


def percent_text(share: Column, digits: int = 0) -> Column:
    return F.concat(fixed(share * 100, digits), F.lit("%"))

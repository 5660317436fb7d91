"""Small helpers that the queries share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import dates


def stamp(column: str) -> Column:
    return dates.stamp_text(F.col(column)).alias(column)


def vector_text(column: str) -> Column:
    """Vector as text of whole millionths, for comparison with other engines."""
    as_int = F.transform(column, lambda x: F.floor(x.cast("double") * 1000000 + 0.5).cast("string"))
    return F.array_join(as_int, ",").alias(column)


def stamped(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: dates.stamp_text(F.col(c)) for c in columns})

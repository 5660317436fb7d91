"""Vector expressions over `array<float>` and `array<double>` columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(v: Column) -> Column:
    return v.cast("array<double>")


def parse_vector(text: Column) -> Column:
    """Vector of its text form `[0.1, 0.2]`; bad text gives null."""
    return F.from_json(text, "array<float>")


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda s, x: s + x * x))


def cosine_similarity(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), norm(a) * norm(b))


def l2_normalised(v: Column) -> Column:
    """Unit vector; a zero vector stays zero. The length is taken once per vector: inside a lambda it would be
    taken again for every element."""
    length = norm(v)
    scale = F.array_repeat(F.when(length > 0, F.lit(1.0) / length).otherwise(F.lit(1.0)), F.size(v))
    return F.zip_with(as_double(v), scale, lambda x, s: x * s)


def squared_distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x
    )


def mean_vector(column: str) -> Column:
    """Aggregate: the mean of vectors, combined on the map side, never exploded to rows."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    return vector_to_array(Summarizer.mean(array_to_vector(as_double(F.col(column)))))

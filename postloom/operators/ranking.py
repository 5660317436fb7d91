"""Ranks and positions inside groups, also inside groups too large for one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import W_ENGAGEMENT_RANK, W_PROBABILITY_RANK
from ..functions import numbers
from .ranged import Ranged, null_safe_join


def value_positions(df: DataFrame, keys: Sequence[str], value: str, group_rows: int | None = None) -> DataFrame:
    """Distinct values of each group with the number of rows above them; null is a value below all others.

    Returns keys, `value`, `n_equal`, `n_above`, `n_total`. Equal values are counted before the shuffle; the counts are split by
    ranges of (group, value) and added up range by range, so no group has to fit a task, and a row carries nothing of its group.
    There are as many ranges as shuffle partitions, or one for `group_rows` counts, if that is given.
    """
    keys = list(keys)
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("n_equal"))
    ranges = max(1, -(-counted.count() // group_rows)) if group_rows else None
    placed = Ranged(counted, keys, [F.desc_nulls_last(value)], ranges).run(
        sums={"n_above": F.col("n_equal")}, own_row=False, totals={"n_total": F.col("n_equal")})
    return placed.table().select(*keys, value, "n_equal", F.col("n_above").cast("long"), "n_total")


def add_min_rank(df: DataFrame, keys: Sequence[str], value: str, name: str, group_rows: int | None = None) -> DataFrame:
    """Descending rank inside a group, equal values share the smallest rank, nulls come last.

    The rank is the number of rows above, counted over ranges, so a group of any size is ranked the same way.
    """
    keys = list(keys)
    ranks = value_positions(df, keys, value, group_rows).select(*keys, value, (F.col("n_above") + 1).alias(name))
    return null_safe_join(df, ranks, [*keys, value]).select(*df.columns, name)


def group_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Exact median per group: the mean of the values at the two middle positions. Nulls are left out; a group of
    nulls has none."""
    keys = list(keys)
    at = value_positions(df.where(F.col(value).isNotNull()), keys, value)
    low = F.floor((F.col("n_total") + 1) / 2)
    high = F.floor((F.col("n_total") + 2) / 2)

    def covers(position: Column) -> Column:
        return (position > F.col("n_above")) & (position <= F.col("n_above") + F.col("n_equal"))

    return at.groupBy(*keys).agg(
        ((F.max(F.when(covers(low), F.col(value))) + F.max(F.when(covers(high), F.col(value)))) / 2).alias(name)
    )


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """The first `n` rows of each group, numbered. Spark keeps only `n` rows per group and task
    before the shuffle (window group limit), so a large group costs no more than a small one."""
    numbered = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int"))
    return numbered.where(F.col(name) <= n)


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return top_rows(df, keys, order, 1, "_first").drop("_first")


def combined_rank(posts: DataFrame, keys: Sequence[str], group_rows: int | None = None) -> DataFrame:
    """Rank by closeness to the cluster and by engagement, and the weighted sum of both ranks."""
    ranked = posts.withColumn(
        "engagement",
        numbers.rounded(numbers.weighted_engagement(F.col("score"), F.col("num_comments"), F.col("upvote_ratio")), 6),
    )
    ranked = add_min_rank(ranked, keys, "probability", "prob_rank", group_rows)
    ranked = add_min_rank(ranked, keys, "engagement", "eng_rank", group_rows)
    return ranked.withColumn(
        "combined_rank",
        F.round(F.col("prob_rank") * F.lit(W_PROBABILITY_RANK) + F.col("eng_rank") * F.lit(W_ENGAGEMENT_RANK), 4),
    )


_RANKED_BY = ("post_id", "timestamp_utc", "score", "num_comments", "upvote_ratio", "probability")


def representative_posts(posts: DataFrame, keys: Sequence[str], n: int, group_rows: int | None = None) -> DataFrame:
    """The `n` posts of each cluster with the smallest combined rank; newer posts win ties. Other columns of the
    posts are joined once the few posts are known."""
    order = [F.asc("combined_rank"), F.desc("timestamp_utc"), F.asc("post_id")]
    narrow = posts.select(*keys, *(c for c in _RANKED_BY if c not in keys))
    best = top_rows(combined_rank(narrow, keys, group_rows), keys, order, n, "position")
    rest = [c for c in posts.columns if c not in narrow.columns]
    if not rest:
        return best
    return null_safe_join(posts.select(*keys, "post_id", *rest), best, [*keys, "post_id"])


def seeded_sample(df: DataFrame, keys: Sequence[str], n: int, seed: int = 42, id_column: str = "post_id") -> DataFrame:
    """Up to `n` rows of each group in the order of a seeded hash of their id."""
    return top_rows(df, keys, [F.md5(F.concat(F.col(id_column).cast("string"), F.lit(f":{seed}"))), F.asc(id_column)], n, "position")

"""Counts, profiles and scores. All are partial + final hash aggregates on their keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import W_COMMENTS, W_SCORE, W_UPVOTE
from ..functions import dates, numbers
from ..session import cut
from .ranking import group_median, null_safe_join, top_rows, value_positions

SLICE = ["niche", "week_year", "week_number"]
NOISE = -1


def count_by(df: DataFrame, *keys: str, name: str = "posts") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def count_with_share(df: DataFrame, keys: Sequence[str], name: str = "posts", share: str = "share_pct") -> DataFrame:
    """Counts with their percentage of all rows; the total is one row, summed from the counts."""
    counts = count_by(df, *keys, name=name)
    total = counts.agg(F.sum(name)).scalar()
    return counts.withColumn(share, numbers.rounded(numbers.percent(F.col(name), total), 1))


def share_within(df: DataFrame, group: Sequence[str], item: str, name: str = "posts") -> DataFrame:
    """Counts of an item inside a group with their percentage of the group."""
    counts = count_by(df, *group, item, name=name)
    totals = counts.groupBy(*group).agg(F.sum(name).alias("_total"))
    return counts.join(totals, list(group)).withColumn(
        "share_pct", numbers.rounded(numbers.percent(F.col(name), F.col("_total")), 1)
    ).drop("_total")


def profile(df: DataFrame, *keys: str) -> DataFrame:
    """Averages, distinct authors and time range, over all rows or per key."""
    return df.groupBy(*keys).agg(
        numbers.rounded(F.avg("score"), 1).alias("avg_score"),
        numbers.rounded(F.avg("upvote_ratio"), 2).alias("avg_upvote_ratio"),
        numbers.rounded(F.avg("num_comments"), 1).alias("avg_comments"),
        F.countDistinct("author").alias("authors"),
        F.min("timestamp_utc").alias("first_seen"),
        F.max("timestamp_utc").alias("last_seen"),
    )


def slice_gate(df: DataFrame, min_posts: int, keys: Sequence[str] = SLICE) -> DataFrame:
    """Rows of the slices with at least `min_posts` rows. The count is an aggregate joined back, not a
    window: a window would hold a whole slice in one task. Slices are few, so rows, which may hold texts or vectors, stay where they are."""
    large_enough = df.groupBy(*keys).count().where(F.col("count") >= min_posts).drop("count")
    return df.join(F.broadcast(large_enough), list(keys), "left_semi")


def cluster_stats(df: DataFrame, keys: Sequence[str] = SLICE, keep_noise: bool = False) -> DataFrame:
    """Importance, size and rounded averages per cluster."""
    rows = df if keep_noise else df.where(F.col("cluster") != NOISE)
    importance = (
        F.avg("score") * F.lit(W_SCORE)
        + F.avg("num_comments") * F.lit(W_COMMENTS)
        + F.avg("upvote_ratio") * F.lit(100) * F.lit(W_UPVOTE)
    )
    return rows.groupBy(*keys, "cluster").agg(
        numbers.rounded(importance, 2).alias("importance_score"),
        F.count("*").alias("post_count"),
        numbers.rounded(F.avg("score"), 1).alias("avg_score"),
        numbers.rounded(F.avg("num_comments"), 1).alias("avg_comments"),
        numbers.rounded(F.avg("upvote_ratio"), 3).alias("avg_upvote_ratio"),
    )


def top_clusters(stats: DataFrame, n: int, keys: Sequence[str] = SLICE) -> DataFrame:
    """The `n` clusters of each slice with the highest rounded importance."""
    return top_rows(stats, keys, [F.desc("importance_score"), F.asc("cluster")], n, "cluster_rank")


def top_clusters_of_large_slices(posts: DataFrame, n: int, min_posts: int) -> DataFrame:
    """Slice gate, scores and top clusters from one pass over the posts: slice sizes are the sums of the
    cluster sizes, noise included, so the gate works on the small table of clusters."""
    stats = cut(cluster_stats(posts, keep_noise=True))
    gate = stats.groupBy(*SLICE).agg(F.sum("post_count").alias("_n")).where(F.col("_n") >= min_posts)
    kept = stats.where(F.col("cluster") != NOISE).join(gate, SLICE, "left_semi")
    return cut(top_clusters(kept, n))


def largest_clusters(df: DataFrame, n: int) -> DataFrame:
    """The `n` largest clusters without noise: cluster, posts."""
    sizes = count_by(df.where(F.col("cluster") != NOISE), "cluster")
    return sizes.orderBy(F.desc("posts"), F.asc("cluster")).limit(n)


def only_clusters(df: DataFrame, clusters: DataFrame) -> DataFrame:
    return df.join(clusters.select("cluster"), "cluster", "left_semi")


def engagement_stats(df: DataFrame) -> DataFrame:
    """Mean, median and sum of plain engagement per cluster."""
    sums = df.groupBy("cluster").agg(
        numbers.rounded(F.avg("engagement"), 1).alias("avg_engagement"),
        numbers.rounded(F.sum("engagement"), 1).alias("total_engagement"),
    )
    medians = group_median(df, ["cluster"], "engagement", "median_engagement").withColumn(
        "median_engagement", numbers.rounded(F.col("median_engagement"), 1)
    )
    return null_safe_join(sums, medians, ["cluster"], "left")


def weekly_volume(df: DataFrame) -> DataFrame:
    """Posts per cluster and week, labelled by the Sunday that ends the week."""
    return count_by(df.withColumn("week_end", dates.week_end(F.col("timestamp_utc"))), "week_end", "cluster")


def week_summary(df: DataFrame) -> DataFrame:
    """Posts and time range per ISO week, with the label of the week."""
    out = df.groupBy("week_year", "week_number").agg(
        F.count("*").alias("post_count"),
        F.min("timestamp_utc").alias("date_start"),
        F.max("timestamp_utc").alias("date_end"),
    )
    return out.withColumn(
        "label",
        dates.summary_label(F.col("week_number"), F.col("date_start"), F.col("date_end"), F.col("post_count")),
    )


def dominant(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """The most frequent value per group, the smaller one on ties."""
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    return top_rows(counts, keys, [F.desc("_n"), F.asc(value)], 1, "_r").select(*keys, F.col(value).alias(name))


def cluster_report(df: DataFrame, keywords: DataFrame | None = None, with_times: bool = False) -> DataFrame:
    """Size, engagement and dominant niche of every cluster but noise, with its keywords if given."""
    rows = df.where(F.col("cluster") != NOISE)
    aggs: list[Column] = [
        F.count("*").alias("posts"),
        numbers.rounded(F.avg("engagement"), 1).alias("avg_engagement"),
        F.sum("engagement").alias("total_engagement"),
    ]
    if with_times:
        aggs += [F.min("timestamp_utc").alias("first_seen"), F.max("timestamp_utc").alias("last_seen")]
    report = (
        rows.groupBy("cluster").agg(*aggs)
        .withColumn("total_engagement", F.floor(numbers.rounded(F.col("total_engagement"), 4)).cast("bigint"))
        .join(dominant(rows, ["cluster"], "niche", "dominant_topic"), "cluster")
    )
    return report if keywords is None else report.join(keywords, "cluster", "left")


def cross_tab(df: DataFrame, niches: Sequence[str] | None = None, most: int = 1000) -> DataFrame:
    """Cluster by niche counts, zero filled. Without a list the niches are read from the data; as each is a
    column, more than `most` of them are an error."""
    if niches is None:
        found = df.select("niche").where("niche IS NOT NULL").distinct().limit(most + 1).collect()
        if len(found) > most:
            raise ValueError(f"more than {most} niches for the columns of a table")
        niches = sorted(r["niche"] for r in found)
    return df.groupBy("cluster").pivot("niche", list(niches)).count().na.fill(0)


def noise_summary(df: DataFrame, *keys: str) -> DataFrame:
    """Clusters found, noise, noise and coverage percentages."""
    noise = F.col("cluster") == NOISE
    return df.groupBy(*keys).agg(
        F.countDistinct(F.when(~noise, F.col("cluster"))).alias("n_clusters"),
        F.sum(noise.cast("bigint")).alias("noise"),
        F.sum((~noise).cast("bigint")).alias("clustered"),
        numbers.rounded(F.avg(noise.cast("double")) * 100, 1).alias("noise_pct"),
        numbers.rounded(F.avg((~noise).cast("double")) * 100, 1).alias("coverage"),
    )


def label_codes(df: DataFrame, column: str, name: str = "code") -> DataFrame:
    """Codes 0..n-1 of the distinct values in sorted order: the number of smaller values."""
    values = df.select(column).distinct().withColumn("_all", F.lit(0))
    at = value_positions(values, ["_all"], column)
    return at.select(column, (F.col("n_total") - F.col("n_above") - 1).cast("int").alias(name))


def confidence_histogram(df: DataFrame, value: str = "probability", bins: int = 40) -> DataFrame:
    """Equal-width bins between smallest and largest value; the largest falls into the last bin."""
    low, high = df.agg(F.min(value)).scalar(), df.agg(F.max(value)).scalar()
    width = (high - low) / bins
    index = F.when(high == low, F.lit(0)).otherwise(
        F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1))
    )
    return df.withColumn("bin", index.cast("int")).groupBy("bin").agg(F.count("*").alias("posts"))


def confident_share(df: DataFrame, threshold: float = 0.8) -> DataFrame:
    return df.where(F.col("cluster") != NOISE).agg(
        numbers.rounded(F.avg((F.col("probability") >= threshold).cast("double")) * 100, 1).alias("high_confidence_pct")
    )


def min_max_scaled(df: DataFrame, column: str, name: str, lower_is_better: bool = False) -> DataFrame:
    """Scale to 0..1 over all rows, 0.5 if constant. Minimum and maximum come from a one-row aggregate."""
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    scaled = (F.col(column) - low) / (high - low)
    if lower_is_better:
        scaled = F.lit(1.0) - scaled
    return df.withColumn(name, F.when(high > low, scaled).otherwise(F.lit(0.5)))

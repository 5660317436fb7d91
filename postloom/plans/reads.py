"""Queries over stored week results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def available_niches(results: DataFrame) -> DataFrame:
    return results.select("niche").distinct().orderBy("niche")


def niche_results(results: DataFrame, niche: str, week: int | None = None) -> DataFrame:
    """All weeks of a niche, or the first one with the week number (1 to 53), in the order of the weeks."""
    rows = results.where(F.col("niche") == niche)
    if week is None:
        return rows.orderBy("week_year", "week_number")
    if not 1 <= week <= 53:
        raise ValueError(f"no such week: {week}")
    return rows.where(F.col("week_number") == week).orderBy("week_year").limit(1)


def weekly_summary(results: DataFrame, niche: str) -> DataFrame:
    """Facts of each week of a niche with the number of trends and their ranks and titles."""
    return niche_results(results, niche).select(
        "niche", "week_year", "week_number", "week_label", "post_count", "clusters_found", "noise_posts",
        F.size("trends").alias("trend_count"),
        F.transform("trends", lambda t: F.struct(t["rank"].alias("rank"), t["title"].alias("title"))).alias("top_trends"),
    )


def niche_summaries(results: DataFrame) -> DataFrame:
    """Posts, sorted weeks and trends per niche; a niche without weeks has no row."""
    return results.groupBy("niche").agg(
        F.sum("post_count").alias("total_posts"),
        F.array_sort(F.collect_list("week_number")).alias("weeks_available"),
        F.sum(F.size("trends")).alias("total_trends"),
    )


def all_summaries(results: DataFrame, generated_at: str, model: str) -> DataFrame:
    """Summaries of all niches with the facts of the run."""
    return niche_summaries(results).withColumns({"generated_at": F.lit(generated_at), "model": F.lit(model)})


def first_trends(results: DataFrame, n: int = 3) -> DataFrame:
    return results.withColumn("trends", F.slice("trends", 1, n))


def first_niches(results: DataFrame, n: int = 6) -> DataFrame:
    """Summaries of the first niches by name."""
    return niche_summaries(results).orderBy("niche").limit(n)

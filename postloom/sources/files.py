"""File readers and writers: CSV posts, listing pages, nested result documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from . import schemas

_CSV = {"header": "true", "quote": '"', "escape": '"'}


def read_posts_csv(spark: SparkSession, path: str, schema: str = schemas.POSTS) -> DataFrame:
    """Posts of CSV files with a header row; quoted text may hold line ends and quotes.

    Multi-line CSV cannot be split, so one file is one task: land many files, not one.
    """
    return spark.read.schema(schema).options(**_CSV).option("multiLine", "true").csv(path)


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """CSV table or report with a header row. A file of many lines is read whole in any case, so large ones may be compressed."""
    keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", "compression": compression}
    df.write.mode("overwrite").options(**_CSV, **keep).csv(path)


def write_json_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """One JSON object per line, in as many files as there are tasks."""
    df.write.mode("overwrite").partitionBy(*partition_by).json(path)


def read_listing_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.LISTING_PAGE).option("recursiveFileLookup", "true").json(path)


def posts_of_pages(pages: DataFrame, *carry: str) -> DataFrame:
    """Walk the envelope of listing pages and project the post record with its defaults.

    A missing value takes its default whether the field is absent or null. `carry` names columns of
    the page to keep, such as the listing it came from.
    """
    posts = pages.select(*carry, F.explode("data.children").alias("child")).select(*carry, "child.data.*")
    return posts.select(
        *carry,
        F.col("id").alias("post_id"),
        F.regexp_replace("subreddit_name_prefixed", "^r/", "").alias("niche"),
        F.col("title"),
        F.coalesce("author", F.lit("[deleted]")).alias("author"),
        F.col("subreddit_name_prefixed").alias("subreddit"),
        F.col("score"),
        F.col("upvote_ratio"),
        F.col("num_comments"),
        dates.from_epoch(F.col("created_utc")).alias("timestamp_utc"),
        text.absolute_link(F.col("permalink")).alias("permalink"),
        F.coalesce("url", F.lit("")).alias("url"),
        F.coalesce("selftext", F.lit("")).alias("selftext"),
        F.col("link_flair_text").alias("flair"),
        F.coalesce("is_video", F.lit(False)).alias("is_video"),
    )


def result_documents(results: DataFrame, generated_at: str, model: str) -> DataFrame:
    """One nested document per niche: `{generated_at, model, niches_processed, results}`.

    A document holds a niche's weeks, which are report rows (at most 53 a year), not posts.
    """
    week = F.struct(*[c for c in results.columns if c != "niche"])
    weeks = results.groupBy("niche").agg(
        F.sort_array(F.collect_list(F.struct("week_year", "week_number", week.alias("week")))).alias("weeks")
    )
    return weeks.select(
        "niche",
        F.to_json(
            F.struct(
                F.lit(generated_at).alias("generated_at"),
                F.lit(model).alias("model"),
                F.array("niche").alias("niches_processed"),
                F.create_map("niche", F.transform("weeks", lambda w: w["week"])).alias("results"),
            ),
            {"pretty": "true", "ignoreNullFields": "false"},
        ).alias("document"),
    )


def write_result_documents(documents: DataFrame, path: str) -> None:
    """One file per niche: a pretty document spans lines, so a file must hold a single one."""
    documents.select("niche", "document").write.mode("overwrite").partitionBy("niche").text(path)


def read_result_documents(spark: SparkSession, path: str) -> DataFrame:
    """Week results of nested documents, one row per niche and week; no file gives no rows."""
    reader = spark.read.schema(schemas.RESULT_DOCUMENT).option("multiLine", "true").option("recursiveFileLookup", "true")
    try:
        documents = reader.json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        documents = spark.createDataFrame([], schemas.RESULT_DOCUMENT)
    return (
        documents.select("generated_at", "model", F.explode("results").alias("niche", "weeks"))
        .select("generated_at", "model", "niche", F.explode("weeks").alias("week"))
        .select("generated_at", "model", "niche", "week.*")
    )


def save_vectors(df: DataFrame, path: str, key: str = "post_id") -> None:
    """Vectors with their key, so that no reader depends on row positions."""
    df.select(key, F.col("vector").cast("array<float>").alias("vector")).write.mode("overwrite").parquet(path)


def load_vectors(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)

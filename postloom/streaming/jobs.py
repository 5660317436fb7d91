"""The two batch steps that are streams by nature: ingest and weekly volume."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import files, schemas

# Weeks start on Mondays; the epoch is a Thursday.
_MONDAY = "4 days"


def read_pages(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Landed listing pages as a stream; the listing is the folder of a page."""
    reader = spark.readStream.schema(schemas.LISTING_PAGE + ", listing string")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def first_seen_posts(pages: DataFrame, since: str | None = None, keep_for: str = "30 days") -> DataFrame:
    """Posts of the pages, each id once within the watermark. State is one row per id, spread over all tasks, and
    ids older than `keep_for` leave it."""
    posts = files.posts_of_pages(pages, "listing").withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp"))
    if since:
        posts = posts.where(F.col("timestamp_utc") >= F.lit(since).cast("timestamp"))
    return posts.withWatermark("timestamp_utc", keep_for).dropDuplicatesWithinWatermark(["post_id"])


def weekly_volume(posts: DataFrame, delay: str = "1 day") -> DataFrame:
    """Posts and engagement per niche and week (Monday to Sunday). A week is written once, when the
    watermark has passed its end; later rows of it are dropped. Counts are combined before the shuffle, so a
    niche with very many posts is one state row."""
    timed = posts.withColumn("timestamp_utc", F.col("timestamp_utc").cast("timestamp")).withWatermark("timestamp_utc", delay)
    return (
        timed.groupBy("niche", F.window("timestamp_utc", "7 days", startTime=_MONDAY).alias("week"))
        .agg(F.count("*").alias("posts"), F.sum("score").alias("score"), F.sum("num_comments").alias("comments"))
        .select("niche", F.col("week.start").alias("week_start"), F.col("week.end").alias("week_end"), "posts", "score", "comments")
    )


def write_available(stream: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None) -> StreamingQuery:
    """Process what has landed and stop; a later run goes on from the checkpoint. Files are written exactly once.

    State has as many partitions as the session shuffles into when a checkpoint is first used, and keeps them;
    `state_partitions` names another number for this stream, since state is not coalesced at run time.
    """
    session = stream.sparkSession
    before = session.conf.get("spark.sql.shuffle.partitions")
    try:
        if state_partitions:
            session.conf.set("spark.sql.shuffle.partitions", str(state_partitions))
        return (
            stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
            .outputMode("append").trigger(availableNow=True).start()
        )
    finally:
        session.conf.set("spark.sql.shuffle.partitions", before)

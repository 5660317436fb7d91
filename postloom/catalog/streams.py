"""Streaming jobs over landed files, run until all files are processed."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import fixtures as fx
from ..streaming import jobs
from . import _sql as S
from . import query
from ._frames import stamp
from .scans import _landed_listings


def _run(spark, stream):
    out, checkpoint = scratch_path(spark, "stream"), scratch_path(spark, "stream-state")
    context = spark.sparkContext
    partitions = context.defaultParallelism if context.master.startswith("local") else None
    jobs.write_available(stream, out, checkpoint, partitions).awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


@query("s1_streamed_ingest", S.with_(S.POSTS) + f"""
SELECT post_id, niche, CASE WHEN author = '0' THEN '[deleted]' ELSE author END AS author, {S.stamp('timestamp_utc')} AS timestamp_utc FROM posts""")
def streamed_ingest(spark, sf):
    """Every post of two listings once."""
    path = scratch_path(spark, "listings")
    _landed_listings(spark, sf, path)
    posts = jobs.first_seen_posts(jobs.read_pages(spark, path))
    return _run(spark, posts).select("post_id", "niche", "author", stamp("timestamp_utc"))


@query("s2_streamed_weekly_volume", S.with_(S.CLEAN) + """
SELECT niche, strftime(date_trunc('week', timestamp_utc), '%Y-%m-%d') AS week_start, count(*) AS posts,
  round(sum(score) + 1e-9, 2) AS score, CAST(sum(num_comments) AS BIGINT) AS comments
FROM clean GROUP BY niche, date_trunc('week', timestamp_utc)
HAVING date_trunc('week', timestamp_utc) + INTERVAL 7 DAY <= (SELECT max(timestamp_utc) FROM clean) - INTERVAL 1 DAY""")
def streamed_weekly_volume(spark, sf):
    """Weeks that the watermark has closed; the last one stays open."""
    landed = scratch_path(spark, "posts")
    posts = fx.posts(spark, sf).select("post_id", "niche", "score", "num_comments", "timestamp_utc")
    posts.write.parquet(landed)
    volume = jobs.weekly_volume(spark.readStream.schema(posts.schema).parquet(landed))
    return _run(spark, volume).select(
        "niche", F.date_format("week_start", "yyyy-MM-dd").alias("week_start"), "posts",
        F.round(F.col("score") + 1e-9, 2).alias("score"), "comments",
    )

"""From landed listing pages to stored posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import LISTINGS
from ..operators.ranking import first_rows
from ..sources import files


def listing_priority(listing: Column) -> Column:
    """Position in the list of listings; unknown listings come last."""
    found = F.array_position(F.array(*[F.lit(x) for x in LISTINGS]), listing)
    return F.when(found > 0, found).otherwise(len(LISTINGS) + 1)


def first_seen(posts: DataFrame) -> DataFrame:
    """One row per post, from the listing with the highest priority."""
    return first_rows(posts, ["post_id"], [listing_priority(F.col("listing")), F.asc("timestamp_utc")])


def ingest(pages: DataFrame, now: str, days: int = 30) -> DataFrame:
    """Posts of the last `days` days in listing pages, each once, newest first."""
    cutoff = F.lit(now).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    posts = files.posts_of_pages(pages, "listing").where(F.col("timestamp_utc") >= cutoff)
    return first_seen(posts).orderBy(F.desc("timestamp_utc"))

"""Table schemas and definitions."""

from __future__ import annotations

from pyspark.sql import SparkSession

POSTS = """post_id string, niche string, title string, author string, score int, upvote_ratio double,
num_comments int, timestamp_utc timestamp_ntz, permalink string, url string, selftext string,
full_text string, text_translated string"""

EMBEDDINGS = "post_id string, niche string, embedding array<float>"

CLUSTER_ASSIGNMENTS = """post_id string, niche string, cluster_id int, cluster_version int,
is_final boolean, assigned_at timestamp"""

CLUSTERS = """niche string, cluster_id int, cluster_version int, cluster_name string,
cluster_summary string, keywords array<string>, post_count int"""

# One page of a listing, as it lands from the site.
LISTING_PAGE = """data struct<after: string, children: array<struct<data: struct<
id: string, title: string, author: string, subreddit_name_prefixed: string, score: int,
upvote_ratio: double, num_comments: int, created_utc: double, permalink: string, url: string,
selftext: string, link_flair_text: string, is_video: boolean>>>>"""

TREND = """struct<rank: int, title: string, description: string,
key_entities: struct<companies: array<string>, products: array<string>, people: array<string>>,
sentiment: string, importance: string, references: array<string>>"""

REPLY = f"struct<niche: string, trends: array<{TREND}>>"

CLUSTER_STAT = """struct<cluster_id: int, importance_score: double, post_count: bigint,
avg_score: double, avg_comments: double, avg_upvote_ratio: double>"""

WEEK_RESULT = f"""week_year int, week_number int, week_label string, post_count bigint,
clusters_found bigint, noise_posts bigint, trends array<{TREND}>, cluster_stats array<{CLUSTER_STAT}>"""


def _as_struct_fields(ddl: str) -> str:
    """`a int, b string` as struct fields `a: int, b: string` (top level only)."""
    out, depth, field = [], 0, ""
    for ch in ddl + ",":
        depth += ch == "<"
        depth -= ch == ">"
        if ch == "," and depth == 0:
            name, kind = field.strip().split(None, 1)
            out.append(f"{name}: {kind}")
            field = ""
        else:
            field += ch
    return ", ".join(out)


RESULT_DOCUMENT = f"""generated_at string, model string, niches_processed array<string>,
results map<string, array<struct<{_as_struct_fields(WEEK_RESULT)}>>>"""

# Stored tables are partitioned by what their readers filter on.
PARTITIONS = {
    "posts": ["niche"],
    "embeddings": ["niche"],
    "cluster_assignments": ["niche", "cluster_version"],
    "clusters": ["niche", "cluster_version"],
}
TABLES = {
    "posts": POSTS + ", created_at timestamp",
    "embeddings": EMBEDDINGS + ", created_at timestamp",
    "cluster_assignments": CLUSTER_ASSIGNMENTS,
    "clusters": CLUSTERS + ", created_at timestamp",
}


def create_tables(spark: SparkSession, database: str) -> None:
    """Create the stored tables that are not there yet."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name, ddl in TABLES.items():
        keys = ", ".join(PARTITIONS[name])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({ddl}) USING parquet PARTITIONED BY ({keys})")

"""Contexts, prompts, replies, stored results and reads (B26-B30, A11-A16, E18, G7, M)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import aggregates as agg
from ..plans import reads, weekly
from ..session import scratch_path
from ..sources import files, fixtures as fx, schemas, store
from . import _sql as S
from . import query
from ._frames import stamped
from .ranked import _RANKED

_LABEL_SQL = "strftime(min(timestamp_utc), '%b %d') || ' – ' || strftime(max(timestamp_utc), '%b %d, %Y')"


def _posts(spark: SparkSession, sf: str, with_text: bool = False) -> DataFrame:
    """Posts of large slices with the given clusters, far ones as noise, and what a description needs."""
    posts = agg.slice_gate(fx.noisy_posts(spark, sf, with_text), 20)
    posts = posts.withColumn("permalink", text.absolute_link(F.concat(F.lit("/comments/"), "post_id")))
    return posts.withColumn("body", text.best_text(F.col("text_translated"), F.col("full_text"))) if with_text else posts


def _replies(posts: DataFrame) -> DataFrame:
    """Stand-in for a writer: one trend per top cluster, fenced; the third one leaves its sentiment out; the
    replies of week 5 are cut off and those of week 4 of one niche are empty."""
    top = agg.top_clusters(agg.cluster_stats(posts), 3)
    trend = F.struct(
        F.col("cluster_rank").alias("rank"),
        F.concat(F.lit("Cluster "), F.col("cluster").cast("string")).alias("title"),
        F.concat(F.lit("About "), "niche").alias("description"),
        F.struct(F.array("niche").alias("companies")).alias("key_entities"),
        F.when(F.col("cluster_rank") < 3, "positive").alias("sentiment"),
    )
    body = F.to_json(F.struct("niche", F.array_sort(F.collect_list(trend)).alias("trends")))
    fenced = F.concat(F.lit("```json\n"), body, F.lit("\n```"))
    reply = F.when(F.col("week_number") == 5, F.substring(fenced, 1, 60)).when(
        (F.col("week_number") == 4) & (F.col("niche") == "view"), ""
    ).otherwise(fenced)
    return top.groupBy(*agg.SLICE).agg(reply.alias("reply"))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    posts = _posts(spark, sf)
    return weekly.week_results(posts, _replies(posts))


_RESULTS = S.with_(S.NOISY, S.GATED.replace("clustered", "noisy"), S.STATS, f"""top3 AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY niche, week_year, week_number ORDER BY importance_score DESC, cluster) AS r FROM stats) WHERE r <= 3),
trends AS (SELECT niche, week_year, week_number, count(*) AS trend_count,
    string_agg('#' || r || ' Cluster ' || cluster, ' | ' ORDER BY r) AS headline,
    string_agg(CASE WHEN r < 3 THEN 'positive' ELSE 'mixed' END, ',' ORDER BY r) AS sentiments FROM top3 GROUP BY ALL),
results AS (
  SELECT niche, week_year, week_number, {_LABEL_SQL} AS week_label, count(*) AS post_count,
    count(DISTINCT cluster) FILTER (cluster <> -1) AS clusters_found, count(*) FILTER (cluster = -1) AS noise_posts
  FROM gated WHERE week_number <> 5 AND NOT (week_number = 4 AND niche = 'view') GROUP BY niche, week_year, week_number)""")


@query("b26_parsed_replies", _RESULTS + """
SELECT niche, week_year, week_number, week_label, post_count, clusters_found, noise_posts, CAST(trend_count AS INTEGER) AS trend_count, headline, sentiments
FROM results JOIN trends USING (niche, week_year, week_number)""")
def parsed_replies(spark, sf):
    results = _results(spark, sf)
    return results.select(
        *agg.SLICE, "week_label", "post_count", "clusters_found", "noise_posts", F.size("trends").alias("trend_count"),
        text.trend_headline(F.col("trends")).alias("headline"),
        F.array_join(F.transform("trends", lambda t: t["sentiment"]), ",").alias("sentiments"),
    )


@query("b26_unread_replies", S.with_(S.CLEAN) + """
SELECT count(*) FILTER (week_number <> 5 AND NOT (week_number = 4 AND niche = 'view')) AS parsed,
  count(*) FILTER (week_number = 5 OR (week_number = 4 AND niche = 'view')) AS unread
FROM (SELECT niche, week_number FROM clean GROUP BY ALL HAVING count(*) >= 20)""")
def unread_replies(spark, sf):
    return weekly.unread_replies(_replies(_posts(spark, sf)))


_CONTEXT_HEAD = S.with_(S.NOISY, S.GATED.replace("clustered", "noisy"), S.STATS, """top3 AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY niche, week_year, week_number ORDER BY importance_score DESC, cluster) AS INTEGER) AS cluster_rank
    FROM stats) WHERE cluster_rank <= 3)""",
    "picked AS (SELECT g.*, t.cluster_rank FROM gated g JOIN top3 t USING (niche, week_year, week_number, cluster))",
    _RANKED.format(source="picked"), """listed AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY niche, week_year, week_number, cluster ORDER BY combined_rank, timestamp_utc DESC, post_id) AS position
    FROM combined) WHERE position <= 8)""")


@query("b27_context_posts", _CONTEXT_HEAD + """
SELECT niche, week_year, week_number, cluster, cluster_rank, 'Top posts by representativeness + engagement:' || chr(10) ||
  string_agg('  ' || position || '. [Score: ' || format('{:,}', CAST(floor(score) AS BIGINT)) || ' | Comments: ' || CAST(floor(num_comments) AS BIGINT) ||
    ' | Prob: ' || printf('%.2f', round(probability + 1e-9, 2)) || '] ' || substr(title, 1, 120) || chr(10) || '     URL: https://reddit.com/comments/' || post_id,
    chr(10) ORDER BY position) AS post_block
FROM listed GROUP BY niche, week_year, week_number, cluster, cluster_rank""")
def context_posts(spark, sf):
    """The part of a context that lists posts."""
    contexts = weekly.cluster_contexts(_posts(spark, sf, with_text=True))
    marker = "Top posts by representativeness + engagement:"
    tail = F.substring_index("context", marker, -1)
    return contexts.select(*weekly.CLUSTER, "cluster_rank", F.concat(F.lit(marker), tail).alias("post_block"))


@query("b27_context_facts", _CONTEXT_HEAD + """
SELECT niche, week_year, week_number, cluster, '--- CLUSTER ' || cluster || ' ---' || chr(10) || 'Post count         : ' || count(*) || chr(10) ||
  'Avg score          : ' || printf('%.0f', round(avg(score) + 1e-9, 0)) || chr(10) || 'Avg comments       : ' || printf('%.0f', round(avg(num_comments) + 1e-9, 0)) || chr(10) ||
  'Avg upvote ratio   : ' || printf('%.2f', round(avg(upvote_ratio) + 1e-9, 2)) AS facts
FROM picked GROUP BY niche, week_year, week_number, cluster""")
def context_facts(spark, sf):
    """The first five lines of a context."""
    contexts = weekly.cluster_contexts(_posts(spark, sf, with_text=True))
    return contexts.select(*weekly.CLUSTER, F.substring_index("context", "\n", 5).alias("facts"))


@query("b28_prompts")
def prompts(spark, sf):
    posts = _posts(spark, sf, with_text=True)
    labels = weekly.slice_facts(posts).select(*agg.SLICE, "week_label")
    return weekly.prompts(weekly.cluster_contexts(posts), labels)


@query("b28_prompt_frames", _CONTEXT_HEAD + f"""
SELECT niche, week_year, week_number, week_label, n_trends, clusters,
  'You describe what a community keeps coming back to. The community is r/' || niche || ', the time ' || week_label || '.' || chr(10) || chr(10) ||
  'A trend is a pattern over many posts, not one event.' AS opening,
  n_trends || ' trend(s), one per cluster, in the order above. For each: a title of at most ten words; a description of three sentences ' ||
  '(the pattern, why it recurs, what it signals); the companies, products and people in it; the sentiment; one sentence on why it matters; ' ||
  'two or three links from the posts above.' || chr(10) || 'Answer with JSON only, in this shape, with exactly ' || n_trends || ' object(s) in trends:' || chr(10) ||
  '{{"niche": "' || niche || '", "trends": [{{"rank": 1, "title": "", "description": "", "key_entities": {{"companies": [], "products": [], "people": []}}, ' ||
  '"sentiment": "positive|negative|mixed", "importance": "", "references": []}}]}}' AS closing
FROM (SELECT niche, week_year, week_number, count(*) AS n_trends, string_agg(CAST(cluster AS VARCHAR), ',' ORDER BY cluster_rank) AS clusters
  FROM top3 GROUP BY niche, week_year, week_number)
JOIN (SELECT niche, week_year, week_number, {_LABEL_SQL} AS week_label FROM gated GROUP BY niche, week_year, week_number)
  USING (niche, week_year, week_number)""")
def prompt_frames(spark, sf):
    """What stands around the contexts of a prompt, and which clusters it holds in which order."""
    posts = _posts(spark, sf, with_text=True)
    labels = weekly.slice_facts(posts).select(*agg.SLICE, "week_label")
    asked = weekly.prompts(weekly.cluster_contexts(posts), labels)
    return asked.select(
        *agg.SLICE, "week_label", "n_trends",
        F.array_join(F.regexp_extract_all("prompt", F.lit("--- CLUSTER (-?[0-9]+) ---"), 1), ",").alias("clusters"),
        F.substring_index("prompt", "\n\nCLUSTERS\n", 1).alias("opening"),
        F.substring_index("prompt", "\n\nWrite exactly ", -1).alias("closing"),
    )


@query("b30_headlines", _RESULTS + "SELECT niche, week_year, week_number, headline FROM results JOIN trends USING (niche, week_year, week_number)")
def headlines(spark, sf):
    return _results(spark, sf).select(*agg.SLICE, text.trend_headline(F.col("trends")).alias("headline"))


_FACTS = "niche, week_year, week_number, week_label, post_count, clusters_found, noise_posts"


@query("a11_result_documents", _RESULTS + f"SELECT {_FACTS} FROM results")
def result_documents(spark, sf):
    """Results as nested JSON documents, written and read back."""
    path = scratch_path(spark, "documents")
    documents = files.result_documents(_results(spark, sf), "2024-02-01 00:00:00", "none")
    files.write_result_documents(documents, path)
    rows = files.read_result_documents(spark, path)
    return rows.select(*_FACTS.split(", "))


@query("a13_result_scan", _RESULTS + f"""
SELECT {_FACTS}, CAST(trend_count AS INTEGER) AS trend_count FROM results JOIN trends USING (niche, week_year, week_number)""")
def result_scan(spark, sf):
    """Results as one JSON row per niche and week, partitioned by niche, written and read back."""
    results, path = _results(spark, sf), scratch_path(spark, "results")
    files.write_json_rows(results, path, ["niche"])
    rows = spark.read.schema(results.schema).json(path)
    return rows.select(*_FACTS.split(", "), F.size("trends").alias("trend_count"))


@query("a14_csv_report", S.with_(S.NOISY) + f"""
SELECT cluster, count(*) AS posts, round(avg(engagement) + 1e-9, 1) AS avg_engagement, {S.stamp('min(timestamp_utc)')} AS first_seen
FROM noisy WHERE cluster <> -1 GROUP BY cluster""")
def csv_report(spark, sf):
    report = stamped(agg.cluster_report(fx.noisy_posts(spark, sf), with_times=True), "first_seen", "last_seen")
    path = scratch_path(spark, "report")
    files.write_csv(report, path)
    return spark.read.schema(report.schema).option("header", "true").csv(path).select("cluster", "posts", "avg_engagement", "first_seen")


@query("a16_created_tables", S.with_(S.POSTS) + "SELECT niche, count(*) AS posts FROM posts GROUP BY niche")
def created_tables(spark, sf):
    """All tables as defined; that of posts is filled and read through its definition."""
    database = f"made_{uuid.uuid4().hex}"
    schemas.create_tables(spark, database)
    table = f"{database}.posts"
    posts = fx.posts(spark, sf).drop("doc_id").withColumn("score", F.floor("score").cast("int"))
    filled = spark.table(table).limit(0).unionByName(posts, allowMissingColumns=True)
    filled.select(*spark.table(table).columns).write.mode("append").insertInto(table)
    return spark.table(table).groupBy("niche").agg(F.count("*").alias("posts"))


_SUMMARIES = _RESULTS + """
SELECT niche, CAST(sum(post_count) AS BIGINT) AS total_posts, array_to_string(list_sort(list(week_number)), ',') AS weeks_available,
  CAST(sum(trend_count) AS BIGINT) AS total_trends{more} FROM results JOIN trends USING (niche, week_year, week_number) GROUP BY niche"""


def _weeks_as_text(df: DataFrame) -> DataFrame:
    return df.withColumn("weeks_available", F.array_join(F.col("weeks_available").cast("array<string>"), ","))


@query("e18_niche_summaries", _SUMMARIES.format(more=""))
def niche_summaries(spark, sf):
    return _weeks_as_text(reads.niche_summaries(_results(spark, sf)))


@query("g7_first_niches", _SUMMARIES.format(more="") + " ORDER BY niche LIMIT 3")
def first_niches(spark, sf):
    return _weeks_as_text(reads.first_niches(_results(spark, sf), 3))


@query("g7_first_trends", _RESULTS + """
SELECT niche, week_year, week_number, CAST(least(trend_count, 2) AS INTEGER) AS shown FROM results JOIN trends USING (niche, week_year, week_number)""")
def first_trends(spark, sf):
    return reads.first_trends(_results(spark, sf), 2).select(*agg.SLICE, F.size("trends").alias("shown"))


@query("m1_available_niches", _RESULTS + "SELECT DISTINCT niche FROM results ORDER BY niche")
def available_niches(spark, sf):
    return reads.available_niches(_results(spark, sf))


@query("m2_niche_results", _RESULTS + f"SELECT {_FACTS} FROM results WHERE niche = 'view'")
def niche_results(spark, sf):
    return reads.niche_results(_results(spark, sf), "view").select(*_FACTS.split(", "))


@query("m2_niche_week", _RESULTS + f"SELECT {_FACTS} FROM results WHERE niche = 'click' AND week_number = 3")
def niche_week(spark, sf):
    return reads.niche_results(_results(spark, sf), "click", 3).select(*_FACTS.split(", "))


@query("m3_weekly_summary", _RESULTS + f"""
SELECT {_FACTS}, CAST(trend_count AS INTEGER) AS trend_count, headline FROM results JOIN trends USING (niche, week_year, week_number) WHERE niche = 'view'""")
def weekly_summary(spark, sf):
    rows = reads.weekly_summary(_results(spark, sf), "view")
    return rows.withColumn("headline", text.trend_headline(F.col("top_trends"))).drop("top_trends")


@query("m4_all_summaries", _SUMMARIES.format(more=", '2024-02-01 00:00:00' AS generated_at, 'none' AS model"))
def all_summaries(spark, sf):
    return _weeks_as_text(reads.all_summaries(_results(spark, sf), "2024-02-01 00:00:00", "none"))

"""Joins, aggregations and set operations (survey groups D, E and H)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import CRITICAL_WORDS
from ..functions import numbers, text
from ..operators import aggregates as agg
from ..sources import fixtures as fx, store
from . import _sql as S
from . import query
from ._frames import stamped, vector_text
from .scans import _POST_VECTORS

_REPORT_SQL = """top AS (
  SELECT cluster, niche AS dominant_topic FROM (
    SELECT cluster, niche, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, niche) AS r
    FROM noisy WHERE cluster <> -1 GROUP BY cluster, niche) WHERE r = 1),
report AS (
  SELECT cluster, count(*) AS posts, round(avg(engagement) + 1e-9, 1) AS avg_engagement,
    CAST(floor(round(sum(engagement) + 1e-9, 4)) AS BIGINT) AS total_engagement,
    min(timestamp_utc) AS first_seen, max(timestamp_utc) AS last_seen
  FROM noisy WHERE cluster <> -1 GROUP BY cluster)"""


@query("d1_posts_with_vectors", S.with_(S.POSTS, _POST_VECTORS) + f"""
SELECT p.post_id, p.score, p.num_comments, {S.vector_text('v.embedding')} AS embedding FROM posts p JOIN post_vectors v USING (post_id)""")
def posts_with_vectors(spark, sf):
    joined = fx.posts(spark, sf, with_ratio=False).join(fx.post_embeddings(spark, sf).drop("niche"), "post_id")
    return joined.select("post_id", "score", "num_comments", vector_text("embedding"))


@query("d2_posts_in_id_set", S.with_(S.POSTS) + """
SELECT post_id, niche FROM posts WHERE post_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE toxic = 0)""")
def posts_in_id_set(spark, sf):
    ids = fx.table(spark, sf, "labels").where("toxic = 0").select(F.col("doc_id").cast("string").alias("post_id"))
    return fx.posts(spark, sf, with_ratio=False).join(ids, "post_id", "left_semi").select("post_id", "niche")


@query("d5_cluster_lookup", S.with_(S.NOISY) + """
SELECT post_id, cluster, CASE WHEN cluster <> -1 THEN (SELECT min(niche) FROM noisy i WHERE i.cluster = noisy.cluster) || cluster END AS keywords FROM noisy""")
def cluster_lookup(spark, sf):
    rows = fx.noisy_posts(spark, sf)
    words = rows.where("cluster <> -1").groupBy("cluster").agg(
        F.concat(F.min("niche"), F.col("cluster").cast("string")).alias("keywords")
    )
    return rows.join(words, "cluster", "left").select("post_id", "cluster", "keywords")


@query("d9_scaled_scores", S.with_(S.POSTS) + """
SELECT post_id, round((score - (SELECT min(score) FROM posts)) / ((SELECT max(score) FROM posts) - (SELECT min(score) FROM posts)) + 1e-9, 6) AS scaled FROM posts""")
def scaled_scores(spark, sf):
    rows = agg.min_max_scaled(fx.posts(spark, sf, with_ratio=False), "score", "scaled")
    return rows.select("post_id", numbers.rounded(F.col("scaled"), 6).alias("scaled"))


@query("e1_posts_per_niche", S.with_(S.POSTS) + """
SELECT niche, count(*) AS posts, round(count(*) * 100.0 / (SELECT count(*) FROM posts) + 1e-9, 1) AS share_pct FROM posts GROUP BY niche""")
def posts_per_niche(spark, sf):
    return agg.count_with_share(fx.posts(spark, sf, with_ratio=False), ["niche"])


_PROFILE = f"""round(avg(score) + 1e-9, 1) AS avg_score, round(avg(upvote_ratio) + 1e-9, 2) AS avg_upvote_ratio,
  round(avg(num_comments) + 1e-9, 1) AS avg_comments, count(DISTINCT author) AS authors,
  {S.stamp('min(timestamp_utc)')} AS first_seen, {S.stamp('max(timestamp_utc)')} AS last_seen"""


@query("e4_profile", S.with_(S.POSTS) + f"SELECT {_PROFILE} FROM posts")
def profile(spark, sf):
    return stamped(agg.profile(fx.posts(spark, sf)), "first_seen", "last_seen")


@query("e4_profile_per_niche", S.with_(S.POSTS) + f"SELECT niche, {_PROFILE} FROM posts GROUP BY niche")
def profile_per_niche(spark, sf):
    return stamped(agg.profile(fx.posts(spark, sf), "niche"), "first_seen", "last_seen")


@query("e5_cluster_scores", S.with_(S.NOISY, "gated AS (SELECT * FROM noisy)", S.STATS) + "SELECT * FROM stats")
def cluster_scores(spark, sf):
    return agg.cluster_stats(fx.noisy_posts(spark, sf))


@query("e5b_cluster_scores_with_noise", S.with_(S.NOISY, "gated AS (SELECT * FROM noisy)", S.STATS.replace("WHERE cluster <> -1", "")) + "SELECT * FROM stats")
def cluster_scores_with_noise(spark, sf):
    return agg.cluster_stats(fx.noisy_posts(spark, sf), keep_noise=True)


@query("e6_avg_score_per_niche", S.with_(S.POSTS) + """
SELECT niche, round(avg(score) + 1e-9, 4) AS avg_score FROM posts GROUP BY niche ORDER BY avg_score DESC, niche""")
def avg_score_per_niche(spark, sf):
    means = fx.posts(spark, sf, with_ratio=False).groupBy("niche").agg(numbers.rounded(F.avg("score"), 4).alias("avg_score"))
    return means.orderBy(F.desc("avg_score"), "niche")


@query("e7_week_summary", S.with_(S.CLEAN) + f"""
SELECT week_year, week_number, count(*) AS post_count, {S.stamp('min(timestamp_utc)')} AS date_start, {S.stamp('max(timestamp_utc)')} AS date_end,
  'Week ' || week_number || '  |  ' || strftime(min(timestamp_utc), '%b %d') || ' – ' || strftime(max(timestamp_utc), '%b %d, %Y')
    || '  |  ' || format('{{:,}}', count(*)) || ' posts' AS label
FROM clean GROUP BY week_year, week_number ORDER BY week_year, week_number""")
def week_summary(spark, sf):
    summary = agg.week_summary(fx.with_weeks(fx.posts(spark, sf, with_ratio=False)))
    return stamped(summary.orderBy("week_year", "week_number"), "date_start", "date_end")


@query("e8_cluster_sizes", S.with_(S.NOISY) + """
SELECT cluster, count(*) AS posts FROM noisy WHERE cluster <> -1 GROUP BY cluster ORDER BY posts DESC, cluster""")
def cluster_sizes(spark, sf):
    rows = fx.noisy_posts(spark, sf).where("cluster <> -1")
    return agg.count_by(rows, "cluster").orderBy(F.desc("posts"), "cluster")


@query("e8_cluster_sizes_with_share", S.with_(S.NOISY) + """
SELECT cluster, count(*) AS posts, round(count(*) * 100.0 / (SELECT count(*) FROM noisy) + 1e-9, 1) AS share_pct FROM noisy GROUP BY cluster""")
def cluster_sizes_with_share(spark, sf):
    return agg.count_with_share(fx.noisy_posts(spark, sf), ["cluster"])


_TOP = """SELECT cluster FROM noisy WHERE cluster <> -1 GROUP BY cluster ORDER BY count(*) DESC, cluster LIMIT {n}"""


@query("e9_engagement_per_cluster", S.with_(S.NOISY) + f"""
SELECT cluster, round(avg(engagement) + 1e-9, 1) AS avg_engagement, round(median(engagement) + 1e-9, 1) AS median_engagement,
  round(sum(engagement) + 1e-9, 1) AS total_engagement FROM noisy WHERE cluster IN ({_TOP.format(n=12)}) GROUP BY cluster""")
def engagement_per_cluster(spark, sf):
    rows = fx.noisy_posts(spark, sf)
    return agg.engagement_stats(agg.only_clusters(rows, agg.largest_clusters(rows, 12)))


@query("e10_weekly_volume", S.with_(S.NOISY) + f"""
SELECT strftime(date_trunc('week', timestamp_utc) + INTERVAL 6 DAY, '%Y-%m-%d') AS week_end, cluster, count(*) AS posts
FROM noisy WHERE cluster IN ({_TOP.format(n=6)}) GROUP BY ALL""")
def weekly_volume(spark, sf):
    rows = fx.noisy_posts(spark, sf)
    volume = agg.weekly_volume(agg.only_clusters(rows, agg.largest_clusters(rows, 6)))
    return volume.withColumn("week_end", F.date_format("week_end", "yyyy-MM-dd"))


@query("e13_dominant_niche", S.with_(S.NOISY, _REPORT_SQL) + "SELECT * FROM top")
def dominant_niche(spark, sf):
    return agg.dominant(fx.noisy_posts(spark, sf).where("cluster <> -1"), ["cluster"], "niche", "dominant_topic")


@query("e14_cross_tab", S.with_(S.NOISY) + """
SELECT c.cluster, n.niche, count(p.niche) AS posts FROM (SELECT DISTINCT cluster FROM noisy) c
CROSS JOIN (SELECT DISTINCT niche FROM noisy WHERE niche IS NOT NULL) n
LEFT JOIN noisy p ON p.cluster IS NOT DISTINCT FROM c.cluster AND p.niche = n.niche GROUP BY c.cluster, n.niche""")
def cross_tab(spark, sf):
    """The table with a column for each niche, turned to long form to be compared: every cluster with every niche."""
    wide = agg.cross_tab(fx.noisy_posts(spark, sf))
    return wide.unpivot("cluster", [c for c in wide.columns if c != "cluster"], "niche", "posts")


@query("e15_niche_shares", S.with_(S.NOISY) + """
SELECT cluster, niche, count(*) AS posts, round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY cluster) + 1e-9, 1) AS share_pct
FROM noisy GROUP BY cluster, niche""")
def niche_shares(spark, sf):
    return agg.share_within(fx.noisy_posts(spark, sf), ["cluster"], "niche")


@query("e15_top_niches", S.with_(S.NOISY) + """
SELECT cluster, string_agg('r/' || niche, ', ' ORDER BY rank) AS niches FROM (
  SELECT cluster, niche, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, niche) AS rank FROM noisy GROUP BY cluster, niche)
WHERE rank <= 3 GROUP BY cluster""")
def top_niches(spark, sf):
    from ..operators.ranking import top_rows

    counts = agg.count_by(fx.noisy_posts(spark, sf), "cluster", "niche")
    top = top_rows(counts, ["cluster"], [F.desc("posts"), F.asc("niche")], 3)
    tagged = F.array_sort(F.collect_list(F.struct("rank", text.niche_tag(F.col("niche")).alias("tag"))))
    return top.groupBy("cluster").agg(F.array_join(F.transform(tagged, lambda s: s["tag"]), ", ").alias("niches"))


@query("e16_distinct_niches", "SELECT DISTINCT event_type AS niche FROM events ORDER BY niche")
def distinct_niches(spark, sf):
    return fx.posts(spark, sf, with_ratio=False).select("niche").distinct().orderBy("niche")


@query("e17_noise_summary", S.with_(S.NOISY) + """
SELECT niche, week_year, week_number, count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters,
  count(*) FILTER (cluster = -1) AS noise, count(*) FILTER (cluster <> -1) AS clustered,
  round(avg(CASE WHEN cluster = -1 THEN 1.0 ELSE 0.0 END) * 100 + 1e-9, 1) AS noise_pct,
  round(avg(CASE WHEN cluster = -1 THEN 0.0 ELSE 1.0 END) * 100 + 1e-9, 1) AS coverage
FROM noisy GROUP BY niche, week_year, week_number""")
def noise_summary(spark, sf):
    return agg.noise_summary(fx.noisy_posts(spark, sf), *agg.SLICE)


@query("e19_critical_share", S.with_(S.POSTS) + """
SELECT niche, round(avg(CASE WHEN list_bool_or([contains(lower(title), w) FOR w IN [{words}]]) THEN 1.0 ELSE 0.0 END) + 1e-9, 6) AS critical_share
FROM posts GROUP BY niche""".format(words=S.word_list(CRITICAL_WORDS)))
def critical_share(spark, sf):
    posts = fx.posts(spark, sf, with_text=True, with_ratio=False)
    hit = text.is_critical(F.col("title")).cast("double")
    return posts.groupBy("niche").agg(numbers.rounded(F.avg(hit), 6).alias("critical_share"))


@query("e20_confidence_histogram", S.with_(
    S.NOISY, "b AS (SELECT min(probability) AS lo, max(probability) AS hi FROM noisy WHERE cluster <> -1)") + """
SELECT CAST(least(floor((probability - lo) / ((hi - lo) / 40)), 39) AS INTEGER) AS bin, count(*) AS posts
FROM noisy, b WHERE cluster <> -1 GROUP BY 1""")
def confidence_histogram(spark, sf):
    return agg.confidence_histogram(fx.noisy_posts(spark, sf).where("cluster <> -1"))


@query("h1_union_of_niches", S.with_(S.POSTS) + "SELECT post_id, niche FROM posts")
def union_of_niches(spark, sf):
    """One scan holds all niches, whatever they are."""
    return fx.posts(spark, sf, with_ratio=False).select("post_id", "niche")


@query("h1_union_of_frames", """
SELECT doc_id AS id, source AS origin, lang, NULL AS url FROM documents
UNION ALL SELECT page_id, 'page', NULL, url FROM pages""")
def union_of_frames(spark, sf):
    """Frames with different columns are put together by name."""
    documents = fx.table(spark, sf, "documents").select(F.col("doc_id").alias("id"), F.col("source").alias("origin"), "lang")
    pages = fx.table(spark, sf, "pages").select(F.lit("page").alias("origin"), F.col("page_id").alias("id"), "url")
    return documents.unionByName(pages, allowMissingColumns=True)


def _weekly_counts(spark, sf):
    return agg.count_by(fx.with_weeks(fx.posts(spark, sf, with_ratio=False)), *agg.SLICE)


_WEEKLY = "weekly AS (SELECT niche, week_year, week_number, count(*) AS posts FROM clean GROUP BY ALL)"


@query("h3_replaced_weeks", S.with_(S.CLEAN, _WEEKLY) + """
SELECT niche, week_year, week_number, CASE WHEN niche = 'view' AND week_number = 2 THEN -posts ELSE posts END AS posts FROM weekly""")
def replaced_weeks(spark, sf):
    """A new run of one niche and week replaces that week only."""
    stored = _weekly_counts(spark, sf)
    new = stored.where("niche = 'view' AND week_number = 2").withColumn("posts", -F.col("posts"))
    return store.merged_results(stored, new)


@query("h3_replaced_niches", S.with_(S.CLEAN, _WEEKLY) + """
SELECT niche, week_year, week_number, CASE WHEN niche = 'view' THEN -posts ELSE posts END AS posts FROM weekly
WHERE niche <> 'view' OR week_number = 2""")
def replaced_niches(spark, sf):
    """The rule that a new run replaces its niches whole."""
    stored = _weekly_counts(spark, sf)
    new = stored.where("niche = 'view' AND week_number = 2").withColumn("posts", -F.col("posts"))
    return store.merged_results(stored, new, ["niche"])


@query("h4_found_clusters", S.with_(S.NOISY) + "SELECT DISTINCT niche, cluster FROM noisy WHERE cluster <> -1")
def found_clusters(spark, sf):
    return fx.noisy_posts(spark, sf).where("cluster <> -1").select("niche", "cluster").distinct()

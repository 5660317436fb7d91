"""Windows, sorts and top-k (survey groups F and G), and the flagship query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import aggregates as agg, ranking
from ..sources import fixtures as fx
from . import _sql as S
from . import query
from ._frames import stamp

_RANKED = """ranked AS (
  SELECT *, rank() OVER (PARTITION BY niche, week_year, week_number, cluster ORDER BY probability DESC) AS prob_rank,
    rank() OVER (PARTITION BY niche, week_year, week_number, cluster
      ORDER BY round(score * 0.5 + num_comments * 0.3 + upvote_ratio * 100 * 0.2 + 1e-9, 6) DESC) AS eng_rank
  FROM {source}),
combined AS (SELECT *, round(prob_rank * 0.6 + eng_rank * 0.4, 4) AS combined_rank FROM ranked)"""

_KEYS = [*agg.SLICE, "cluster"]


@query("weekly_representative_posts", S.with_(S.CLUSTERED, S.GATED, S.STATS, """top3 AS (
  SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY niche, week_year, week_number ORDER BY importance_score DESC, cluster) AS INTEGER) AS cluster_rank
    FROM stats) WHERE cluster_rank <= 3)""",
    "picked AS (SELECT g.*, t.importance_score, t.cluster_rank FROM gated g JOIN top3 t USING (niche, week_year, week_number, cluster))",
    _RANKED.format(source="picked")) + f"""
SELECT niche, week_year, week_number, cluster_rank, cluster, importance_score, position, post_id, score, combined_rank,
  {S.stamp('timestamp_utc')} AS timestamp_utc FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY niche, week_year, week_number, cluster ORDER BY combined_rank, timestamp_utc DESC, post_id) AS INTEGER) AS position
  FROM combined) WHERE position <= 8""")
def weekly_representative_posts(spark, sf):
    """The top 3 clusters of each niche and week, and the 8 most representative posts of each."""
    posts = fx.clustered_posts(spark, sf)
    top = agg.top_clusters_of_large_slices(posts, 3, 20)
    mine = posts.join(top.select(*_KEYS, "importance_score", "cluster_rank"), _KEYS)
    picked = ranking.representative_posts(mine, _KEYS, 8)
    return picked.select(
        *agg.SLICE, "cluster_rank", "cluster", "importance_score", "position", "post_id", "score", "combined_rank",
        stamp("timestamp_utc"),
    )


_RANK_COLUMNS = "post_id, niche, week_year, week_number, cluster, prob_rank, eng_rank, combined_rank"


@query("f1_ranks_in_cluster", S.with_(S.CLUSTERED, _RANKED.format(source="clustered")) + f"SELECT {_RANK_COLUMNS} FROM combined")
def ranks_in_cluster(spark, sf):
    return ranking.combined_rank(fx.clustered_posts(spark, sf), _KEYS).select(*_RANK_COLUMNS.split(", "))


_NICHE_RANKED = _RANKED.replace("PARTITION BY niche, week_year, week_number, cluster", "PARTITION BY niche")


@query("f1_ranks_in_large_group", S.with_(S.CLUSTERED, _NICHE_RANKED.format(source="clustered")) + f"SELECT {_RANK_COLUMNS} FROM combined")
def ranks_in_large_group(spark, sf):
    """The same ranks over whole niches, in slices of about a hundred values."""
    rows = fx.clustered_posts(spark, sf)
    return ranking.combined_rank(rows, ["niche"], group_rows=100).select(*_RANK_COLUMNS.split(", "))


# Posts with gaps: no vote ratio, no probability, no cluster.
_GAPS = """gaps AS (
  SELECT p.post_id, p.niche, p.score, CAST(p.num_comments AS DOUBLE) AS num_comments, p.upvote_ratio, p.timestamp_utc, p.author,
    CASE WHEN CAST(p.post_id AS BIGINT) % 7 <> 0 THEN g.cluster END AS cluster,
    CASE WHEN g.probability >= 0.1 THEN g.probability END AS probability
  FROM posts p JOIN given g ON g.vec_id = CAST(p.post_id AS BIGINT) % (SELECT count(*) FROM embeddings))"""

_GAPS_RANKED = _RANKED.replace("niche, week_year, week_number, cluster", "niche, cluster").format(source="gaps")


def _posts_with_gaps(spark, sf):
    vecs = fx.table(spark, sf, "embeddings").agg(F.count("*")).scalar()
    posts = fx.posts(spark, sf).withColumn("vec_id", F.col("post_id").cast("bigint") % vecs).join(fx.given_clusters(spark, sf), "vec_id")
    return posts.select(
        "post_id", "niche", "score", F.col("num_comments").cast("double").alias("num_comments"), "upvote_ratio", "timestamp_utc", "author",
        F.when(F.col("post_id").cast("bigint") % 7 != 0, F.col("cluster")).alias("cluster"),
        F.when(F.col("probability") >= 0.1, F.col("probability")).alias("probability"),
    )


_GAP_RANKS = "post_id, niche, cluster, prob_rank, eng_rank, combined_rank"


@query("f1_ranks_with_nulls", S.with_(S.POSTS, S.GIVEN, _GAPS, _GAPS_RANKED) + f"SELECT {_GAP_RANKS} FROM combined")
def ranks_with_nulls(spark, sf):
    """No post is lost for a missing value or cluster; slices are small, so groups are split."""
    return ranking.combined_rank(_posts_with_gaps(spark, sf), ["niche", "cluster"], group_rows=20).select(*_GAP_RANKS.split(", "))


@query("f2_representative_posts_with_nulls", S.with_(S.POSTS, S.GIVEN, _GAPS, _GAPS_RANKED) + f"""
SELECT niche, cluster, position, post_id, author, combined_rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY niche, cluster ORDER BY combined_rank, timestamp_utc DESC, post_id) AS INTEGER) AS position
  FROM combined) WHERE position <= 8""")
def representative_posts_with_nulls(spark, sf):
    picked = ranking.representative_posts(_posts_with_gaps(spark, sf), ["niche", "cluster"], 8, group_rows=20)
    return picked.select("niche", "cluster", "position", "post_id", "author", "combined_rank")


@query("e9_median_with_nulls", S.with_(S.POSTS, S.GIVEN, _GAPS) + """
SELECT cluster, median(probability) AS middle FROM gaps GROUP BY cluster HAVING count(probability) > 0""")
def median_with_nulls(spark, sf):
    return ranking.group_median(_posts_with_gaps(spark, sf), ["cluster"], "probability", "middle")


@query("f3_top_clusters", S.with_(S.CLUSTERED, S.GATED, S.STATS) + """
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY niche, week_year, week_number ORDER BY importance_score DESC, cluster) AS INTEGER) AS cluster_rank
  FROM stats) WHERE cluster_rank <= 3""")
def top_clusters(spark, sf):
    return agg.top_clusters(agg.cluster_stats(agg.slice_gate(fx.clustered_posts(spark, sf), 20)), 3)


@query("f4_top_posts_by_score", S.with_(S.NOISY) + """
SELECT cluster, rank, post_id, niche, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY cluster ORDER BY score DESC, post_id) AS INTEGER) AS rank FROM noisy WHERE cluster <> -1)
WHERE rank <= 3""")
def top_posts_by_score(spark, sf):
    rows = fx.noisy_posts(spark, sf).where("cluster <> -1")
    top = ranking.top_rows(rows, ["cluster"], [F.desc("score"), F.asc("post_id")], 3)
    return top.select("cluster", "rank", "post_id", "niche", "score")


@query("f5_sample_per_cluster", S.with_(S.NOISY) + """
SELECT cluster, position, post_id FROM (
  SELECT cluster, post_id, CAST(row_number() OVER (PARTITION BY cluster ORDER BY md5(post_id || ':42'), post_id) AS INTEGER) AS position FROM noisy)
WHERE position <= 5""")
def sample_per_cluster(spark, sf):
    """Up to five posts of each cluster, picked by a seeded hash: the same posts on every run."""
    return ranking.seeded_sample(fx.noisy_posts(spark, sf), ["cluster"], 5, seed=42).select("cluster", "position", "post_id")


@query("f6_inverted_scale", S.with_(S.POSTS) + """
SELECT post_id, round(1 - (num_comments - (SELECT min(num_comments) FROM posts)) / ((SELECT max(num_comments) FROM posts) - (SELECT min(num_comments) FROM posts)) + 1e-9, 6) AS inverted,
  0.5::DOUBLE AS constant FROM posts""")
def inverted_scale(spark, sf):
    rows = fx.posts(spark, sf, with_ratio=False).withColumn("one", F.lit(1.0))
    scaled = agg.min_max_scaled(rows, "num_comments", "inverted", lower_is_better=True)
    scaled = agg.min_max_scaled(scaled, "one", "constant")
    return scaled.select("post_id", F.round(F.col("inverted") + 1e-9, 6).alias("inverted"), "constant")


@query("g1_newest_posts", S.with_(S.POSTS) + f"""
SELECT post_id, niche, {S.stamp('timestamp_utc')} AS timestamp_utc FROM posts WHERE niche = 'view'
ORDER BY posts.timestamp_utc DESC, post_id LIMIT 50""")
def newest_posts(spark, sf):
    from ..sources import store

    rows = store.posts_by_niche(fx.posts(spark, sf, with_ratio=False), "view", 50)
    return rows.select("post_id", "niche", stamp("timestamp_utc"))


@query("g3_largest_clusters", S.with_(S.NOISY) + """
SELECT cluster, count(*) AS posts FROM noisy WHERE cluster <> -1 GROUP BY cluster ORDER BY posts DESC, cluster LIMIT 6""")
def largest_clusters(spark, sf):
    return agg.largest_clusters(fx.noisy_posts(spark, sf), 6)


@query("g4_best_cluster_by_metric", S.with_(S.CLUSTERED, "gated AS (SELECT * FROM clustered)", S.STATS) + """
SELECT niche, arg_max(cluster, (importance_score, -cluster)) AS best_cluster, arg_min(cluster, (avg_comments, cluster)) AS quietest_cluster
FROM stats WHERE week_number = 2 GROUP BY niche""")
def best_cluster_by_metric(spark, sf):
    stats = agg.cluster_stats(fx.clustered_posts(spark, sf)).where("week_number = 2")
    return stats.groupBy("niche").agg(
        F.max_by("cluster", F.struct("importance_score", -F.col("cluster"))).alias("best_cluster"),
        F.min_by("cluster", F.struct("avg_comments", "cluster")).alias("quietest_cluster"),
    )


@query("g6_weeks_of_niche", S.with_(S.CLEAN) + """
SELECT niche, array_to_string(list_sort(list(DISTINCT week_number)), ',') AS weeks FROM clean GROUP BY niche""")
def weeks_of_niche(spark, sf):
    weeks = fx.with_weeks(fx.posts(spark, sf, with_ratio=False)).groupBy("niche").agg(F.collect_set("week_number").alias("weeks"))
    return weeks.select("niche", F.array_join(F.array_sort("weeks").cast("array<string>"), ",").alias("weeks"))

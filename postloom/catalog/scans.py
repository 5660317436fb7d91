"""Scans, sources, stored tables and sinks (survey group A, H3, M)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..session import scratch_path
from ..sources import files, fixtures as fx, schemas, store
from . import _sql as S
from . import query, sql_of
from ._frames import stamp, stamped, vector_text

_STORED_NICHES = ("click", "view")


def _csv_posts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.posts(spark, sf, with_text=True).select(
        "post_id", "niche", "title", "author", F.floor("score").cast("int").alias("score"), "upvote_ratio",
        "num_comments", "timestamp_utc", F.concat(F.lit("/comments/"), "post_id").alias("permalink"),
        F.lit(None).cast("string").alias("url"), F.lit("").alias("selftext"), "full_text", "text_translated",
    )


@query("a1_csv_scan", S.with_(S.POSTS) + f"""
SELECT post_id, niche, title, author, CAST(floor(score) AS INTEGER) AS score, upvote_ratio, num_comments,
  {S.stamp('timestamp_utc')} AS timestamp_utc, '/comments/' || post_id AS permalink, CAST(NULL AS VARCHAR) AS url,
  CAST(NULL AS VARCHAR) AS selftext, md5(full_text) AS full_text, md5(text_translated) AS text_translated FROM posts""")
def csv_scan(spark, sf):
    """An empty field of the file reads as null."""
    path = scratch_path(spark, "posts-csv")
    files.write_csv(_csv_posts(spark, sf), path, "gzip")
    rows = files.read_posts_csv(spark, path)
    return stamped(rows, "timestamp_utc").withColumns({c: F.md5(c) for c in ("full_text", "text_translated")})


def _landed_listings(spark: SparkSession, sf: str, path: str) -> None:
    """Listing pages as a site would serve them: four of five posts in the listing of new posts, posts with
    more than 50 comments in the top listing, some in that of the week, with a later score; an author missing where the user id is 0. A page has the posts of
    100 consecutive ids."""
    posts = fx.posts(spark, sf)
    child = F.struct(
        F.struct(
            F.col("post_id").alias("id"),
            F.concat(F.lit("Post "), "post_id").alias("title"),
            F.when(F.col("author") != "0", F.col("author")).alias("author"),
            text.niche_tag(F.col("niche")).alias("subreddit_name_prefixed"),
            F.floor("score").cast("int").alias("score"),
            "upvote_ratio",
            "num_comments",
            F.unix_timestamp(F.col("timestamp_utc").cast("timestamp")).cast("double").alias("created_utc"),
            F.concat(F.lit("/r/"), "niche", F.lit("/comments/"), "post_id").alias("permalink"),
            F.when(F.col("num_comments") % 2 == 0, F.concat(F.lit("https://example.com/"), "post_id")).alias("url"),
        ).alias("data")
    ).alias("child")
    newest = posts.where("num_comments % 5 <> 0").select(F.lit("new").alias("listing"), "post_id", child)
    top = posts.where("num_comments > 50").select(F.lit("top/month").alias("listing"), "post_id", child)
    later = child.withField("data.score", (F.floor("score") + 7).cast("int"))
    week = posts.where("num_comments % 5 = 0 OR num_comments > 90").select(F.lit("top/week").alias("listing"), "post_id", later.alias("child"))
    pages = (
        newest.unionByName(top).unionByName(week)
        .withColumn("page", F.floor(F.col("post_id").cast("bigint") / 100))
        .groupBy("listing", "page")
        .agg(F.collect_list("child").alias("children"))
        .select("listing", F.struct(F.col("page").cast("string").alias("after"), "children").alias("data"))
    )
    files.write_json_rows(pages, path, ["listing"])


_LISTED = """listed AS (
  SELECT post_id, niche, 'Post ' || post_id AS title, CASE WHEN author = '0' THEN '[deleted]' ELSE author END AS author,
    'r/' || niche AS subreddit, CAST(floor(score) AS INTEGER) AS score, upvote_ratio, num_comments, timestamp_utc,
    'https://reddit.com/r/' || niche || '/comments/' || post_id AS permalink,
    CASE WHEN num_comments % 2 = 0 THEN 'https://example.com/' || post_id ELSE '' END AS url, '' AS selftext,
    CAST(NULL AS VARCHAR) AS flair, false AS is_video FROM posts)"""


@query("a2_listing_pages", S.with_(S.POSTS, _LISTED) + f"""
SELECT * REPLACE ({S.stamp('timestamp_utc')} AS timestamp_utc), 'new' AS listing FROM listed WHERE num_comments % 5 <> 0
UNION ALL SELECT * REPLACE ({S.stamp('timestamp_utc')} AS timestamp_utc, score + 7 AS score), 'top/week' AS listing FROM listed WHERE num_comments % 5 = 0 OR num_comments > 90
UNION ALL SELECT * REPLACE ({S.stamp('timestamp_utc')} AS timestamp_utc), 'top/month' AS listing FROM listed WHERE num_comments > 50""")
def listing_pages(spark, sf):
    path = scratch_path(spark, "listings")
    _landed_listings(spark, sf, path)
    pages = spark.read.schema(schemas.LISTING_PAGE + ", listing string").json(path)
    return stamped(files.posts_of_pages(pages, "listing"), "timestamp_utc")


@query("a3_posts_by_niche", S.with_(S.POSTS) + f"""
SELECT post_id, niche, author, score, num_comments, upvote_ratio, {S.stamp('timestamp_utc')} AS timestamp_utc
FROM posts WHERE niche = 'click' ORDER BY posts.timestamp_utc DESC, post_id""")
def posts_by_niche(spark, sf):
    rows = store.posts_by_niche(fx.posts(spark, sf), "click")
    return rows.select("post_id", "niche", "author", "score", "num_comments", "upvote_ratio", stamp("timestamp_utc"))


_POST_VECTORS = """post_vectors AS (
  SELECT CAST(event_id AS VARCHAR) AS post_id, event_type AS niche, embedding FROM events
  JOIN embeddings ON vec_id = event_id % (SELECT count(*) FROM embeddings))"""


@query("a4_embeddings_by_niche", S.with_(_POST_VECTORS) + f"""
SELECT post_id, {S.vector_text('embedding')} AS embedding FROM post_vectors WHERE niche = 'view'""")
def embeddings_by_niche(spark, sf):
    rows = store.embeddings_by_niche(fx.post_embeddings(spark, sf), "view")
    return rows.select("post_id", vector_text("embedding"))


def _assignments(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of assignments: the given clusters, and the same in pairs; version 2 has the posts with
    a vote ratio only."""
    rows = fx.clustered_posts(spark, sf)
    first = rows.select("post_id", "niche", F.col("cluster").alias("cluster_id"), F.lit(1).alias("cluster_version"))
    second = rows.where("upvote_ratio > 0").select(
        "post_id", "niche", F.floor(F.col("cluster") / 2).cast("int").alias("cluster_id"), F.lit(2).alias("cluster_version")
    )
    return first.unionByName(second).withColumns(
        {"is_final": F.lit(True), "assigned_at": F.lit("2024-02-01 00:00:00").cast("timestamp")}
    )


_ASSIGNMENTS = """assignments AS (
  SELECT post_id, niche, cluster AS cluster_id, 1 AS cluster_version FROM clustered
  UNION ALL SELECT post_id, niche, CAST(cluster // 2 AS INTEGER), 2 FROM clustered WHERE upvote_ratio > 0)"""


def _clusters(assignments: DataFrame) -> DataFrame:
    """Metadata of every assigned cluster with an even id."""
    return (
        assignments.where("cluster_id % 2 = 0").groupBy("niche", "cluster_id", "cluster_version")
        .agg(F.count("*").cast("int").alias("post_count"))
        .withColumns({
            "cluster_name": F.concat_ws("-", "niche", F.col("cluster_id").cast("string")),
            "cluster_summary": F.lit(None).cast("string"),
            "keywords": F.array("niche"),
        })
    )


_CLUSTERS = """clusters AS (
  SELECT niche, cluster_id, cluster_version, CAST(count(*) AS INTEGER) AS post_count,
    niche || '-' || cluster_id AS cluster_name, CAST(NULL AS VARCHAR) AS cluster_summary, niche AS keywords
  FROM assignments WHERE cluster_id % 2 = 0 GROUP BY niche, cluster_id, cluster_version)"""


@query("a5_assignments_by_version", S.with_(S.CLUSTERED, _ASSIGNMENTS) + """
SELECT post_id, niche, cluster_id, cluster_version FROM assignments WHERE niche = 'click' AND cluster_version = 2""")
def assignments_by_version(spark, sf):
    rows = store.assignments_by_niche(_assignments(spark, sf), "click", 2)
    return rows.select("post_id", "niche", "cluster_id", "cluster_version")


@query("a5_assignments_all_versions", S.with_(S.CLUSTERED, _ASSIGNMENTS) + """
SELECT post_id, niche, cluster_id, cluster_version FROM assignments WHERE niche = 'click' ORDER BY cluster_version DESC""")
def assignments_all_versions(spark, sf):
    rows = store.assignments_by_niche(_assignments(spark, sf), "click")
    return rows.select("post_id", "niche", "cluster_id", "cluster_version")


@query("a6_clean_text_scan", S.with_(S.POSTS) + f"""
SELECT post_id, md5(text_translated) AS text_translated, niche, {S.stamp('timestamp_utc')} AS timestamp_utc, score, num_comments
FROM posts WHERE text_translated IS NOT NULL AND trim(text_translated) <> ''""")
def clean_text_scan(spark, sf):
    rows = store.clean_text_rows(fx.posts(spark, sf, with_text=True, with_ratio=False))
    return stamped(rows, "timestamp_utc").withColumn("text_translated", F.md5("text_translated"))


@query("a7_insert_ignore", S.with_(S.POSTS) + f"""
SELECT post_id, niche, score FROM posts WHERE niche IN ({S.word_list(_STORED_NICHES)})
UNION ALL SELECT post_id, 'late ' || niche, score + 1 FROM posts WHERE niche NOT IN ({S.word_list(_STORED_NICHES)})""")
def insert_ignore(spark, sf):
    """Two niches are stored; then a batch with every post twice arrives, the better copy first."""
    posts = fx.posts(spark, sf, with_ratio=False).select("post_id", "niche", "score")
    path = scratch_path(spark, "posts")
    store.append(posts.where(F.col("niche").isin(*_STORED_NICHES)), path, ["niche"])
    late = posts.withColumn("niche", F.concat(F.lit("late "), "niche"))
    batch = late.unionByName(late.withColumn("score", F.col("score") + 1))
    stored = spark.read.parquet(path)
    store.append(store.rows_to_insert(stored, batch, [F.desc("score")]), path, ["niche"])
    return spark.read.schema(posts.schema).parquet(path).select("post_id", "niche", "score")


@query("a8_upsert_embeddings", S.with_(_POST_VECTORS) + f"""
SELECT post_id, CASE WHEN niche IN ({S.word_list(_STORED_NICHES)}) THEN niche ELSE 'other' END AS niche,
  {S.vector_text('[-x FOR x IN embedding]')} AS embedding FROM post_vectors""")
def upsert_embeddings(spark, sf):
    """Vectors of two niches are stored; new vectors of all posts arrive under another niche name: known
    posts get the new vector and keep their niche."""
    vecs = fx.post_embeddings(spark, sf)
    path = scratch_path(spark, "embeddings")
    store.append(vecs.where(F.col("niche").isin(*_STORED_NICHES)), path, ["niche"])
    batch = vecs.withColumns({"niche": F.lit("other"), "embedding": F.transform("embedding", lambda x: -x)})
    stored = spark.read.schema(vecs.schema).parquet(path)
    store.upsert(stored, batch, ["post_id"], ["embedding"], [F.asc("niche")], path, ["niche"])
    return spark.read.schema(vecs.schema).parquet(path).select("post_id", "niche", vector_text("embedding"))


@query("a8_upsert_buckets", sql_of("a8_upsert_embeddings"))
def upsert_into_buckets(spark, sf):
    """The same into a table dealt by key, of which a batch reads and writes its own buckets only."""
    vecs = fx.post_embeddings(spark, sf)
    path = scratch_path(spark, "embedding-buckets")
    store.write_bucketed(vecs.where(F.col("niche").isin(*_STORED_NICHES)), path, ["post_id"], 16)
    batch = vecs.withColumns({"niche": F.lit("other"), "embedding": F.transform("embedding", lambda x: -x)})
    stored = spark.read.schema(f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in vecs.schema)}, {store.BUCKET} int").parquet(path)
    store.upsert_bucketed(stored, batch, ["post_id"], ["embedding"], [F.asc("niche")], path, 16)
    return spark.read.schema(vecs.schema).parquet(path).select("post_id", "niche", vector_text("embedding"))


@query("a9_versioned_assignments", S.with_(S.CLUSTERED, _ASSIGNMENTS) + """
SELECT niche, cluster_id, cluster_version, count(*) AS posts FROM assignments GROUP BY ALL""")
def versioned_assignments(spark, sf):
    """Writing the same versions a second time replaces their partitions."""
    rows, path = _assignments(spark, sf), scratch_path(spark, "assignments")
    for _ in range(2):
        store.overwrite_partitions(rows, path, ["niche", "cluster_version"])
    stored = spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("niche", "cluster_id", "cluster_version").agg(F.count("*").alias("posts"))


@query("a10_upsert_clusters", S.with_(S.CLUSTERED, _ASSIGNMENTS, _CLUSTERS) + """
SELECT niche, cluster_id, cluster_version, CASE WHEN cluster_version = 1 THEN post_count + 1000 ELSE post_count END AS post_count,
  CASE WHEN cluster_version = 1 THEN 'new' ELSE cluster_name END AS cluster_name FROM clusters
UNION ALL SELECT niche, cluster_id + 100, 1, post_count + 1000, 'new' FROM clusters WHERE cluster_version = 1""")
def upsert_clusters(spark, sf):
    stored = _clusters(_assignments(spark, sf))
    renamed = stored.where("cluster_version = 1").withColumns(
        {"post_count": F.col("post_count") + 1000, "cluster_name": F.lit("new")}
    )
    added = renamed.withColumn("cluster_id", F.col("cluster_id") + 100)
    path, parts = scratch_path(spark, "clusters"), schemas.PARTITIONS["clusters"]
    store.append(stored, path, parts)
    stored = spark.read.schema(stored.schema).parquet(path)
    store.upsert(
        stored, renamed.unionByName(added), ["niche", "cluster_id", "cluster_version"],
        ["cluster_name", "cluster_summary", "keywords", "post_count"], [F.asc("cluster_name")], path, parts,
    )
    return spark.read.schema(stored.schema).parquet(path).select("niche", "cluster_id", "cluster_version", "post_count", "cluster_name")


@query("a12_json_rows", S.with_(S.POSTS) + f"""
SELECT post_id, niche, author, score, num_comments, upvote_ratio, {S.stamp('timestamp_utc')} AS timestamp_utc FROM posts""")
def json_rows(spark, sf):
    rows = stamped(fx.posts(spark, sf).drop("doc_id"), "timestamp_utc")
    path = scratch_path(spark, "posts-json")
    files.write_json_rows(rows, path)
    return spark.read.schema(rows.schema).json(path).select(
        "post_id", "niche", "author", "score", "num_comments", "upvote_ratio", "timestamp_utc"
    )


@query("a15_saved_vectors", f"SELECT vec_id, {S.vector_text('embedding')} AS vector FROM embeddings")
def saved_vectors(spark, sf):
    path = scratch_path(spark, "vectors")
    files.save_vectors(fx.embeddings(spark, sf).withColumnRenamed("embedding", "vector"), path, "vec_id")
    return files.load_vectors(spark, path).select("vec_id", vector_text("vector"))


@query("d3_posts_with_clusters", S.with_(S.CLUSTERED, _ASSIGNMENTS, _CLUSTERS) + """
SELECT p.post_id, p.niche, p.score, a.cluster_id, c.cluster_name
FROM posts p LEFT JOIN assignments a ON p.post_id = a.post_id
LEFT JOIN clusters c ON a.niche = c.niche AND a.cluster_id = c.cluster_id AND a.cluster_version = c.cluster_version
WHERE p.niche = 'purchase' AND a.cluster_version = 2""")
def posts_with_clusters(spark, sf):
    assignments = _assignments(spark, sf)
    rows = store.posts_with_clusters(
        fx.posts(spark, sf, with_ratio=False), assignments, _clusters(assignments), "purchase", 2
    )
    return rows.select("post_id", "niche", "score", "cluster_id", "cluster_name")


@query("d4_new_posts_only", S.with_(S.POSTS) + """
SELECT post_id, niche FROM posts p WHERE NOT EXISTS (
  SELECT 1 FROM posts s WHERE s.post_id = p.post_id AND s.upvote_ratio IS NOT NULL)""")
def new_posts_only(spark, sf):
    posts = fx.posts(spark, sf)
    stored = posts.where(F.col("upvote_ratio").isNotNull())
    return store.rows_to_insert(stored, posts, [F.asc("niche")]).select("post_id", "niche")


@query("d6_cascade", S.with_(S.POSTS, _POST_VECTORS) + """
SELECT v.post_id, v.niche, p.post_id IS NULL AS orphan FROM post_vectors v
LEFT JOIN (SELECT post_id FROM posts WHERE upvote_ratio IS NOT NULL) p USING (post_id)""")
def cascade(spark, sf):
    """Posts without a vote ratio are deleted: which vectors stay, which go."""
    vecs = fx.post_embeddings(spark, sf).drop("embedding")
    posts = fx.posts(spark, sf).where(F.col("upvote_ratio").isNotNull())
    kept = store.without_orphans(vecs, posts).withColumn("orphan", F.lit(False))
    return kept.unionByName(store.orphans(vecs, posts).withColumn("orphan", F.lit(True)))


@query("e3_table_statistics", S.with_(S.CLUSTERED, _ASSIGNMENTS, _CLUSTERS, _POST_VECTORS) + """
SELECT 'posts' AS section, niche, CAST(NULL AS INTEGER) AS cluster_version, count(*) AS rows FROM posts GROUP BY niche
UNION ALL SELECT 'embeddings', NULL, NULL, count(*) FROM post_vectors
UNION ALL SELECT 'cluster_assignments', niche, cluster_version, count(*) FROM assignments GROUP BY niche, cluster_version
UNION ALL SELECT 'clusters', niche, cluster_version, count(*) FROM clusters GROUP BY niche, cluster_version""")
def table_statistics(spark, sf):
    assignments = _assignments(spark, sf)
    return store.table_statistics(
        fx.posts(spark, sf, with_ratio=False), fx.post_embeddings(spark, sf), assignments, _clusters(assignments)
    )


@query("e2_rows_per_version", S.with_(S.CLUSTERED, _ASSIGNMENTS) + """
SELECT niche, cluster_version, count(*) AS posts FROM assignments GROUP BY niche, cluster_version""")
def rows_per_version(spark, sf):
    return _assignments(spark, sf).groupBy("niche", "cluster_version").agg(F.count("*").alias("posts"))


@query("f7_first_seen_posts", S.with_(S.POSTS, _LISTED) + """
SELECT post_id, niche, author, listing, CASE listing WHEN 'top/week' THEN score + 7 ELSE score END AS score FROM (
  SELECT *, CASE WHEN num_comments % 5 <> 0 THEN 'new' WHEN num_comments > 50 THEN 'top/month' ELSE 'top/week' END AS listing FROM listed)""")
def first_seen_posts(spark, sf):
    """A post in two listings counts once, under the listing with the higher priority."""
    from ..plans.ingest import first_seen

    path = scratch_path(spark, "listings")
    _landed_listings(spark, sf, path)
    pages = spark.read.schema(schemas.LISTING_PAGE + ", listing string").json(path)
    return first_seen(files.posts_of_pages(pages, "listing")).select("post_id", "niche", "author", "listing", "score")


@query("c4_recent_posts", S.with_(S.POSTS, _LISTED) + f"""
SELECT post_id, niche, {S.stamp('timestamp_utc')} AS timestamp_utc FROM listed
WHERE timestamp_utc >= TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 10 DAY
ORDER BY listed.timestamp_utc DESC""")
def recent_posts(spark, sf):
    from ..plans.ingest import ingest

    path = scratch_path(spark, "listings")
    _landed_listings(spark, sf, path)
    pages = spark.read.schema(schemas.LISTING_PAGE + ", listing string").json(path)
    return ingest(pages, now="2024-01-31 00:00:00", days=10).select("post_id", "niche", stamp("timestamp_utc"))

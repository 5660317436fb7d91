"""The shared test tables seen as posts.

An event is a post; its text is a document and its vector an embedding, found by the event id modulo
the size of the other table. Each reader takes only the parts it needs, so a plan that wants
counts never reads a text column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, numbers, text, vectors


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores before costly work per row, where the input has fewer splits than there are cores;
    a large table has many splits and stays as it is."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents"))


def _size(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def posts(spark: SparkSession, sf_dir: str, with_text: bool = False, with_ratio: bool = True) -> DataFrame:
    """Posts as they are stored: the vote ratio may be null, the translation too."""
    events = table(spark, sf_dir, "events")
    documents = table(spark, sf_dir, "documents")
    out = events.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.col("event_type").alias("niche"),
        F.col("user_id").cast("string").alias("author"),
        F.col("value").alias("score"),
        F.get_json_object("props", "$.k").try_cast("int").alias("num_comments"),
        F.col("ts").alias("timestamp_utc"),
        (F.col("event_id") % _size(documents)).alias("doc_id"),
    )
    if with_ratio:
        labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("upvote_ratio"))
        out = out.join(labels, "doc_id", "left")
    return with_texts(spark, sf_dir, out) if with_text else out


def with_texts(spark: SparkSession, sf_dir: str, df: DataFrame) -> DataFrame:
    """Add the texts of the document of each post. The last of the joins, so that no other one moves texts."""
    return df.join(
        table(spark, sf_dir, "documents").select(
            "doc_id",
            F.col("text").alias("full_text"),
            F.when(F.col("lang") == "en", F.col("text")).alias("text_translated"),
            text.first_line(F.col("text")).alias("title"),
        ),
        "doc_id",
    )


def with_weeks(df: DataFrame) -> DataFrame:
    """Add the slice key: ISO year and ISO week."""
    return df.withColumns(
        {
            "week_year": dates.iso_year(F.col("timestamp_utc")),
            "week_number": dates.iso_week(F.col("timestamp_utc")),
        }
    )


def with_numbers(df: DataFrame) -> DataFrame:
    """Missing or bad engagement counts as 0."""
    return df.withColumns({c: numbers.to_number(F.col(c)) for c in ("score", "num_comments", "upvote_ratio")})


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with their true class."""
    return table(spark, sf_dir, "embeddings").select("vec_id", "embedding", F.col("label").alias("label"))


def given_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster (the given label), probability (cosine to the centroid of the label)."""
    vecs = embeddings(spark, sf_dir)
    centroids = vecs.groupBy("label").agg(vectors.mean_vector("embedding").alias("centroid"))
    return vecs.join(centroids, "label").select(
        "vec_id",
        F.col("label").alias("cluster"),
        F.round(vectors.cosine_similarity(F.col("embedding"), F.col("centroid")), 9).alias("probability"),
    )


def clustered_posts(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Posts with week key, clean numbers and the given cluster and probability."""
    vecs = table(spark, sf_dir, "embeddings")
    base = with_numbers(with_weeks(posts(spark, sf_dir)))
    out = base.withColumn("vec_id", F.col("post_id").cast("bigint") % _size(vecs)).join(
        given_clusters(spark, sf_dir), "vec_id"
    )
    return with_texts(spark, sf_dir, out) if with_text else out


def post_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """post_id, niche, embedding, as the embeddings table stores them."""
    vecs = table(spark, sf_dir, "embeddings")
    events = table(spark, sf_dir, "events")
    return events.select(
        F.col("event_id").cast("string").alias("post_id"),
        F.col("event_type").alias("niche"),
        (F.col("event_id") % _size(vecs)).alias("vec_id"),
    ).join(vecs.select("vec_id", "embedding"), "vec_id").select("post_id", "niche", "embedding")


def noisy_posts(spark: SparkSession, sf_dir: str, with_text: bool = False) -> DataFrame:
    """Clustered posts where a vector far from its centroid counts as noise; with plain engagement."""
    return clustered_posts(spark, sf_dir, with_text).withColumns(
        {
            "cluster": F.when(F.col("probability") < 0.05, F.lit(-1)).otherwise(F.col("cluster")),
            "engagement": numbers.engagement(F.col("score"), F.col("num_comments")),
        }
    )

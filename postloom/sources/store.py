"""Stored tables: reads, insert-ignore, upserts, versioned writes and clean-up.

Parquet has no keys, so the write paths keep the keys themselves. Merges are equi-joins on the key; only
the partitions that change are rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import first_rows, null_safe_join
from ..session import cut, discard

#: Column of the folder a row of a table dealt by key lies in.
BUCKET = "key_bucket"


# Reads -----------------------------------------------------------------------------------------------

def posts_by_niche(posts: DataFrame, niche: str, limit: int | None = None) -> DataFrame:
    """Posts of a niche, newest first. With a limit Spark takes the top rows without a full sort."""
    newest = posts.where(F.col("niche") == niche).orderBy(F.desc("timestamp_utc"), F.asc("post_id"))
    return newest.limit(limit) if limit else newest


def embeddings_by_niche(embeddings: DataFrame, niche: str) -> DataFrame:
    return embeddings.where(F.col("niche") == niche).select("post_id", "embedding")


def assignments_by_niche(assignments: DataFrame, niche: str, version: int | None = None) -> DataFrame:
    """Assignments of a niche; all versions, latest first, when none (or 0) is asked for."""
    rows = assignments.where(F.col("niche") == niche)
    if version:
        return rows.where(F.col("cluster_version") == version)
    return rows.orderBy(F.desc("cluster_version"), F.asc("post_id"))  # a version alone would be one task's to sort


def posts_with_clusters(posts: DataFrame, assignments: DataFrame, clusters: DataFrame, niche: str, version: int = 1) -> DataFrame:
    """Posts of a niche with the cluster they have in a version and the name of it, if it has one."""
    assigned = assignments.where(F.col("cluster_version") == version).select(
        "post_id", F.col("niche").alias("_niche"), "cluster_id"
    )
    named = clusters.where(F.col("cluster_version") == version).select(
        F.col("niche").alias("_niche"), "cluster_id", "cluster_name"
    )
    return (
        posts.where(F.col("niche") == niche)
        .join(assigned, "post_id")
        .join(named, ["_niche", "cluster_id"], "left")
        .drop("_niche")
    )


def clean_text_rows(posts: DataFrame) -> DataFrame:
    """Six columns of the posts whose translated text is neither null nor blank."""
    return posts.where(F.trim("text_translated") != "").select(
        "post_id", "text_translated", "niche", "timestamp_utc", "score", "num_comments"
    )


def table_statistics(posts: DataFrame, embeddings: DataFrame, assignments: DataFrame, clusters: DataFrame) -> DataFrame:
    """Row counts: posts per niche, all embeddings, assignments and clusters per niche and version."""
    shape = ["section", "niche", "cluster_version", "rows"]
    none_text, none_int = F.lit(None).cast("string"), F.lit(None).cast("int")
    n = F.count("*").alias("rows")
    parts = [
        posts.groupBy("niche").agg(n).withColumns({"section": F.lit("posts"), "cluster_version": none_int}),
        embeddings.agg(n).withColumns({"section": F.lit("embeddings"), "niche": none_text, "cluster_version": none_int}),
        assignments.groupBy("niche", "cluster_version").agg(n).withColumn("section", F.lit("cluster_assignments")),
        clusters.groupBy("niche", "cluster_version").agg(n).withColumn("section", F.lit("clusters")),
    ]
    out = parts[0].select(*shape)
    for part in parts[1:]:
        out = out.unionByName(part.select(*shape))
    return out


# Merges ----------------------------------------------------------------------------------------------

def rows_to_insert(stored: DataFrame, incoming: DataFrame, order: Sequence[Column], key: str = "post_id") -> DataFrame:
    """Insert-ignore: the first row of each new key; keys that are stored already are skipped."""
    return first_rows(incoming, [key], order).join(stored.select(key), key, "left_anti")


def upserted(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], replaced: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Stored rows with the `replaced` columns taken from the first incoming row (in `order`) of the same
    key, plus the rows with new keys. Other columns of a stored row stay as they are."""
    keys = list(keys)
    columns = stored.columns
    fresh = first_rows(incoming, keys, order).select(
        *keys, *[F.col(c).alias(f"_new_{c}") for c in columns if c not in keys], F.lit(True).alias("_new")
    )
    both = stored.withColumn("_old", F.lit(True)).join(fresh, keys, "full_outer")

    def pick(c: str) -> Column:
        if c in keys:
            return F.col(c)
        take_new = F.col("_new") if c in replaced else F.col("_old").isNull()
        return F.when(take_new, F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)

    return both.select(*[pick(c) for c in columns])


def without_orphans(children: DataFrame, parents: DataFrame, key: str = "post_id") -> DataFrame:
    """Rows whose parent still exists: what a cascading delete leaves."""
    return children.join(parents.select(key), key, "left_semi")


def orphans(children: DataFrame, parents: DataFrame, key: str = "post_id") -> DataFrame:
    return children.join(parents.select(key), key, "left_anti")


def merged_results(stored: DataFrame, new: DataFrame, keys: Sequence[str] = ("niche", "week_year", "week_number")) -> DataFrame:
    """New results in place of the stored ones with the same key. With keys `("niche",)` a new run
    replaces all weeks of its niches."""
    return stored.join(new.select(*keys).distinct(), list(keys), "left_anti").unionByName(new)


# Writes ----------------------------------------------------------------------------------------------

def append(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace the partitions that occur in `df` and no others, so that a re-run does not duplicate."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def upsert(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], replaced: Sequence[str], order: Sequence[Column], path: str,
    partition_by: Sequence[str],
) -> None:
    """`upserted` into the files that `stored` reads. Partitions without a key of the batch keep their files.

    Of the stored rows only keys and partition columns are read to find the partitions that change; those are rewritten
    whole. New keys go where their partition columns say. The result is made durable first, since a write would
    otherwise delete files that a retried task still has to read.
    """
    fresh = cut(first_rows(incoming, keys, order).select(*stored.columns))
    held = stored.select(*{*keys, *partition_by}).join(fresh.select(*keys), list(keys), "left_semi").select(*partition_by)
    # A new key may land in a partition that is stored already; its rows are then rewritten with it.
    touched = cut(held.unionByName(fresh.select(*partition_by)).distinct())
    old = null_safe_join(stored, touched, list(partition_by), "left_semi")
    overwrite_partitions(cut(upserted(old, fresh, keys, replaced, order)), path, partition_by)


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """Where a row lies in a table dealt by key; a null is a key value like any other."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(BUCKET)


def write_bucketed(df: DataFrame, path: str, keys: Sequence[str], buckets: int) -> None:
    """A table whose folders are ranges of key hashes, for `upsert_bucketed`. `buckets` belongs to the table."""
    dealt = df.withColumn(BUCKET, bucket_of(keys, buckets))
    dealt.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(path)


def upsert_bucketed(
    stored: DataFrame, incoming: DataFrame, keys: Sequence[str], replaced: Sequence[str], order: Sequence[Column], path: str, buckets: int
) -> None:
    """`upserted` into the files of `write_bucketed` that `stored` reads. A batch meets only its own buckets: the others are
    neither read nor written.

    The batch says which buckets change; these are at most `buckets` numbers, which become a filter on folders.
    """
    columns = [c for c in stored.columns if c != BUCKET]
    fresh = cut(first_rows(incoming, keys, order).select(*columns, bucket_of(keys, buckets)))
    touched = [r[BUCKET] for r in fresh.select(BUCKET).distinct().collect()]
    old = stored.where(F.col(BUCKET).isin(touched)).select(*columns)
    # Made durable first, since a write would otherwise delete files that a retried task still has to read.
    new = cut(upserted(old, fresh.select(*columns), keys, replaced, order))
    overwrite_partitions(new.withColumn(BUCKET, bucket_of(keys, buckets)).repartition(BUCKET), path, [BUCKET])
    discard(fresh, new)

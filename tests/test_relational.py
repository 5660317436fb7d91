"""Ranks in large groups, stored tables, files and streams on small input."""

import glob
import json
import os

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from postloom.operators import aggregates as agg, ranking
from postloom.plans import ingest, weekly
from postloom.session import scratch_path
from postloom.sources import files, schemas, store
from postloom.streaming import jobs


def _skewed(spark):
    """One group holds most rows, and a third of all rows share one value."""
    rng = np.random.default_rng(5)
    rows = [("hot", i, 1.0 if i % 3 == 0 else float(np.round(rng.gamma(1.0), 2))) for i in range(3000)]
    rows += [("cold", i, float(i % 7)) for i in range(50)]
    return spark.createDataFrame(rows, "g string, id int, v double")


def _with_nulls(spark):
    return _skewed(spark).selectExpr(
        "if(id % 5 = 0, null, g) AS g", "id", "if(id % 4 = 0, null, v) AS v")


@pytest.mark.parametrize("rows", [_skewed, _with_nulls])
def test_rank_in_slices_equals_window(spark, rows):
    df = rows(spark)
    window = Window.partitionBy("g").orderBy(F.desc_nulls_last("v"))
    plain = df.withColumn("r", F.rank().over(window).cast("bigint"))
    for group_rows in (20, 200_000):
        sliced = ranking.add_min_rank(df, ["g"], "v", "r", group_rows=group_rows)
        assert sliced.count() == 3050 and plain.exceptAll(sliced).isEmpty()
    at = ranking.value_positions(df, ["g"], "v", 20)
    assert at.agg(F.sum("n_equal").alias("n")).first()["n"] == 3050


@pytest.mark.parametrize("rows", [_skewed, _with_nulls])
def test_median_and_codes(spark, rows):
    df = rows(spark)
    got = {r["g"]: r["m"] for r in ranking.group_median(df, ["g"], "v", "m").collect()}
    want = df.toPandas().groupby("g", dropna=False)["v"].median().to_dict()
    assert got == {None if k != k else k: v for k, v in want.items()}
    codes = agg.label_codes(_skewed(spark), "g").orderBy("code").collect()
    assert [tuple(r) for r in codes] == [("cold", 0), ("hot", 1)]


def test_store(spark):
    old = spark.createDataFrame([("1", "a", [1.0]), ("2", "b", [2.0])], schemas.EMBEDDINGS)
    new = spark.createDataFrame([("2", "x", [9.0]), ("3", "x", [3.0]), ("3", "y", [4.0])], schemas.EMBEDDINGS)
    path = scratch_path(spark, "t")
    store.append(old, path, ["niche"])
    stored = spark.read.schema(old.schema).parquet(path)
    store.upsert(stored, new, ["post_id"], ["embedding"], [F.asc("niche")], path, ["niche"])
    got = {r["post_id"]: (r["niche"], r["embedding"]) for r in spark.read.schema(old.schema).parquet(path).collect()}
    assert got == {"1": ("a", [1.0]), "2": ("b", [9.0]), "3": ("x", [3.0])}
    assert [r["post_id"] for r in store.rows_to_insert(old, new, [F.asc("niche")]).collect()] == ["3"]


def test_upsert_reads_its_own_buckets_only(spark):
    path, schema = scratch_path(spark, "dealt"), "post_id string, niche string, embedding array<float>"
    old = [(f"p{i}", "a", [float(i)]) for i in range(40)] + [(None, "a", [1.0])]
    store.write_bucketed(spark.createDataFrame(old, schema), path, ["post_id"], 8)
    batch = spark.createDataFrame([("p3", "b", [0.5]), ("p3", "c", [0.7]), ("new", "b", [9.0])], schema)
    meant = {r[0] for r in batch.select(store.bucket_of(["post_id"], 8)).collect()}
    kept = {}
    for folder in glob.glob(f"{path}/{store.BUCKET}=*"):
        if int(folder.rpartition("=")[2]) not in meant:
            for file in glob.glob(f"{folder}/*.parquet"):  # whoever reads these gets an error
                kept[file] = open(file, "rb").read()
                open(file, "wb").write(b"no parquet")
    assert kept and len(meant) <= 2
    stored = spark.read.schema(f"{schema}, {store.BUCKET} int").parquet(path)
    store.upsert_bucketed(stored, batch, ["post_id"], ["embedding"], [F.asc("niche")], path, 8)
    for file, content in kept.items():
        assert open(file, "rb").read() == b"no parquet"
        open(file, "wb").write(content)
        crc = f"{os.path.dirname(file)}/.{os.path.basename(file)}.crc"
        assert os.path.exists(crc)
    spark.catalog.refreshByPath(path)
    got = {(r.post_id, r.niche, r.embedding[0]) for r in spark.read.schema(schema).parquet(path).collect()}
    want = {(i, n, v[0]) for i, n, v in old if i != "p3"} | {("p3", "a", 0.5), ("new", "b", 9.0)}
    assert got == want


def test_upsert_leaves_other_partitions_alone(spark):
    old = spark.createDataFrame([(str(i), "abcd"[i % 4], [float(i)]) for i in range(40)], schemas.EMBEDDINGS)
    path = scratch_path(spark, "u")
    store.append(old, path, ["niche"])
    stored = spark.read.schema(old.schema).parquet(path)
    before = set(stored.inputFiles())
    new = spark.createDataFrame([("1", "x", [9.0]), ("99", "e", [1.0])], schemas.EMBEDDINGS)
    store.upsert(stored, new, ["post_id"], ["embedding"], [F.asc("niche")], path, ["niche"])
    after = spark.read.schema(old.schema).parquet(path)
    kept = before & set(after.inputFiles())
    assert kept == {f for f in before if "niche=b/" not in f} and after.count() == 41
    assert {r["post_id"]: r["embedding"] for r in after.collect()}["1"] == [9.0]


def _page(*posts):
    return json.dumps({"data": {"after": None, "children": [{"data": p} for p in posts]}})


def _post(i, created, **more):
    return {"id": i, "title": f"t{i}", "subreddit_name_prefixed": "r/science", "score": 3, "num_comments": 1,
            "created_utc": created, "permalink": f"/r/{i}", **more}


def _land(spark, listing, *pages):
    from pathlib import Path

    root = Path(scratch_path(spark, "pages").removeprefix("file:"))
    for name, page in pages:
        (root / f"listing={listing}").mkdir(parents=True, exist_ok=True)
        (root / f"listing={listing}" / f"{name}.json").write_text(page)
    return str(root)


def test_ingest(spark):
    day = 86400.0
    new = _page(_post("a", 40 * day, author="x", url="u"), _post("b", 39 * day), _post("old", 1 * day))
    top = _page(_post("a", 40 * day, author="x"), _post("c", 30 * day))
    pages = spark.createDataFrame([("top/week", top), ("new", new)], "listing string, raw string").select(
        "listing", F.from_json("raw", schemas.LISTING_PAGE).alias("p")).select("listing", "p.*")
    got = ingest.ingest(pages, "1970-02-10 00:00:00", 30).collect()
    assert [(r["post_id"], r["listing"], r["author"], r["url"]) for r in got] == [
        ("a", "new", "x", "u"), ("b", "new", "[deleted]", ""), ("c", "top/week", "[deleted]", "")]
    assert got[0]["permalink"].endswith("/r/a") and got[0]["niche"] == "science" and got[0]["is_video"] is False


def test_streamed_ingest_over_two_runs(spark):
    day = 86400.0
    root = _land(spark, "new", ("1", _page(_post("a", 40 * day), _post("b", 41 * day))))
    out, state = scratch_path(spark, "out"), scratch_path(spark, "state")

    def run():
        posts = jobs.first_seen_posts(jobs.read_pages(spark, root))
        jobs.write_available(posts, out, state).awaitTermination()
        return sorted(r["post_id"] for r in spark.read.parquet(out).collect())

    assert run() == ["a", "b"]
    from pathlib import Path

    Path(root, "listing=new", "2.json").write_text(_page(_post("b", 41 * day), _post("c", 42 * day)))
    assert run() == ["a", "b", "c"]


def test_missing_documents_are_empty(spark):
    assert files.read_result_documents(spark, scratch_path(spark, "none")).isEmpty()


def test_csv_with_quotes_and_lines(spark):
    row = ("1", "a", 'He said "x",\nthen left', "me", 1, 0.5, 2, None, "p", None, "  body ", "full", None)
    path = scratch_path(spark, "csv")
    files.write_csv(spark.createDataFrame([row], schemas.POSTS), path)
    assert tuple(files.read_posts_csv(spark, path).first()) == row


def test_compressed_csv_reads_the_same(spark):
    """Posts that share a text, as they land: the files hold a fraction of what plain ones do."""
    import os

    body = 'He said "x",\nthen left. ' * 200
    rows = [(str(i), "a", body[:40], "me", 1, 0.5, 2, None, "p", None, "  b ", body, None) for i in range(50)]
    df = spark.createDataFrame(rows, schemas.POSTS).coalesce(1)
    sizes = []
    for kind in ("none", "gzip"):
        path = scratch_path(spark, "csv")
        files.write_csv(df, path, kind)
        assert sorted(map(tuple, files.read_posts_csv(spark, path).collect())) == sorted(rows)
        sizes.append(sum(os.path.getsize(f"{path}/{f}") for f in os.listdir(path) if f.startswith("part")))
    assert sizes[1] < 0.1 * sizes[0]


def test_tables_are_created(spark):
    name = "postloom_test"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{scratch_path(spark, 'warehouse')}'")
    schemas.create_tables(spark, name)
    schemas.create_tables(spark, name)
    assert {r["tableName"] for r in spark.sql(f"SHOW TABLES IN {name}").collect()} == set(schemas.TABLES)
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_weekly_plan(spark):
    """Two slices, one too small; blobs become clusters, the report names the best."""
    from helpers import blobs

    x, y = blobs(dim=24, noise=4, copies=0)
    rows = [(str(i), "n", 2024, 1, float(10 * (y[i] + 2)), 1.0, 0.5, "2024-01-02 00:00:00", f"Big Fox story {y[i]}", "cats and dogs") for i in range(len(x))]
    rows += [(f"s{i}", "n", 2024, 2, 1.0, 1.0, 1.0, "2024-01-09 00:00:00", "t", "b") for i in range(5)]
    posts = spark.createDataFrame(
        rows, "post_id string, niche string, week_year int, week_number int, score double, num_comments double, upvote_ratio double, ts string, title string, body string"
    ).withColumn("timestamp_utc", F.col("ts").cast("timestamp_ntz")).withColumn("permalink", F.concat(F.lit("/p/"), "post_id"))
    vecs = spark.createDataFrame([(r[0], [float(v) for v in (x[i] if i < len(x) else x[0])]) for i, r in enumerate(rows)], "post_id string, embedding array<double>")
    clustered = weekly.clustered_posts(posts, vecs).cache()
    assert clustered.select("week_number").distinct().collect()[0][0] == 1
    sizes = {r["cluster"]: r["count"] for r in clustered.groupBy("cluster").count().collect()}
    assert sum(v for k, v in sizes.items() if k >= 0 and v >= 10) >= 100
    contexts = weekly.cluster_contexts(clustered).orderBy("cluster_rank").collect()
    assert 1 <= len(contexts) <= 3 and "Recurring phrases  : big fox" in contexts[0]["context"]
    assert contexts[0]["context"].count("URL: /p/") == 8
    labels = weekly.slice_facts(clustered)
    prompt = weekly.prompts(weekly.cluster_contexts(clustered), labels).first()
    assert f"exactly {len(contexts)} trend(s)" in prompt["prompt"] and "Jan 02 – Jan 02, 2024" in prompt["prompt"]

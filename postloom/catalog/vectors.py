"""Neighbours, reduction, encoders and metrics over the embeddings (survey group J and I8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers, text
from ..operators import aggregates as agg, keywords as kw, metrics, neighbours, reduction
from ..plans import experiments
from ..sources import fixtures as fx
from . import _sql as S
from . import query, sql_of as _sql_of
from ._frames import vector_text


def _points(spark, sf):
    return fx.embeddings(spark, sf).select(
        F.lit(0).alias("all"), F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), F.col("label").alias("cluster")
    )


_UNIT = """unit AS (
  SELECT vec_id, label, [x / sqrt(list_sum([CAST(y AS DOUBLE) * y FOR y IN embedding])) FOR x IN CAST(embedding AS DOUBLE[])] AS v FROM embeddings)"""


@query("d7_nearest_neighbours", S.with_(_UNIT, """pairs AS (
  SELECT a.vec_id AS id, b.vec_id AS neighbour, greatest(1 - list_dot_product(a.v, b.v), 0) AS d, a.vec_id <> b.vec_id AS other FROM unit a, unit b)""") + """
SELECT id, neighbour, CAST(rank AS INTEGER) AS rank, CASE WHEN other THEN round(d + 1e-9, 6) ELSE 0.0 END AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY other, d, neighbour) AS rank FROM pairs) WHERE rank <= 5""")
def nearest_neighbours(spark, sf):
    """The five nearest by cosine distance, the point itself first."""
    found = neighbours.nearest_neighbours(_points(spark, sf), ["all"], "id", "vector", 5, "cosine")
    return found.select("id", "neighbour", "rank", (F.when(F.col("rank") > 1, numbers.rounded(F.col("distance"), 6)).otherwise(0.0)).alias("distance"))


@query("g5_distance_curve", S.with_(_UNIT, """pairs AS (
  SELECT a.vec_id AS id, greatest(1 - list_dot_product(a.v, b.v), 0) AS d, a.vec_id <> b.vec_id AS other FROM unit a, unit b)""") + """
SELECT id, round(d + 1e-9, 6) AS k_distance FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY other, d) AS rank FROM pairs)
WHERE rank = 5 ORDER BY d DESC""")
def distance_curve(spark, sf):
    found = neighbours.nearest_neighbours(_points(spark, sf), ["all"], "id", "vector", 5, "cosine")
    return neighbours.kth_distances(found, ["all"], 5).select("id", numbers.rounded(F.col("k_distance"), 6).alias("k_distance"))


_LABELLED = """comps AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
sizes AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
cents AS (SELECT label, pos, avg(x) AS c FROM comps GROUP BY label, pos)"""

_SILHOUETTE = """sums AS (
  SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS total, count(*) AS n
  FROM embeddings a, embeddings b GROUP BY a.vec_id, a.label, b.label),
ab AS (SELECT vec_id, label, max(CASE WHEN label = other THEN total / (n - 1) END) AS a, min(CASE WHEN label <> other THEN total / n END) AS b FROM sums GROUP BY vec_id, label),
sil AS (SELECT vec_id, label, (b - a) / greatest(a, b) AS s FROM ab)"""

_CH = """mid AS (SELECT pos, avg(x) AS m FROM comps GROUP BY pos),
ch AS (SELECT (SELECT sum(n * (c - m) * (c - m)) FROM cents JOIN mid USING (pos) JOIN sizes USING (label)) / (count(*) - 1)
  / ((SELECT sum((x - c) * (x - c)) FROM comps JOIN cents USING (label, pos)) / (sum(n) - count(*))) AS v FROM sizes)"""

_DB = """spread AS (SELECT label, avg(d) AS s FROM (SELECT vec_id, label, sqrt(sum((x - c) * (x - c))) AS d FROM comps JOIN cents USING (label, pos) GROUP BY vec_id, label) GROUP BY label),
apart AS (SELECT a.label AS i, b.label AS j, sqrt(sum((a.c - b.c) * (a.c - b.c))) AS m FROM cents a JOIN cents b USING (pos) WHERE a.label <> b.label GROUP BY a.label, b.label),
db AS (SELECT avg(w) AS v FROM (SELECT i, max((si.s + sj.s) / m) AS w FROM apart JOIN spread si ON si.label = i JOIN spread sj ON sj.label = j GROUP BY i))"""


@query("j10_silhouette_samples", S.with_(_LABELLED, _SILHOUETTE) + "SELECT vec_id AS id, label AS cluster, round(s + 1e-9, 6) AS silhouette FROM sil")
def silhouette_samples(spark, sf):
    samples = metrics.silhouette_samples(_points(spark, sf), [], "id", "vector")
    return samples.withColumn("silhouette", numbers.rounded(F.col("silhouette"), 6))


@query("j10_cosine_silhouette", S.with_(_UNIT, _SILHOUETTE.replace(
    "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))", "CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE greatest(1 - list_dot_product(a.v, b.v), 0) END"
).replace("FROM embeddings a, embeddings b", "FROM unit a, unit b")) + "SELECT round(avg(s) + 1e-9, 6) AS silhouette FROM sil")
def cosine_silhouette(spark, sf):
    value = metrics.silhouette(_points(spark, sf), [], "id", "vector", metric="cosine")
    return value.select(numbers.rounded(F.col("silhouette"), 6).alias("silhouette"))


@query("j10_cosine_silhouette_samples", S.with_(_UNIT, _SILHOUETTE.replace(
    "list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))", "CASE WHEN a.vec_id = b.vec_id THEN 0 ELSE greatest(1 - list_dot_product(a.v, b.v), 0) END"
).replace("FROM embeddings a, embeddings b", "FROM unit a, unit b")) + "SELECT vec_id AS id, label AS cluster, round(s + 1e-9, 6) AS silhouette FROM sil")
def cosine_silhouette_samples(spark, sf):
    samples = metrics.silhouette_samples(_points(spark, sf), [], "id", "vector", metric="cosine")
    return samples.withColumn("silhouette", numbers.rounded(F.col("silhouette"), 6))


_DRAWN = """drawn AS (
  SELECT vec_id, label, embedding FROM (SELECT *, row_number() OVER (ORDER BY md5(vec_id || ':42'), vec_id) AS r FROM embeddings) WHERE r <= 300)"""


@query("j10_sampled_silhouette", S.with_(_DRAWN, _SILHOUETTE.replace("FROM embeddings a, embeddings b", "FROM drawn a, drawn b")) + """
SELECT vec_id AS id, label AS cluster, round(s + 1e-9, 6) AS silhouette FROM sil""")
def sampled_silhouette(spark, sf):
    """Silhouettes within a seeded sample of the vectors."""
    samples = metrics.silhouette_samples(_points(spark, sf), [], "id", "vector", sample=300)
    return samples.withColumn("silhouette", numbers.rounded(F.col("silhouette"), 6))


#: A block of this size makes many blocks of the test vectors: the same answers by way of pairs of blocks.
_SMALL_BLOCK = 64


def _many_blocks(name: str, of: str):
    """Register a query with the SQL of another one."""
    return query(name, _sql_of(of))


@_many_blocks("d7_nearest_neighbours_many_blocks", "d7_nearest_neighbours")
def nearest_neighbours_many_blocks(spark, sf):
    found = neighbours.nearest_neighbours(_points(spark, sf), ["all"], "id", "vector", 5, "cosine", block_rows=_SMALL_BLOCK)
    return found.select("id", "neighbour", "rank", (F.when(F.col("rank") > 1, numbers.rounded(F.col("distance"), 6)).otherwise(0.0)).alias("distance"))


@_many_blocks("g5_distance_curve_many_blocks", "g5_distance_curve")
def distance_curve_many_blocks(spark, sf):
    found = neighbours.nearest_neighbours(_points(spark, sf), ["all"], "id", "vector", 5, "cosine", block_rows=_SMALL_BLOCK)
    return neighbours.kth_distances(found, ["all"], 5).select("id", numbers.rounded(F.col("k_distance"), 6).alias("k_distance"))


@_many_blocks("j10_silhouette_samples_many_blocks", "j10_silhouette_samples")
def silhouette_samples_many_blocks(spark, sf):
    samples = metrics.silhouette_samples(_points(spark, sf), [], "id", "vector", block_rows=_SMALL_BLOCK)
    return samples.withColumn("silhouette", numbers.rounded(F.col("silhouette"), 6))


@query("j11_calinski_harabasz", S.with_(_LABELLED, _CH) + "SELECT round(v + 1e-9, 6) AS calinski_harabasz FROM ch")
def calinski_harabasz(spark, sf):
    value = metrics.calinski_harabasz(_points(spark, sf), [], "id", "vector")
    return value.select(numbers.rounded(F.col("calinski_harabasz"), 6).alias("calinski_harabasz"))


@query("j12_davies_bouldin", S.with_(_LABELLED, _DB) + "SELECT round(v + 1e-9, 6) AS davies_bouldin FROM db")
def davies_bouldin(spark, sf):
    value = metrics.davies_bouldin(_points(spark, sf), [], "id", "vector")
    return value.select(numbers.rounded(F.col("davies_bouldin"), 6).alias("davies_bouldin"))


_CELLS = """cells AS (SELECT niche, week_number, cluster, CAST(count(*) AS DOUBLE) AS n FROM noisy WHERE cluster <> -1 GROUP BY ALL),
r AS (SELECT week_number, niche, sum(n) AS s FROM cells GROUP BY ALL), c AS (SELECT week_number, cluster, sum(n) AS s FROM cells GROUP BY ALL),
t AS (SELECT week_number, sum(n) AS n, sum(n * n) AS nn FROM cells GROUP BY week_number)"""


@query("j13_adjusted_rand", S.with_(S.NOISY, _CELLS, """p AS (
  SELECT week_number, nn - n AS tp, (SELECT sum(s * s) FROM c WHERE c.week_number = t.week_number) - nn AS fp,
    (SELECT sum(s * s) FROM r WHERE r.week_number = t.week_number) - nn AS fn, n FROM t),
q AS (SELECT *, n * n - tp - fp - fn - n AS tn FROM p)""") + """
SELECT week_number, round(2 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) + 1e-9, 6) AS ari FROM q""")
def adjusted_rand(spark, sf):
    value = metrics.adjusted_rand(fx.noisy_posts(spark, sf), ["week_number"], "niche")
    return value.withColumn("ari", numbers.rounded(F.col("ari"), 6))


@query("j14_mutual_information", S.with_(S.NOISY, _CELLS, """mi AS (
  SELECT cells.week_number, sum(cells.n / t.n * ln(cells.n * t.n / (r.s * c.s))) AS v FROM cells JOIN t USING (week_number)
  JOIN r ON r.week_number = cells.week_number AND r.niche = cells.niche JOIN c ON c.week_number = cells.week_number AND c.cluster = cells.cluster GROUP BY cells.week_number),
h1 AS (SELECT week_number, -sum(s / n * ln(s / n)) AS h FROM r JOIN t USING (week_number) GROUP BY week_number),
h2 AS (SELECT week_number, -sum(s / n * ln(s / n)) AS h FROM c JOIN t USING (week_number) GROUP BY week_number)""") + """
SELECT week_number, round(greatest(v, 0) / ((h1.h + h2.h) / 2) + 1e-9, 6) AS nmi FROM mi JOIN h1 USING (week_number) JOIN h2 USING (week_number)""")
def mutual_information(spark, sf):
    value = metrics.normalised_mutual_information(fx.noisy_posts(spark, sf), ["week_number"], "niche")
    return value.withColumn("nmi", numbers.rounded(F.col("nmi"), 6))


# Labels against the remainder of the id: pair counts and mutual information of the cross table.
_TRUTH = """cells AS (SELECT vec_id % 4 AS t, label AS c, CAST(count(*) AS DOUBLE) AS n FROM embeddings GROUP BY ALL),
rows_ AS (SELECT t, sum(n) AS s FROM cells GROUP BY t), cols AS (SELECT c, sum(n) AS s FROM cells GROUP BY c), all_ AS (SELECT sum(n) AS n FROM cells),
pairs AS (SELECT (SELECT sum(n * n) FROM cells) AS nn, (SELECT sum(s * s) FROM rows_) AS rr, (SELECT sum(s * s) FROM cols) AS cc, n FROM all_),
ari AS (SELECT 2 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn)) AS ari
  FROM (SELECT nn - n AS tp, cc - nn AS fp, rr - nn AS fn, n * n - (nn - n) - (cc - nn) - (rr - nn) - n AS tn FROM pairs)),
nmi AS (SELECT greatest((SELECT sum(cells.n / all_.n * ln(cells.n * all_.n / (rows_.s * cols.s))) FROM cells JOIN rows_ USING (t) JOIN cols USING (c), all_), 0)
  / (((SELECT -sum(s / n * ln(s / n)) FROM rows_, all_) + (SELECT -sum(s / n * ln(s / n)) FROM cols, all_)) / 2) AS nmi)"""


@query("j15_metric_row", S.with_(_LABELLED, _SILHOUETTE, _CH, _DB, _TRUTH) + """
SELECT (SELECT count(*) FROM sizes) AS n_clusters, CAST(0 AS BIGINT) AS noise, 0.0::DOUBLE AS noise_pct, 100.0::DOUBLE AS coverage,
  (SELECT round(avg(s) + 1e-9, 4) FROM sil) AS silhouette, (SELECT round(v + 1e-9, 2) FROM ch) AS calinski_harabasz,
  (SELECT round(v + 1e-9, 4) FROM db) AS davies_bouldin, (SELECT round(ari + 1e-9, 4) FROM ari) AS ari, (SELECT round(nmi + 1e-9, 4) FROM nmi) AS nmi""")
def metric_row(spark, sf):
    """All metrics of the given labels in one row, with the remainder of the id as truth."""
    rows = _points(spark, sf).withColumn("truth", (F.col("id") % 4).cast("int"))
    return metrics.evaluate(rows, [], "id", "vector", "truth")


@query("c8_metric_gate", S.with_(S.NOISY) + """
SELECT niche, week_number, count(DISTINCT cluster) FILTER (cluster <> -1) AS n_clusters FROM noisy GROUP BY niche, week_number
HAVING count(DISTINCT cluster) FILTER (cluster <> -1) >= 2""")
def metric_gate(spark, sf):
    rows = agg.noise_summary(fx.noisy_posts(spark, sf), "niche", "week_number")
    return rows.where("n_clusters >= 2").select("niche", "week_number", "n_clusters")


@query("j18_composite_score", S.with_(S.CLUSTERED, "gated AS (SELECT * FROM clustered)", S.STATS, """m AS (
  SELECT niche, week_number, cluster, importance_score AS silhouette, avg_score AS calinski_harabasz, avg_comments AS davies_bouldin FROM stats),
b AS (SELECT min(silhouette) AS s0, max(silhouette) AS s1, min(calinski_harabasz) AS c0, max(calinski_harabasz) AS c1, min(davies_bouldin) AS d0, max(davies_bouldin) AS d1 FROM m)""") + """
SELECT niche, week_number, cluster, round(0.4 * (silhouette - s0) / (s1 - s0) + 0.3 * (1 - (davies_bouldin - d0) / (d1 - d0)) + 0.3 * (calinski_harabasz - c0) / (c1 - c0) + 1e-9, 6) AS composite FROM m, b""")
def composite_score(spark, sf):
    """The weighting, over a table of numbers that both engines agree on."""
    stats = agg.cluster_stats(fx.clustered_posts(spark, sf)).select(
        "niche", "week_number", "cluster", F.col("importance_score").alias("silhouette"),
        F.col("avg_score").alias("calinski_harabasz"), F.col("avg_comments").alias("davies_bouldin"))
    scored = experiments.with_composite(stats)
    return scored.select("niche", "week_number", "cluster", numbers.rounded(F.col("composite"), 6).alias("composite"))


@query("j21_labelled_vectors", S.with_(S.POSTS) + """
SELECT p.post_id, CAST(dense_rank() OVER (ORDER BY p.niche) - 1 AS INTEGER) AS truth, {v} AS embedding FROM posts p
JOIN embeddings v ON v.vec_id = CAST(p.post_id AS BIGINT) % (SELECT count(*) FROM embeddings)""".format(v=S.vector_text("v.embedding")))
def labelled_vectors(spark, sf):
    """All posts with their vector and the code of their niche."""
    joined = fx.posts(spark, sf, with_ratio=False).join(fx.post_embeddings(spark, sf).drop("niche"), "post_id")
    codes = agg.label_codes(fx.posts(spark, sf, with_ratio=False), "niche", "truth")
    return joined.join(codes, "niche").select("post_id", "truth", vector_text("embedding"))


# Reduction and encoders: no SQL twin, checked by invariants and against NumPy in the tests ------------

def _coordinates(rows):
    return rows.select("id", F.transform("vector", lambda x: F.round(x, 6)).alias("vector"))


@query("j2_reduced_slices")
def reduced_slices(spark, sf):
    """Ten components of the vectors of each class."""
    points = _points(spark, sf)
    return reduction.reduce_slices(points, ["cluster"], "id", "vector", 10).select("cluster", "id", "vector")


@query("j9_principal_components")
def principal_components(spark, sf):
    return _coordinates(reduction.pca(_points(spark, sf), "id", "vector", 50).rows)


@query("j9_plane_coordinates")
def plane_coordinates(spark, sf):
    return _coordinates(reduction.pca(_points(spark, sf), "id", "vector", 2).rows)


@query("j9_kept_distances", """
WITH comps AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
mid AS (SELECT pos, avg(x) AS m FROM comps GROUP BY pos)
SELECT vec_id AS id, round(sum((x - m) * (x - m)) + 1e-9, 6) AS squared FROM comps JOIN mid USING (pos) GROUP BY vec_id""")
def kept_distances(spark, sf):
    """With all components the coordinates keep every squared distance from the mean."""
    rows = reduction.pca(_points(spark, sf), "id", "vector", 64).rows
    squared = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    return rows.select("id", numbers.rounded(squared, 6).alias("squared"))


@query("i8_truncated_svd")
def truncated_svd(spark, sf):
    """TF-IDF of all documents in 100 dimensions, brought to unit length."""
    from ..functions import vectors
    from ..session import cut

    weights = cut(kw.tfidf(fx.documents(spark, sf).select("doc_id", "text"), "doc_id", "text"))
    rows = reduction.truncated_svd(weights, "doc_id", 100).rows
    return rows.select("id", vectors.l2_normalised(F.col("vector")).alias("vector"))


@query("j1_text_vectors")
def text_vectors(spark, sf):
    """Default vectors of all documents."""
    docs = fx.documents(spark, sf).withColumn(
        "body", text.best_text(F.when(F.col("lang") == "en", F.col("text")), F.col("text")))
    return reduction.hashed_vectors(docs, "doc_id", "body", 384, keep=["source"])


def _letter_model():
    """A stand-in for a real model: the share of each letter."""
    import numpy as np

    def encode(texts):
        counts = np.array([[t.count(chr(97 + i)) for i in range(26)] for t in texts], dtype=float)
        return counts / np.maximum(counts.sum(1, keepdims=True), 1.0)

    return encode


_LETTERS = "abcdefghijklmnopqrstuvwxyz"


@query("j1_model_vectors", "SELECT doc_id, " + ", ".join(
    f"round(CAST(CAST((length(body) - length(replace(body, '{c}', ''))) / greatest(letters, 1.0) AS FLOAT) AS DOUBLE) + 1e-9, 4) AS share_{c}" for c in _LETTERS
) + " FROM (SELECT doc_id, coalesce(text, '') AS body, len(regexp_extract_all(coalesce(text, ''), '[a-z]')) + 0.0::DOUBLE AS letters FROM documents)")
def model_vectors(spark, sf):
    """Vectors by a plugged-in model, loaded once per worker."""
    rows = reduction.encode_with(fx.documents(spark, sf), "doc_id", "text", _letter_model)
    return rows.select("doc_id", *[
        F.round(F.col("embedding")[ord(c) - 97].cast("double") + 1e-9, 4).alias(f"share_{c}") for c in _LETTERS])

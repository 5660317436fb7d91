"""Clustering methods, sweeps and comparisons (survey group J). Methods have no SQL twin: the tests check
them against plain NumPy on small input."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import BLOCK_ROWS
from ..functions import numbers, vectors
from ..operators import approximate, blocks, centroid_models, dbscan, hdbscan
from ..operators.agglomerative import agglomerative, merge_table
from ..plans import experiments, weekly
from ..sources import fixtures as fx
from . import _sql as S
from . import query, sql_of
from .vectors import _UNIT, _points


# Cosine distances of the test vectors are large, so the radius is wider than the default 0.25.
_EPS = 0.7


@query("j7_dbscan", "WITH RECURSIVE " + _UNIT + f""",
near AS (SELECT a.vec_id AS id, b.vec_id AS other FROM unit a, unit b WHERE a.vec_id = b.vec_id OR 1 - list_dot_product(a.v, b.v) <= {_EPS}),
core AS (SELECT id FROM near GROUP BY id HAVING count(*) >= 5),
links AS (SELECT id, other FROM near WHERE id IN (SELECT id FROM core) AND other IN (SELECT id FROM core)),
reach AS (SELECT id AS root, id FROM core UNION SELECT r.root, l.other FROM reach r JOIN links l ON l.id = r.id WHERE r.root < l.other),
roots AS (SELECT id, min(root) AS root FROM reach GROUP BY id),
numbered AS (SELECT root, CAST(dense_rank() OVER (ORDER BY root) - 1 AS INTEGER) AS cluster FROM (SELECT DISTINCT root FROM roots)),
border AS (SELECT n.id, min(n.other) AS via FROM near n WHERE n.id NOT IN (SELECT id FROM core) AND n.other IN (SELECT id FROM core) GROUP BY n.id),
labelled AS (SELECT id, root, true AS is_core FROM roots UNION ALL SELECT b.id, r.root, false FROM border b JOIN roots r ON r.id = b.via)
SELECT e.vec_id AS id, coalesce(n.cluster, -1) AS cluster, coalesce(l.is_core, false) AS is_core
FROM embeddings e LEFT JOIN labelled l ON l.id = e.vec_id LEFT JOIN numbered n USING (root)""")
def dbscan_clusters(spark, sf):
    """Cosine DBSCAN of all vectors."""
    return dbscan.dbscan(_points(spark, sf), ["all"], "id", "vector", _EPS, 5, "cosine").drop("all")


@query("d8_points_within_radius", S.with_(_UNIT) + f"""
SELECT a.vec_id AS id, count(*) AS near FROM unit a, unit b WHERE a.vec_id = b.vec_id OR 1 - list_dot_product(a.v, b.v) <= {_EPS} GROUP BY a.vec_id""")
def points_within_radius(spark, sf):
    """How many points lie within the radius of each point, itself counted."""
    return dbscan.near_counts(_points(spark, sf), ["all"], "id", "vector", _EPS, "cosine").drop("all")


@query("j7_dbscan_many_blocks", sql_of("j7_dbscan"))
def dbscan_many_blocks(spark, sf):
    """The same by way of pairs of blocks."""
    return dbscan.dbscan(_points(spark, sf), ["all"], "id", "vector", _EPS, 5, "cosine", block_rows=64).drop("all")


@query("d8_points_within_radius_many_blocks", sql_of("d8_points_within_radius"))
def points_within_radius_many_blocks(spark, sf):
    return dbscan.near_counts(_points(spark, sf), ["all"], "id", "vector", _EPS, "cosine", block_rows=64).drop("all")


@query("j3_hdbscan_slices")
def hdbscan_slices(spark, sf):
    """Clusters of all niches and weeks by density, in one plan."""
    posts = fx.with_weeks(fx.posts(spark, sf, with_ratio=False))
    rows = weekly.clustered_posts(posts, fx.post_embeddings(spark, sf))
    return rows.select(*weekly.CLUSTER, "post_id", "probability")


@query("j3_hdbscan_leaf")
def hdbscan_leaf(spark, sf):
    """All vectors as one slice, smallest clusters of the tree."""
    return hdbscan.hdbscan(_points(spark, sf), ["all"], "id", "vector", 5, 3, "leaf").drop("all")


@query("d8_points_within_radius_approximate")
def points_within_radius_approximate(spark, sf):
    """The same by way of buckets of random projections; tests measure the recall."""
    return approximate.approximate_near_counts(_points(spark, sf), ["all"], "id", "vector", _EPS, "cosine").drop("all")


@query("j7_dbscan_approximate")
def dbscan_approximate(spark, sf):
    return approximate.approximate_dbscan(_points(spark, sf), ["all"], "id", "vector", _EPS, 5, "cosine").drop("all")


# Density clusters of each class: the twin closes the minimax distances of a class over its points one by one and reads
# components, clusters and their stability off them.
_MIN_SIZE = 4

_MEET = """
v AS MATERIALIZED (SELECT vec_id AS id, label AS class, CAST(embedding AS DOUBLE[]) AS x, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS k FROM embeddings),
d AS MATERIALIZED (SELECT a.class, a.k AS p, b.k AS q, list_distance(a.x, b.x) AS d FROM v a JOIN v b ON a.class = b.class),
core AS MATERIALIZED (SELECT class, p, max(d) AS core FROM (SELECT *, row_number() OVER (PARTITION BY class, p ORDER BY p = q DESC, d) AS r FROM d) WHERE r <= 4 GROUP BY class, p),
reach AS MATERIALIZED (SELECT d.class, d.p, d.q, CASE WHEN d.p = d.q THEN a.core ELSE greatest(d.d, a.core, b.core) END AS w
  FROM d JOIN core a ON a.class = d.class AND a.p = d.p JOIN core b ON b.class = d.class AND b.p = d.q),
steps AS (SELECT 0 AS k, class, p, q, w FROM reach
  UNION ALL
  SELECT s.k + 1, s.class, s.p, s.q, CASE WHEN s.p = s.q THEN s.w ELSE least(s.w, greatest(a.w, b.w)) END
  FROM steps s JOIN steps a ON a.class = s.class AND a.p = s.p AND a.q = s.k + 1 JOIN steps b ON b.class = s.class AND b.p = s.k + 1 AND b.q = s.q),
meet AS MATERIALIZED (SELECT class, p, q, round(w, 12) AS w FROM steps s WHERE k = (SELECT max(k) FROM v WHERE v.class = s.class))"""

_TREE = _MEET + f""",
enter AS MATERIALIZED (SELECT class, p, min(w) FILTER (r >= {_MIN_SIZE}) AS w FROM (SELECT class, p, w, row_number() OVER (PARTITION BY class, p ORDER BY w) AS r FROM meet) GROUP BY class, p),
level AS (SELECT DISTINCT class, w FROM enter WHERE w IS NOT NULL UNION SELECT DISTINCT class, w FROM meet WHERE p <> q),
comp AS MATERIALIZED (SELECT l.class, l.w, m.p, min(m.q) AS root FROM level l JOIN meet m ON m.class = l.class AND m.w <= l.w GROUP BY l.class, l.w, m.p HAVING count(*) >= {_MIN_SIZE}),
part AS (SELECT c.class, c.w, c.root, c.p, (SELECT min(m.q) FROM meet m WHERE m.class = c.class AND m.p = c.p AND m.w < c.w) AS before,
  (SELECT count(*) FROM meet m WHERE m.class = c.class AND m.p = c.p AND m.w < c.w) >= {_MIN_SIZE} AS large FROM comp c),
opened AS MATERIALIZED (SELECT class, w, root, count(DISTINCT before) FILTER (large) = 0 AS leaf FROM part GROUP BY class, w, root HAVING count(DISTINCT before) FILTER (large) <> 1),
node AS MATERIALIZED (SELECT o.*, (SELECT min(n.w) FROM opened n JOIN meet m ON m.class = n.class AND m.p = n.root AND m.q = o.root AND m.w <= n.w WHERE n.class = o.class AND n.w > o.w) AS next_w,
  row_number() OVER (PARTITION BY class ORDER BY w, root) AS n FROM opened o),
inside AS MATERIALIZED (SELECT n.class, n.n, m.q AS p FROM node n JOIN meet m ON m.class = n.class AND m.p = n.root AND m.w < coalesce(n.next_w, 'inf')),
own AS (SELECT n.class, n.n, any_value(n.leaf) AS leaf, any_value(n.w) AS w, any_value(n.next_w) AS next_w,
  sum(1 / greatest(e.w, n.w)) - count(*) * coalesce(1 / any_value(n.next_w), 0) AS own
  FROM node n JOIN inside i ON i.class = n.class AND i.n = n.n JOIN enter e ON e.class = n.class AND e.p = i.p GROUP BY n.class, n.n),
parent AS (SELECT o.*, (SELECT min(u.n) FROM node u JOIN inside i ON i.class = u.class AND i.n = u.n JOIN node c ON c.class = o.class AND c.n = o.n
  WHERE u.class = o.class AND u.w = o.next_w AND i.p = c.root) AS up FROM own o),
listed AS (SELECT class, list({{'own': own, 'leaf': leaf, 'up': coalesce(up, 0)}} ORDER BY n) AS nodes FROM parent GROUP BY class),
fold AS (SELECT class, 0 AS n, nodes, list_transform(nodes, lambda x: 0.0::DOUBLE) AS below, []::BOOLEAN[] AS wins FROM listed
  UNION ALL
  SELECT class, n + 1, nodes,
    list_transform(below, lambda b, i: CASE WHEN i = nodes[n + 1].up THEN b + CASE WHEN nodes[n + 1].leaf OR nodes[n + 1].own >= below[n + 1] - 1e-12 THEN nodes[n + 1].own ELSE below[n + 1] END ELSE b END),
    list_append(wins, nodes[n + 1].up > 0 AND (nodes[n + 1].leaf OR nodes[n + 1].own >= below[n + 1] - 1e-12)) FROM fold WHERE n < len(nodes)),
best AS (SELECT class, unnest(wins) AS wins, generate_subscripts(wins, 1) AS n FROM fold WHERE n = len(nodes)),
"""


def _density_sql(chosen: str, result: str) -> str:
    return "WITH RECURSIVE " + _TREE + f"""won AS (SELECT i.class, i.p, n.n, n.w FROM inside i JOIN node n ON n.class = i.class AND n.n = i.n JOIN best b ON b.class = i.class AND b.n = i.n WHERE {chosen}),
mine AS (SELECT class, p, arg_max(n, w) AS n, max(w) AS w FROM won GROUP BY class, p),
first AS (SELECT class, n, min(p) AS p FROM mine GROUP BY class, n),
number AS (SELECT class, n, row_number() OVER (PARTITION BY class ORDER BY p) - 1 AS cluster FROM first)""" + result


_LABELS = """
SELECT v.class, v.id, coalesce(c.cluster, -1)::INTEGER AS cluster, round(coalesce(least(1 / e.w, 1 / m.w) * m.w, 0) + 1e-9, 6) AS probability
FROM v LEFT JOIN mine m ON m.class = v.class AND m.p = v.k LEFT JOIN number c ON c.class = m.class AND c.n = m.n LEFT JOIN enter e ON e.class = v.class AND e.p = v.k"""

_SHARES = """,
exemplar AS (SELECT m.class, c.cluster, e.p FROM node n JOIN meet t ON t.class = n.class AND t.p = n.root AND t.w <= n.w
  JOIN enter e ON e.class = n.class AND e.p = t.q AND e.w = n.w JOIN mine m ON m.class = e.class AND m.p = e.p
  JOIN number c ON c.class = m.class AND c.n = m.n WHERE n.leaf),
nearest AS (SELECT d.class, d.p, x.cluster, greatest(min(CASE WHEN d.p = d.q THEN 0 ELSE d.d END), 1e-12) AS d
  FROM d JOIN exemplar x ON x.class = d.class AND x.p = d.q GROUP BY d.class, d.p, x.cluster)
SELECT v.class, v.id, n.cluster::INTEGER AS cluster, round(1 / n.d / sum(1 / n.d) OVER (PARTITION BY n.class, n.p) + 1e-9, 6) AS share
FROM nearest n JOIN v ON v.class = n.class AND v.k = n.p"""


@query("j3_spanning_tree_weight", "WITH RECURSIVE " + _MEET + """
SELECT class, count(*) AS edges, round(sum(w) + 1e-9, 6) AS weight
FROM (SELECT class, p, min(w) AS w FROM meet WHERE q < p GROUP BY class, p) GROUP BY class""")
def spanning_tree_weight(spark, sf):
    """Edges and weight of the spanning tree of each class under mutual reachability."""
    return _tree_weights(spark, sf, BLOCK_ROWS)


@query("j3_spanning_tree_weight_many_blocks", sql_of("j3_spanning_tree_weight"))
def spanning_tree_weight_many_blocks(spark, sf):
    return _tree_weights(spark, sf, 16)


def _classes(spark, sf):
    return _points(spark, sf).withColumnRenamed("cluster", "class")


def _tree_weights(spark, sf, block_rows):
    graph = hdbscan.density_graph(_classes(spark, sf), ["class"], "id", "vector", 3, block_rows=block_rows)
    return graph.forest.groupBy("class").agg(F.count("*").alias("edges"), numbers.rounded(F.sum("weight"), 6).alias("weight"))


def _density(spark, sf, selection, block_rows=BLOCK_ROWS):
    found = hdbscan.hdbscan(_classes(spark, sf), ["class"], "id", "vector", _MIN_SIZE, 3, selection, block_rows=block_rows)
    return found.select("class", "id", "cluster", numbers.rounded(F.col("probability"), 6).alias("probability"))


@query("j3_hdbscan_per_class", _density_sql("b.wins", _LABELS))
def hdbscan_per_class(spark, sf):
    """Clusters of each class by excess of mass."""
    return _density(spark, sf, "eom")


@query("j3_hdbscan_per_class_many_blocks", sql_of("j3_hdbscan_per_class"))
def hdbscan_per_class_many_blocks(spark, sf):
    return _density(spark, sf, "eom", 16)


@query("j3_hdbscan_leaves_per_class", _density_sql("n.leaf AND n.next_w IS NOT NULL", _LABELS))
def hdbscan_leaves_per_class(spark, sf):
    return _density(spark, sf, "leaf")


@query("j4_kmeans")
def kmeans(spark, sf):
    labels, inertia = centroid_models.kmeans(_points(spark, sf), "id", "vector", 6)
    return labels.groupBy("cluster").agg(F.count("*").alias("points")).withColumn("inertia", F.round(F.lit(inertia), 4))


@query("j20_soft_membership", _density_sql("b.wins", _SHARES))
def soft_membership(spark, sf):
    """Share of each cluster of a class in each of its vectors, by the nearest exemplars."""
    graph = hdbscan.density_graph(_classes(spark, sf), ["class"], "id", "vector", 3)
    return hdbscan.soft_membership(graph, _MIN_SIZE).withColumn("share", numbers.rounded(F.col("share"), 6))


_TOTAL = """comps AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
mids AS (SELECT pos, avg(x) AS m FROM comps GROUP BY pos),
total AS (SELECT sum((x - m) * (x - m)) AS squares, (SELECT count(*) FROM embeddings) AS points FROM comps JOIN mids USING (pos))"""


@query("j4_kmeans_variance", S.with_(_TOTAL) + "SELECT 6 AS clusters, points, round(squares + 1e-9, 4) AS squares, true AS settled FROM total")
def kmeans_variance(spark, sf):
    """The inertia and the squares between the centroids add up to the squares of all vectors around their mean, and
    every vector is nearest to the centroid of its own cluster: both hold only for a settled clustering and its inertia."""
    points = _points(spark, sf)
    labels, inertia = centroid_models.kmeans(points, "id", "vector", 6)
    rows = labels.join(points.select("id", vectors.as_double(F.col("vector")).alias("vector")), "id")
    centres = rows.groupBy("cluster").agg(F.count("*").alias("n"), vectors.mean_vector("vector").alias("centre"))
    middle = rows.agg(vectors.mean_vector("vector").alias("middle"))
    between = centres.crossJoin(middle).agg(
        F.count("*").alias("clusters"), F.sum("n").alias("points"), F.sum(F.col("n") * vectors.squared_distance(F.col("centre"), F.col("middle"))).alias("between"))
    own = rows.join(centres, "cluster").select("id", "vector", vectors.squared_distance(F.col("vector"), F.col("centre")).alias("own"))
    every = centres.agg(F.collect_list("centre").alias("centres"))  # one for each cluster asked for
    settled = own.crossJoin(every).agg(F.min(F.forall("centres", lambda c: vectors.squared_distance(F.col("vector"), c) >= F.col("own") - 1e-6)).alias("settled"))
    return between.crossJoin(settled).select(
        F.col("clusters").cast("int").alias("clusters"), "points", numbers.rounded(F.col("between") + F.lit(inertia), 4).alias("squares"), "settled")


@query("j16_sweep_variance", S.with_(_TOTAL) + """
SELECT k::INTEGER AS k, round(squares + 1e-9, 4) AS squares FROM total, range(2, 9) t(k)""")
def sweep_variance(spark, sf):
    """The same sum for every k of a sweep: its inertia and what Calinski-Harabasz says of the squares between its clusters. That
    measure is rounded, so a sum within a ten thousandth of the squares of all vectors counts as these, and others show as they are."""
    points = _points(spark, sf)
    swept = centroid_models.k_sweep(points, "id", "vector", range(2, 9), starts=3)
    rows = points.select(vectors.as_double(F.col("vector")).alias("vector"))
    middle = rows.agg(F.count("*").alias("n"), vectors.mean_vector("vector").alias("middle"))
    total = rows.crossJoin(middle).agg(F.first("n").alias("n"), F.sum(vectors.squared_distance(F.col("vector"), F.col("middle"))).alias("total"))
    ratio = F.col("calinski_harabasz") * (F.col("k") - 1) / (F.col("n") - F.col("k"))
    added = F.col("inertia") * (1 + ratio)
    squares = F.when(F.abs(added - F.col("total")) < 1e-4 * F.col("total"), F.col("total")).otherwise(added)
    return swept.crossJoin(total).select("k", numbers.rounded(squares, 4).alias("squares"))


@query("j5_mixture_moments", S.with_(_TOTAL) + """
SELECT 4 AS components, round(1 + 1e-9, 6) AS weights, round((SELECT sum(m * m) FROM mids) + squares / points + 1e-9, 6) AS mean_square,
  round((SELECT sum(m) FROM mids) + 1e-9, 6) AS mean_sum FROM total""")
def mixture_moments(spark, sf):
    """After a step of maximisation the weighted moments of the components are those of all vectors."""
    rows = centroid_models.table_of(_points(spark, sf), "id", "vector")
    fit = max(centroid_models.fit_mixtures(rows, 4, [42, 43], max_iter=20), key=lambda m: m.likelihood)
    table = [(float(w), [float(x) for x in m], float(c.trace()) - len(m) * centroid_models.LEAST_VARIANCE)
             for w, m, c in zip(fit.weights, fit.means, fit.covariances)]
    parts = spark.createDataFrame(table, "weight double, mean array<double>, trace double")
    square = vectors.dot(F.col("mean"), F.col("mean")) + F.col("trace")
    return parts.agg(
        F.count("*").cast("int").alias("components"), numbers.rounded(F.sum("weight"), 6).alias("weights"),
        numbers.rounded(F.sum(F.col("weight") * square), 6).alias("mean_square"),
        numbers.rounded(F.sum(F.col("weight") * F.aggregate("mean", F.lit(0.0), lambda a, x: a + x)), 6).alias("mean_sum"))


@query("j5_gaussian_mixture")
def gaussian_mixture(spark, sf):
    from ..operators.reduction import reduce_slices

    reduced = reduce_slices(_points(spark, sf), ["all"], "id", "vector", 10)
    return centroid_models.gaussian_mixture(reduced, "id", "vector", 6)


@query("j6_ward")
def ward(spark, sf):
    return agglomerative(_points(spark, sf), ["all"], "id", "vector", 12, "ward").drop("all")


@query("j6_average_cosine")
def average_cosine(spark, sf):
    return agglomerative(_points(spark, sf), ["all"], "id", "vector", 10, "average").drop("all")


@query("j6_ward_heights", """
WITH comps AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS pos FROM embeddings),
cents AS (SELECT label, pos, avg(x) AS c FROM comps GROUP BY label, pos)
SELECT label AS class, round(sum((x - c) * (x - c)) + 1e-9, 4) AS inertia FROM comps JOIN cents USING (label, pos) GROUP BY label""")
def ward_heights(spark, sf):
    """Half the squared costs of all merges of a class add up to its inertia. Blocks are small, so merges are
    done in rounds and in a chain."""
    points = _points(spark, sf).withColumnRenamed("cluster", "class")
    copies = blocks.collapse_copies(blocks.prepare(points, ["class"], "id", "vector", "euclidean"), ["class"])
    history = merge_table(copies.distinct.withColumnRenamed("copies", "n"), ["class"], "ward", block_rows=32)
    return history.groupBy("class").agg(numbers.rounded(F.sum(F.col("cost") * F.col("cost")) / 2, 4).alias("inertia"))


@query("j6_ward_per_class")
def ward_per_class(spark, sf):
    """Two clusters inside each class: all slices in one plan."""
    points = _points(spark, sf).withColumnRenamed("cluster", "class")
    return agglomerative(points, ["class"], "id", "vector", 2, "ward")


@query("j16_k_sweep")
def k_sweep(spark, sf):
    """Every k from 2 to 20, ten starts each."""
    return centroid_models.k_sweep(_points(spark, sf), "id", "vector")


@query("g4_best_k")
def best_k(spark, sf):
    """The best k of the sweep by either metric."""
    return centroid_models.best_k(centroid_models.k_sweep(_points(spark, sf), "id", "vector"))


@query("j17_grid_search")
def grid_search(spark, sf):
    """All 350 settings, the best 15 by composite score."""
    points = _points(spark, sf).withColumnRenamed("cluster", "truth")
    found = experiments.grid_search(points, "id", "vector", "truth")
    return experiments.best_settings(experiments.with_composite(found))


@query("j19_weekly_comparison")
def weekly_comparison(spark, sf):
    """Four methods on one niche and week."""
    posts = fx.with_weeks(fx.posts(spark, sf, with_ratio=False)).where("niche = 'view' AND week_number = 2")
    rows = posts.join(fx.post_embeddings(spark, sf).drop("niche"), "post_id")
    return experiments.compare_methods(rows, "post_id", "embedding", 12)


@query("j19_full_comparison")
def full_comparison(spark, sf):
    """Four methods on all vectors, measured against the true classes."""
    points = _points(spark, sf).withColumnRenamed("cluster", "truth")
    return experiments.compare_methods(points, "id", "vector", 6, "truth")

"""Vector operators against plain NumPy on small input, in one block and in many."""

import math

import numpy as np
import pytest
from helpers import blobs, brute_dbscan, distance_matrix

from postloom.operators import blocks, components, dbscan, neighbours


def frame(spark, x, keys=("a",)):
    rows = [(k, i, [float(v) for v in row]) for k in keys for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "slice string, id bigint, vector array<double>")


@pytest.mark.parametrize("block_rows", [1000, 25])
def test_neighbours(spark, block_rows):
    x, _ = blobs()
    df = frame(spark, x, ("a", "b"))
    got = neighbours.nearest_neighbours(df, ["slice"], "id", "vector", 5, "cosine", block_rows).toPandas()
    assert len(got) == 2 * 5 * len(x)
    d = distance_matrix(x, "cosine")
    for _, part in got.groupby("slice"):
        wide = part.sort_values(["id", "rank"])
        assert (wide[wide["rank"] == 1]["neighbour"].to_numpy() == np.arange(len(x))).all()
        assert wide.groupby("id")["neighbour"].nunique().eq(5).all()
        dist = wide["distance"].to_numpy().reshape(len(x), 5)
        assert np.allclose(np.sort(dist, 1), np.sort(d, 1)[:, :5], atol=1e-9)


@pytest.mark.parametrize("block_rows", [1000, 25])
def test_core_distances(spark, block_rows):
    x, _ = blobs()
    copies = blocks.collapse_copies(blocks.prepare(frame(spark, x), ["slice"], "id", "vector", "euclidean"), ["slice"])
    blocked = blocks.split_into_blocks(copies.distinct, ["slice"], block_rows)
    got = neighbours.core_distances(blocked, 5).toPandas().set_index("id")["core"]
    want = np.sort(distance_matrix(x), 1)[:, 5]
    assert len(got) == len(x) - 6
    assert all(abs(got[i] - want[i]) < 1e-6 for i in got.index)


@pytest.mark.parametrize("block_rows", [1000, 25])
@pytest.mark.parametrize("metric,eps", [("cosine", 0.005), ("euclidean", 0.6)])
def test_dbscan(spark, block_rows, metric, eps):
    x, _ = blobs()
    got = dbscan.dbscan(frame(spark, x), ["slice"], "id", "vector", eps, 5, metric, block_rows).toPandas().sort_values("id")
    label, core = brute_dbscan(x, eps, 5, metric)
    assert label.max() >= 2 and (label == -1).any() and (~core & (label >= 0)).any()
    assert (got["is_core"].to_numpy() == core).all()
    assert (got["cluster"].to_numpy() == label).all()


def test_components(spark):
    rng = np.random.default_rng(1)
    edges = [("a", int(u), int(v)) for u, v in rng.integers(0, 300, (220, 2))] + [("a", i, i + 1) for i in range(400, 440)]
    got = components.connected_components(spark.createDataFrame(edges, "slice string, u bigint, v bigint"), ["slice"]).toPandas()
    root = {n: n for e in edges for n in e[1:]}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for _, u, v in edges:
        a, b = find(u), find(v)
        root[max(a, b)] = min(a, b)
    want = {n: find(n) for n in root if any(n in e[1:] and e[1] != e[2] for e in edges)}
    assert dict(zip(got["id"], got["component"])) == want
    assert got["id"].is_unique


@pytest.mark.parametrize("block_rows", [1000, 40])
def test_spanning_tree(spark, block_rows):
    from helpers import prim_weights
    from postloom.operators import spanning

    x, _ = blobs(copies=0)
    points = blocks.prepare(frame(spark, x), ["slice"], "id", "vector", "euclidean")
    blocked = blocks.split_into_blocks(blocks.collapse_copies(points, ["slice"]).distinct, ["slice"], block_rows)
    core = neighbours.core_distances(blocked, 5).cache()
    got = spanning.spanning_tree(blocked, core).toPandas()
    d = distance_matrix(x)
    c = np.sort(d, 1)[:, 5]
    want = prim_weights(np.maximum(d, np.maximum(c[:, None], c[None, :])))
    assert len(got) == len(x) - 1
    assert np.allclose(np.sort(got["weight"]), want, atol=1e-6)


@pytest.mark.parametrize("seed,spread,block_rows", [(0, 0.25, 1000), (3, 1.2, 1000), (3, 1.2, 40)])
@pytest.mark.parametrize("method", ["eom", "leaf"])
def test_hdbscan(spark, seed, spread, block_rows, method):
    from helpers import brute_hdbscan, same_partition
    from postloom.operators.hdbscan import hdbscan

    x, _ = blobs(seed=seed, spread=spread)
    got = hdbscan(frame(spark, x, ("a", "b")), ["slice"], "id", "vector", 6, 3, method, block_rows=block_rows).toPandas()
    label, prob = brute_hdbscan(x, 6, 3, method)
    assert len(set(label)) > 2
    for _, part in got.groupby("slice"):
        part = part.sort_values("id")
        assert same_partition(part["cluster"].tolist(), label.tolist())
        assert np.allclose(part["probability"], prob, atol=1e-6)
        assert (part[part["cluster"] == -1]["probability"] == 0).all()


def brute_metrics(x, y):
    d = distance_matrix(x)
    labels = np.unique(y)
    sil = []
    for i in range(len(x)):
        same = (y == y[i]) & (np.arange(len(x)) != i)
        if not same.any():
            sil.append(0.0)
            continue
        a, b = d[i, same].mean(), min(d[i, y == c].mean() for c in labels if c != y[i])
        sil.append((b - a) / max(a, b))
    c = np.array([x[y == k].mean(0) for k in labels])
    n = np.array([(y == k).sum() for k in labels])
    w = sum(((x[y == k] - c[i]) ** 2).sum() for i, k in enumerate(labels))
    ch = ((n[:, None] * (c - x.mean(0)) ** 2).sum() / (len(c) - 1)) / (w / (len(x) - len(c)))
    s = np.array([np.sqrt(((x[y == k] - c[i]) ** 2).sum(1)).mean() for i, k in enumerate(labels)])
    m = distance_matrix(c)
    np.fill_diagonal(m, np.inf)
    return np.mean(sil), ch, ((s[:, None] + s[None, :]) / m).max(1).mean()


@pytest.mark.parametrize("block_rows,bundle", [(1000, 256), (40, 256), (40, 6)])
def test_clusterings_of_the_same_vectors_share_distances(spark, monkeypatch, block_rows, bundle):
    """Bundled clusterings have the silhouettes that each has by itself; noise, ids that come twice and single points included."""
    from postloom.operators import metrics

    rng = np.random.default_rng(5)
    x = rng.normal(size=(120, 3))
    rows = []
    for k in range(1, 6):
        labels = rng.integers(-1, k, 120)
        labels[3] = 90  # alone
        for i, (v, c) in enumerate(zip(x.tolist(), labels.tolist())):
            rows += [("a", k, 8 if i == 7 else i, v, c)] * (2 if i % 30 == 0 else 1)
    df = spark.createDataFrame(rows, "space string, k int, id bigint, vector array<double>, cluster int")
    monkeypatch.setattr(metrics, "BUNDLE_CLUSTERS", bundle)
    order = ["k", "id", "cluster"]
    by_itself = metrics.silhouette_samples(df, ["space", "k"], "id", "vector").toPandas().sort_values(order)
    for keys, given in ((["space", "k"], df), (["k"], df.drop("space"))):
        together = metrics.silhouette_samples(given, keys, "id", "vector", block_rows=block_rows, shared=["k"]).toPandas().sort_values(order)
        assert together[order].values.tolist() == by_itself[order].values.tolist()
        assert np.allclose(together["silhouette"], by_itself["silhouette"], atol=1e-7)


@pytest.mark.parametrize("block_rows", [1000, 30])
def test_metrics(spark, block_rows):
    from postloom.operators import metrics

    x, y = blobs(spread=1.5)
    rows = [("a", i, [float(v) for v in r], int(c), int(c) // 2) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "slice string, id bigint, vector array<double>, cluster int, truth int")
    got = metrics.evaluate(df, ["slice"], "id", "vector", "truth", block_rows=block_rows).first()
    sil, ch, db = brute_metrics(x[y >= 0], y[y >= 0])
    assert abs(got["silhouette"] - sil) < 1e-4 and abs(got["calinski_harabasz"] - ch) < 1e-2
    assert abs(got["davies_bouldin"] - db) < 1e-4
    assert got["n_clusters"] == 4 and got["noise"] == 10
    assert 0.4 < got["ari"] < 0.7 and 0.5 < got["nmi"] < 0.8


def test_reduction(spark):
    from postloom.operators import reduction

    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 30)) @ rng.normal(size=(30, 30))
    got = reduction.reduce_slices(frame(spark, x, ("a", "b")), ["slice"], "id", "vector", 5).toPandas()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    u = u - u.mean(0)
    top = np.linalg.svd(u, full_matrices=False)
    want = np.abs(u @ top[2][:5].T)
    for _, part in got.groupby("slice"):
        assert np.allclose(np.abs(np.stack(part.sort_values("id")["vector"])), want, atol=1e-8)
    small = reduction.reduce_slices(frame(spark, x[:, :8]), ["slice"], "id", "vector", 5).toPandas()
    assert len(small["vector"].iloc[0]) == 8
    holes = frame(spark, x).unionByName(spark.createDataFrame([("a", 900, None)], "slice string, id bigint, vector array<double>"))
    assert reduction.reduce_slices(holes, ["slice"], "id", "vector", 5).count() == len(x)
    with pytest.raises(ValueError):
        reduction.reduce_slices(frame(spark, x).unionByName(frame(spark, x[:, :9])), ["slice"], "id", "vector", 5)
    p = reduction.pca(frame(spark, x), "id", "vector", 3)
    c = x - x.mean(0)
    s = np.linalg.svd(c, full_matrices=False)
    assert np.allclose(np.abs(np.stack(p.rows.toPandas().sort_values("id")["vector"])), np.abs(c @ s[2][:3].T), atol=1e-6)
    assert np.allclose(p.explained, (s[1] ** 2 / (s[1] ** 2).sum())[:3])


@pytest.mark.parametrize("part_entries", [5_000_000, 60])
def test_truncated_svd(spark, monkeypatch, part_entries):
    from postloom.operators import reduction

    monkeypatch.setattr(reduction, "PART_ENTRIES", part_entries)
    monkeypatch.setattr(reduction, "_CHUNK_TERMS", 256 if part_entries > 60 else 7)

    rng = np.random.default_rng(2)
    a = np.abs(rng.normal(size=(60, 25))) * (rng.random((60, 25)) < 0.3)
    a[:, 0] = 1.0
    rows = [(i, f"t{j:02d}", float(a[i, j])) for i in range(60) for j in range(25) if a[i, j] > 0]
    got = reduction.truncated_svd(spark.createDataFrame(rows, "id bigint, term string, weight double"), "id", 4, iterations=25)
    _, _, v = np.linalg.svd(a, full_matrices=False)
    want = a @ v[:4].T
    have = np.stack(got.rows.toPandas().sort_values("id")["vector"])
    assert np.allclose(np.abs(have), np.abs(want), atol=1e-3)
    assert np.allclose(got.explained, want.var(0) / a.var(0).sum(), atol=1e-4)
    # Two directions only, though more are asked for.
    few = [(i, t, w * (i + 1)) for i in range(9) for t, w in ((("x", 1.0), ("y", 2.0)) if i % 2 else (("z", 3.0),))]
    got = reduction.truncated_svd(spark.createDataFrame(few, "id bigint, term string, weight double"), "id", 3)
    have = {r.id: r.vector for r in got.rows.collect()}
    assert all(len(v) == 2 and math.isclose(sum(c * c for c in v), (5 if i % 2 else 9) * (i + 1) ** 2) for i, v in have.items())
    none = reduction.truncated_svd(spark.createDataFrame([], "id bigint, term string, weight double"), "id", 3)
    assert none.rows.count() == 0 and none.explained == []


def brute_agglomerative(x, k, linkage):
    groups = [[i] for i in range(len(x))]
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    while len(groups) > k:
        n = np.array([len(g) for g in groups])
        if linkage == "ward":
            c = np.array([x[g].mean(0) for g in groups])
            cost = np.sqrt(2 * np.outer(n, n) / (n[:, None] + n[None, :])) * distance_matrix(c)
        else:
            c = np.array([u[g].mean(0) for g in groups])
            cost = 1 - c @ c.T
        np.fill_diagonal(cost, np.inf)
        a, b = sorted(np.unravel_index(cost.argmin(), cost.shape))
        groups[a] += groups.pop(b)
    label = np.empty(len(x), int)
    for c, g in enumerate(groups):
        label[g] = c
    return label


@pytest.mark.parametrize("linkage,block_rows", [("ward", 1000), ("average", 1000), ("ward", 30)])
def test_agglomerative(spark, linkage, block_rows):
    from helpers import same_partition
    from postloom.operators.agglomerative import agglomerative

    x, _ = blobs(spread=2.0, per=15, noise=4)
    got = agglomerative(frame(spark, x, ("a", "b")), ["slice"], "id", "vector", 5, linkage, block_rows).toPandas()
    want = brute_agglomerative(x, 5, linkage)
    for _, part in got.groupby("slice"):
        assert same_partition(part.sort_values("id")["cluster"].tolist(), want.tolist())


@pytest.mark.parametrize("linkage", ["ward", "average"])
def test_agglomerative_ties_do_not_depend_on_blocks(spark, linkage):
    """A grid of whole numbers: most costs are equal."""
    from postloom.operators.agglomerative import agglomerative

    rows = [("s", 9 * i + j, [float(i + 1), float(j + 1)]) for i in range(9) for j in range(9)]
    df = spark.createDataFrame(rows, "slice string, id long, vector array<double>")
    found = [agglomerative(df, ["slice"], "id", "vector", 7, linkage, b).orderBy("id").collect() for b in (1000, 30)]
    assert found[0] == found[1]
    assert len({r["cluster"] for r in found[0]}) == 7


def test_only_the_first_round_of_a_linkage_compares_all_pairs(spark, monkeypatch):
    """Later rounds look again only for clusters whose nearest one was merged, with the same history as one task has."""
    from postloom.operators import agglomerative, blocks

    calls, all_pairs = [], blocks.run_on_pairs
    monkeypatch.setattr(blocks, "run_on_pairs", lambda *a, **k: calls.append(1) or all_pairs(*a, **k))
    x = np.random.default_rng(5).normal(size=(48, 3))
    df = spark.createDataFrame([("s", i, v, 1) for i, v in enumerate(x.tolist())], "slice string, id long, vector array<double>, n long")
    found = [sorted(map(tuple, agglomerative.merge_table(df, ["slice"], "ward", b).collect())) for b in (1000, 12)]
    assert found[0] == found[1] and len(found[0]) == 47
    assert len(calls) == 1


def test_steps_of_all_settings_run_on_all_cores(spark):
    """Rows of a small file are dealt before the steps, and the shared sums are those of each setting by itself."""
    from postloom.operators import centroid_models as cm

    x = np.random.default_rng(2).normal(size=(1500, 4))
    df = spark.createDataFrame([(i, r) for i, r in enumerate(x.tolist())], "id bigint, vector array<double>").coalesce(1)
    rows = cm.table_of(df, "id", "vector")
    assert len(rows.inputFiles()) == spark.sparkContext.defaultParallelism
    centres = {0: x[:3], 1: x[3:8]}
    for i, (sums, sizes, inertia) in cm._pass(rows, centres).items():
        d = ((x[:, None] - centres[i][None]) ** 2).sum(2)
        best = d.argmin(1)
        assert np.allclose(sums, [x[best == c].sum(0) for c in range(len(centres[i]))])
        assert sizes.tolist() == [(best == c).sum() for c in range(len(centres[i]))]
        assert abs(inertia - d.min(1).sum()) < 1e-6


def test_methods_find_blobs(spark):
    from postloom.operators import centroid_models, metrics

    x, y = blobs(noise=0, copies=0)
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>, truth int")
    km, inertia = centroid_models.kmeans(df, "id", "vector", 4)
    gm = centroid_models.gaussian_mixture(df, "id", "vector", 4)
    want = sum(((x[y == c] - x[y == c].mean(0)) ** 2).sum() for c in range(4))
    assert abs(inertia - want) < 1e-6 * want
    for labels in (km, gm):
        assert metrics.adjusted_rand(labels.join(df, "id"), [], "truth").first()["ari"] > 0.99
    sweep = centroid_models.k_sweep(df, "id", "vector", range(2, 6), starts=3).cache()
    assert sweep.count() == 4
    assert centroid_models.best_k(sweep).first()["best_by_silhouette"] == 4


def test_grid_and_comparison(spark):
    from postloom.operators.hdbscan import hdbscan
    from postloom.plans import experiments

    x, y = blobs(dim=24, spread=0.8)
    rows = [(i, [float(v) for v in r], int(c)) for i, (r, c) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id bigint, vector array<double>, truth int")
    grid = {"n_components": [3, 5], "min_cluster_size": [5, 8], "min_samples": [5, 7], "selection": ["eom", "leaf"]}
    found = experiments.grid_search(df, "id", "vector", "truth", grid).cache()
    scored = experiments.best_settings(experiments.with_composite(found)).toPandas()
    assert 8 <= len(scored) <= 15 and scored["composite"].between(0, 1.0001).all()
    assert scored["ari"].max() > 0.9
    table = experiments.compare_methods(df, "id", "vector", 4, "truth").toPandas()
    assert table["algorithm"].tolist() == experiments.METHODS
    # A mixture with full covariances is not made for compact clusters; its labels are tested on their own above.
    compact = table[table["algorithm"] != "GMM"]
    assert (compact["silhouette"] > 0.6).all() and (compact["ari"] > 0.5).all()
    assert table["silhouette"].between(-1, 1).all() and table["ari"].between(-1, 1).all()
    # A cell of the grid is the clustering that a single run gives.
    from postloom.operators.reduction import reduce_slices
    from pyspark.sql import functions as F

    reduced = reduce_slices(df.withColumn("_all", F.lit(0)), ["_all"], "id", "vector", 3, 0)
    one = hdbscan(reduced, ["_all"], "id", "vector", 8, 5, "leaf").where("cluster >= 0").agg(F.countDistinct("cluster")).first()[0]
    cell = found.where("n_components = 3 AND min_cluster_size = 8 AND min_samples = 5 AND selection = 'leaf'").first()
    assert cell["n_clusters"] == one


def test_mixtures_step_by_step(spark):
    """Steps in shared scans against plain NumPy, and the likelihood against separate fits of Spark ML on the same rows."""
    from pyspark.ml.clustering import GaussianMixture
    from pyspark.ml.functions import array_to_vector

    from postloom.operators import centroid_models as cm

    x, _ = blobs(noise=0, copies=0, spread=1.5, dim=4, per=60)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "id bigint, vector array<double>")
    start = cm.Mixture(np.full(3, 1 / 3), x[:3].copy(), np.broadcast_to(np.eye(4) * 9, (3, 4, 4)).copy())
    got = cm._mixture_step(df.repartition(5), {0: start})[0]
    p = np.stack([
        w * np.exp(-0.5 * np.einsum("nd,de,ne->n", x - m, np.linalg.inv(c), x - m)) / np.sqrt(np.linalg.det(2 * np.pi * c))
        for w, m, c in zip(start.weights, start.means, start.covariances)], 1)
    r = p / p.sum(1, keepdims=True)
    means = (r.T @ x) / r.sum(0)[:, None]
    assert abs(got.likelihood - np.log(p.sum(1)).sum()) < 1e-6
    assert np.allclose(got.weights, r.mean(0)) and np.allclose(got.means, means)
    for c in range(3):
        assert np.allclose(got.covariances[c], (r[:, c] * (x - means[c]).T) @ (x - means[c]) / r[:, c].sum() + 1e-6 * np.eye(4), atol=1e-8)
    fits = cm.fit_mixtures(df, 4, [42 + i for i in range(5)])
    best = max(fits, key=lambda m: m.likelihood)
    rows = df.select("id", array_to_vector("vector").alias("features")).coalesce(1).cache()
    separate = max(GaussianMixture(k=4, seed=42 + i, maxIter=100, tol=1e-3).fit(rows).summary.logLikelihood for i in range(2))
    rows.unpersist()
    assert best.likelihood >= separate - 0.001 * abs(separate)  # optima of the same height
    labels = cm.gaussian_mixture(df, "id", "vector", 4).toPandas().sort_values("id")["cluster"].to_numpy()
    assert (labels == best.log_densities(x).argmax(1)).all()
    assert cm.gaussian_mixture(df.where("false"), "id", "vector", 4).count() == 0


def test_first_centres_see_every_row(spark):
    """A few rows far from all others, far fewer than one in four thousand, get a centre of their own."""
    from postloom.operators import centroid_models as cm

    r = np.random.default_rng(4)
    x = np.concatenate([r.normal(0, 1, (20_000, 3)) + np.repeat([[0, 0, 0], [9, 0, 0], [0, 9, 0], [0, 0, 9]], 5_000, 0), r.normal(0, 0.1, (3, 3)) + 80])
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "id bigint, vector array<double>")
    labels, inertia = cm.kmeans(df, "id", "vector", 5, starts=3)
    sizes = sorted(n["count"] for n in labels.groupBy("cluster").count().collect())
    assert sizes[0] == 3 and min(sizes[1:]) > 4_500
    assert inertia < 3.2 * len(x)

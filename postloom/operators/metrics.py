"""Quality of clusterings, one row per key. Keys may be a slice, an algorithm or a parameter setting, so many
clusterings are measured in one plan. Noise is left out first."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import BLOCK_ROWS
from ..functions import numbers, vectors
from ..session import cut
from . import blocks
from .aggregates import NOISE, noise_summary
from .ranking import null_safe_join, top_rows

# Clusters that the clusterings of a bundle have together, more only by those of its last one; summaries of theirs that are put together at once.
BUNDLE_CLUSTERS = 256
BUNDLE_ROWS = 20_000


def _keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Without keys all rows are one clustering."""
    return (df, list(keys)) if keys else (df.withColumn("_all", F.lit(0)), ["_all"])


def _unkeyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df if keys else df.drop("_all")


def clustered_points(df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str, metric: str) -> DataFrame:
    points = df.where(F.col("cluster") != NOISE)
    v = F.col(vector_column)
    unit = vectors.l2_normalised(v) if metric == "cosine" else vectors.as_double(v)
    return points.select(*keys, F.col(id_column).alias("id"), unit.alias("vector"), "cluster")


def centroids(points: DataFrame, keys: Sequence[str]) -> DataFrame:
    return points.groupBy(*keys, "cluster").agg(F.count("*").alias("n"), vectors.mean_vector("vector").alias("centroid"))


# Silhouette ------------------------------------------------------------------------------------------

def _distance_sums(metric: str) -> blocks.Kernel:
    """Per point and cluster the sum of distances to the points of the cluster in the other block."""

    def sums(ids, own, others, d):
        codes, index = np.unique(others, return_inverse=True)
        hot = np.zeros((len(others), len(codes)))
        hot[np.arange(len(others)), index] = 1.0
        total = d @ hot
        return pd.DataFrame({
            "id": np.repeat(ids, len(codes)), "cluster": np.repeat(own, len(codes)),
            "other": np.tile(codes, len(ids)), "total": total.ravel(),
        })

    def kernel(left, right, key):
        a = blocks.matrix(left)
        ids, own = left["id"].to_numpy(), left["cluster"].to_numpy()
        if right is None:
            d = blocks.distances(a, a, metric)
            np.fill_diagonal(d, 0.0)
            return sums(ids, own, own, d)
        d = blocks.distances(a, blocks.matrix(right), metric)
        other_ids, other = right["id"].to_numpy(), right["cluster"].to_numpy()
        return pd.concat([sums(ids, own, other, d), sums(other_ids, other, own, d.T)], ignore_index=True)

    return kernel


def _added_sums(found: pd.DataFrame, own: bool) -> pd.DataFrame:
    return found.groupby(["id", "cluster", "other"], sort=False, dropna=False, as_index=False)["total"].sum()


def seeded_sample_of_each(points: DataFrame, keys: Sequence[str], sample: int, seed: int) -> DataFrame:
    """The `sample` points of each key that come first by a hash of their id.

    A key of any size may hold them, so points that cannot be among them are left out first: a threshold on the hash,
    from the key's size, passes a few more points than asked for; only these are numbered. Should it pass too few, which
    is all but impossible, the key's points are all numbered.
    """
    draw = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")))
    share = F.conv(F.substring(draw, 1, 13), 16, 10).cast("double") / float(16**13)
    drawn = points.withColumns({"_draw": draw, "_share": share})
    # Ten deviations above the number asked for.
    enough = (sample + 10 * sample**0.5 + 10) / F.count("*")
    limits = drawn.groupBy(*keys).agg(enough.alias("_limit"))
    near = null_safe_join(drawn, limits, keys).withColumn("_near", F.col("_share") <= F.col("_limit"))
    passed = near.groupBy(*keys).agg((F.sum(F.col("_near").cast("int")) < F.least(F.lit(sample), F.count("*"))).alias("_too_few"))
    chosen = null_safe_join(near, passed, keys).where("_near OR _too_few")
    return top_rows(chosen, keys, [F.asc("_draw"), F.asc("id")], sample, "_r").select(*points.columns)


def silhouette_samples(
    df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str, metric: str = "euclidean",
    sample: int | None = None, seed: int = 42, block_rows: int = BLOCK_ROWS, shared: Sequence[str] = (),
) -> DataFrame:
    """Silhouette of every clustered point: keys, id, cluster, silhouette.

    Mean distances need every pair of points; blocks keep the pairs out of the shuffle. Cosine distances need none
    (`_cosine_samples`). `sample` measures a seeded sample of that many points per key instead, as is usual for large sets.
    `shared` names keys that tell clusterings of the same vectors apart: those share the distances (`_shared_samples`).
    """
    given = keys
    points, keys = _keyed(clustered_points(df, keys, id_column, vector_column, metric), keys)
    if sample:
        points = seeded_sample_of_each(points, keys, sample, seed)
    if metric == "cosine":
        return _unkeyed(_cosine_samples(points, keys), given)
    if shared:
        return _unkeyed(_shared_samples(points, keys, shared, metric, block_rows), given)
    blocked = blocks.split_into_blocks(points, keys, block_rows)
    kind = points.schema["id"].dataType.simpleString()
    sums = blocks.run_on_pairs(
        blocked, _distance_sums(metric), f"id {kind}, cluster int, other int, total double", carry=["cluster"], combine=_added_sums
    )
    sizes = points.groupBy(*keys, "cluster").agg(F.count("*").alias("n"))
    means = sums.groupBy(*keys, "id", "cluster", "other").agg(F.sum("total").alias("total")).join(
        sizes.withColumnRenamed("cluster", "other"), [*keys, "other"]
    )
    own = F.col("cluster") == F.col("other")
    per_point = means.groupBy(*keys, "id", "cluster").agg(
        F.max(F.when(own, F.col("n"))).alias("n"),
        F.max(F.when(own & (F.col("n") > 1), F.col("total") / (F.col("n") - 1))).alias("a"),
        F.min(F.when(~own, F.col("total") / F.col("n"))).alias("b"),
    )
    value = F.when(F.col("n") > 1, F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0)))
    out = per_point.select(*keys, "id", "cluster", value.otherwise(F.lit(0.0)).alias("silhouette"))
    return _unkeyed(out, given)


def _bundled_sums(metric: str) -> blocks.Kernel:
    """Per point the sums of distances to the points of every cluster of the bundle in the other block, as one array."""

    def hot(rows):
        codes = rows["codes"].to_numpy()
        out = np.zeros((len(rows), int(rows["width"].iloc[0])))
        np.add.at(out, (np.repeat(np.arange(len(rows)), [len(c) for c in codes]), np.concatenate(codes)), 1.0)
        return out

    def sums(rows, total):
        return rows[["id", "member", "codes"]].assign(totals=list(total))

    def kernel(left, right, key):
        a = blocks.matrix(left)
        if right is None:
            d = blocks.distances(a, a, metric)
            np.fill_diagonal(d, 0.0)
            return sums(left, d @ hot(left))
        d = blocks.distances(a, blocks.matrix(right), metric)
        return pd.concat([sums(left, d @ hot(right)), sums(right, d.T @ hot(left))], ignore_index=True)

    return kernel


def _added_arrays(found: pd.DataFrame, own: bool) -> pd.DataFrame:
    ids = found["id"].to_numpy()
    order = np.argsort(ids, kind="stable")
    starts = np.flatnonzero(np.diff(ids[order], prepend=ids[order[0]] - 1))
    total = np.add.reduceat(np.stack(found["totals"].to_numpy())[order], starts, axis=0)
    return found.iloc[order[starts]].assign(totals=list(total))


def _shared_samples(points: DataFrame, keys: list[str], shared: Sequence[str], metric: str, block_rows: int) -> DataFrame:
    """Silhouettes of clusterings of the same vectors, with the distances of a pair of vectors computed once for a bundle of clusterings.

    The clusters of a bundle are numbered through. A vector carries the numbers of its clusters, and its sums of distances to all of
    them are one array. An id with several rows counts as often as it comes, as it does for a single clustering.
    """
    spaces = [k for k in keys if k not in shared]
    if not spaces:
        points, spaces = points.withColumn("_space", F.lit(0)), ["_space"]
    every, group = [*spaces, *shared], [*spaces, "_bundle"]
    kind = points.schema["id"].dataType.simpleString()
    sizes = points.groupBy(*every, "cluster").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy(*spaces).orderBy(*shared).rowsBetween(Window.unboundedPreceding, -1)
    bundle = F.floor(F.coalesce(F.sum("_k").over(earlier), F.lit(0)) / F.lit(BUNDLE_CLUSTERS)).cast("int").alias("_bundle")
    bundles = sizes.groupBy(*every).agg(F.count("*").alias("_k")).select(*every, bundle)
    clusters = cut(sizes.join(bundles, every).withColumn(
        "_code", F.row_number().over(Window.partitionBy(*group).orderBy(*shared, "cluster")) - 1
    ).withColumns({"_first": F.min("_code").over(Window.partitionBy(*every)), "_width": F.count("*").over(Window.partitionBy(*group)).cast("int")}))
    coded = points.join(clusters.drop("n", "_first"), [*every, "cluster"])
    together = coded.groupBy(*group, F.col("id").alias("member"), "vector").agg(F.collect_list("_code").alias("codes"), F.max("_width").alias("width"))
    rows = cut(together.withColumn("id", F.monotonically_increasing_id()))
    blocked = blocks.split_into_blocks(rows, group, block_rows)
    sums = blocks.run_on_pairs(
        blocked, _bundled_sums(metric), f"id long, member {kind}, codes array<int>, totals array<double>",
        carry=["member", "codes", "width"], combine=_added_arrays, summary_rows=BUNDLE_ROWS)

    def measure(key, rows, known):
        known = known.sort_values("_code", ignore_index=True)
        n, first = known["n"].to_numpy().astype(float), known["_first"].to_numpy()
        rows = _added_arrays(rows, True)
        total, codes = np.stack(rows["totals"].to_numpy()), rows["codes"].to_numpy()
        who, names = pd.factorize(rows["member"], use_na_sentinel=False)
        flat = np.repeat(np.arange(len(rows)), [len(c) for c in codes]) * len(n) + np.concatenate(codes)
        flat, times = np.unique(flat, return_counts=True)
        at, code = flat // len(n), flat % len(n)
        parts = []
        for start in np.unique(first[code]):
            end = start + int((first == start).sum())
            mine = (code >= start) & (code < end)
            one, where = np.unique(who[at[mine]] * len(n) + code[mine], return_inverse=True)
            apart = np.zeros((len(one), end - start))
            np.add.at(apart, where, total[at[mine], start:end] * times[mine, None])
            each, own = np.arange(len(one)), one % len(n)
            size = n[own]
            a = apart[each, own - start] / np.maximum(size - 1, 1)
            apart /= n[start:end]
            apart[each, own - start] = np.inf
            b = apart.min(1)
            top = np.maximum(a, b)
            fine = (size > 1) & ~np.isposinf(b) & (top != 0)
            value = np.divide(b - a, top, out=np.zeros(len(one)), where=fine)
            parts.append(pd.DataFrame({"id": names[one // len(n)], "_code": own, "silhouette": value}))
        out = pd.concat(parts, ignore_index=True)
        for i, k in enumerate(group):
            out.insert(i, k, pd.Series([key[i]] * len(out), index=out.index, dtype=object))
        return out

    chunks = blocked.points.groupBy(*group).agg(F.ceil(F.count("*") * F.lit(blocked.tiles) / F.lit(BUNDLE_ROWS)).cast("int").alias("_chunks"))
    dealt = sums.join(chunks, group).withColumn("_chunk", F.pmod(F.xxhash64("member", F.lit(17)), F.col("_chunks")).cast("int")).drop("_chunks")
    beside = clusters.select(*group, "_code", "_first", "n").join(chunks, group).withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    beside = beside.toDF(*beside.columns)

    def run(key, rows, known):
        return measure(key, rows, known) if len(rows) else pd.DataFrame(columns=[*group, "id", "_code", "silhouette"])

    by = [*group, "_chunk"]
    measured = dealt.groupBy(*by).cogroup(beside.groupBy(*by)).applyInPandas(run, blocked.key_ddl() + f"id {kind}, _code int, silhouette double")
    named = clusters.select(*every, "_bundle", "_code", "cluster")
    return measured.join(named, [*group, "_code"]).select(*keys, "id", "cluster", "silhouette")


def _cosine_samples(points: DataFrame, keys: list[str]) -> DataFrame:
    """The cosine distances of a unit vector u to the n vectors of a cluster add up to n - u * (their sum): so exact
    silhouettes need a sum of vectors for each cluster, and a product of each point with each sum."""
    kind = points.schema["id"].dataType.simpleString()
    clusters = cut(points.groupBy(*keys, "cluster").agg(F.count("*").alias("n"), vectors.mean_vector("vector").alias("mean")))

    def measure(rows, known):
        x, n = blocks.matrix(rows), known["n"].to_numpy().astype(float)
        total = np.maximum(n - (x @ np.stack(known["mean"].to_numpy()).T) * n, 0.0)
        codes = known["cluster"].to_numpy()
        own = rows["cluster"].to_numpy()[:, None] == codes[None, :]
        size = (own * n).sum(1)
        # A point is no neighbour of itself; a zero vector has distance 1 to all, itself among them.
        inside = (own * total).sum(1) - np.maximum(1.0 - (x * x).sum(1), 0.0)
        a = np.maximum(inside, 0.0) / np.maximum(size - 1, 1)
        b = np.where(own, np.inf, total / n).min(1)
        top = np.maximum(a, b)
        value = np.where((size > 1) & np.isfinite(b) & (top > 0), (b - a) / np.where(np.isfinite(top) & (top > 0), top, 1.0), 0.0)
        return pd.DataFrame({"id": rows["id"].to_numpy(), "cluster": rows["cluster"].to_numpy(), "silhouette": value})

    return blocks.beside_table(points, clusters, keys, measure, f"id {kind}, cluster int, silhouette double")


def silhouette(df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str, **options) -> DataFrame:
    samples = silhouette_samples(df, keys, id_column, vector_column, **options)
    return samples.groupBy(*keys).agg(F.avg("silhouette").alias("silhouette"))


# Centroid metrics ------------------------------------------------------------------------------------

def _spreads(points: DataFrame, centres: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mean distance and sum of squares of each cluster around its centroid."""
    apart = points.join(centres, [*keys, "cluster"]).withColumn("_sq", vectors.squared_distance(F.col("vector"), F.col("centroid")))
    return apart.groupBy(*keys, "cluster").agg(F.sum("_sq").alias("within"), F.avg(F.sqrt("_sq")).alias("spread"))


def calinski_harabasz(df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str) -> DataFrame:
    """Spread between clusters over spread inside clusters, each per degree of freedom."""
    points, k = _keyed(clustered_points(df, keys, id_column, vector_column, "euclidean"), keys)
    return _unkeyed(_calinski_harabasz(points, centroids(points, k), k), keys)


def _calinski_harabasz(points: DataFrame, centres: DataFrame, keys: Sequence[str]) -> DataFrame:
    middle = points.groupBy(*keys).agg(vectors.mean_vector("vector").alias("middle"))
    between = centres.join(middle, list(keys)).groupBy(*keys).agg(
        F.sum(F.col("n") * vectors.squared_distance(F.col("centroid"), F.col("middle"))).alias("_between"),
        F.count("*").alias("_k"), F.sum("n").alias("_n"),
    )
    within = _spreads(points, centres, keys).groupBy(*keys).agg(F.sum("within").alias("_within"))
    ratio = (F.col("_between") / (F.col("_k") - 1)) / (F.col("_within") / (F.col("_n") - F.col("_k")))
    value = F.when(F.col("_within") == 0, F.lit(1.0)).otherwise(ratio)
    return between.join(within, list(keys)).where("_k >= 2").select(*keys, value.alias("calinski_harabasz"))


def _worst_ratio(left, right, key):
    """Per centroid the largest (s_i + s_j) / distance to another centroid of the pair of blocks."""

    def worst(a, b, same):
        d = blocks.distances(blocks.matrix(a), blocks.matrix(b), "euclidean")
        if same:
            np.fill_diagonal(d, 0.0)
        total = a["spread"].to_numpy()[:, None] + b["spread"].to_numpy()[None, :]
        ratio = np.divide(total, d, out=np.zeros_like(total), where=d > 0)
        return pd.DataFrame({"id": a["id"], "worst": ratio.max(1)})

    if right is None:
        return worst(left, left, True)
    return pd.concat([worst(left, right, False), worst(right, left, False)], ignore_index=True)


def _largest(found: pd.DataFrame, own: bool) -> pd.DataFrame:
    return found.groupby("id", sort=False, dropna=False, as_index=False)["worst"].max()


def davies_bouldin(df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str) -> DataFrame:
    """Mean over clusters of the worst ratio of spreads to the distance of centroids."""
    points, k = _keyed(clustered_points(df, keys, id_column, vector_column, "euclidean"), keys)
    return _unkeyed(_davies_bouldin(points, centroids(points, k), k), keys)


def _davies_bouldin(points: DataFrame, centres: DataFrame, keys: Sequence[str]) -> DataFrame:
    spread = _spreads(points, centres, keys)
    rows = centres.join(spread, [*keys, "cluster"]).select(
        *keys, F.col("cluster").alias("id"), F.col("centroid").alias("vector"), "spread"
    )
    blocked = blocks.split_into_blocks(rows, keys)
    worst = blocks.run_on_pairs(blocked, _worst_ratio, "id int, worst double", carry=["spread"], combine=_largest)
    per_cluster = worst.groupBy(*keys, "id").agg(F.max("worst").alias("worst"))
    return per_cluster.groupBy(*keys).agg(F.avg("worst").alias("davies_bouldin"), F.count("*").alias("_k")).where(
        "_k >= 2"
    ).drop("_k")


# Agreement with true classes -------------------------------------------------------------------------

def _contingency(df: DataFrame, keys: Sequence[str], truth: str) -> DataFrame:
    return df.where(F.col("cluster") != NOISE).groupBy(*keys, F.col(truth).alias("_truth"), "cluster").agg(
        F.count("*").cast("double").alias("n")
    )


def adjusted_rand(df: DataFrame, keys: Sequence[str], truth: str) -> DataFrame:
    """Adjusted Rand index, from pair counts of the contingency table."""
    cells, k = _keyed(_contingency(df, keys, truth), keys)
    squares = cells.groupBy(*k).agg(F.sum(F.col("n") * F.col("n")).alias("_cells"), F.sum("n").alias("_n"))
    for name, by in (("_rows", "_truth"), ("_cols", "cluster")):
        sums = cells.groupBy(*k, by).agg(F.sum("n").alias("s")).groupBy(*k).agg(F.sum(F.col("s") * F.col("s")).alias(name))
        squares = squares.join(sums, k)
    both, rows, cols, n = F.col("_cells"), F.col("_rows"), F.col("_cols"), F.col("_n")
    # Ordered pairs that are together in both, in neither, or in one of the two.
    tp, fp, fn = both - n, cols - both, rows - both
    tn = n * n - tp - fp - fn - n
    value = F.when((fp == 0) & (fn == 0), F.lit(1.0)).otherwise(
        2.0 * (tp * tn - fn * fp) / ((tp + fn) * (fn + tn) + (tp + fp) * (fp + tn))
    )
    return _unkeyed(squares.select(*k, value.alias("ari")), keys)


def normalised_mutual_information(df: DataFrame, keys: Sequence[str], truth: str) -> DataFrame:
    """Mutual information over the mean of both entropies."""
    cells, k = _keyed(_contingency(df, keys, truth), keys)
    total = cells.groupBy(*k).agg(F.sum("n").alias("_n"))
    rows = cells.groupBy(*k, "_truth").agg(F.sum("n").alias("_row"))
    cols = cells.groupBy(*k, "cluster").agg(F.sum("n").alias("_col"))
    information = (
        cells.join(total, k).join(rows, [*k, "_truth"]).join(cols, [*k, "cluster"])
        .groupBy(*k).agg(
            F.sum(F.col("n") / F.col("_n") * F.ln(F.col("n") * F.col("_n") / (F.col("_row") * F.col("_col")))).alias("_mi")
        )
    )

    def entropy(sums: DataFrame, column: str, name: str) -> DataFrame:
        share = F.col(column) / F.col("_n")
        return sums.join(total, k).groupBy(*k).agg((-F.sum(share * F.ln(share))).alias(name), F.count("*").alias(name + "_k"))

    joined = information.join(entropy(rows, "_row", "_h1"), k).join(entropy(cols, "_col", "_h2"), k)
    value = F.when((F.col("_h1_k") == 1) & (F.col("_h2_k") == 1), F.lit(1.0)).otherwise(
        F.coalesce(F.try_divide(F.greatest(F.col("_mi"), F.lit(0.0)), (F.col("_h1") + F.col("_h2")) / 2), F.lit(0.0))
    )
    return _unkeyed(joined.select(*k, value.alias("nmi")), keys)


# All together ----------------------------------------------------------------------------------------

def evaluate(
    df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str, truth: str | None = None,
    sample: int | None = None, block_rows: int = BLOCK_ROWS, shared: Sequence[str] = (),
) -> DataFrame:
    """One rounded metric row per clustering with at least two clusters; the others have no row. `shared` names
    the keys whose clusterings are of the same vectors."""
    rows, k = _keyed(df, keys)
    counts = noise_summary(rows, *k).where(F.col("n_clusters") >= 2).drop("clustered")
    points = clustered_points(rows, k, id_column, vector_column, "euclidean").join(counts.select(*k), k, "left_semi")
    points = cut(points)  # read by every metric
    centres = centroids(points, k)
    measured = [
        silhouette(points, k, "id", "vector", sample=sample, block_rows=block_rows, shared=shared),
        _calinski_harabasz(points, centres, k),
        _davies_bouldin(points, centres, k),
    ]
    if truth:
        measured += [adjusted_rand(rows, k, truth), normalised_mutual_information(rows, k, truth)]
    out = counts
    for table in measured:
        out = out.join(table, k)
    digits = {"silhouette": 4, "calinski_harabasz": 2, "davies_bouldin": 4, "ari": 4, "nmi": 4}
    return out.withColumns({c: numbers.rounded(F.col(c), d) for c, d in digits.items() if c in out.columns}).drop("_all")

"""DBSCAN per slice."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import BLOCK_ROWS
from ..session import cut
from . import blocks
from .components import connected_components
from .ranking import value_positions


def _count_kernel(eps: float, metric: str) -> blocks.Kernel:
    """Per point the number of points within eps, copies counted, itself among them."""

    def kernel(left, right, key):
        a, wa = blocks.matrix(left), left["copies"].to_numpy()
        if right is None:
            d = blocks.distances(a, a, metric)
            np.fill_diagonal(d, 0.0)
            return pd.DataFrame({"id": left["id"], "near": (d <= eps) @ wa})
        hit = blocks.distances(a, blocks.matrix(right), metric) <= eps
        return pd.concat([
            pd.DataFrame({"id": left["id"], "near": hit @ right["copies"].to_numpy()}),
            pd.DataFrame({"id": right["id"], "near": hit.T @ wa}),
        ], ignore_index=True)

    return kernel


def added_counts(found: pd.DataFrame, own: bool) -> pd.DataFrame:
    return found.groupby("id", sort=False, dropna=False, as_index=False)["near"].sum()


def _local_roots(hit: np.ndarray) -> np.ndarray:
    """Smallest position of the component of each position, for a symmetric matrix of links."""
    n = len(hit)
    root = np.full(n, -1)
    for start in range(n):
        if root[start] >= 0:
            continue
        seen = np.zeros(n, dtype=bool)
        frontier = np.array([start])
        seen[start] = True
        while len(frontier):
            reached = hit[frontier].any(0) & ~seen
            seen |= reached
            frontier = np.flatnonzero(reached)
        root[seen] = start
    return root


def link_kernel(eps: float, metric: str) -> blocks.Kernel:
    """Links that say which core points hang together in a pair of pieces, one per point at most, and the
    smallest core point within eps of each border point."""

    def kernel(left, right, key):
        rows = left if right is None else pd.concat([left, right], ignore_index=True).sort_values("id", ignore_index=True)
        ids, core = rows["id"].to_numpy(), rows["core"].to_numpy().astype(bool)
        x = blocks.matrix(rows)
        inner, outer = x[core], x[~core]
        core_ids, border_ids = ids[core], ids[~core]
        out = []
        if len(inner):
            hit = blocks.distances(inner, inner, metric) <= eps
            np.fill_diagonal(hit, True)
            root = _local_roots(hit)
            out.append(pd.DataFrame({"u": core_ids, "v": core_ids[root], "core": True, "own": right is None}))
            if len(outer):
                near = blocks.distances(outer, inner, metric) <= eps
                has = near.any(1)
                out.append(pd.DataFrame({"u": border_ids[has], "v": core_ids[near[has].argmax(1)], "core": False, "own": right is None}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"u": ids[:0], "v": ids[:0], "core": core[:0], "own": core[:0]})

    return kernel


def linked_roots(found: pd.DataFrame, own: bool) -> pd.DataFrame:
    """The links of several pieces as those of one: every core point with the smallest one that hangs together with it, border points with
    their smallest core point."""
    core, border = found[found["core"].astype(bool)], found[~found["core"].astype(bool)]
    ids, at = np.unique(np.concatenate([core["u"].to_numpy(), core["v"].to_numpy()]), return_inverse=True)
    u, v = at[: len(core)], at[len(core) :]
    root = np.arange(len(ids))
    while True:  # roots take the smallest root they are linked to, then all go to the root of their root
        a, b = root[u], root[v]
        before = root.copy()
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    first = border.groupby("u", sort=False, as_index=False)["v"].min()
    return pd.concat([
        pd.DataFrame({"u": ids, "v": ids[root], "core": True, "own": own}),
        pd.DataFrame({"u": first["u"], "v": first["v"], "core": False, "own": own})], ignore_index=True)


def near_counts(
    df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str, eps: float, metric: str = "cosine",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Range self-join as a count: the points within eps of each point, itself among them: keys, id, near."""
    keys = list(keys)
    points = blocks.prepare(df, keys, id_column, vector_column, metric)
    copies = blocks.collapse_copies(points, keys)
    counts = _near_counts(blocks.split_into_blocks(copies.distinct, keys, block_rows), eps, metric)
    return copies.members.join(counts, [*keys, "id"]).select(*keys, F.col("member").alias("id"), "near")


def _near_counts(blocked: blocks.Blocked, eps: float, metric: str) -> DataFrame:
    kind = blocked.points.schema["id"].dataType.simpleString()
    reach = blocks.euclidean_radius(eps, metric)
    counts = blocks.run_on_pairs(blocked, _count_kernel(eps, metric), f"id {kind}, near bigint", reach, carry=["copies"], combine=added_counts)
    return counts.groupBy(*blocked.keys, "id").agg(F.sum("near").alias("near"))


def dbscan(
    df: DataFrame,
    keys: Sequence[str],
    id_column: str,
    vector_column: str,
    eps: float = 0.25,
    min_points: int = 5,
    metric: str = "cosine",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Cluster of every point, -1 for noise: keys, id, cluster, is_core.

    A point is core with `min_points` points within eps, itself counted. Clusters are the components of the
    core points; a border point joins the cluster of its smallest core point. Clusters are numbered by their
    smallest core point. Copies count as points but are compared once.
    """
    keys = list(keys)
    points = blocks.prepare(df, keys, id_column, vector_column, metric)
    copies = blocks.collapse_copies(points, keys)
    blocked = blocks.split_into_blocks(copies.distinct, keys, block_rows)
    kind = points.schema["id"].dataType.simpleString()
    reach = blocks.euclidean_radius(eps, metric)

    core = _near_counts(blocked, eps, metric).select(*keys, "id", (F.col("near") >= min_points).alias("core"))
    marked = blocked.with_columns_of(cut(core))
    schema = f"u {kind}, v {kind}, core boolean, own boolean"
    links = cut(blocks.run_on_pairs(marked, link_kernel(eps, metric), schema, reach, carry=["core"], combine=linked_roots))

    # Inside a tile every core point has its root; between tiles only the roots are joined.
    inside = links.where("core AND own").select(*keys, F.col("u").alias("id"), F.col("v").alias("root"))
    between = links.where("core AND NOT own AND u <> v").select(*keys, "u", "v")
    for end in ("u", "v"):
        between = between.join(inside.select(*keys, F.col("id").alias(end), "root"), [*keys, end]).withColumn(end, F.col("root")).drop("root")
    found = connected_components(between.distinct(), keys).withColumnRenamed("id", "root")
    roots = inside.join(found, [*keys, "root"], "left").select(*keys, "id", F.coalesce("component", "root").alias("component"))
    return labelled_members(copies, roots, links.where(~F.col("core")).select(*keys, "u", "v"), keys)


def labelled_members(copies: blocks.Copies, roots: DataFrame, reached: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Clusters of all points from the component of each core point (keys, id, component) and the links of border points to core points (keys, u, v)."""
    border = reached.groupBy(*keys, "u").agg(F.min("v").alias("v"))
    border = border.join(roots.withColumnRenamed("id", "v"), [*keys, "v"]).select(*keys, F.col("u").alias("id"), "component")
    labelled = roots.withColumn("is_core", F.lit(True)).unionByName(border.withColumn("is_core", F.lit(False)))
    numbers = number_components(roots, keys)
    return (
        copies.members.join(labelled, [*keys, "id"], "left").join(numbers, [*keys, "component"], "left")
        .select(*keys, F.col("member").alias("id"), F.coalesce("cluster", F.lit(-1)).alias("cluster"),
                F.coalesce("is_core", F.lit(False)).alias("is_core"))
    )


def number_components(roots: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Numbers 0..n-1 of the components of each slice in the order of their ids: keys, component, cluster."""
    keyed = roots.select(*keys, "component").distinct().withColumn("_one", F.lit(0))
    at = value_positions(keyed, [*keys, "_one"], "component")
    return at.select(*keys, "component", (F.col("n_total") - F.col("n_above") - 1).cast("int").alias("cluster"))

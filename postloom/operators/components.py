"""Connected components of an edge table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, discard


def connected_components(edges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Smallest id of the component of every node that has an edge: keys, id, component.

    `edges` has keys, u, v. Large-star and small-star rounds (Kiveris et al., 2014) until nothing changes;
    each ends in a written table. The centre of a star may have very many leaves: the smallest
    neighbours are combined on the map side and written first, so that both sides of the join that
    brings them back are scans with a shuffle of their own, whose large partitions adaptive execution splits.
    """
    keys = list(keys)
    links = cut(edges.where(F.col("u") != F.col("v")).select(
        *keys, F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        low = cut(_smallest_around(links, keys))
        large = cut(_large_star(links, low, keys))
        least = cut(large.groupBy(*keys, "u").agg(F.min("v").alias("m")))
        after = cut(_small_star(large, least, keys))
        discard(links, low, large, least)
        links = after
        state = tuple(links.agg(
            F.count("*"), F.sum(F.xxhash64(*keys, "u", "v").cast("decimal(38,0)"))
        ).first())
        if state == before or state[0] == 0:
            break
        before = state
    roots = links.select(*keys, F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return links.select(*keys, F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)


def _both_ways(links: DataFrame, keys: list[str]) -> DataFrame:
    return links.unionByName(links.select(*keys, F.col("v").alias("u"), F.col("u").alias("v")))


def _smallest_around(links: DataFrame, keys: list[str]) -> DataFrame:
    """The smallest among a node and its neighbours."""
    return _both_ways(links, keys).groupBy(*keys, "u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def _large_star(links: DataFrame, low: DataFrame, keys: list[str]) -> DataFrame:
    """Link the larger neighbours of a node to the smallest among its neighbours and itself."""
    return (
        _both_ways(links, keys).where(F.col("v") > F.col("u")).join(low, [*keys, "u"])
        .select(*keys, F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
    )


def _small_star(links: DataFrame, least: DataFrame, keys: list[str]) -> DataFrame:
    """Link the smaller neighbours of a node, and the node, to the smallest of them. Links point from the
    larger to the smaller id already."""
    neighbours = links.join(least, [*keys, "u"]).select(*keys, F.col("v").alias("u"), F.col("m").alias("v"))
    own = least.select(*keys, "u", F.col("m").alias("v"))
    return neighbours.unionByName(own).where("u <> v").distinct()

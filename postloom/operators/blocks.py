"""Work on pairs of vectors without making rows of pairs.

Vectors are split into blocks of bounded size around pivots, and blocks are put together in tiles, of which a slice has a few. A task
compares two tiles (`run_on_pairs`), or vectors that visit a tile (`visit`): so a vector travels once for each tile, not for
each block. Inside, it goes through pieces of whole blocks, computes the distances of two pieces as one matrix product, and gives back a
summary per vector (nearest neighbours, a count, a lightest edge), put together for the whole tile, never the pairs
themselves. What cannot hold a pair of interest is left out by the triangle inequality. A slice of one block takes the same way as
one of many: it has no other block to meet.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import BLOCK_ROWS
from ..functions import vectors
from ..session import cut, growing
from .ranking import top_rows

# Rows of a slice that one task compares with the pivots, and visitors that a tile gets at once.
CHUNK_ROWS = 20_000
VISITORS = 32_768
# Tiles of a single slice, each of several has fewer; numbers that the vectors of a tile hold at most.
TILES = 16
TILE_NUMBERS = 2_000_000
# Rows of a summary that are put together at once.
_SUMMARY_ROWS = 500_000
# Pairs that are looked at together, which should fit a cache.
_PAIRS = 500_000
_SUB_BITS = 1 << 32

# kernel(left, right, key): `right` is None when a piece meets itself; both are sorted by id.
Kernel = Callable[[pd.DataFrame, "pd.DataFrame | None", tuple], pd.DataFrame]
# combine(found, own): one summary of several, all of one tile (`own`) or of a pair; it may get summaries of its own again.
Combine = Callable[[pd.DataFrame, bool], pd.DataFrame]


def matrix(rows: pd.DataFrame) -> np.ndarray:
    return np.stack(rows["vector"].to_numpy()).astype(np.float64)


def distances(a: np.ndarray, b: np.ndarray, metric: str) -> np.ndarray:
    """Distance matrix. Cosine expects vectors of unit length."""
    if metric == "cosine":
        return np.clip(1.0 - a @ b.T, 0.0, 2.0)
    squared = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squared, 0.0))


def pairs_within(a: np.ndarray, b: np.ndarray, reach: np.ndarray, metric: str) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs of rows that may be within `reach`, a Euclidean distance for each row of `a`: their positions and distances, batch by batch.

    One product says which pairs are near, with some more that rounding leaves in; the distances of the others are never made.
    """
    own, squares = (a * a).sum(1), (b * b).sum(1)
    limit = reach * reach * (1 + 1e-9) - own + 1e-9 * (own + squares.max(initial=0.0))
    wide, tall = np.concatenate([-2.0 * a, np.ones((len(a), 1))], 1), np.concatenate([b, squares[:, None]], 1).T
    for lo in range(0, len(a), step := max(1, _PAIRS // max(len(b), 1))):
        i, j = np.nonzero(wide[lo : lo + step] @ tall <= limit[lo : lo + step, None])
        if len(i) * 16 > step * len(b):
            yield i + lo, j, distances(a[lo : lo + step], b, metric)[i, j]
        elif len(i):
            product = np.einsum("ij,ij->i", a[i + lo], b[j])
            d = np.clip(1.0 - product, 0.0, 2.0) if metric == "cosine" else np.sqrt(np.maximum(own[i + lo] + squares[j] - 2.0 * product, 0.0))
            yield i + lo, j, d


def euclidean_radius(radius: float, metric: str) -> float:
    """The Euclidean radius that a radius means on the stored vectors. A cosine distance of 1 or more
    also reaches zero vectors, which have no direction, so it does not bound anything."""
    if metric != "cosine":
        return radius
    return math.sqrt(2.0 * radius) if radius < 1.0 else math.inf


@dataclass(frozen=True)
class Copies:
    """Distinct vectors with the number of their copies, and who is a copy of whom."""

    distinct: DataFrame  # keys, id, vector, copies
    members: DataFrame  # keys, member, id


def prepare(df: DataFrame, keys: Sequence[str], id_column: str, vector_column: str, metric: str) -> DataFrame:
    """keys, id, vector (doubles; of unit length for cosine)."""
    v = F.col(vector_column)
    unit = vectors.l2_normalised(v) if metric == "cosine" else vectors.as_double(v)
    return df.select(*keys, F.col(id_column).alias("id"), unit.alias("vector"))


def collapse_copies(points: DataFrame, keys: Sequence[str]) -> Copies:
    """Equal vectors become one with a count, so that a large group of copies costs one row. The copy
    with the smallest id stands for all."""
    keyed = points.withColumn("_h", F.xxhash64("vector"))
    distinct = keyed.groupBy(*keys, "_h", "vector").agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    distinct = cut(distinct)
    members = keyed.select(*keys, "_h", "vector", F.col("id").alias("member")).join(growing(distinct), [*keys, "_h", "vector"])
    return Copies(distinct.drop("_h"), members.select(*keys, "member", "id"))


def largest_slice(points: DataFrame, keys: Sequence[str]) -> int:
    return points.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


# Blocks ----------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Blocked:
    """Points with their block, and what is known of each block."""

    points: DataFrame  # keys, id, vector, ..., chunk, cell, away (from the pivot of the cell), block, tile
    blocks: DataFrame  # keys, block, tile, cell, pivot, pivot_id, radius (largest `away`), rows, chunks (of the slice)
    keys: tuple[str, ...]
    most: int  # blocks of the largest slice
    tiles: int  # tiles of the slice that has most of them

    def with_columns_of(self, other: DataFrame) -> "Blocked":
        """The same blocks, the points with the columns of a table (keys, id, ...)."""
        return replace(self, points=self.points.join(growing(other), [*self.keys, "id"]))

    def key_ddl(self) -> str:
        return "".join(f"`{k}` {self.points.schema[k].dataType.simpleString()}, " for k in self.keys)

    def id_type(self) -> str:
        return self.points.schema["id"].dataType.simpleString()


def _with_keys(keys: Sequence[str], values: tuple, out: pd.DataFrame) -> pd.DataFrame:
    for i, k in enumerate(keys):
        out.insert(i, k, pd.Series([values[i]] * len(out), index=out.index, dtype=object))  # also right without rows
    return out


def split_into_blocks(points: DataFrame, keys: Sequence[str], block_rows: int = BLOCK_ROWS) -> Blocked:
    """Give every point the cell of its nearest pivot and a block of about `block_rows` points inside it.

    A slice of n points has min(n / block_rows, sqrt(n)) pivots, points of its own picked by hash, so comparing all points with them costs
    n ** 1.5 at most. Pivots are rows beside chunks of the slice; nothing is collected.
    """
    keys = tuple(keys)
    draw = F.shiftrightunsigned(F.xxhash64("id", F.lit(3)), 11) / float(2**53)
    drawn = points.withColumn("_draw", draw)
    wanted = F.ceil(F.least(F.col("_n") / block_rows, F.sqrt("_n"))).cast("int")
    sizes = cut(drawn.groupBy(*keys).agg(F.count("*").alias("_n"), F.min("_draw").alias("_low"), F.max(F.size("vector")).alias("_width")).select(
        *keys, "_n", "_low", "_width", wanted.alias("_wanted"), F.ceil(F.col("_n") / CHUNK_ROWS).cast("int").alias("chunks")))
    # A threshold passes a few more points than wanted, and the first one always; only these are numbered.
    limit = F.when(F.col("_wanted") > 1, (F.col("_wanted") + 6 * F.sqrt("_wanted") + 10) / F.col("_n")).otherwise(F.col("_low"))
    passed = drawn.join(sizes, list(keys)).where(F.col("_draw") <= F.greatest(limit, F.col("_low")))
    ranked = top_rows(passed, keys, [F.asc("_draw"), F.asc("id")], 1 << 30, "_at").where(F.col("_at") <= F.col("_wanted"))
    pivots = cut(ranked.select(*keys, (F.col("_at") - 1).alias("cell"), F.col("vector").alias("pivot"), F.col("id").alias("pivot_id"), "chunks"))

    def nearest(key, rows, cells):
        cells = cells.sort_values("cell", ignore_index=True)
        centre = np.stack(cells["pivot"].to_numpy())
        cell, away = np.empty(len(rows), np.int64), np.empty(len(rows))
        for at in batches(len(rows), len(cells)):
            d = distances(matrix(rows.iloc[at]), centre, "euclidean")
            cell[at], away[at] = d.argmin(1), d.min(1)
        rows = rows.assign(cell=cells["cell"].to_numpy()[cell], away=away)
        return rows[[f.name for f in schema.fields]]

    chunked = points.join(sizes.select(*keys, "chunks"), list(keys)).withColumn(
        "chunk", F.pmod(F.xxhash64("id", F.lit(5)), F.col("chunks")).cast("int")).drop("chunks")
    schema = T.StructType([*chunked.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())])
    beside = pivots.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    group = [*keys, "chunk"]
    celled = cut(chunked.groupBy(*group).cogroup(beside.groupBy(*group)).applyInPandas(nearest, schema))
    # Tiles are runs of blocks in the order of their cells; the blocks of a cell count as full.
    tiles = math.ceil(TILES / math.sqrt(max(sizes.count(), 1)))
    tile_rows = F.greatest(F.least(F.ceil(F.col("_n") / tiles), F.lit(TILE_NUMBERS) / F.greatest("_width", F.lit(1))), F.lit(block_rows))
    before = Window.partitionBy(*keys).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    counted = celled.groupBy(*keys, "cell").agg(F.count("*").alias("_rows")).withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    parts = counted.join(sizes.select(*keys, tile_rows.alias("_tile_rows")), list(keys)).select(
        *keys, "cell", "_before", "_tile_rows", F.ceil(F.col("_rows") / F.lit(block_rows)).alias("_parts"))
    part = F.pmod(F.xxhash64("id", F.lit(7)), F.col("_parts"))
    blocked = cut(celled.join(parts, [*keys, "cell"]).withColumn("_part", part).withColumns({
        "block": F.col("cell") * F.lit(_SUB_BITS) + F.col("_part"),
        "tile": F.floor((F.col("_before") + F.col("_part") * F.lit(block_rows)) / F.col("_tile_rows")).cast("int"),
    }).drop("_part", "_parts", "_before", "_tile_rows"))
    known = cut(blocked.groupBy(*keys, "cell", "block", "tile").agg(F.max("away").alias("radius"), F.count("*").alias("rows")).join(
        pivots, [*keys, "cell"]))
    return Blocked(blocked, known, keys, largest_slice(known, keys), largest_slice(known.select(*keys, "tile").distinct(), keys))


def batches(rows: int, columns: int) -> list[slice]:
    """Slices of rows whose matrices have a few million cells."""
    step = max(1, 4_000_000 // max(columns, 1))
    return [slice(at, at + step) for at in range(0, rows, step)]


def lower_bounds(rows: pd.DataFrame, blocks: pd.DataFrame) -> np.ndarray:
    """Euclidean distance that each row has at least to any point of each block.

    A point q of the block is within its radius of the pivot, and no nearer to the pivot of the row than to its own.
    """
    cell, at = np.unique(blocks["cell"].to_numpy(), return_index=True)
    to_pivot = distances(matrix(rows), np.stack(blocks["pivot"].to_numpy()[at]), "euclidean")
    d = to_pivot[:, np.searchsorted(cell, blocks["cell"].to_numpy())]
    return np.maximum(np.maximum(d - blocks["radius"].to_numpy(), (d - rows["away"].to_numpy()[:, None]) / 2), 0.0)


def beside_blocks(blocked: Blocked, points: DataFrame, blocks: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Give `work` chunks of the points of a slice with all rows of `blocks` of the slice, in batches of rows."""
    keys = list(blocked.keys)
    names = _names(schema)  # a task has no session to read it

    def run(key, rows, known):
        known = known.sort_values("block", ignore_index=True)
        parts = [work(rows.iloc[at], known) for at in batches(len(rows), len(known))] if len(known) else []
        out = pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=names)
        return _with_keys(keys, key, out)

    group = [*keys, "chunk"]
    beside = blocks.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    return points.groupBy(*group).cogroup(beside.groupBy(*group)).applyInPandas(run, blocked.key_ddl() + schema)


def beside_table(points: DataFrame, table: DataFrame, keys: Sequence[str], work: Callable, schema: str) -> DataFrame:
    """Give `work` chunks of the points of a slice with all rows that a (much smaller) table has for the slice."""
    keys = list(keys)
    sizes = points.groupBy(*keys).agg(F.ceil(F.count("*") / CHUNK_ROWS).cast("int").alias("_chunks"))
    chunked = points.join(sizes, keys).withColumn("_chunk", F.pmod(F.xxhash64("id", F.lit(13)), F.col("_chunks")).cast("int")).drop("_chunks")
    copied = table.join(sizes, keys).withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1))).drop("_chunks")
    copied = copied.toDF(*copied.columns)
    group = [*keys, "_chunk"]
    key_ddl = "".join(f"`{k}` {points.schema[k].dataType.simpleString()}, " for k in keys)
    names = _names(schema)

    def run(key, rows, known):
        parts = [work(rows.iloc[at], known) for at in batches(len(rows), len(known))] if len(known) else []
        return _with_keys(keys, key, pd.concat(parts, ignore_index=True) if parts else pd.DataFrame(columns=names))

    return chunked.groupBy(*group).cogroup(copied.groupBy(*group)).applyInPandas(run, key_ddl + schema)


def tiles_within(low: np.ndarray, known: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The tiles of some blocks, sorted by block, and the least of the bounds that each row has to the blocks of each tile."""
    tiles, starts = np.unique(known["tile"].to_numpy(), return_index=True)
    return tiles, np.minimum.reduceat(low, starts, axis=1)


@dataclass(frozen=True)
class Piece:
    """Whole blocks of a tile that are compared with others at once, sorted by id."""

    rows: pd.DataFrame
    x: np.ndarray
    middle: np.ndarray
    radius: float


def _pieces(rows: pd.DataFrame) -> list[Piece]:
    """The blocks of a tile, small ones of a cell and its neighbours together."""
    rows = rows.sort_values(["block", "id"], ignore_index=True)
    block = rows["block"].to_numpy()
    ends = np.append(np.flatnonzero(block[1:] != block[:-1]) + 1, len(rows))
    out, first, last = [], 0, 0
    for end in [*ends.tolist(), None]:
        if end is None or (end - first > BLOCK_ROWS and last > first):
            part = rows.iloc[first:last].sort_values("id", ignore_index=True)
            x = matrix(part)
            middle = x.mean(0, keepdims=True)
            out.append(Piece(part, x, middle, float(distances(x, middle, "euclidean").max())))
            first = last
        last = end
    return out


class _Summary:
    """What kernels give back, put together as it grows."""

    def __init__(self, columns: Sequence[str], combine: Combine | None, own: bool, most: int = _SUMMARY_ROWS):
        self.columns, self.combine, self.own = list(columns), combine, own
        self.parts: list[pd.DataFrame] = []
        self.rows, self.limit, self.most = 0, most, most

    def add(self, found: pd.DataFrame) -> None:
        if len(found):
            self.parts.append(found)
            self.rows += len(found)
            if self.combine and self.rows > self.limit:
                self._together()
                self.limit = self.rows + self.most

    def _together(self) -> None:
        self.parts = [self.combine(pd.concat(self.parts, ignore_index=True), self.own)]
        self.rows = len(self.parts[0])

    def result(self) -> pd.DataFrame:
        if not self.parts:
            return pd.DataFrame(columns=self.columns)
        if self.combine:
            self._together()
        return pd.concat(self.parts, ignore_index=True)[self.columns]


def visit(
    blocked: Blocked, visits: DataFrame, visitors: DataFrame, kernel: Callable, schema: str, carry: Sequence[str] = (),
    combine: Combine | None = None, wanted: Callable[[pd.DataFrame, pd.DataFrame], np.ndarray] | None = None,
) -> DataFrame:
    """Run the kernel (visitors, points of a piece of the tile, the vectors of both) for all `visits` (keys, id, tile, reach, ...; a written table).

    `visitors` has the vectors and further columns of the visiting points. They meet those pieces of the tile that may hold a point within
    `reach`, a Euclidean distance, and of which they want to know anything. A tile with many visitors gets them in groups of about `VISITORS`.
    """
    keys = list(blocked.keys)
    # Both sides of a cogroup are dealt by the hash of its keys, which differs between types.
    visits = visits.withColumn("tile", F.col("tile").cast(blocked.points.schema["tile"].dataType))
    groups = visits.groupBy(*keys, "tile").agg(F.ceil(F.count("*") / F.lit(VISITORS)).cast("int").alias("_groups"))
    dealt = visits.join(groups, [*keys, "tile"]).withColumn("_group", F.pmod(F.xxhash64("id", F.lit(11)), F.col("_groups")).cast("int"))
    coming = dealt.drop("_groups").join(growing(visitors), [*keys, "id"])
    hosts = blocked.points.select(*keys, "tile", "block", "id", "vector", *carry).join(groups, [*keys, "tile"]).withColumn(
        "_group", F.explode(F.sequence(F.lit(0), F.col("_groups") - 1)))
    hosts = hosts.toDF(*hosts.columns)  # both sides come from one table: new names for the columns of this one
    group = [*keys, "tile", "_group"]
    names = _names(schema)

    def run(key, left, right):
        summary = _Summary(names, combine, False)
        pieces = _pieces(right) if len(left) and len(right) else []
        left = left.sort_values("id", ignore_index=True)
        for at in range(0, len(left) if pieces else 0, BLOCK_ROWS):
            some = left.iloc[at : at + BLOCK_ROWS]
            x = matrix(some)
            # A tolerance keeps pieces that only rounding puts out of reach.
            to_middle = distances(x, np.concatenate([p.middle for p in pieces]), "euclidean")
            near = to_middle - np.array([p.radius for p in pieces]) <= some["reach"].to_numpy()[:, None] + 1e-6
            for i, piece in enumerate(pieces):
                mine = near[:, i] if wanted is None else near[:, i] & wanted(some, piece.rows)
                if mine.any():
                    summary.add(kernel(some[mine].reset_index(drop=True), piece.rows, x[mine], piece.x))
        return _with_keys(keys, key, summary.result())

    return coming.groupBy(*group).cogroup(hosts.groupBy(*group)).applyInPandas(run, blocked.key_ddl() + schema)


def on_own_blocks(blocked: Blocked, kernel: Kernel, schema: str, carry: Sequence[str] = ()) -> DataFrame:
    """Run the kernel on every block by itself."""
    keys = list(blocked.keys)

    def single(key, rows):
        return _with_keys(keys, key, kernel(rows.sort_values("id", ignore_index=True), None, key[: len(keys)]))

    points = blocked.points.select(*keys, "id", "vector", *carry, "block")
    return points.groupBy(*keys, "block").applyInPandas(single, blocked.key_ddl() + schema)


def tile_pairs(blocked: Blocked, reach: float) -> DataFrame:
    """Pairs of different tiles of a slice that may hold two points within reach: keys, left, right."""
    keys = list(blocked.keys)
    few = blocked.blocks.withColumn("chunk", F.pmod(F.xxhash64("block"), F.col("chunks")).cast("int"))

    def near(rows, known):
        a, b = np.stack(rows["pivot"].to_numpy()), np.stack(known["pivot"].to_numpy())
        gap = distances(a, b, "euclidean") - rows["radius"].to_numpy()[:, None] - known["radius"].to_numpy()[None, :]
        tiles, least = tiles_within(gap, known)
        # A tolerance keeps pairs that only rounding puts out of reach.
        i, j = np.nonzero(least <= reach + 1e-6)
        found = np.stack([rows["tile"].to_numpy()[i], tiles[j]], 1).reshape(-1, 2)
        found = np.unique(np.sort(found[found[:, 0] != found[:, 1]], axis=1), axis=0)
        return pd.DataFrame({"left": found[:, 0], "right": found[:, 1]})

    points = few.select(*keys, "chunk", "tile", "pivot", "radius")
    return beside_blocks(blocked, points, blocked.blocks, near, "left int, right int").distinct()


def run_on_pairs(
    blocked: Blocked, kernel: Kernel, schema: str, reach: float = math.inf, carry: Sequence[str] = (), combine: Combine | None = None,
    summary_rows: int = _SUMMARY_ROWS,
) -> DataFrame:
    """Run the kernel on all points of a slice that may be within reach of each other, piece by piece, in each tile and each pair of tiles.

    Returns keys plus the columns of `schema`. `carry` names further columns that the kernel reads. `combine` makes one summary of
    those of the pieces of a tile or a pair, whenever about `summary_rows` have come together.
    """
    keys = list(blocked.keys)
    ddl = blocked.key_ddl()
    names = _names(schema)

    def meet(summary, a, b, key):
        gap = float(distances(a.middle, b.middle, "euclidean")[0, 0]) - a.radius - b.radius
        if gap <= reach + 1e-6:
            summary.add(kernel(a.rows, b.rows, key[: len(keys)]))

    def single(key, rows):
        summary = _Summary(names, combine, True, summary_rows)
        pieces = _pieces(rows)
        for i, a in enumerate(pieces):
            summary.add(kernel(a.rows, None, key[: len(keys)]))
            for b in pieces[:i]:
                meet(summary, b, a, key)
        return _with_keys(keys, key, summary.result())

    points = blocked.points.select(*keys, "tile", "block", "id", "vector", *carry)
    own = points.groupBy(*keys, "tile").applyInPandas(single, ddl + schema)
    if blocked.tiles < 2:
        return own

    def pair(key, left, right):
        summary = _Summary(names, combine, False, summary_rows)
        if len(left) and len(right):
            others = _pieces(right)
            for a in _pieces(left):
                for b in others:
                    meet(summary, a, b, key)
        return _with_keys(keys, key, summary.result())

    pairs = cut(tile_pairs(blocked, reach))
    lefts = points.withColumnRenamed("tile", "left").join(pairs, [*keys, "left"])
    rights = points.withColumnRenamed("tile", "right").join(pairs, [*keys, "right"])
    rights = rights.toDF(*rights.columns)
    group = [*keys, "left", "right"]
    return own.unionByName(lefts.groupBy(*group).cogroup(rights.groupBy(*group)).applyInPandas(pair, ddl + schema))


def _names(ddl: str) -> list[str]:
    return [f.name for f in T.StructType.fromDDL(ddl).fields]

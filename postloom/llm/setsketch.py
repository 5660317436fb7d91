"""Near-duplicate documents by SetSketch registers.

A document is the set of its distinct runs of five words. Every element sends a Poisson stream of arrival times to
`registers` registers; a register keeps its smallest time x, rounded to 1 - log_b(x) and cut off to 16 bits, so that
the registers of a union are the maxima of the registers. Elements stop as soon as their next arrival is later than
every register's time, which makes a sketch cost about the size of the set.

1. Documents with equal sets (by size and 128 bits) are one class; its smallest id stands for it.
2. Bands of registers are hashed; representatives with an equal band meet in a bucket.
3. Every member of a bucket is paired with its most central member, the one that meets most others in all its buckets; a
   joint likelihood of the two sketches drops pairs far below the threshold, and the rest is confirmed on the full sets.
4. Links form components. Pairs inside one cannot change it, so what is left are pairs between components that meet in a
   bucket. Components that meet form a cluster; in it, documents outside the largest component are compared with all
   others, in tiles of two blocks of documents: a task estimates all pairs of a tile, confirms the likely ones that are
   not united yet, and gives back links only. So components are those of all candidate pairs, and pairs are never rows.

The band width follows from the threshold: the widest whose chance to miss a pair at the threshold is below `MISS`.

Defined results: documents without words have an empty set and no links; fewer words than a run are one element; rows
that share an id are versions of one document, linked if one of them is, and each gets a row; rows without an id count as
one document that comes before all others, and its id stays null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..session import cut, release, ship_package
from .common import NO_ID, WordHashes, id_key, map_rows, mixed, run_hashes, text_bytes, words

SHINGLE = 5
REGISTERS = 400
BASE = 1.001
LOWEST = -20_000  # register values start here: x up to b ** 20000
MISS = 1e-6
TILE = 256  # documents of a block


def band_width(threshold: float, registers: int = REGISTERS) -> int:
    """Registers to a band."""
    for width in range(registers, 1, -1):
        if (1 - threshold**width) ** (registers // width) <= MISS:
            return width
    return 1


def shingles(found: list[bytes], cache: WordHashes, length: int = SHINGLE) -> np.ndarray:
    """Sorted hashes of the distinct runs of words."""
    if not found:
        return np.empty(0, np.uint64)
    hashes = cache.of(found)
    if len(hashes) < length:
        return mixed(run_hashes(hashes, len(hashes)), 100 + len(hashes))
    return np.unique(run_hashes(hashes, length))


def sketch(elements: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """Register values of a set, larger for larger sets; the minima of a set are the times of its first arrivals."""
    low = np.full(registers, np.inf)
    active, times, step = elements, np.zeros(len(elements)), 0
    columns = max(1, min(64, int(registers * (np.log(registers) + 1) / max(len(elements), 1)) + 1))
    while len(active):
        draws = mixed(active[:, None] + np.arange(2 * step, 2 * (step + columns), 2, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
        gaps = -np.log(((draws >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / registers
        arrivals = times[:, None] + np.cumsum(gaps, axis=1)
        np.minimum.at(low, (mixed(draws, 7) % np.uint64(registers)).astype(np.int64).ravel(), arrivals.ravel())
        step += columns
        times = arrivals[:, -1]
        late = times < low.max()
        active, times = active[late], times[late]
        columns = min(64, columns + 2)
    if not len(elements):
        return np.zeros(registers, np.uint16)
    values = np.floor(1 - np.log(low) / np.log(BASE)) - LOWEST
    return np.clip(values, 0, 65_535).astype(np.uint16)


def likely_similarity(a: np.ndarray, b: np.ndarray, sizes_a: np.ndarray, sizes_b: np.ndarray) -> np.ndarray:
    """Maximum-likelihood similarity of pairs of sketches (rows) with known sizes, from larger, smaller and equal registers."""
    more = (a > b).sum(1)
    less = (a < b).sum(1)
    same = a.shape[1] - more - less
    u = sizes_a / (sizes_a + sizes_b)
    v = 1 - u
    most = np.minimum(u / v, v / u)

    def chance(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)

    def score(j: np.ndarray) -> np.ndarray:
        up, down = chance(u - v * j), chance(v - u * j)
        with np.errstate(divide="ignore", invalid="ignore"):
            total = np.where(more > 0, more * np.log(up), 0) + np.where(less > 0, less * np.log(down), 0)
            return total + np.where(same > 0, same * np.log(np.maximum(1 - up - down, 1e-300)), 0)

    low, high = np.zeros(len(u)), most.copy()
    ratio = (np.sqrt(5) - 1) / 2
    for _ in range(32):  # golden section: the likelihood is concave
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        worse = score(left) < score(right)
        low, high = np.where(worse, left, low), np.where(worse, high, right)
    return (low + high) / 2


def sketches(docs: DataFrame, width: int, registers: int = REGISTERS, length: int = SHINGLE) -> DataFrame:
    """id, n (elements), d1, d2 (digest of the set), bands, registers."""
    bands = registers // width

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        cache = WordHashes()
        band_steps = mixed(np.arange(bands, dtype=np.uint64), 3)
        for row in each:
            found = shingles(words(row["text"].lower()), cache, length)
            values = sketch(found, registers)
            keys = band_steps.copy()
            for i in range(width):
                keys = mixed(keys + values[i : bands * width : width].astype(np.uint64), i)
            d1, d2 = (int(mixed(found, k).sum(dtype=np.uint64).view(np.int64)) for k in (11, 12))
            yield row["id"], len(found), d1, d2, keys.view(np.int64).tolist() if len(found) else [], values.tobytes()

    arrow = pa.schema([
        ("id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("bands", pa.list_(pa.int64())),
        ("registers", pa.binary())])
    return map_rows(docs, rows, "id long, n long, d1 long, d2 long, bands array<long>, registers binary", arrow)


def _least(threshold: float, registers: int) -> float:
    return threshold - 6 * np.sqrt(threshold * (1 - threshold) / registers)


def _likely(pairs: DataFrame, made: DataFrame, threshold: float, registers: int) -> DataFrame:
    """Pairs whose joint likelihood is highest less than six deviations below the threshold."""
    least = _least(threshold, registers)
    side = lambda c: made.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint16).reshape(-1, registers).astype(np.int32) for c in ("r_a", "r_b"))
                na, nb = (part.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("n_a", "n_b"))
                good = likely_similarity(a, b, na, nb) >= least
                yield part.select(["a", "b"]).filter(pa.array(good))

    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b").mapInArrow(keep, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int, length: int) -> DataFrame:
    """Pairs whose full sets are as similar as asked for."""
    wanted = cut(pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).distinct())
    texts = cut(docs.join(wanted, "id", "left_semi"))
    side = lambda c: texts.select(F.col("id").alias(c), F.col("text").alias(f"t_{c}"))

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        cache = WordHashes(200_000)
        before, left = None, None
        for row in each:
            if row["t_a"] != before:
                before = row["t_a"]
                left = shingles(words(before.lower()), cache, length)
            right = shingles(words(row["t_b"].lower()), cache, length)
            both = len(np.intersect1d(left, right, assume_unique=True))
            if 100 * both >= percent * (len(left) + len(right) - both):
                yield row["a"], row["b"]

    joined = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "t_a", "t_b").sortWithinPartitions("a")
    return map_rows(joined, rows, "a long, b long", pa.schema([("a", pa.int64()), ("b", pa.int64())]))


def _cross_links(placed: DataFrame, made: DataFrame, source: DataFrame, percent: int, registers: int, length: int) -> DataFrame:
    """Links between components that meet in a bucket. `placed`: band, id, component."""
    spark = placed.sparkSession
    main = cut(
        placed.groupBy("band", "component").agg(F.count("*").alias("members")).groupBy("band")
        .agg(F.max_by("component", F.struct("members", "component")).alias("main"), F.count("*").alias("parts"))
        .where("parts > 1").select("band", "main"))
    still = cut(placed.join(main, "band").select("id", "component", "main").distinct())
    met = cut(still.where("component <> main").select(F.col("component").alias("u"), F.col("main").alias("v")).distinct())
    cluster = cut(connected_components(met, []).select(F.col("id").alias("component"), F.col("component").alias("cluster")))
    docs = cut(still.select("id", "component").distinct().join(cluster, "component"))
    largest = (
        docs.groupBy("cluster", "component").agg(F.count("*").alias("members")).groupBy("cluster")
        .agg(F.max_by("component", F.struct("members", "component")).alias("largest"), F.sum("members").alias("members")))
    # A block has about TILE documents; blocks of the documents outside the largest component meet all blocks.
    block = F.pmod(F.xxhash64("id", F.lit("block")), F.ceil(F.col("members") / TILE)).cast("int")
    dealt = cut(docs.join(cut(largest), "cluster").select("cluster", "id", "component", (F.col("component") != F.col("largest")).alias("outside"), block.alias("block")))
    release(spark, main, still, met, cluster)
    documents = cut(dealt.join(made.select("id", "n", "registers"), "id").join(source, "id"))
    sizes = dealt.groupBy("cluster").agg(F.collect_set(F.when(F.col("outside"), F.col("block"))).alias("left"), F.collect_set("block").alias("right"))
    tiles = cut(sizes.select("cluster", F.explode("left").alias("left"), "right").select("cluster", "left", F.explode("right").alias("right")))
    tile = ["cluster", "left", "right"]
    lefts = documents.where("outside").withColumnRenamed("block", "left").join(tiles, ["cluster", "left"])
    rights = documents.withColumnRenamed("block", "right").join(tiles, ["cluster", "right"])

    def links(left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(_tile_links(left.to_pylist(), right.to_pylist(), WordHashes(200_000), percent, registers, length))
        return pa.table({c: pa.array([f[i] for f in found], pa.int64()) for i, c in enumerate("ab")})

    # Both sides come from one table; the right one gets columns of its own.
    columns = [*tile, "id", "component", "outside", "n", "registers", "text"]
    own = rights.select(*(F.col(c).alias(f"r_{c}") for c in columns)).select(*(F.col(f"r_{c}").alias(c) for c in columns))
    return lefts.select(*columns).groupBy(*tile).cogroup(own.groupBy(*tile)).applyInArrow(links, "a long, b long")


def _tile_links(left: list[dict], right: list[dict], cache: WordHashes, percent: int, registers: int, length: int) -> Iterator[tuple[int, int]]:
    """Links that unite components of a tile."""
    least = _least(percent / 100, registers)
    values = lambda side: np.frombuffer(b"".join(bytes(d["registers"]) for d in side), np.uint16).reshape(-1, registers).astype(np.int32)
    sizes = lambda side: np.array([d["n"] for d in side], np.float64)
    of = lambda side: np.array([d["component"] for d in side], np.int64)
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := root.get(x, x)) != x:
            root[x] = root.get(up, up)
            x = up
        return x

    sets: dict[int, np.ndarray] = {}

    def elements(d: dict) -> np.ndarray:
        if id(d) not in sets:
            sets[id(d)] = shingles(words(bytes(d["text"]).lower()), cache, length)
        return sets[id(d)]

    if not left or not right:
        return
    right_values, right_sizes, right_of = values(right), sizes(right), of(right)
    for d, mine, n, own in zip(left, values(left), sizes(left), of(left)):
        other = np.flatnonzero((right_of != own) & (np.minimum(right_sizes, n) * 100 >= percent * np.maximum(right_sizes, n)))
        if not len(other):
            continue
        a = np.broadcast_to(mine, (len(other), registers))
        likely = likely_similarity(a, right_values[other], np.full(len(other), n), right_sizes[other])
        for k in other[likely >= least].tolist():
            x, y = find(int(own)), find(int(right_of[k]))
            if x == y:
                continue
            both = len(np.intersect1d(elements(d), elements(right[k]), assume_unique=True))
            if 100 * both >= percent * (n + right_sizes[k] - both):
                root[max(x, y)] = min(x, y)
                yield min(d["id"], right[k]["id"]), max(d["id"], right[k]["id"])


def near_duplicates(
    docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text", registers: int = REGISTERS, length: int = SHINGLE
) -> DataFrame:
    """id, n_shingles, component_id (smallest linked id). Links: 100 * intersection >= percent * union of the sets."""
    spark = docs.sparkSession
    ship_package(spark)
    width = band_width(percent / 100, registers)
    source = docs.select(id_key(doc_id).alias("id"), text_bytes(text).alias("text"))
    made = cut(sketches(source, width, registers, length))
    classes = cut(made.where("n > 0").groupBy("d1", "d2", "n").agg(F.min("id").alias("class")))
    firsts = made.join(classes.select(F.col("class").alias("id")).distinct(), "id", "left_semi")
    banded = lambda: firsts.select("id", F.explode("bands").alias("band"))
    buckets = cut(
        banded().groupBy("band").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("size"))
        .where("low < high").select("band", "size"))
    members = cut(banded().join(buckets, "band").select("band", "id", "size"))
    release(spark, buckets)
    meets = cut(members.groupBy("id").agg(F.sum("size").alias("meets")))
    centres = cut(
        members.join(meets, "id").groupBy("band").agg(F.min(F.struct((-F.col("meets")).alias("m"), "id")).alias("c"))
        .select("band", F.col("c.id").alias("centre")))
    stars = cut(
        members.join(centres, "band").where("id <> centre")
        .select(F.least("centre", "id").alias("a"), F.greatest("centre", "id").alias("b")).distinct())
    links = cut(_confirmed(cut(_likely(stars, made, percent / 100, registers)), source, percent, length))
    release(spark, meets, centres, stars)
    component = cut(connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")), []))
    placed = cut(members.join(component, "id", "left").select("band", "id", F.coalesce("component", "id").alias("component")))
    more = cut(_cross_links(placed, made, source, percent, registers, length))
    release(spark, members, placed)
    every = cut(connected_components(links.unionByName(more).select(F.col("a").alias("u"), F.col("b").alias("v")), []))

    of_class = cut(classes.join(every, classes["class"] == every["id"], "left").select(
        "d1", "d2", "n", F.coalesce("component", "class").alias("component")))
    return made.select("id", "n", "d1", "d2").join(of_class, ["d1", "d2", "n"], "left").select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"))


def near_duplicate_rows(docs: DataFrame, percent: int = 85) -> DataFrame:
    found = near_duplicates(docs, percent)
    real = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return found.select(
        real("id").alias("doc_id"), "n_shingles", real("component_id").alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"),
    )

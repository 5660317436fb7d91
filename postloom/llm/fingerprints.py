"""Document fingerprints from prefix polynomial hashes.

For a text c0 c1 ... the prefix array holds H(i) = sum of c(j) * B^j for j < i, modulo a prime. The span from l to r has the
hash H(r) - H(l), which equals that of a span k places further on up to a factor B^k: so two arrays answer whether any two
spans are equal, and a binary search over that finds the longest common extension of two places.

A fingerprint keeps a grid of prefix hashes: the block size is the smallest power of two that cuts the text into at most
`BLOCKS` blocks, and the hashes of the prefixes and the suffixes whose lengths are multiples of it are written down with
the text's length. It also keeps the text cut into chunks at places that its own code points choose (about two for each block), so
that equal passages are cut alike wherever they are.

Two texts share what their fingerprints show to be equal: a common beginning and end, found by binary search on the grids; spans of
a block from any place of either grid, by differences of its hashes; and chunks. Spans and chunks may be anywhere, and
have at least `LEAST_SPAN` code points. The likeness is the share of the longer text that is covered so, in the text where that is
less; equal fingerprints have likeness 1. An edit hides about the chunk it is in, unless a span of the grid has the rest.

The next document (ascending id, after the last the first) is needed for the edited text. Documents are split by ranges
of ids into shards, each sorted; the first document of a shard also goes to the end of the shard before it. The
bounds of the ranges come from all ids, so text is shuffled once.

Defined results: a null text is empty; a single document is followed by itself; rows without an id come first, rows that
share an id go by text; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, ship_package
from .common import NO_ID, id_key, map_rows, mixed

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003, 1_299_709)
BLOCKS = 32
SHARD_ROWS = 4_000
LEAST_SPAN = 16  # code points; also the window that places of cuts are chosen by
KNOTS = 256
SHARD_BYTES = 16_000_000


class Powers:
    """B^0, B^1, ... modulo a prime, grown as texts ask for it."""

    def __init__(self, base: int, prime: int):
        self.base, self.prime = base, np.uint64(prime)
        self.values = np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.values) < n:
            step = np.uint64(pow(self.base, len(self.values), int(self.prime)))
            self.values = np.concatenate([self.values, self.values * step % self.prime])
        return self.values[:n]


_POWERS = [Powers(b, p) for b, p in zip(BASES, PRIMES)]
_BACK = Powers(pow(BASES[0], -1, PRIMES[0]), PRIMES[0])


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHashes:
    """Prefix arrays of a text, for each prime."""

    def __init__(self, points: np.ndarray):
        self.size = len(points)
        self.sums = []
        for powers in _POWERS:
            terms = (points.astype(np.uint64) + np.uint64(1)) * powers.upto(len(points)) % powers.prime
            # Terms are below 2^31, so sums of 2^32 of them fit 64 bits; longer texts are summed in parts.
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64) % powers.prime]))

    def at(self, places: np.ndarray) -> np.ndarray:
        """Prefix hashes at some places, a column for each prime."""
        return np.stack([s[places] for s in self.sums], axis=1)

    def equal(self, left: int, other: "PrefixHashes", right: int, length: int) -> bool:
        """Whether the spans of this length from `left` here and from `right` there are equal."""
        for powers, mine, its in zip(_POWERS, self.sums, other.sums):
            p = int(powers.prime)
            a = int(mine[left + length]) - int(mine[left])
            b = int(its[right + length]) - int(its[right])
            if a * pow(powers.base, max(right - left, 0), p) % p != b * pow(powers.base, max(left - right, 0), p) % p:
                return False
        return True

    def common_extension(self, left: int, other: "PrefixHashes", right: int) -> int:
        """Length of the longest equal spans from these places on."""
        low, high = 0, min(self.size - left, other.size - right)
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.equal(left, other, right, middle) else (low, middle - 1)
        return low


    def normal(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Hashes of spans by the first prime, as if they began the text: equal spans have equal numbers anywhere."""
        p = _POWERS[0].prime
        span = (self.sums[0][right] + p - self.sums[0][left]) % p
        return span * _BACK.upto(self.size + 1)[left] % p


def _cut_level(block: int) -> int:
    """Cuts of this level are half a block apart on average, and at least `LEAST_SPAN`."""
    return max(block // 2, LEAST_SPAN).bit_length() - 1


def _cuts(hashes: PrefixHashes, block: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places inside the text and their levels; the window that begins there decides alone.

    A level says how rare the window is: the places of a larger block are those of a higher level. Places in a passage that
    repeats itself within a window are left out; where one window comes again and again, only rarer ones are cuts.
    """
    n = hashes.size
    if n <= 2 * LEAST_SPAN:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    p = _POWERS[0].prime
    sums = hashes.sums[0]
    windows = (sums[LEAST_SPAN:] + p - sums[:-LEAST_SPAN]) % p * _BACK.upto(n + 1)[: n + 1 - LEAST_SPAN] % p
    mix = mixed(windows)
    level = _cut_level(block)
    at = np.flatnonzero(mix & np.uint64((1 << level) - 1) == 0)
    at = at[at > 0]
    before = at[:, None] - np.arange(1, LEAST_SPAN + 1)
    at = at[~((before >= 0) & (windows[np.maximum(before, 0)] == windows[at, None])).any(1)]
    low = mix[at] & (~mix[at] + np.uint64(1))  # the lowest bit that is set
    levels = np.minimum(np.log2(np.maximum(low, np.uint64(1)).astype(np.float64)).astype(np.int64), 62)
    levels[low == 0] = 62
    while len(at) > most:
        level += 1
        at, levels = at[levels >= level], levels[levels >= level]
    return at, levels


def fingerprint(text: str, blocks: int = BLOCKS) -> str:
    """Length, block size, hash of the whole, grid of the prefixes, grid of the suffixes, and of the
    chunks the levels of the cuts at their ends, hashes and lengths (8 hex digits for each block or chunk)."""
    points = code_points(text)
    n, block = len(points), 1
    while block * blocks < n:
        block *= 2
    hashes = PrefixHashes(points)
    ends = np.arange(block, n + 1, block)
    starts = np.zeros(len(ends), np.int64)
    grids = [hashes.normal(starts, ends), hashes.normal(n - ends, starts + n)]
    whole = "".join(f"{int(s[-1]):08x}" for s in hashes.sums)
    at, levels = _cuts(hashes, block, 4 * blocks)
    bounds = np.concatenate([[0], at, [n]])
    chunks = [np.append(levels, 63), hashes.normal(bounds[:-1], bounds[1:]), np.diff(bounds)]
    return f"{n}:{block}:{whole}:" + ":".join(x.astype(">u4").tobytes().hex() for x in (*grids, *chunks))


def _shared(a: str, block_a: int, b: str, block_b: int, most: int) -> int:
    """Code points that both grids begin with, in whole blocks of the coarser one, by binary search."""
    step = max(block_a, block_b)
    low, high = 0, most // step
    while low < high:
        middle = (low + high + 1) // 2
        i, j = (8 * (middle * step // k - 1) for k in (block_a, block_b))
        low, high = (middle, high) if a[i : i + 8] == b[j : j + 8] else (low, middle - 1)
    return low * step


def _numbers(digits: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(digits), ">u4").astype(np.uint64)


@lru_cache(64)
def _passages(mark: str, size: int, level: int) -> dict[tuple[int, int], list[tuple[int, int]]]:
    """Where a fingerprint shows what: start and end by hash and length, of the spans of `size` (whole blocks) from every place of
    both grids, and of the chunks between cuts of at least this level."""
    n, block, _, *digits = mark.split(":")
    n, block = int(n), int(block)
    heads, tails, levels, hashes, sizes = map(_numbers, digits)
    p, step = _POWERS[0].prime, size // block
    out: dict[tuple[int, int], list[tuple[int, int]]] = {}
    if len(heads) >= step:
        h, t = np.append(np.uint64(0), heads), np.append(np.uint64(0), tails)
        starts = np.arange(len(h) - step) * block
        found = (h[step:] + p - h[:-step]) % p * _BACK.upto(n + 1)[starts] % p
        more = (t[step:] + p - t[:-step] * np.uint64(pow(BASES[0], size, PRIMES[0])) % p) % p
        places = np.concatenate([starts, n - starts - size]).tolist()
        for key, start in zip(np.concatenate([found, more]).tolist(), places):
            out.setdefault((key, size), []).append((start, start + size))
    start, at, total = 0, 0, 0
    for end, own, length in zip((levels >= level).tolist(), hashes.tolist(), sizes.tolist()):
        total = (total + own * pow(BASES[0], at - start, PRIMES[0])) % PRIMES[0] if at > start else own
        at += length
        if end:
            if at - start >= LEAST_SPAN:
                out.setdefault((total, at - start), []).append((start, at))
            start, total = at, 0
    return out


def _covered(parts: list[tuple[int, int]]) -> int:
    total = reached = 0
    for start, end in sorted(parts):
        total += max(0, end - max(start, reached))
        reached = max(reached, end)
    return total


def likeness(a: str, b: str) -> float:
    """0 to 1: the share of the longer text that is covered by what the fingerprints show to be in both."""
    if a == b:
        return 1.0
    (na, ka, _, fa, ra, *_), (nb, kb, _, fb, rb, *_) = a.split(":"), b.split(":")
    na, ka, nb, kb = int(na), int(ka), int(nb), int(kb)
    if not na or not nb:
        return 0.0
    head, tail = _shared(fa, ka, fb, kb, min(na, nb)), _shared(ra, ka, rb, kb, min(na, nb))
    parts_a, parts_b = [(0, head), (na - tail, na)], [(0, head), (nb - tail, nb)]
    block = max(ka, kb)
    in_a, in_b = (_passages(x, max(block, LEAST_SPAN), _cut_level(block)) for x in (a, b))
    for key in in_a.keys() & in_b.keys():
        parts_a += in_a[key]
        parts_b += in_b[key]
    return min(_covered(parts_a), _covered(parts_b), max(na, nb) - 1) / max(na, nb)


def edited(text: str, following: str) -> str:
    """The text with its last quarter replaced by the first code points of the following text."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n] if n else text


def _sharded(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """id, text, shard, guest: documents by ranges of ids; the first of a shard is also a guest of the shard before."""
    source = docs.select(id_key(doc_id).alias("id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    size = source.agg(F.count("*").alias("rows"), F.sum(F.octet_length("text")).alias("bytes")).first()
    shards = max(1, -(-size["rows"] // SHARD_ROWS), -(-(size["bytes"] or 0) // SHARD_BYTES))
    knots = min(KNOTS, shards)
    # Ids that split the rows into at most KNOTS equal parts; between two of them ids are dealt out evenly.
    shares = F.array(*(F.lit(i / knots) for i in range(knots + 1)))
    found = source.agg(F.percentile_approx("id", shares, 10_000).alias("at")).first()["at"] or [0, 0]
    bounds = sorted(set(found[1:-1]))
    inside = -(-shards // knots)
    part, lowest, width = F.lit(0), F.lit(int(found[0])).cast("double"), F.lit(float(found[-1]) - float(found[0]) + 1)
    if bounds:
        edges = F.array(*(F.lit(int(x)) for x in [found[0], *bounds, found[-1]]))
        part = F.size(F.filter(F.array(*(F.lit(int(x)) for x in bounds)), lambda x: x < F.col("id")))
        lowest = F.get(edges, part).cast("double")
        width = F.get(edges, part + 1).cast("double") - lowest + 1
    step = F.least(F.greatest(F.floor((F.col("id").cast("double") - lowest) / width * inside), F.lit(0)), F.lit(inside - 1))
    dealt = source.withColumn("shard", part.cast("long") * inside + step)
    firsts = dealt.groupBy("shard").agg(F.min("id").alias("id"))
    before = F.coalesce(F.lag("shard").over(Window.orderBy("shard")), F.max("shard").over(Window.partitionBy()))
    guests = cut(firsts.select("id", before.alias("shard")))
    rows = dealt.withColumn("guest", F.lit(0)).unionByName(
        dealt.drop("shard").join(guests, "id").withColumn("guest", F.lit(1)).select("id", "text", "shard", "guest"))
    return rows.repartition("shard").sortWithinPartitions("shard", "guest", "id", "text")


def fingerprint_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", blocks: int = BLOCKS) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    ship_package(docs.sparkSession)

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        before, mark, done = None, None, False
        for row in each:
            if before and row["shard"] != before["shard"]:
                before, done = None, False
            if done:
                continue  # further rows with the guest's id
            own = fingerprint(row["text"], blocks)
            if before:
                changed = edited(before["text"], row["text"])
                other = mark if changed == before["text"] else fingerprint(changed, blocks)
                yield (
                    before["id"], len(before["text"]), hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
                    mark, other, likeness(mark, other), likeness(mark, own),
                )
            before, mark, done = row, own, bool(row["guest"])

    arrow = pa.schema([
        ("id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
    schema = (
        "id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
    done = map_rows(_sharded(docs, doc_id, text), rows, schema, arrow)
    return done.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), *done.columns[1:])

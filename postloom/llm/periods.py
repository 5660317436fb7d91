"""Periodic runs of words, found by minimizers at many scales.

A run is a stretch of consecutive words with smallest period q (words q apart are identical) and at least
`max(least, 2 * q)` words that no neighbouring word extends. Every document is searched whole, as numbers of words; the
documents of a block are searched together, with a separator of its own after each.

Short periods, below `SCALE`, are found by direct scans: words are compared with those q places on. Longer ones belong to a
scale S with S <= q < 2S. There the k-mers (k = S / 2 words) of every S consecutive words have a smallest hash, the minimizer.
The words that begin a run come again q places on, so their minimizers do; pairs of equal minimizers whose distance lies
in the scale are seeds, and each is extended word by word to the left and to the right. Only the seeds go by hashes; a run is what
the words themselves show.

K-mers with a period of k / 2 or less would give very many pairs ("a a a a ..."). They lie inside runs that smaller scales have found,
and are no minimizers. So equal minimizers are more than k / 2 apart, and a scale has a bounded number of seeds per
minimizer. A run is then missed only if its first period holds nothing but such k-mers. That period is a part of one run of a
small period d, and the period after it a part of the next run of period d, which touches it; the lags at which the two have equal
words are a class modulo d, and give exactly the missing runs (`_between_neighbours`).

Defined results: a null or empty text has no words and no runs; a null id stays null; each of several equal rows gets
its result; an empty table gives no rows; other columns are not read. One text must fit a task.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import NO_ID, id_key, map_rows, mixed, text_bytes, words

LEAST_WORDS = 12
#: Smallest scale; shorter periods are scanned for. Its k-mers (half as long) have at least `LEAST_WORDS` words.
SCALE = 24
_BLOCK_WORDS = 200_000
_NEVER = np.uint64(2**64 - 1)

#: Changes the words of a document before runs are looked for: (id, words) to words.
Edit = Callable[["int | None", list[bytes]], list[bytes]]


class Numbers(dict):
    """A number for each word, in order of appearance."""

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        return number

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.int64, len(found))


def _sliding(x: np.ndarray, width: int, choose) -> np.ndarray:
    """The smallest or largest of every `width` neighbours."""
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        x = choose(x[:-step], x[step:])
        covered += step
    return x


def _prime_factors(n: int) -> list[int]:
    found, p = [], 2
    while p * p <= n:
        if n % p == 0:
            found.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return found + [n] * (n > 1)


def _matching(a: np.ndarray, b: np.ndarray) -> int:
    """How many places two arrays agree from their beginning on, looked at in steps that double."""
    n, at, step = min(len(a), len(b)), 0, 16
    while at < n:
        differ = a[at : min(at + step, n)] != b[at : min(at + step, n)]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, step = at + len(differ), 2 * step
    return n


class RunSearch:
    """All runs (start, end, period) of an array of numbers. Texts may follow each other if a number that no other place has divides them."""

    def __init__(self, x: np.ndarray, longest: int, least: int = LEAST_WORDS):
        if not 0 < least <= LEAST_WORDS:
            raise ValueError(f"runs of 1 to {LEAST_WORDS} words or more")
        self.x, self.least = x, least
        self.runs: set[tuple[int, int, int]] = set()
        self._scan_short_lags(min(SCALE - 1, longest // 2))
        scale = SCALE
        hashes, size = mixed(x.astype(np.uint64)), 1
        while 2 * scale <= longest:
            wanted = scale // 2
            while size < wanted:  # 1, 3, 6, 12, 24, ...
                grow = 3 if size == 1 else 2
                n = len(hashes) - (grow - 1) * size
                total = hashes[:n].copy()
                for i in range(1, grow):
                    total = mixed(total, i) + hashes[i * size : i * size + n]
                hashes, size = mixed(total), grow * size
            self._extend(*self._seeds(hashes, scale))
            self._between_neighbours(scale)
            scale *= 2

    def _add(self, start: int, end: int, period: int) -> None:
        """Note a maximal stretch if it is a run and has no smaller period. A smaller one would divide this one."""
        if end - start < max(self.least, 2 * period):
            return
        for p in _prime_factors(period):
            d = period // p
            if (self.x[start : start + period] == self.x[start + d : start + d + period]).all():
                return
        self.runs.add((start, end, period))

    def _scan_short_lags(self, longest: int) -> None:
        for q in range(1, longest + 1):
            at = np.flatnonzero(self.x[q:] == self.x[:-q])
            if not len(at):
                continue
            opens = np.concatenate([[True], np.diff(at) > 1])
            first = at[opens]
            size = np.diff(np.append(np.flatnonzero(opens), len(at)))
            for k in np.flatnonzero(size + q >= max(self.least, 2 * q)).tolist():
                self._add(int(first[k]), int(first[k] + size[k]) + q, q)

    def _seeds(self, hashes: np.ndarray, scale: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and distances of pairs of equal minimizers whose distance belongs to the scale."""
        k = scale // 2
        inside = np.zeros(len(hashes) + 1, np.int64)
        for start, end, period in self.runs:
            if period <= k // 2 and end - start >= k:
                inside[start] += 1
                inside[end - k + 1] -= 1
        hashes = np.where(np.cumsum(inside)[:-1] > 0, _NEVER, hashes)
        width = scale - k + 1
        none = np.empty(0, np.int64)
        if len(hashes) < width:
            return none, none
        low = _sliding(hashes, width, np.minimum)
        # A k-mer is the minimizer of some window over it if it equals the largest of the minima of these windows.
        edge = np.zeros(width - 1, np.uint64)
        chosen = np.flatnonzero((_sliding(np.concatenate([edge, low, edge]), width, np.maximum) == hashes) & (hashes != _NEVER))
        order = np.lexsort((chosen, hashes[chosen]))
        place, value = chosen[order], hashes[chosen[order]]
        starts, lags = [none], [none]
        step = 1
        while step < len(place):
            apart = place[step:] - place[:-step]
            near = (value[step:] == value[:-step]) & (apart < 2 * scale)
            if not near.any():  # further steps are further apart
                break
            hit = near & (apart >= scale)
            starts.append(place[:-step][hit])
            lags.append(apart[hit])
            step += 1
        return np.concatenate(starts), np.concatenate(lags)

    def _extend(self, places: np.ndarray, lags: np.ndarray) -> None:
        """Extend seeds to the longest stretches with the lag as a period. A stretch is extended once."""
        x, before, reached = self.x, -1, 0
        order = np.lexsort((places, lags))
        for p, q in zip(places[order].tolist(), lags[order].tolist()):
            if q == before and p < reached:
                continue
            right = p + _matching(x[p:], x[p + q :])
            left = p - _matching(x[:p][::-1], x[: p + q][::-1])
            before, reached = q, right
            self._add(left, right + q, q)

    def _between_neighbours(self, scale: int) -> None:
        """Runs of the scale whose periods are parts of two runs of one small period that touch or overlap."""
        x = self.x
        places, lags = [], []
        small = sorted((d, start, end) for start, end, d in self.runs if 4 * d <= scale and end - start >= scale)
        for (d, b1, e1), (d2, b2, e2) in zip(small, small[1:]):
            if d != d2 or b2 > e1:
                continue
            turned = [r for r in range(d) if (x[b1 + r : b1 + r + d] == x[b2 : b2 + d]).all()]
            if not turned:
                continue
            first = scale + (b2 - b1 - turned[0] - scale) % d
            for q in range(first, min(2 * scale - 1, e1 - b1, e2 - b2, (e2 - b1) // 2) + 1, d):
                places.append(max(b1, b2 - q))
                lags.append(q)
        self._extend(np.array(places, np.int64), np.array(lags, np.int64))


def runs_of_documents(found: list[list[bytes]], least: int = LEAST_WORDS) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each document, by start, then period."""
    numbers = Numbers()
    parts = [numbers.of(f) for f in found]
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    heads = np.cumsum(sizes) - sizes
    x = np.concatenate([np.empty(0, np.int64), *(y for d, p in enumerate(parts) for y in (p, [len(numbers) + d]))]).astype(np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in found]
    if not len(x):
        return out
    every = sorted(RunSearch(x, int(sizes.max()) - 1, least).runs, key=lambda r: (r[0], r[2]))
    for start, end, period in every:
        d = int(np.searchsorted(heads, start, "right")) - 1
        out[d].append((start - int(heads[d]), end - start, period))
    return out


def collapsed(found: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """The words without those that some run contains after its first period."""
    if not runs:
        return found
    cover = np.zeros(len(found) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return [w for w, c in zip(found, np.cumsum(cover).tolist()) if not c]


def _searched(each: Iterator[dict], least: int, edit: Edit | None) -> Iterator[tuple[dict, list[bytes], list[tuple[int, int, int]]]]:
    """Rows with their words and runs, searched in blocks of bounded size (a longer document is a block of its own)."""
    block: list[tuple[dict, list[bytes]]] = []
    size = 0

    def done() -> Iterator[tuple]:
        for (row, found), runs in zip(block, runs_of_documents([f for _, f in block], least)):
            yield row, found, runs

    for row in each:
        found = words(row["text"])
        if edit:
            found = edit(None if row["id"] == NO_ID else row["id"], found)
        if block and size + len(found) > _BLOCK_WORDS:
            yield from done()
            block, size = [], 0
        block.append(({"id": row["id"]}, found))
        size += len(found)
    if block:
        yield from done()


def _mapped(docs: DataFrame, doc_id: str, text: str, rows, schema: str, arrow: pa.Schema) -> DataFrame:
    ship_package(docs.sparkSession)
    done = map_rows(docs.select(id_key(doc_id).alias("id"), text_bytes(text).alias("text")), rows, "id long, " + schema, arrow)
    return done.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), *done.columns[1:])


def periodic_runs(docs: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per run: doc_id, start (word number), length, period."""

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        for row, _, runs in _searched(each, least, None):
            for run in runs:
                yield row["id"], *run

    arrow = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    return _mapped(docs, doc_id, text, rows, "start long, length long, period long", arrow)


def without_runs(docs: DataFrame, least: int = LEAST_WORDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_dropped, text (words that stay, with one space between)."""

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        for row, found, runs in _searched(each, least, None):
            kept = collapsed(found, runs)
            yield row["id"], len(found), len(found) - len(kept), b" ".join(kept).decode("utf-8", "replace")

    arrow = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_dropped", pa.int64()), ("text", pa.string())])
    return _mapped(docs, doc_id, text, rows, "n_words long, n_dropped long, text string", arrow)


def planted(doc_id: int | None, found: list[bytes]) -> list[bytes]:
    """The edit of the query: in one document of ten a stretch repeats itself to the end. A document without an id has none."""
    h = zlib.crc32(str(doc_id).encode())
    n = len(found)
    if doc_id is None or h % 10 or not n:
        return found
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return found[:a] + [found[a + i % p] for i in range(n - a)]


def run_digests(docs: DataFrame, edit: Edit | None = planted, least: int = LEAST_WORDS) -> DataFrame:
    """Per document: number of runs, the longest one, digests of all runs and of the words that stay, n_words, n_kept."""

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        for row, found, runs in _searched(each, least, edit):
            start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
            kept = collapsed(found, runs)
            yield (
                row["id"], len(runs), start, length, period, 1000 * length // period if runs else None,
                hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
                hashlib.sha256(b" ".join(kept)).hexdigest(), len(found), len(kept),
            )

    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words", "n_kept")
    kinds = {n: pa.string() if n.endswith("sha256") else pa.int64() for n in names}
    schema = ", ".join(f"{n} {'string' if n.endswith('sha256') else 'long'}" for n in names)
    return _mapped(docs, "doc_id", "text", rows, schema, pa.schema([("id", pa.int64()), *kinds.items()]))

"""Substring dedup: repeated windows of words found by super-k-mer partitioning.

A window is `window` consecutive words. Its minimiser is the smallest hash among its runs of `mer` words, so equal windows
have equal minimisers. Consecutive windows with one minimiser form a super-k-mer, which travels as one packed string to
the bucket of its minimiser, where the windows are sorted and counted by their words.

1. Of documents with equal texts only the first goes on: in the others every window is a repeat.
2. Every document gives its minimisers. Those with one place in the corpus cannot hold a repeated window and stay at home.
3. Documents that hold the others pack their super-k-mers; equal strings are combined before the shuffle.
4. A bucket sorts its windows; of equal ones the first place (id, then position) keeps its words. A bucket with more
   windows than `BUCKET_WINDOWS` is split by window instead: windows are cut out and combined by their words.
5. A window of a packed super-k-mer that kept no place is a repeat; its words go.

Windows are judged on the input, so a removed word still counts for other windows. Only minimisers and keys are compared
as 64-bit hashes (a chance match costs work, not results), whole texts by 128 bits; windows are compared as strings.

Defined results: null and empty texts have no words; documents shorter than a window are kept whole; a null id comes before
all others; rows that share an id but not the text are ordered by a hash of the text; exact repeats of a row (same id and
text) are one document and each gets its result; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, release, ship_package
from .common import NO_ID, WordHashes, id_key, map_rows, run_hashes, text_bytes, words

WINDOW = 20
MER = 8
BUCKET_WINDOWS = 4_000
_BLOCK_WORDS = 200_000


def _sliding(x: np.ndarray, width: int, choose) -> np.ndarray:
    """The smallest or largest of every `width` neighbours."""
    covered = 1
    while covered < width:
        step = min(covered, width - covered)
        x = choose(x[:-step], x[step:])
        covered += step
    return x


class Windows:
    """The windows of a block of documents, over the hashes of all their words."""

    def __init__(self, hashes: list[np.ndarray], window: int, mer: int):
        sizes = np.array([len(h) for h in hashes], np.int64)
        total = int(sizes.sum())
        self.ends = np.cumsum(sizes)
        self.heads = self.ends - sizes
        self.document = np.repeat(np.arange(len(hashes)), sizes)
        every = np.concatenate([np.empty(0, np.uint64), *hashes])
        self.runs = run_hashes(every, mer)
        count = max(total - window + 1, 0)
        low = _sliding(self.runs, window - mer + 1, np.minimum) if count else np.empty(0, np.uint64)
        inside = np.arange(count) + window <= self.ends[self.document[:count]]
        self.low = np.where(inside, low, np.uint64(0))
        self.starts = np.flatnonzero(inside)  # of the windows
        self.reach = window - mer  # runs of a window after its first

    def minimisers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Document, minimiser, and in how many places of the document it is one."""
        if not len(self.starts):
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
        # A run is the minimiser of a window over it if it equals the largest of their minima.
        around = np.concatenate([np.zeros(self.reach, np.uint64), self.low, np.zeros(self.reach, np.uint64)])
        chosen = np.flatnonzero(_sliding(around, self.reach + 1, np.maximum) == self.runs)
        document, run = self.document[chosen], self.runs[chosen]
        order = np.lexsort((run, document))
        document, run = document[order], run[order]
        first = np.flatnonzero(np.concatenate([[True], (document[1:] != document[:-1]) | (run[1:] != run[:-1])]))
        return document[first], run[first], np.diff(np.append(first, len(run)))

    def super_kmers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Document, start in it, number of windows and minimiser of each super-k-mer."""
        at = self.starts
        if not len(at):
            none = np.empty(0, np.int64)
            return none, none, none, np.empty(0, np.uint64)
        low = self.low[at]
        first = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1] + 1) | (low[1:] != low[:-1]) | (self.document[at[1:]] != self.document[at[:-1]])]))
        document = self.document[at[first]]
        return document, at[first] - self.heads[document], np.diff(np.append(first, len(at))), low[first]


def _blocks(each: Iterator[dict]) -> Iterator[tuple[list[dict], list[list[bytes]]]]:
    """Rows with their words, in blocks of bounded size (a longer document is a block of its own)."""
    rows, found, size = [], [], 0
    for row in each:
        rows.append(row)
        found.append(words(row["text"]))
        size += len(found[-1])
        if size >= _BLOCK_WORDS:
            yield rows, found
            rows, found, size = [], [], 0
    if rows:
        yield rows, found


def _dict_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            yield from batch.slice(start, 256).to_pylist()


def _minimiser_rows(docs: DataFrame, window: int, mer: int) -> DataFrame:
    """doc, minimiser, places: in how many places of the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordHashes()
        for rows, found in _blocks(_dict_rows(batches)):
            document, minimiser, places = Windows([cache.of(f) for f in found], window, mer).minimisers()
            doc = np.array([r["doc"] for r in rows], np.int64)[document]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc), pa.array(minimiser.view(np.int64)), pa.array(np.minimum(places, 127).astype(np.int8))], names=["doc", "minimiser", "places"])

    return docs.select("doc", "text").mapInArrow(run, "doc long, minimiser long, places byte")


def _chosen(rows: list[dict], found: list[list[bytes]], cache: WordHashes, window: int, mer: int):
    """Super-k-mers of these rows whose minimiser is in the row's `shared`: row, start, windows, minimiser."""
    document, start, windows, low = Windows([cache.of(f) for f in found], window, mer).super_kmers()
    of = [np.array(r["shared"], np.int64).view(np.uint64) for r in rows]
    edges = np.searchsorted(document, np.arange(len(rows) + 1))
    keep = np.concatenate([np.empty(0, bool), *(np.isin(low[a:b], s) for a, b, s in zip(edges[:-1], edges[1:], of))])
    return document[keep], start[keep], windows[keep], low[keep]


def _pack(docs: DataFrame, window: int, mer: int) -> DataFrame:
    """The shared super-k-mers of documents: minimiser, packed, windows, id, key, start."""

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        cache = WordHashes()
        for block, found in _blocks(each):
            chosen = _chosen(block, found, cache, window, mer)
            for d, s, n, m in zip(*(c.tolist() for c in (*chosen[:3], chosen[3].view(np.int64)))):
                packed = b" ".join(found[d][s : s + n + window - 1]).decode("utf-8", "replace")
                yield m, packed, n, block[d]["id"], block[d]["key"], s

    arrow = pa.schema([
        ("minimiser", pa.int64()), ("packed", pa.string()), ("windows", pa.int32()), ("id", pa.int64()), ("key", pa.int64()), ("start", pa.int32())])
    return map_rows(docs, rows, "minimiser long, packed string, windows int, id long, key long, start int", arrow)


def _first_places(strings: DataFrame, window: int) -> DataFrame:
    """Per bucket: the first place of every window. Gives id, key, starts (first places)."""

    def first(group: list[dict]) -> Iterator[tuple]:
        if len(group) == 1:
            row = group[0]
            heads = row["packed"].split(" ", row["windows"])[: row["windows"]]
            if len(set(heads)) == len(heads):  # no two windows begin with the same word
                yield row["id"], row["key"], list(range(row["start"], row["start"] + row["windows"]))
                return
        group.sort(key=lambda r: (r["id"], r["key"], r["start"]))
        listed, places = [], []
        for n, row in enumerate(group):
            packed = row["packed"]
            edges = [0]
            for word in packed.split(" "):
                edges.append(edges[-1] + len(word) + 1)
            for i in range(row["windows"]):
                listed.append((packed[edges[i] : edges[i + window] - 1], len(places)))
                places.append((n, row["start"] + i))
        listed.sort()
        kept: dict[int, list[int]] = {}
        before = None
        for text, place in listed:
            if text != before:
                n, start = places[place]
                kept.setdefault(n, []).append(start)
                before = text
        for n, starts in kept.items():
            yield group[n]["id"], group[n]["key"], starts

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        group: list[dict] = []
        for row in each:
            if group and row["minimiser"] != group[0]["minimiser"]:
                yield from first(group)
                group = []
            group.append(row)
        if group:
            yield from first(group)

    arrow = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("starts", pa.list_(pa.int32()))])
    sorted_buckets = strings.repartition("minimiser").sortWithinPartitions("minimiser")
    return map_rows(sorted_buckets, rows, "id long, key long, starts array<int>", arrow)


def _first_places_split(strings: DataFrame, window: int) -> DataFrame:
    """The same for buckets too large for one task: each window is a row, combined before it is shuffled."""
    found = F.split("packed", " ")
    cut_out = F.transform(F.sequence(F.lit(0), F.col("windows") - 1), lambda i: F.struct(
        F.array_join(F.slice(found, i + 1, F.lit(window)), " ").alias("words"), (F.col("start") + i).alias("start")))
    each = strings.select("id", "key", F.explode(cut_out).alias("w"))
    firsts = each.groupBy("w.words").agg(F.min(F.struct("id", "key", F.col("w.start").alias("start"))).alias("f"))
    return firsts.groupBy("f.id", "f.key").agg(F.collect_list("f.start").alias("starts"))


def repeated_words(
    docs: DataFrame, window: int = WINDOW, mer: int = MER, doc_id: str = "doc_id", text: str = "text",
    bucket_windows: int | None = None,
) -> DataFrame:
    """Per document: id, key (a hash of the text), text (bytes), and what `kept_words` needs: `first` (null for a copy of an
    earlier text), `shared` (minimisers with other places), `kept` (starts of their windows that are first of their kind)."""
    if not 0 < mer <= window:
        raise ValueError("a window has at least as many words as a run")
    spark = docs.sparkSession
    ship_package(spark)
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    source = docs.select(id_key(doc_id).alias("id"), F.xxhash64(whole).alias("key"), text_bytes(text).alias("text"))
    source = source.withColumn("doc", F.xxhash64("id", "key"))
    firsts = cut(
        source.groupBy("key", F.xxhash64(F.reverse("text"), F.length("text")).alias("key2")).agg(F.min("id").alias("id"))
        .select("id", "key", F.xxhash64("id", "key").alias("doc")).distinct())
    places = cut(_minimiser_rows(source.join(firsts.select("id", "key"), ["id", "key"], "left_semi"), window, mer))
    shared = cut(places.groupBy("minimiser").agg(F.sum("places").alias("n")).where("n > 1").select("minimiser"))
    release(spark)
    of_document = (
        places.join(shared, "minimiser", "left_semi").groupBy("doc").agg(F.collect_set("minimiser").alias("shared")))
    about = cut(firsts.join(of_document, "doc", "left").select("id", "key", F.lit(True).alias("first"), "shared"))
    release(spark, places, shared, firsts)
    strings = cut(
        _pack(source.join(about.where("shared is not null"), ["id", "key"]).select("id", "key", "text", "shared"), window, mer)
        .groupBy("minimiser", "packed")
        .agg(F.min(F.struct("id", "key", "start")).alias("f"), F.first("windows").alias("windows"))
        .select("minimiser", "packed", "windows", "f.id", "f.key", "f.start"))
    release(spark)
    large = cut(
        strings.groupBy("minimiser").agg(F.sum("windows").alias("n"))
        .where(F.col("n") > (bucket_windows or BUCKET_WINDOWS)).select("minimiser"))
    small = _first_places(strings.join(large, "minimiser", "left_anti"), window)
    split = _first_places_split(strings.join(large, "minimiser", "left_semi"), window)
    kept = small.unionByName(split).groupBy("id", "key").agg(F.flatten(F.collect_list("starts")).alias("kept"))
    decided = cut(about.join(kept, ["id", "key"], "left"))
    release(spark, strings, large, about)
    return source.drop("doc").join(decided, ["id", "key"], "left")


def kept_words(
    each: Iterator[dict], window: int, mer: int = MER
) -> Iterator[tuple[dict, int, list[bytes]]]:
    """Rows of `repeated_words` with the number of their words and the words that stay."""
    cache = WordHashes()
    for block, found in _blocks(each):
        marked = [i for i, r in enumerate(block) if r["shared"]]
        spans: dict[int, list[tuple[int, int]]] = {}
        if marked:
            chosen = _chosen([block[i] for i in marked], [found[i] for i in marked], cache, window, mer)
            for d, s, n in zip(*(c.tolist() for c in chosen[:3])):
                spans.setdefault(marked[d], []).append((s, n))
        for i, (row, all_words) in enumerate(zip(block, found)):
            size = len(all_words)
            if not row["first"]:
                yield row, size, [] if size >= window else all_words
                continue
            if i not in spans:
                yield row, size, all_words
                continue
            gone = np.zeros(size + 1, np.int64)
            for s, n in spans[i]:
                gone[s : s + n] = 1
            gone[np.array(row["kept"] or [], np.int64)] = 0
            starts = np.flatnonzero(gone)
            cover = np.zeros(size + 1, np.int64)
            cover[starts] += 1
            cover[starts + window] -= 1
            stays = np.cumsum(cover)[:size] == 0
            yield row, size, [w for w, k in zip(all_words, stays.tolist()) if k]


def dedup_digests(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: number of words, of removed words, digest of what stays."""

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        for row, n, kept in kept_words(each, window):
            yield row["id"], n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()

    arrow = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])
    done = map_rows(repeated_words(docs, window), rows, "id long, n_words long, n_removed long, kept_sha256 string", arrow)
    return done.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, window: int = WINDOW, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, key, n_words, n_removed, text: the text as it was if nothing is removed, else the kept words with one space between."""

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        for row, n, kept in kept_words(each, window):
            left = row["text"] if len(kept) == n else b" ".join(kept)
            yield row["id"], row["key"], n, n - len(kept), left.decode("utf-8", "replace")

    arrow = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])
    return map_rows(
        repeated_words(docs, window, doc_id=doc_id, text=text), rows, "id long, key long, n_words long, n_removed long, text string", arrow
    )

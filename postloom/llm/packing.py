"""Sum-of-squares packing of documents into sequences of a fixed number of tokens.

Documents become ids, then an end id; only a document longer than a sequence is cut, into full pieces and a rest. The
lengths (not the texts) are dealt by a hash to shards of about `SHARD_PIECES` pieces, so that the work of a task does
not grow with the corpus. Inside a shard the pieces come longest first; each goes to the open sequence, or a new one, for
which the sum over all gaps of (number of open sequences with that gap) squared becomes smallest; of equals the smallest
gap wins. The choice keeps gaps of all kinds open for pieces to come; once none come, the emptiest open sequences are given up
if their pieces fit best into the gaps of others.

Defined results: a null or empty text is the end id alone; repeated rows are packed each; a null id stays null; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut, ship_package
from .common import map_rows, text_bytes
from .tokens import LibraryIds, groups_of, per_worker

CAPACITY = 4096
END_ID = 1
SHARD_PIECES = 16_384


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, doc_id: str = "doc_id",
    text: str = "text", with_ids: bool = False,
) -> DataFrame:
    """Pieces of at most `capacity` ids: id, piece, start, length, ids_crc32 and, if asked for, the ids (32-bit, little-endian)."""
    end = struct.pack("<I", end_id)
    step = 4 * capacity

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        cache = per_worker(LibraryIds, tokenizer)
        for group in groups_of(each, "text"):
            for row, found in zip(group, cache.found([r["text"] for r in group])):
                ids = b"".join([*found, end])
                for piece, at in enumerate(range(0, len(ids), step)):
                    part = ids[at : at + step]
                    out = (row["id"], piece, at // 4, len(part) // 4, zlib.crc32(part))
                    yield (*out, part) if with_ids else out

    fields = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    if with_ids:
        fields.append(("ids", pa.binary()))
        schema += ", ids binary"
    source = docs.select(F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("text"))
    return map_rows(source, rows, schema, pa.schema(fields))


class OpenSequences:
    """The open sequences of a shard by their gap."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.counts = np.zeros(capacity + 1, np.int64)
        self.by_gap: dict[int, list[int]] = {}
        self.opened = 0

    def place(self, length: int) -> tuple[int, int]:
        """Sequence and offset of a piece."""
        counts, capacity = self.counts, self.capacity
        if length < 1 or length > capacity:
            raise ValueError(f"a piece of {length} tokens")
        gap = capacity
        if length < capacity:
            gaps = np.flatnonzero(counts[length:capacity]) + length
            if len(gaps):
                # Change of the sum of squares if a sequence with gap g gets the piece, over 2: N(g) falls by one, N(g - length) rises.
                change = counts[gaps - length] - counts[gaps] + 1
                if gaps[0] == length:  # it becomes full and is no longer counted; 2N - 1 against 2N, so a half less
                    change = change.astype(np.float64)
                    change[0] = 0.5 - counts[length]
                best = int(change.argmin())
                if change[best] <= counts[capacity - length] + 0.5:  # a new sequence
                    gap = int(gaps[best])
        if gap == capacity:
            sequence = self.opened
            self.opened += 1
        else:
            sequence = self.by_gap[gap].pop()
            counts[gap] -= 1
        rest = gap - length
        if rest:
            counts[rest] += 1
            self.by_gap.setdefault(rest, []).append(sequence)
        return sequence, capacity - gap


def give_up_emptiest(sequences: list[list[int]], lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences (lists of pieces) without those whose pieces fit into the gaps of the others, emptiest first."""
    gap_of = [capacity - sum(lengths[p] for p in parts) for parts in sequences]
    gaps = sorted((gap, k) for k, gap in enumerate(gap_of) if gap)
    for k in sorted(range(len(sequences)), key=lambda k: (-gap_of[k], k)):
        if not gap_of[k]:
            break
        own = (gap_of[k], k)
        tried = gaps.copy()
        tried.pop(bisect_left(tried, own))
        moves = []
        for piece in sorted(sequences[k], key=lambda p: (-lengths[p], p)):
            at = bisect_left(tried, (lengths[piece], -1))
            if at == len(tried):
                break
            gap, to = tried.pop(at)
            moves.append((piece, to))
            if gap > lengths[piece]:
                insort(tried, (gap - lengths[piece], to))
        else:
            for piece, to in moves:
                sequences[to].append(piece)
                gap_of[to] -= lengths[piece]
            sequences[k], gaps = [], tried
    return [parts for parts in sequences if parts]


def pack_lengths(lengths: list[int], capacity: int) -> list[list[int]]:
    """Sequences of pieces, given by their places in the list. Longest first is up to the caller."""
    open_sequences = OpenSequences(capacity)
    sequences: list[list[int]] = []
    for piece, length in enumerate(lengths):
        sequence, offset = open_sequences.place(length)
        if not offset:
            sequences.append([])
        sequences[sequence].append(piece)
    return give_up_emptiest(sequences, lengths, capacity)


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The pieces with `sequence_id` and `offset`. `pieces` has doc_id, piece, start, length, ids_crc32 and is read twice."""
    shards = max(1, -(-pieces.count() // shard_pieces))
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(shards)).cast("long"))

    def pack(shard: pd.DataFrame) -> pd.DataFrame:
        shard = shard.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        lengths = shard["length"].tolist()
        sequence, offset = np.zeros(len(shard), np.int64), np.zeros(len(shard), np.int64)
        for k, parts in enumerate(pack_lengths(lengths, capacity)):
            sequence[parts] = k
            offset[parts] = np.cumsum([0, *(lengths[p] for p in parts[:-1])])
        shard["sequence_id"] = (shard["shard"].to_numpy() << 32) + sequence
        shard["offset"] = offset
        return shard.drop(columns="shard")

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return dealt.groupBy("shard").applyInPandas(pack, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Documents as pieces placed in sequences. The pieces are written once, since packing needs their number first."""
    ship_package(docs.sparkSession)
    return pack_pieces(cut(token_pieces(docs, tokenizer, capacity, end_id, with_ids=with_ids)), capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, ids (32-bit, little-endian), doc_ids, lengths. Needs the ids of the pieces."""
    collected = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids", "doc_id", "length"))).alias("parts"))
    return collected.select(
        "sequence_id", F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"),
        F.transform("parts", lambda p: p["doc_id"]).alias("doc_ids"), F.transform("parts", lambda p: p["length"]).alias("lengths"),
    )

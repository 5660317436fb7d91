"""Small helpers of the operators: words, hashes, keys of documents, batches of rows."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Stands for a null id inside an operator; such rows come first.
NO_ID = -(2**63)

_GOLDEN = 0x9E3779B97F4A7C15


def words(text: bytes) -> list[bytes]:
    """Runs of bytes other than space, tab, line feed, vertical tab, form feed and carriage return."""
    return text.split()


#: What a worker process keeps between its tasks. A worker may go on with another operator, which then needs the memory.
KEPT: dict = {}


class WordHashes(dict):
    """64-bit hash of each word, kept for the words seen last."""

    def __init__(self, most: int = 150_000):
        super().__init__()
        self.most = most
        KEPT.clear()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, found: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def mixed(x: np.ndarray, step: int = 0) -> np.ndarray:
    """Scatter 64-bit numbers (the finaliser of splitmix64), differently for each step."""
    x = x + np.uint64(_GOLDEN * (step + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(hashes: np.ndarray, length: int) -> np.ndarray:
    """A 64-bit hash of every run of `length` neighbours."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = hashes[:n].copy()
    for i in range(1, length):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += hashes[i : i + n]
    return mixed(total, length)


def id_key(column: Column | str) -> Column:
    """An id that is never null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(NO_ID)).cast("long")


def text_bytes(column: str) -> Column:
    """The UTF-8 bytes of a text, none for null."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def map_rows(
    df: DataFrame, rows: Callable[[Iterator[dict]], Iterator[tuple]], schema: str, arrow: pa.Schema, batch_bytes: int = 8_000_000
) -> DataFrame:
    """Apply a generator over the rows of a partition. Rows go out in Arrow batches of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[dict]:
            for batch in batches:
                names = batch.schema.names
                for start in range(0, batch.num_rows, 256):
                    part = batch.slice(start, 256)
                    yield from (dict(zip(names, row)) for row in zip(*(c.to_pylist() for c in part.columns)))

        kept: list[tuple] = []
        size = 0
        for row in rows(each()):
            kept.append(row)
            size += 64 + sum(len(x) if isinstance(x, (bytes, str)) else 8 for x in row)
            if size >= batch_bytes or len(kept) >= 20_000:
                yield _batch(kept, arrow)
                kept, size = [], 0
        if kept:
            yield _batch(kept, arrow)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = [pa.array(column, field.type) for column, field in zip(zip(*rows), schema)]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def mounted(path: str) -> str:
    """The local path of a shared folder that is mounted on driver and workers."""
    if path.startswith("file:"):
        return "/" + path[5:].lstrip("/")
    if "://" in path:
        raise ValueError(f"the arrays are mapped into memory, so {path} has to be a mounted folder")
    return path


def save_array(folder: str, name: str, array: np.ndarray) -> None:
    """Written under a name of its own, then renamed: a second attempt of a task replaces a file by an equal one."""
    os.makedirs(folder, exist_ok=True)
    own = f"{folder}/.{name}-{os.getpid()}-{os.urandom(4).hex()}"
    with open(own, "wb") as f:
        np.save(f, array)
    os.replace(own, f"{folder}/{name}.npy")

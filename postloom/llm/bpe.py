"""Byte-pair encoding and decoding with a segment tree over the ranks of adjacent pairs.

The leaves of the tree are the ranks of the pairs of neighbouring symbols, each inner node is the smaller of its two
children. The root is the lowest rank; going down, to the left among equals, finds its leftmost pair. A merge changes at
most three leaves, so it costs a logarithm of the word's length, until the root says that no pair can be merged.

Short words are done many at a time: the trees of words of one size are the rows of a matrix. Long ones are done alone.

Defined results: a null text is empty: no ids, and the digest of nothing; special tokens' strings in a text become those
tokens; repeated rows and null ids are kept; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import map_rows, text_bytes
from .tokens import RunCache, groups_of, per_worker

_NONE = 2**31 - 1
_SHORT = 64
_WIDTH = 20  # bits of a symbol in a pair's key


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable bytes for themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in plain}
    rest = (b for b in range(256) if b not in letters)
    letters |= {b: chr(256 + i) for i, b in enumerate(rest)}
    return [letters[b] for b in range(256)]


class Merges:
    """The merge table of a vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocabulary: dict[str, int] = model["vocab"]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (vocabulary | self.specials).items()}
        self.inner = np.array([vocabulary[x] for x in byte_letters()], np.int64)
        self.last = np.array([vocabulary[x + self.suffix] for x in byte_letters()], np.int64)
        pairs = [p if isinstance(p, list) else p.split(" ") for p in model["merges"]]
        keys = np.array([vocabulary[a] << _WIDTH | vocabulary[b] for a, b in pairs], np.int64)
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")
        self.keys = keys[self.order]
        self.ranks = dict(zip(keys.tolist(), range(len(keys))))

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, `_NONE` where there is no merge."""
        wanted = left << _WIDTH | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.order[at], _NONE)

    def symbols(self, word: bytes) -> np.ndarray:
        out = self.inner[np.frombuffer(word, np.uint8)]
        out[-1] = self.last[word[-1]]
        return out

    def merge_many(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words. Words of a size share a matrix of trees; a column is a node, the root is node 1."""
        out: list[np.ndarray] = [np.empty(0, np.int64)] * len(words)
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            leaves = 1 << max(0, len(word) - 2).bit_length()
            by_size.setdefault(leaves, []).append(i)
        for leaves, chosen in by_size.items():
            if leaves > _SHORT:
                for i in chosen:
                    out[i] = self.merge_long(words[i])
                continue
            for part in (chosen[k : k + 4096] for k in range(0, len(chosen), 4096)):
                for i, ids in zip(part, self._merge_matrix([words[i] for i in part], leaves)):
                    out[i] = ids
        return out

    def _merge_matrix(self, words: list[bytes], leaves: int) -> list[np.ndarray]:
        n, width = len(words), leaves + 2
        sizes = np.array([len(w) for w in words])
        symbols = np.full((n, width), -1, np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        inside = np.arange(width) < sizes[:, None]
        symbols[inside] = self.inner[flat]
        symbols[np.arange(n), sizes - 1] = self.last[flat[np.cumsum(sizes) - 1]]
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = np.tile(np.arange(-1, width - 1), (n, 1))
        tree = np.full((n, 2 * leaves), _NONE, np.int64)
        pairs = np.arange(leaves) < (sizes - 1)[:, None]
        tree[:, leaves:][pairs] = self.rank(symbols[:, :leaves][pairs], symbols[:, 1 : leaves + 1][pairs])
        level = leaves
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        if leaves == 1:
            tree[:, 1] = np.where(pairs[:, 0], tree[:, 1], _NONE)
        rows = np.flatnonzero(tree[:, 1] != _NONE)
        while len(rows):
            best = tree[rows, 1]
            node = np.ones(len(rows), np.int64)
            while node[0] < leaves:
                node = 2 * node
                node += tree[rows, node] != best
            left = node - leaves
            right = after[rows, left]
            made = self.made[best]
            symbols[rows, left] = made
            symbols[rows, right] = -1
            beyond = after[rows, right]
            after[rows, left] = beyond
            has = beyond < sizes[rows]
            before[rows[has], beyond[has]] = left[has]
            previous = before[rows, left]
            new_right = np.full(len(rows), _NONE, np.int64)
            new_right[has] = self.rank(made[has], symbols[rows[has], beyond[has]])
            tree[rows, leaves + left] = new_right
            gone = right < leaves
            tree[rows[gone], leaves + right[gone]] = _NONE
            some = previous >= 0
            tree[rows[some], leaves + previous[some]] = self.rank(symbols[rows[some], previous[some]], made[some])
            for r, at in ((rows, leaves + left), (rows[gone], leaves + right[gone]), (rows[some], leaves + previous[some])):
                at = at >> 1
                while len(at) and at[0] >= 1:
                    tree[r, at] = np.minimum(tree[r, 2 * at], tree[r, 2 * at + 1])
                    at = at >> 1
            rows = rows[tree[rows, 1] != _NONE]
        left_over = symbols >= 0
        return np.split(symbols[left_over], np.cumsum(left_over.sum(1))[:-1])

    def merge_long(self, word: bytes) -> np.ndarray:
        """Ids of one word."""
        symbols = self.symbols(word).tolist()
        n = len(symbols)
        leaves = 1 << max(0, n - 2).bit_length()
        rank = self.ranks.get
        tree = [_NONE] * (2 * leaves)
        for i in range(n - 1):
            tree[leaves + i] = rank(symbols[i] << _WIDTH | symbols[i + 1], _NONE)
        for node in range(leaves - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, value: int) -> None:
            node = leaves + leaf
            tree[node] = value
            node >>= 1
            while node:
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low
                node >>= 1

        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        while tree[1] != _NONE:
            best, node = tree[1], 1
            while node < leaves:
                node *= 2
                node += tree[node] != best
            left = node - leaves
            right = after[left]
            made = int(self.made[best])
            symbols[left], symbols[right] = made, -1
            beyond = after[left] = after[right]
            if right < leaves:
                put(right, _NONE)
            if beyond < n:
                before[beyond] = left
                put(left, rank(made << _WIDTH | symbols[beyond], _NONE))
            else:
                put(left, _NONE)
            if before[left] >= 0:
                put(before[left], rank(symbols[before[left]] << _WIDTH | made, _NONE))
        return np.array([s for s in symbols if s >= 0], np.int64)


class TreeTokens(RunCache):
    """Of each run: its ids in decimal and its tokens as text, each after one space, and their number."""

    kept = 350_000

    #: How the normaliser and the splitter of the vocabulary file read a text.
    SPACE = regex.compile(r"\p{White_Space}+")
    WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")

    def __init__(self, path: str):
        super().__init__()
        self.merges = Merges(path)
        self.special = regex.compile("|".join(map(regex.escape, self.merges.specials))) if self.merges.specials else None

    def split(self, run: bytes) -> list[bytes | int]:
        """Words as UTF-8 and ids of special tokens."""
        text, out, at = run.decode("utf-8", "replace"), [], 0
        for found in self.special.finditer(text) if self.special else ():
            out += [*self._words(text[at : found.start()]), self.merges.specials[found[0]]]
            at = found.end()
        return out + self._words(text[at:])

    def _words(self, text: str) -> list[bytes]:
        text = self.SPACE.sub(" ", unicodedata.normalize("NFC", text))
        # Letter by letter: a final sigma is written like any other.
        text = text.lower() if "Σ" not in text else "".join(c.lower() for c in text)
        return [w.encode("utf-8") for w in self.WORD.findall(text)]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        folded = [w if w.isascii() else w.decode().lower().encode() for w in words]
        return self.merges.merge_many(folded)

    def encode_runs(self, runs: list[bytes]) -> list[np.ndarray]:
        parts = [self.split(r) for r in runs]
        new = list({w for p in parts for w in p if isinstance(w, bytes)})
        ids = dict(zip(new, self.merges.merge_many(new)))
        none = np.empty(0, np.int64)
        return [np.concatenate([none, *(ids[w] if isinstance(w, bytes) else np.array([w]) for w in p)]) for p in parts]

    def decode(self, ids: list[int]) -> str:
        """The vocabulary file names no decoder: tokens with a space between."""
        return " ".join(map(self.merges.tokens.__getitem__, ids))

    def value(self, ids: np.ndarray) -> tuple[bytes, bytes, int]:
        listed = ids.tolist()
        if not listed:
            return b"", b"", 0
        return (" " + " ".join(map(str, listed))).encode(), (" " + self.decode(listed)).encode(), len(listed)

    def both(self, first, second):
        return tuple(a + b for a, b in zip(first, second))


def encode_documents(docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Ids and decoded text of whole texts: doc_id, ids (decimal, one space between), decoded (UTF-8 bytes), n_tokens."""
    return _encoded(docs, tokenizer, doc_id, text, lambda i, n, ids, decoded: (i, n, ids, decoded), "ids string, decoded binary", [
        ("ids", pa.string()), ("decoded", pa.binary())])


def token_digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    def digests(i, n, ids, decoded):
        return i, n, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()

    return _encoded(docs, tokenizer, "doc_id", "text", digests, "ids_sha256 string, decoded_sha256 string", [
        ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def _encoded(docs: DataFrame, tokenizer: str, doc_id: str, text: str, make, schema: str, fields: list) -> DataFrame:
    ship_package(docs.sparkSession)

    def rows(each: Iterator[dict]) -> Iterator[tuple]:
        cache = per_worker(TreeTokens, tokenizer)
        for group in groups_of(each, "text"):
            for row, found in zip(group, cache.found([r["text"] for r in group])):
                ids, decoded = (b"".join([f[k] for f in found])[1:] for k in (0, 1))
                yield make(row["id"], sum(f[2] for f in found), ids, decoded)

    source = docs.select(F.col(doc_id).cast("long").alias("id"), text_bytes(text).alias("text"))
    arrow = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), *fields])
    return map_rows(source, rows, f"doc_id long, n_tokens long, {schema}", arrow)

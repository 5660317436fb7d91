"""Tokens of a public word-end BPE tokenizer for whole texts, run by run.

The normaliser and the splitter never look across the white space they drop, so a text is encoded run by run and a
task keeps the ids of the runs it has seen. Runs of Latin letters, alone or before one stop or comma, are kept in lower
case, which is what the tokenizer makes of them. Strings of special tokens hold no white space and stay in one run.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np

from .common import KEPT

# Letters of ASCII and Latin-1, with or without one stop or comma: one word for the splitter, and its mark.
_PLAIN = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+[.,]?\Z")
_JOINED = 64


class RunCache(dict):
    """Tokens of runs of text without white space, given as UTF-8. What a run's tokens look like is up to `value`."""

    kept = 700_000  # runs, and words, kept by a worker

    def __init__(self):
        super().__init__()
        self.words: dict[bytes, object] = {}

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of single words of Latin letters."""
        raise NotImplementedError

    def encode_runs(self, runs: list[bytes]) -> list[np.ndarray]:
        """Ids of any runs."""
        raise NotImplementedError

    def value(self, ids: np.ndarray) -> object:
        return ids.astype("<u4").tobytes()

    def both(self, first, second):
        return first + second

    def learn(self, runs: set[bytes]) -> None:
        """Encode new runs in few calls."""
        if len(self) + len(runs) > self.kept:
            self.clear()
        if len(self.words) > self.kept:
            self.words.clear()
        plain, other = [], []
        for r in runs:
            (plain if _PLAIN.match(r) else other).append(r)
        split = [(r, low[:-1], low[-1:]) if (low := r.lower())[-1] in b".," else (r, low, b"") for r in plain]
        new = list({w for _, w, _ in split if w not in self.words})
        for word, ids in zip(new, self.encode_words(new)):
            self.words[word] = self.value(ids)
        marks = dict(zip((b".", b","), map(self.value, self.encode_runs([b".", b","]))))
        for r, word, mark in split:
            self[r] = self.both(self.words[word], marks[mark]) if mark else self.words[word]
        for r, ids in zip(other, self.encode_runs(other)):
            self[r] = self.value(ids)

    def found(self, texts: list[bytes]) -> list[list]:
        """The values of the runs of whole texts."""
        runs = [t.split() for t in texts]
        found = [list(map(self.get, r)) for r in runs]
        gaps = [[i for i, x in enumerate(f) if x is None] for f in found]
        new = {r[i] for r, g in zip(runs, gaps) for i in g}
        if new:
            self.learn(new)
            for r, f, g in zip(runs, found, gaps):
                for i in g:
                    f[i] = self[r[i]]
        return found


class LibraryIds(RunCache):
    """Little-endian 32-bit ids as the tokenizers library gives them."""

    def __init__(self, path: str):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task per core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def encode_runs(self, runs: list[bytes]) -> list[np.ndarray]:
        texts = [r.decode("utf-8", "replace") for r in runs]
        return [np.array(x.ids, "<u4") for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_words(self, words: list[bytes]) -> list[np.ndarray]:
        """Many words to a call: each ends in its only token with a word end."""
        groups = [words[i : i + _JOINED] for i in range(0, len(words), _JOINED)]
        out: list[np.ndarray] = []
        for group, ids in zip(groups, self.encode_runs([b" ".join(g) for g in groups])):
            cuts = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(cuts) != len(group):
                raise ValueError("a word has more than one word end")
            out.extend(ids[a:b] for a, b in zip([0, *cuts], cuts))
        return out

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Ids of whole texts."""
        return [b"".join(f) for f in self.found(texts)]


def per_worker(kind: type, path: str):
    """One cache per worker process, used again by its later tasks, until another operator runs there."""
    if (kind, path) not in KEPT:
        KEPT.clear()
        KEPT[kind, path] = kind(path)
    return KEPT[kind, path]


def groups_of(rows: Iterator[dict], column: str, most_rows: int = 256, most_bytes: int = 4_000_000) -> Iterator[list[dict]]:
    """Rows in lists of bounded text."""
    kept, size = [], 0
    for row in rows:
        kept.append(row)
        size += len(row[column])
        if len(kept) >= most_rows or size >= most_bytes:
            yield kept
            kept, size = [], 0
    if kept:
        yield kept

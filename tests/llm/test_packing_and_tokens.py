import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from cases import documents, frame

from postloom.llm import bpe, packing
from postloom.llm.queries import vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


def test_packing_places_every_id(spark, library):
    rows = documents()
    packed = packing.pack_documents(frame(spark, rows), vocabulary_path(), capacity=256).collect()
    expected = sorted(
        (i is not None, i or 0, np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes()) for i, t, _ in rows)
    pieces = []
    for known, i, ids in expected:
        pieces += [(i if known else None, at // 1024, at // 4, len(ids[at : at + 1024]) // 4, zlib.crc32(ids[at : at + 1024])) for at in range(0, len(ids), 1024)]
    as_key = lambda p: (p[0] is not None, p[0] or 0, *p[1:])
    assert sorted(map(as_key, pieces)) == sorted(as_key(tuple(r)[:5]) for r in packed)
    sequences = defaultdict(list)
    for r in packed:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 256
    total = sum(r.length for r in packed)
    assert len(sequences) <= -(-total // 256) + 2


def test_packing_in_many_shards_and_with_ids(spark):
    pieces = packing.token_pieces(frame(spark, documents()), vocabulary_path(), 128, with_ids=True).cache()
    packed = packing.pack_pieces(pieces, 128, shard_pieces=40).cache()
    assert packed.count() == pieces.count()
    whole = packing.sequences(packed).collect()
    assert sum(len(r.ids) for r in whole) == 4 * sum(sum(r.lengths) for r in whole)
    assert max(sum(r.lengths) for r in whole) <= 128


def test_sum_of_squares_choice():
    """Each piece goes where the sum of squared counts, tried out one by one, becomes smallest."""
    r = np.random.default_rng(3)
    open_sequences = packing.OpenSequences(20)
    gaps: list[int] = []
    for length in r.integers(1, 21, 400).tolist():
        score = lambda g: sum(g.count(k) ** 2 for k in set(g) if k)
        options = []
        for g in sorted(set(x for x in gaps if x >= length)):
            rest = gaps.copy()
            rest.remove(g)
            options.append((score(rest + [g - length]), g))
        options.append((score(gaps + [20 - length]), 20))
        best = min(options)[0]
        _, offset = open_sequences.place(length)
        gap = 20 - offset
        assert (best, gap) in [(s, g) for s, g in options if s == best]
        if gap != 20:
            gaps.remove(gap)
        gaps.append(20 - offset - length)
        gaps = [g for g in gaps if g]


def test_empty_tables(spark):
    none = frame(spark, documents()).where("false")
    assert packing.pack_documents(none, vocabulary_path()).count() == 0
    assert bpe.token_digests(none, vocabulary_path()).count() == 0


ODD = [
    "Don't<|endoftext|>stop É café ñ 12 ẍ<|startoftext|>a", "ΑΣ ΣΑ İstanbul é ́x a\x1cb a\x85b c\xa0d", "'s 'S 't'tx 5,5. ... ,, a., it'S it's.",
    "ﬀ Å ẞ ﻿ x​x", "日本 語ab12", " a \x00b", "🙂 a🙂b 𝐀", "Ǆ ǅ ʼn", "Γειά ΣΟΦΟΣ", "abİcd a", "क़ ख़", "ÀÉÎ× ÿ÷ Ý.", "abcdefghij" * 300,
]


def test_tokens_equal_the_library(spark, library):
    rows = documents() + [(2000 + k, t, None) for k, t in enumerate(ODD)]
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.token_digests(frame(spark, rows), vocabulary_path()).collect())
    want = []
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((i is not None, i or 0, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)


def test_one_tree_and_many_trees_agree():
    merges = bpe.Merges(vocabulary_path())
    r = np.random.default_rng(1)
    found = ["".join(r.choice(list("aeinorst"), n)).encode() for n in [*range(1, 40)] * 3]
    many = merges.merge_many(found)
    assert [m.tolist() for m in many] == [merges.merge_long(w).tolist() for w in found]

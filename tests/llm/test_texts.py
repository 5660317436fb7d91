import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import documents, frame, unique_ids, words
from pyspark.sql import functions as F

from postloom.llm import fingerprints, kneser_ney, langid

TESTDATA = "/root/testdata/sf0.01"


def test_language_of_held_out_documents(spark):
    df = spark.read.parquet(f"{TESTDATA}/documents.parquet")
    got = {r.doc_id: r for r in langid.predicted_languages(df).collect()}
    rows = df.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert all(got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert sum(got[r.doc_id].lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_of_awkward_rows(spark):
    rows = documents()
    got = langid.predicted_languages(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r)
    assert all(by[i][0].lang_pred == "und" for i in (3, 4, 5))
    assert by[6][0].lang_pred in ("en", "de")
    none = frame(spark, rows)
    assert langid.predicted_languages(none.where("false")).count() == 0
    unlabelled = none.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.predicted_languages(unlabelled).collect()} == {"und"}


def test_language_does_not_read_labels(spark):
    df = spark.read.parquet(f"{TESTDATA}/documents.parquet").limit(60)
    model = langid.Model(["a", "b"], np.random.default_rng(0).normal(0, 1, (langid.FEATURES, 2)).astype(np.float32), np.zeros(2), 2.0)
    with_labels = {r.doc_id: r.score for r in langid.identify(df, model).collect()}
    without = {r.doc_id: r.score for r in langid.identify(df.selectExpr("doc_id", "text", "'zz' AS lang"), model).collect()}
    assert with_labels == without
    text = "Ab, c! " * 500_000  # read in parts
    places = np.concatenate(list(langid.ngram_places(text)))
    whole = len(text) + 2
    assert len(places) >= 3 * whole - 3


def test_calibration():
    r = np.random.default_rng(1)
    logits = r.normal(0, 2, (4000, 3))
    shares = np.exp(logits) / np.exp(logits).sum(1, keepdims=True)
    drawn = (r.random((4000, 1)) < shares.cumsum(1)).argmax(1)
    assert abs(langid.calibrated(3 * logits, drawn) - 3) < 0.4


def brute_scores(rows, order):
    start, end = object(), object()
    padded = lambda t: [*[start] * (order - 1), *t, end]
    counts, levels = Counter(), [Counter() for _ in range(order + 1)]
    for i, t in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 10:
            s = padded(t)
            counts.update(s[order - 1:])
            levels[order].update(tuple(s[j - order:j]) for j in range(order, len(s) + 1))
    for k in range(order, 1, -1):
        levels[k - 1].update(run[1:] for run in levels[k])
    n, v = sum(counts.values()), len(counts)
    off, total, seen = [None], [None], [None]
    for level in levels[1:]:
        off.append((0.0, *kneser_ney._discounts(*(sum(x == j for x in level.values()) for j in (1, 2, 3, 4)))))
        total.append(Counter())
        seen.append(defaultdict(lambda: [0, 0, 0]))
        for run, c in level.items():
            total[-1][run[:-1]] += c
            seen[-1][run[:-1]][min(c, 3) - 1] += 1

    def p(run):
        if not run:
            return 1 / (v + 1)
        k, below = len(run), p(run[1:])
        if not total[k][run[:-1]]:
            return below
        c = levels[k][run]
        return (max(c - off[k][min(c, 3)], 0) + sum(x * y for x, y in zip(off[k][1:], seen[k][run[:-1]])) * below) / total[k][run[:-1]]

    for context in [(start,) * (order - 1), next(iter(levels[order]))[:-1]]:
        assert abs(sum(p((*context, w)) for w in counts) + p((*context, None)) - 1) < 1e-9  # and one unseen word
    for i, t in rows:
        s = padded(t)
        yield (
            i, len(t) + 1, sum(counts[w] > 0 for w in s[order - 1:]), n,
            sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in s[order - 1:]),
            sum(math.log10(p(tuple(s[j - order:j]))) for j in range(order, len(s) + 1)))


def close(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:4], round(r[4], 4))
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:4] == w[:4] and abs(g[4] - w[4]) < 1e-6 * abs(w[4]) and abs(g[5] - w[5]) < 1e-6 * abs(w[5]), (g, w)


@pytest.mark.parametrize("order", [2, 3, 4])
def test_language_model(spark, monkeypatch, order):
    rows = documents()
    want = list(brute_scores([(i, [w.lower() for w in words(t)]) for i, t, _ in rows], order))
    for part, bucket in ((2_000_000, 16_000_000), (500, 3_000)):
        monkeypatch.setattr(kneser_ney, "PART_TOKENS", part)
        found = kneser_ney.train(frame(spark, rows).where(~kneser_ney.held_out()), bucket_bytes=bucket, order=order)
        assert bucket > 10_000 or found.buckets > 10
        got = kneser_ney.score(frame(spark, rows), found, [("doc_id", "long")]).collect()
        close([(r.doc_id, r.n_tokens, r.n_known, found.tokens, r.base_score, r.score) for r in got], want)


def test_language_model_with_a_lost_file(spark):
    rows = frame(spark, documents())
    found = kneser_ney.train(rows)
    found.folder += "-elsewhere"
    with pytest.raises(Exception, match="FileNotFoundError"):
        kneser_ney.score(rows, found, [("doc_id", "long")]).collect()
    with pytest.raises(ValueError):
        kneser_ney.train(rows, order=1)


def test_language_model_without_texts(spark):
    none = frame(spark, documents()).where("false")
    assert kneser_ney.scored_documents(none).count() == 0
    model = kneser_ney.train(none)
    got = kneser_ney.score(frame(spark, documents()), model, [("doc_id", "long")]).collect()
    assert all(r.n_known == 0 and r.score == 0 == r.base_score for r in got)  # the uniform share of one unseen word is 1


def test_fingerprints(spark, monkeypatch):
    rows = sorted((i, t or "") for i, t, _ in unique_ids(documents()))
    for shard_rows in (4_000, 7):
        monkeypatch.setattr(fingerprints, "SHARD_ROWS", shard_rows)
        got = {r.doc_id: r for r in fingerprints.fingerprint_documents(frame(spark, [(i, t, None) for i, t in rows])).collect()}
        assert len(got) == len(rows)
        for k, (i, t) in enumerate(rows):
            after = rows[(k + 1) % len(rows)][1]
            n = len(t) // 4
            changed = t[: len(t) - n] + after[:n]
            r, marks = got[i], [fingerprints.fingerprint(x) for x in (t, changed, after)]
            assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(changed.encode()).hexdigest(), *marks[:2])
            assert (r.near_edited, r.near_next) == (fingerprints.likeness(*marks[:2]), fingerprints.likeness(marks[0], marks[2]))
            assert 0 <= r.near_next <= 1 and (r.near_edited >= 0.6 or n == 0 or len(changed) < len(t))


def test_fingerprints_of_awkward_rows(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "SHARD_ROWS", 9)
    rows = documents()
    got = fingerprints.fingerprint_documents(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_chars) for r in got) == sorted((-1 if i is None else i, len(t or "")) for i, t, _ in rows)
    one = fingerprints.fingerprint_documents(frame(spark, rows[:1])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert fingerprints.fingerprint_documents(frame(spark, rows).where("false")).count() == 0


def test_spans_and_extensions():
    x = "the quick brown fox " * 30
    y = "zz" + x[:300] + "Q" + x[301:]
    a, b = (fingerprints.PrefixHashes(fingerprints.code_points(t)) for t in (x, y))
    for left in range(0, 400, 13):
        for right in range(0, 400, 17):
            n = 0
            while left + n < len(x) and right + n < len(y) and x[left + n] == y[right + n]:
                n += 1
            assert a.common_extension(left, b, right) == n
    near = fingerprints.likeness(fingerprints.fingerprint(x), fingerprints.fingerprint(y[2:]))
    assert 0.85 < near < 1
    assert fingerprints.likeness(fingerprints.fingerprint("abc"), fingerprints.fingerprint("")) == 0


def test_likeness_of_near_copies_with_scattered_edits():
    r = np.random.default_rng(8)
    for size in (300, 700, 3000):
        words_of = [f"{w}{k}" for k, w in zip(r.integers(0, 10_000, size), r.choice(["ab", "cde", "fghi", "é"], size))]
        text = " ".join(words_of)
        for edits, least in ((2, 0.8), (4, 0.65)):
            for kind in ("equal", "longer", "gone", "mixed"):
                new = list(words_of)
                for k in range(edits):
                    at = int(size * (2 * k + 1) / (2 * edits))
                    new[at] = {"equal": "#" * len(new[at]), "longer": new[at] + "more", "gone": "", "mixed": ["", "x" * 9][k % 2]}[kind]
                other = " ".join(new)
                got = fingerprints.likeness(*(fingerprints.fingerprint(x) for x in (text, other)))
                # By brute force: the places of runs of 16 code points that the other text has, too.
                share = []
                for x, y in ((text, other), (other, text)):
                    runs = {y[i : i + 16] for i in range(len(y) - 15)}
                    seen = np.zeros(len(x), bool)
                    for i in range(len(x) - 15):
                        if x[i : i + 16] in runs:
                            seen[i : i + 16] = True
                    share.append(seen.sum())
                assert least <= got <= min(share) / max(len(text), len(other)) + 1e-9, (size, edits, kind, got)
        far = " ".join(f"q{k}z" for k in r.integers(0, 10_000, size))
        assert fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(far)) == 0
        moved = " ".join(words_of[size // 2 :] + words_of[: size // 2])
        assert fingerprints.likeness(fingerprints.fingerprint(text), fingerprints.fingerprint(moved)) > 0.75
    long = fingerprints.fingerprint("ab cd " * 200_000)
    assert len(long) < 20 * 4 * fingerprints.BLOCKS + 1000


def test_language_sample_counts_copies_once(spark, monkeypatch):
    r = np.random.default_rng(6)

    def text(letters):
        return " ".join("".join(r.choice(list(letters), 5)) for _ in range(20))

    rows = [(text("abcdef"), "x") for _ in range(150)] + [(text("abcdef"), "x")] * 3000
    few = [text("uvwxyz") for _ in range(5)]
    rows += [(few[k % 5], "y") for k in range(3000)]  # many rows, five texts
    seen = []
    fit = langid.follow_the_leader
    monkeypatch.setattr(langid, "follow_the_leader", lambda given, n: seen.append(given) or fit(given, n))
    for copies in (rows, rows + rows[-1:] * 2000):
        model = langid.train(spark.createDataFrame(copies, "text string, lang string"), sample_rows=200)
        of = Counter(label for _, _, label in seen[-1])
        assert len(seen[-1]) == 84 and of[1] == 4, of  # four fifths of 100 and of 5
        different = {(p.tobytes(), v.tobytes()) for p, v, _ in seen[-1]}
        assert len(different) == len(seen[-1])
        assert all(model.predict(t)[0] == "y" for t in few) and model.predict(rows[0][0])[0] == "x"

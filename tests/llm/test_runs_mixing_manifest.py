import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import documents, frame, words
from pyspark.sql import functions as F

from postloom.llm import merkle, mixing, periods, running

# Runs ---------------------------------------------------------------------------------------------


def brute_runs(found, least=12):
    """Every lag, every stretch of equal places, every smaller period tried."""
    x, out = np.array(found), []
    for q in range(1, len(x) // 2 + 1):
        same = np.concatenate([[0], (x[q:] == x[:-q]).astype(int), [0]])
        for a, b in zip(np.flatnonzero(np.diff(same) == 1).tolist(), np.flatnonzero(np.diff(same) == -1).tolist()):
            size = b - a + q
            if size >= max(least, 2 * q) and not any((x[a : a + size - d] == x[a + d : a + size]).all() for d in range(1, q)):
                out.append((a, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def strange_text(r, kind):
    if kind == 0:
        return [r.choice("ab") for _ in range(r.randint(0, 300))]
    if kind == 1:  # a long period between other words
        unit = [r.choice("abc") for _ in range(r.randint(1, 90))]
        return [r.choice("abcd") for _ in range(r.randint(0, 20))] + unit * r.randint(1, 6) + unit[: r.randint(0, 90)] + ["z"] * r.randint(0, 30)
    if kind == 2:  # long periods that hold long runs of one word
        unit = ["a"] * r.randint(1, 60) + ["b"] * r.randint(0, 60)
        return unit * r.randint(1, 5) + ["c"] + unit * r.randint(0, 3)
    if kind == 3:  # Fibonacci words
        a, b = ["a"], ["a", "b"]
        for _ in range(r.randint(1, 11)):
            a, b = b, b + a
        return b
    if kind == 4:  # runs of one small period that touch
        unit, out = [r.choice("ab") for _ in range(r.randint(1, 5))], []
        while len(out) < 400:
            out += unit * r.randint(1, 20) + unit[: r.randint(0, len(unit))] + ["b"] * (r.random() < 0.3)
        return out
    if kind == 5:
        return ["a", "b"] * r.randint(10, 90) + ["b", "a"] * r.randint(10, 90) + ["a", "b"] * r.randint(0, 60)
    out = [r.choice("ab")]  # repeats of repeats
    while len(out) < 250:
        out = out * r.randint(2, 4) + out[: r.randint(0, len(out))] + [r.choice("abc")] * (r.random() < 0.5)
    return out[:700]


@pytest.mark.parametrize("seed", range(4))
def test_runs_of_strange_texts(seed):
    r = random.Random(seed)
    docs = [[w.encode() for w in strange_text(r, k % 7)] for k in range(70)]
    found = [runs for at in range(0, 70, 5) for runs in periods.runs_of_documents(docs[at : at + 5])]
    assert sum(map(len, found)) > 300
    for doc, runs in zip(docs, found):
        assert runs == brute_runs(doc)


def test_runs_in_a_very_long_text():
    """Work grows with the words, not with the pairs of equal words."""
    unit = [b"w%d" % k for k in range(7_000)]
    runs = periods.runs_of_documents([[b"a"] * 300_000 + unit * 3])[0]
    assert runs == [(0, 300_000, 1), (300_000, 21_000, 7_000)]


def long_runs():
    """Documents with repeats of every length, ids such that some are planted."""
    r = random.Random(8)
    rows = documents()
    for i in range(1_000, 1_080):
        unit = [r.choice("the of and in to".split()) + str(r.randint(0, 9)) for _ in range(r.randint(1, 200))]
        rows.append((i, " ".join(unit * r.choice([1, 1, 2, 3])) + "\n" + "no " * r.randint(0, 14), None))
    return rows


def test_run_digests(spark):
    rows = [(i, t, x) for i, t, x in long_runs() if len(words(t)) < 3_500]
    got = periods.run_digests(frame(spark, rows)).collect()
    want = []
    for i, t, _ in rows:
        found = words(t)
        h, n = zlib.crc32(str(i).encode()), len(found)
        if i is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            found = [found[k] if k < a else found[a + (k - a) % p] for k in range(n)]
        runs = brute_runs(found)
        best = sorted(runs, key=lambda s: (-s[1], s[0], s[2]))[0] if runs else (None, None, None)
        gone = {k for s, size, q in runs for k in range(s + q, s + size)}
        kept = b" ".join(w for k, w in enumerate(found) if k not in gone)
        want.append((i, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
                     hashlib.sha256("".join("%d,%d,%d\n" % s for s in runs).encode()).hexdigest(), hashlib.sha256(kept).hexdigest(), n, n - len(gone)))
    key = lambda row: tuple((x is not None, x or 0) for x in row)
    assert sorted(map(key, map(tuple, got))) == sorted(map(key, want))
    assert sum(r.n_runs > 0 for r in got) > 30


def test_runs_as_rows_and_as_texts(spark):
    docs = frame(spark, [(1, "x y " * 10 + "end", None), (2, None, None), (3, "one two", None)])
    assert [tuple(r) for r in periods.periodic_runs(docs).collect()] == [(1, 0, 20, 2)]
    texts = {r.doc_id: (r.n_words, r.n_dropped, r.text) for r in periods.without_runs(docs).collect()}
    assert texts == {1: (21, 18, "x y end"), 2: (0, 0, ""), 3: (2, 0, "one two")}


# Mixing -------------------------------------------------------------------------------------------


def mix_rows():
    r = random.Random(4)
    rows = []
    for k, (source, n) in enumerate([("b", 90), ("a", 80), (None, 15), ("é", 5), ("", 30), ("c", 0)]):
        for j in range(n):
            rows.append((100 * k + j, " ".join("w%d" % r.randint(0, 50) for _ in range(r.randint(0, 40))), source))
    rows += [(7, "same text again", "b")] * 300 + [(None, "no id 1 2 3", "a")] * 4 + [(None, None, None), (5_000, "", "empty")]
    r.shuffle(rows)
    return rows


def with_sources(spark, rows):
    return frame(spark, rows).withColumnRenamed("lang", "source").withColumns({
        "copies": F.lit("x"), "all": F.lit(1), "before": F.lit(1), "source_key": F.lit(1), "n": F.lit(0), "group": F.lit("g")})


def brute_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    target, full = {}, set()
    while True:
        left = sum(sizes.values()) - sum(3 * sizes[s] for s in full)
        total = sum(w for s, w in weight.items() if s not in full)
        target = {s: 3.0 * sizes[s] if s in full else left / total * weight[s] for s in order}
        over = {s for s in order if target[s] > 3 * sizes[s]}
        if not over:
            return target
        full |= over


def test_mixture(spark):
    rows = mix_rows()
    got = mixing.mixture(with_sources(spark, rows)).collect()
    size = lambda t: len(words(t))
    assert Counter((r.doc_id, r.source, r.size) for r in got) == Counter((i, s, size(t)) for i, t, s in rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    target = brute_targets(sizes)
    by_source = defaultdict(list)
    for r in got:
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-9
        assert 0 <= r.last_words <= r.size and r.taken == r.epochs * r.size + r.last_words <= 3 * r.size
        by_source[r.source].append(r)
    for s, taken in by_source.items():
        assert sum(r.taken for r in taken) == round(target[s])
        assert len({r.epochs for r in taken}) == 1  # whole epochs first
        assert sum(0 < r.last_words < r.size for r in taken) <= 1
    assert any(r.epochs for r in got) and any(0 < r.last_words < r.size for r in got)
    again = mixing.mixture(with_sources(spark, rows).repartition(7)).collect()
    assert Counter(map(tuple, got)) == Counter(map(tuple, again))


def test_the_mix_itself(spark):
    rows = mix_rows()
    docs = with_sources(spark, rows)
    plan = mixing.mixture(docs).cache()
    mix = mixing.mixed_texts(docs, plan).collect()
    taken = Counter()
    for r in mix:
        taken[r.doc_id, r.source] += len(words(r.text))
    want = Counter()
    for r in plan.collect():
        want[r.doc_id, r.source] += r.taken
    assert +taken == +want


def test_better_documents_come_first(spark):
    """With qualities of 9 to 1 the chance to come first is 0.9, whatever the order of ids."""
    docs = spark.range(4_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.col("id").cast("string")).alias("text"),
                                     (F.col("id") % 2000).cast("string").alias("pair"))
    keyed = docs.withColumn("key", mixing.sampling_key(F.col("doc_id"), F.col("text"), F.when(F.col("doc_id") < 2000, 9.0).otherwise(1.0)))
    first = keyed.groupBy("pair").agg(F.min_by("doc_id", "key").alias("first")).where("first < 2000").count()
    assert 0.87 < first / 2000 < 0.93


def test_running_totals_of_a_large_group(spark):
    rows = [("g" if k % 3 else "h", k * 7919 % 5_000, k % 11) for k in range(5_000)]
    df = spark.createDataFrame(rows, "grp string, o long, a long").repartition(5)
    got = running.running_totals(df, "grp", ["o"], F.col("a"), "before", "total").collect()
    for g in "gh":
        at = 0
        for r in sorted((r for r in got if r.grp == g), key=lambda r: r.o):
            assert r.before == at
            at += r.a
        assert {r.total for r in got if r.grp == g} == {at}


# Manifest -----------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_leaf(i, t, s):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, s, "L", 3, t)))


def brute_tree(leaves, arity):
    """Root, and per leaf the (before, after) pairs up to it."""
    level, at, out = leaves, list(range(len(leaves))), [[] for _ in leaves]
    while len(level) > 1:
        for k, a in enumerate(at):
            run = level[a // arity * arity :][:arity]
            out[k].append(("".join(run[: a % arity]), "".join(run[a % arity + 1 :])))
            at[k] = a // arity
        level = [sha("".join(level[a : a + arity])) for a in range(0, len(level), arity)]
    return level[0], out


def manifest_docs(spark, rows):
    df = with_sources(spark, rows).withColumns({"lang": F.lit("L"), "n_chars": F.lit(3), "path": F.lit(2), "at": F.lit(1), "top": F.lit("t")})
    return df


@pytest.mark.parametrize("arity,step", [(3, 4), (2, 2), (3, 1)])
def test_proofs(spark, arity, step):
    rows = mix_rows() + [(9_000 + k, f"line {k}\nnext", "long") for k in range(260)]
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    got = merkle.proofs(manifest_docs(spark, rows), arity=arity, step=step, tampered={"text": text}).withColumns({
        "folded": merkle.folded(F.col("leaf"), F.col("path")), "broken": merkle.folded(F.col("tampered_leaf"), F.col("path")),
        "proof": merkle.proof_digest(F.col("path"))}).collect()
    by_source = defaultdict(list)
    for i, t, s in rows:
        by_source[s].append((i is not None, i or 0, brute_leaf(i, t, s)))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([leaf for *_, leaf in sorted(by_source[s])], arity) for s in order}
    root, over = brute_tree([trees[s][0] for s in order], arity)
    want = Counter()
    for s, above in zip(order, over):
        subroot, inside = trees[s]
        for (known, i, leaf), path in zip(sorted(by_source[s]), inside):
            want[i if known else None, s, leaf, subroot, root, sha("".join(b + a for b, a in path + above))] += 1
    assert Counter((r.doc_id, r.source, r.leaf, r.subroot, r.root, r.proof) for r in got) == want
    for r in got:
        assert r.folded == r.root
        assert (r.broken == r.root) == (r.doc_id is None or r.doc_id < 9_000)


def test_every_level_is_not_written(spark):
    leaves = spark.range(1_000).select(F.lit("g").alias("group"), F.lit(1_000).cast("long").alias("n"), F.col("id").alias("at"), F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    manifest = merkle.build(leaves)
    assert [w.count() for w in manifest.written] == [1_000, 13, 1]
    assert manifest.tops().first()["top"] == brute_tree([sha(str(k)) for k in range(1_000)], 3)[0]


def test_one_leaf_and_no_rows(spark):
    one = merkle.proof_rows(manifest_docs(spark, [(8, "a\nb", "s")])).first()
    assert one.leaf == one.subroot == one.root == brute_leaf(8, "a\nb", "s") and one.proof_sha256 == sha("")
    assert one.verified == (zlib.crc32(b"8") % 2 == 1)
    none = manifest_docs(spark, [(8, "a", "s")]).where("false")
    assert merkle.proof_rows(none).count() == 0
    assert mixing.mixed_documents(with_sources(spark, [(1, "a", "s")]).where("false")).count() == 0
    assert periods.run_digests(frame(spark, [(1, "a", "s")]).where("false")).count() == 0


def test_proof_rows_change_every_second_text(spark):
    rows = [(k, f"t {k}\n", "s") for k in range(40)] + [(None, "x\ny", None), (41, None, None)]
    got = merkle.proof_rows(manifest_docs(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.verified == (r.doc_id in (None, 41) or zlib.crc32(str(r.doc_id).encode()) % 2 == 1)

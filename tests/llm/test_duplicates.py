import hashlib
from collections import defaultdict

import numpy as np
import pytest
from cases import documents, frame, unique_ids, words

from postloom.llm import setsketch, small_world, superkmers


def brute_repeats(rows, window):
    seen, out = set(), {}
    for i, t in sorted((i, t) for i, t, _ in rows):
        found = words(t)
        gone = set()
        for s in range(len(found) - window + 1):
            w = tuple(found[s : s + window])
            if w in seen:
                gone.update(range(s, s + window))
            seen.add(w)
        out[i] = (len(found), len(gone), hashlib.sha256(b" ".join(w for k, w in enumerate(found) if k not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("bucket_windows", [4_000, 3])
def test_substring_dedup(spark, bucket_windows, monkeypatch):
    rows = [(i, t or "", x) for i, t, x in unique_ids(documents())]
    monkeypatch.setattr(superkmers, "BUCKET_WINDOWS", bucket_windows)
    monkeypatch.setattr(superkmers, "BUCKET_WINDOWS", bucket_windows)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in superkmers.dedup_digests(frame(spark, rows), 20).collect()}
    assert got == brute_repeats(rows, 20)
    assert any(n for _, n, _ in got.values())


def test_substring_dedup_keeps_every_row(spark):
    rows = documents()
    got = superkmers.dedup_digests(frame(spark, rows)).collect()
    assert sorted((r.doc_id or -1, r.n_words) for r in got) == sorted((i if i is not None else -1, len(words(t))) for i, t, _ in rows)
    repeated = [r for r in got if r.doc_id == 700]
    assert len(repeated) == 2 and repeated[0] == repeated[1]
    assert superkmers.dedup_digests(frame(spark, rows).where("false")).count() == 0


def test_texts_without_repeats_stay_as_they_are(spark):
    rows = documents()
    texts = {(i, t or "") for i, t, _ in rows}
    for r in superkmers.without_repeats(frame(spark, rows)).collect():
        assert r.n_removed or (None if r.id == -(2**63) else r.id, r.text) in texts


def shingle_set(text):
    found = [w.lower() for w in words(text)]
    return {tuple(found[k : k + 5]) for k in range(max(len(found) - 4, 1))} if found else set()


def brute_components(rows, percent):
    sets = {i: shingle_set(t) for i, t, _ in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(spark, percent):
    rows = unique_ids(documents())
    r = np.random.default_rng(4)
    for g in range(8):  # chains: neighbours are near, ends are not
        text = [f"g{g}w{k}" for k in range(120)]
        for step in range(6):
            rows.append((3000 + 10 * g + step, " ".join(text), None))
            at = int(r.integers(0, 118))
            text = [*text[:at], f"new{step}", *text[at + 2 :]]
    got = {x.doc_id: (x.n_shingles, x.component_id, x.kept) for x in setsketch.near_duplicate_rows(frame(spark, rows), percent).collect()}
    assert got == brute_components(rows, percent)


def test_near_duplicates_of_awkward_rows(spark):
    rows = documents()
    got = setsketch.near_duplicate_rows(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id == 700} == {min(i for i, t, _ in rows if i is not None and t and shingle_set(t) == shingle_set(next(t for i, t, _ in rows if i == 700)))}
    assert setsketch.near_duplicate_rows(frame(spark, rows).where("false")).count() == 0


def test_sketches_of_unions_are_maxima_and_estimates_are_near():
    from postloom.llm.common import mixed

    a, b = (mixed(np.arange(s, s + 500, dtype=np.uint64)) for s in (0, 60))
    x, y = setsketch.sketch(a), setsketch.sketch(b)
    assert (np.maximum(x, y) == setsketch.sketch(np.union1d(a, b))).all()
    similarity = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
    got = setsketch.likely_similarity(x[None].astype(int), y[None].astype(int), np.array([500.0]), np.array([500.0]))[0]
    assert abs(got - similarity) < 0.1
    assert (setsketch.sketch(a[:0]) == 0).all()
    for percent in (80, 85):
        width = setsketch.band_width(percent / 100)
        assert (1 - (percent / 100) ** width) ** (setsketch.REGISTERS // width) <= setsketch.MISS


def vectors():
    r = np.random.default_rng(2)
    x = r.normal(0, 1, (300, 16))
    x[40:60] = x[0] + r.normal(0, 0.1, (20, 16))
    x[60:70] = x[5]
    x[70] = 3 * x[5]
    rows = [(k + 100, [float(f) for f in np.float32(v)]) for k, v in enumerate(x)]
    rows += [(1, None), (2, [0.0] * 16), (3, [float("nan")] + [1.0] * 15), (4, [float("inf")] + [1.0] * 15), (5, [None] + [1.0] * 15), (6, []), (7, [1.0, 2.0]), (8, [1.0, 2.0])]
    return rows


def brute_vectors(rows, threshold):
    good = {i: np.array(v, np.float64) for i, v in rows if v and all(f is not None and np.isfinite(f) for f in v) and any(v)}
    links = defaultdict(set)
    for a, x in good.items():
        for b, y in good.items():
            if a != b and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= threshold:
                links[a].add(b)
    low = {i: i for i, _ in rows}
    for _ in range(len(rows)):
        new = {i: min([low[i], *(low[j] for j in links[i])]) for i in low}
        if new == low:
            break
        low = new
    return {i: (len(links[i]), low[i], low[i] == i) for i, _ in rows}


def test_near_vectors(spark):
    rows = vectors()
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, label int, id string").repartition(3)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in small_world.near_vector_rows(df).collect()}
    want = brute_vectors(rows, 0.9)
    assert got == want
    more = spark.createDataFrame([(None, rows[0][1], 0, "x"), (101, rows[2][1], 0, "x"), (101, rows[2][1], 0, "x")], df.schema)
    assert small_world.near_vector_rows(df.unionByName(more)).count() == len(rows) + 3
    assert small_world.near_vector_rows(df.where("false")).count() == 0


def test_graph_recall_and_wide_beams():
    r = np.random.default_rng(7)
    x = r.normal(0, 1, (3000, 24))
    x[:700] = x[0] + r.normal(0, 0.15, (700, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = small_world.Graph.build(x)
    q = x[::20]
    sims = q @ x.T
    rows, nodes = graph.within(q, 0.9, 32)
    assert len(set(zip(rows.tolist(), nodes.tolist()))) == len(rows) >= 0.99 * (sims >= 0.9).sum()
    ten = -np.partition(-sims, 9, axis=1)[:, 9]
    found = graph.nearest(q, 96)[1]
    assert (found >= ten[:, None] - 1e-6).sum() >= 0.9 * (sims >= ten[:, None] - 1e-6).sum()


def test_audit_sees_lost_links_beside_a_hot_group(tmp_path):
    r = np.random.default_rng(11)
    x = r.normal(0, 1, (3000, 24))
    x[:1000] = x[0] + r.normal(0, 0.1, (1000, 24))
    x[1000:1040] = x[2000:2040] + r.normal(0, 0.1, (40, 24))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)
    graph = small_world.Graph.build(x)
    for what, array in (("ids", np.arange(3000)), ("copies", np.ones(3000, np.int64)), ("raw", x), ("units", x)):
        small_world.save_array(str(tmp_path), f"s-{what}", array)
    for cut in (False, True):
        if cut:  # no link leads to twenty of the copies
            graph.links[0][np.isin(graph.links[0], np.arange(1000, 1020))] = -1
        for k, links in enumerate(graph.links):
            small_world.save_array(str(tmp_path), f"s-links{k}", links)
        needed = small_world._beam_needed(small_world.Shard(str(tmp_path), "s"), x, np.arange(3000), 0.9)
        assert (needed > small_world.WIDEST) == cut
    wanted = np.minimum((x @ x.T >= 0.9).sum(1), 96)
    assert (graph.nearest(x, 96)[1] >= 0.9).sum() >= 0.995 * wanted.sum()  # summed over queries, nothing is seen


def test_near_vectors_in_shards_wider_than_a_beam(spark, monkeypatch):
    monkeypatch.setattr(small_world, "SHARDS", 2)
    r = np.random.default_rng(12)
    x = r.normal(0, 1, (1200, 24))
    x[:300] = x[0] + r.normal(0, 0.1, (300, 24))
    x[400:500] = x[700:800] + r.normal(0, 0.2, (100, 24))
    x = np.float32(x)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {v.vec_id: v.n_links for v in small_world.near_vector_rows(df).collect()}
    u = x.astype(np.float64)
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    assert [got[k] for k in range(len(x))] == ((u @ u.T >= 0.9).sum(1) - 1).tolist()

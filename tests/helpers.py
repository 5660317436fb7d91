"""Plain NumPy versions of the operators, for small input."""

from __future__ import annotations

import numpy as np


def blobs(seed=0, centres=4, per=30, dim=8, spread=0.25, noise=10, copies=6):
    rng = np.random.default_rng(seed)
    mid = rng.normal(0, 4, (centres, dim))
    x = np.concatenate([m + rng.normal(0, spread, (per, dim)) for m in mid] + [rng.normal(0, 6, (noise, dim))])
    y = np.concatenate([np.full(per, c) for c in range(centres)] + [np.full(noise, -1)])
    if copies:
        x = np.concatenate([x, np.repeat(x[:1], copies, 0)])
        y = np.concatenate([y, np.full(copies, y[0])])
    order = rng.permutation(len(x))
    return x[order].astype(np.float64), y[order]


def distance_matrix(x, metric="euclidean"):
    if metric == "cosine":
        n = np.linalg.norm(x, axis=1, keepdims=True)
        u = x / np.where(n > 0, n, 1)
        d = 1 - u @ u.T
    else:
        d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    d = np.maximum(d, 0)
    np.fill_diagonal(d, 0)
    return d


def brute_dbscan(x, eps, min_points, metric):
    d = distance_matrix(x, metric)
    hit = d <= eps
    core = hit.sum(1) >= min_points
    label = np.full(len(x), -1)
    c = 0
    for i in range(len(x)):
        if not core[i] or label[i] >= 0:
            continue
        stack = [i]
        label[i] = c
        while stack:
            j = stack.pop()
            for k in np.flatnonzero(hit[j] & core):
                if label[k] < 0:
                    label[k] = c
                    stack.append(k)
        c += 1
    for i in np.flatnonzero(~core):
        near = np.flatnonzero(hit[i] & core)
        if len(near):
            label[i] = label[near[0]]
    return label, core


def prim_weights(w):
    """Sorted edge weights of a minimum spanning tree of a full weight matrix."""
    n = len(w)
    best = w[0].copy()
    inside = np.zeros(n, dtype=bool)
    inside[0] = True
    out = []
    for _ in range(n - 1):
        masked = np.where(inside, np.inf, best)
        j = int(masked.argmin())
        out.append(masked[j])
        inside[j] = True
        best = np.minimum(best, w[j])
    return np.sort(out)


def brute_hdbscan(x, min_cluster_size, min_samples, method="eom"):
    """Top-down on the full mutual-reachability matrix: split components at every weight."""
    d = distance_matrix(x)
    core = np.sort(d, 1)[:, min(min_samples, len(x) - 1)]
    reach = np.maximum(d, np.maximum(core[:, None], core[None, :]))
    np.fill_diagonal(reach, np.inf)
    dens = lambda w: 1.0 / max(w, 1e-12)
    clusters = []  # birth, points leaving [(point, density)], children, split density

    def parts(points, w):
        left, out = set(points), []
        while left:
            s = left.pop()
            comp, stack = [s], [s]
            while stack:
                i = stack.pop()
                for j in [j for j in left if reach[i, j] < w]:
                    left.remove(j)
                    comp.append(j)
                    stack.append(j)
            out.append(sorted(comp))
        return out

    def grow(points, birth):
        me = len(clusters)
        clusters.append({"birth": birth, "leave": [], "kids": [], "split": 0.0, "moved": 0})
        now = points
        while True:
            w = max(tree_weights(reach, now))
            comps = parts(now, w)
            big = [c for c in comps if len(c) >= min_cluster_size]
            for c in comps:
                if len(c) < min_cluster_size:
                    clusters[me]["leave"] += [(p, dens(w)) for p in c]
            if len(big) == 1 and len(big[0]) > 1:
                now = big[0]
                continue
            if len(big) >= 2:
                
                clusters[me]["split"] = dens(w)
                clusters[me]["moved"] = sum(map(len, big))
                for c in big:
                    clusters[me]["kids"].append(grow(c, dens(w)))
            return me

    grow(list(range(len(x))), 0.0)
    own = [sum(l - c["birth"] for _, l in c["leave"]) + c["moved"] * (c["split"] - c["birth"]) for c in clusters]

    def best(c):
        below = [best(k) for k in clusters[c]["kids"]]
        total = sum(b for b, _ in below)
        if c != 0 and (not below or not total > own[c]):
            return own[c], [c]
        return total, [s for _, ss in below for s in ss]

    chosen = best(0)[1] if method == "eom" else [c for c in range(1, len(clusters)) if not clusters[c]["kids"]]
    label, prob = np.full(len(x), -1), np.zeros(len(x))
    for s in chosen:
        stack, top = [s], max([l for _, l in clusters[s]["leave"]] + [clusters[s]["split"]])
        while stack:
            c = stack.pop()
            stack += clusters[c]["kids"]
            for p, l in clusters[c]["leave"]:
                label[p], prob[p] = s, min(l, top) / top
    return label, prob


def tree_weights(reach, points):
    sub = reach[np.ix_(points, points)].copy()
    np.fill_diagonal(sub, 0)
    return prim_weights(sub)


def same_partition(a, b):
    """True if two labelings agree up to the names of the clusters; -1 is noise in both."""
    pairs = set(zip(a, b))
    return len(pairs) == len({p[0] for p in pairs}) == len({p[1] for p in pairs}) and all((p[0] == -1) == (p[1] == -1) for p in pairs)

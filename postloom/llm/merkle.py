"""Merkle manifest of a dataset: checkpoints of a few levels, the rest recomputed where a proof needs it.

A row is a leaf, the digest of its columns. The leaves of a source, by id, are hashed `ARITY` at a time, level by
level, until one node is left, the subroot of the source; the subroots, by source, are hashed in the same way to the root.

Only every `STEP`-th level is written down. A node of a written level stands for an aligned subtree of at most ARITY ** STEP nodes of
the written level below. To build, the subtree is hashed up and its interior is dropped. To prove, the subtree is read
again, its interior regenerated, the siblings of each of its nodes emitted, and the interior dropped again: the path of a
node is what its subtree gives, then the path of the subtree's top. So the manifest holds about 1.01 digests a row, and each task a
subtree at a time, however large a source is.

Places of leaves in their source come from ranges of ids (`running_totals`), not from a sort of a source in one task.

Defined results: null columns count as `-`; a null source is a source, the first one; rows without an id come first in
theirs; rows that share an id go by their digest; equal rows are leaves each; a source with one leaf has it as its subroot, a table
with one source that subroot as its root; an empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .running import running_totals

ARITY = 3
STEP = 4
_COPIES = 10_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def row_digest(columns: Sequence[Column]) -> Column:
    """Digest of a row: of each column `-` for null, else the number of bytes, `:`, the value."""
    parts = [c.cast("string") for c in columns]
    return F.sha2(F.concat(*(
        F.coalesce(F.concat(F.octet_length(p).cast("string"), F.lit(":"), p), F.lit("-")) for p in parts)), 256)


def _hash(nodes: Column) -> Column:
    return F.sha2(F.array_join(nodes, ""), 256)


def _level_up(nodes: Column, arity: int) -> Column:
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / arity).cast("int") - 1)
    return F.transform(runs, lambda i: _hash(F.slice(nodes, i * arity + 1, F.lit(arity))))


def _levels(count: Column, arity: int, most: int) -> Column:
    """How many levels there are above `count` nodes."""
    return sum((F.when(F.lit(arity**i) < count, 1).otherwise(0) for i in range(most)), F.lit(0))


@dataclass(frozen=True)
class Manifest:
    """The written levels of the trees of all groups: group, levels (of the group's tree above its leaves), at (place), digest, and
    further columns of the leaves."""

    written: list[DataFrame]
    arity: int
    step: int

    def tops(self) -> DataFrame:
        """group, top: the last node of each group, from the highest level written."""
        return self.written[-1].select("group", F.col("digest").alias("top"))


def _subtrees(level: DataFrame, arity: int, step: int) -> DataFrame:
    """The nodes of a written level by the subtree they belong to: group, levels, block, listed (in order), nodes (their digests)."""
    columns = ["at", *(c for c in level.columns if c not in ("group", "levels", "at"))]
    listed = level.groupBy("group", "levels", F.expr(f"at div {arity**step}").alias("block")).agg(
        F.sort_array(F.collect_list(F.struct(*columns))).alias("listed"))
    return listed.withColumn("nodes", F.col("listed.digest"))


def build(leaves: DataFrame, arity: int = ARITY, step: int = STEP) -> Manifest:
    """Manifest of `leaves`: group (never null), n (leaves in the group), at (0, 1, ... in the group), digest, and further columns."""
    largest = leaves.agg(F.max("n")).first()[0] or 0
    most = 0
    while arity**most < largest:
        most += 1
    others = [c for c in leaves.columns if c not in ("group", "n", "at", "digest")]
    written = [leaves.select("group", _levels(F.col("n"), arity, most).alias("levels"), "at", "digest", *others)]
    for below in range(0, most, step):
        grown = _subtrees(written[-1].select("group", "levels", "at", "digest"), arity, step)
        for i in range(step):  # a group that has no more levels goes on as it is
            node = F.col("nodes")
            grown = grown.withColumn("nodes", F.when(F.col("levels") > below + i, _level_up(node, arity)).otherwise(node))
        written.append(cut(grown.select("group", "levels", F.col("block").alias("at"), F.get("nodes", F.lit(0)).alias("digest"))))
    return Manifest(written, arity, step)


def paths(manifest: Manifest, above: DataFrame | None = None) -> DataFrame:
    """The proof of every leaf: the columns of the leaves, top, path. A step of the path has the digests before and after the
    node among those that are hashed together. `above` (group, above) goes on from the tops of the groups."""
    arity, step = manifest.arity, manifest.step
    known = manifest.written[-1].select("group", "at", F.col("digest").alias("top"))
    if above is None:
        known = known.withColumn("path", F.array().cast("array<struct<before:string,after:string>>"))
    else:
        known = known.join(above.withColumnRenamed("above", "path"), "group")
    for height in range(len(manifest.written) - 2, -1, -1):
        below, level = height * step, manifest.written[height]
        # Regenerate the interior: a list of nodes for each level of the subtree below its top.
        blocks = _subtrees(level, arity, step).withColumnRenamed("nodes", "_in0")
        for i in range(1, step):
            blocks = blocks.withColumn(f"_in{i}", F.when(F.col("levels") > below + i, _level_up(F.col(f"_in{i - 1}"), arity)))
        blocks = blocks.join(known.withColumnRenamed("at", "block"), ["group", "block"])
        inside = [f"_in{i}" for i in range(step)]
        each = blocks.select("group", "levels", "top", "path", *inside, F.posexplode("listed").alias("_own", "_leaf"))
        steps = []
        for i, name in enumerate(inside):
            place = F.expr(f"cast(_own div {arity**i} as int)")
            first = F.expr(f"cast(_own div {arity ** (i + 1)} as int)") * arity
            siblings = F.struct(
                F.array_join(F.slice(name, first + 1, place - first), "").alias("before"),
                F.array_join(F.slice(name, place + 2, first + arity - 1 - place), "").alias("after"))
            steps.append(F.when(F.col("levels") > below + i, F.array(siblings)).otherwise(F.slice("path", 1, 0)))
        own = [F.col("_leaf")[c].alias(c) for c in level.columns if c not in ("group", "levels")]
        known = each.select("group", *own, "top", F.concat(*steps, "path").alias("path"))
        if height:
            known = cut(known.drop("digest"))
    if len(manifest.written) == 1:
        known = manifest.written[0].drop("levels").join(known, ["group", "at"])
    return known


def folded(digest: Column, path: Column) -> Column:
    """The root that a digest and the siblings on its path lead to."""
    return F.aggregate(path, digest, lambda h, s: F.sha2(F.concat(s["before"], h, s["after"]), 256))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def proofs(
    docs: DataFrame, fields: Sequence[str] = FIELDS, doc_id: str = "doc_id", source: str = "source", arity: int = ARITY, step: int = STEP,
    tampered: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row of `docs`: doc_id, source, leaf, subroot, root, path (its proof), tampered_leaf.

    `tampered` gives other expressions for some fields; the digest of the row with them is `tampered_leaf`.
    """
    group = F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("n"))  # null first, then by bytes
    changed = tampered or {}
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(source).cast("string").alias("source"), group.alias("group"),
        row_digest([F.col(f) for f in fields]).alias("leaf"), row_digest([changed.get(f, F.col(f)) for f in fields]).alias("tampered_leaf"))
    combined = cut(rows.groupBy("group", "source", "doc_id", "leaf", "tampered_leaf").agg(F.count("*").alias("copies")))
    placed = running_totals(combined, "group", ["doc_id", "leaf"], F.col("copies"), "before", "n")
    # Equal rows come one by one again, in steps, so that no list grows with their number.
    stepped = placed.withColumn("_step", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(copies - 1) div {_COPIES}"))))
    first = F.col("_step") * _COPIES
    each = stepped.withColumn("_copy", F.explode(F.sequence(first, F.least(F.col("copies") - 1, first + _COPIES - 1))))
    manifest = build(cut(each.select(
        "group", "n", (F.col("before") + F.col("_copy")).alias("at"), F.col("leaf").alias("digest"), "doc_id", "source", "tampered_leaf")), arity, step)
    # The subroots are the leaves of the upper tree, all in one group.
    tops = manifest.tops().select(F.lit("all").alias("all"), F.col("group").alias("own"), F.col("top").alias("digest"))
    upper = build(cut(running_totals(tops, "all", ["own"], F.lit(1).cast("long"), "at", "n").withColumnRenamed("all", "group")), arity, step)
    over = paths(upper).select(F.col("own").alias("group"), F.col("path").alias("above"))
    root = upper.tops().first()
    return paths(manifest, over).select(
        "doc_id", "source", "at", F.col("digest").alias("leaf"), F.col("top").alias("subroot"),
        F.lit(root["top"] if root else None).cast("string").alias("root"), "path", "tampered_leaf")


def proof_rows(docs: DataFrame) -> DataFrame:
    """Every row with its proof, and whether it still leads to the root if line feeds are lost in every second text."""
    lost = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    text = F.col("text").cast("string")
    done = proofs(docs, tampered={"text": F.when(lost, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)})
    found = done.withColumn("folded_root", folded(F.col("tampered_leaf"), F.col("path")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), "source", F.col("at").alias("leaf_number"))

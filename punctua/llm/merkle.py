"""Merkle manifest of a dataset: checkpointed levels, proofs recomputed from them.

A tree has runs of ``FAN`` nodes. Only every ``STRIDE``-th level is stored, as one row for each aligned subtree of ``FAN ** STRIDE`` nodes; the
levels between are regenerated from the row while proofs are cut out of it, and are not kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from punctua.llm.common import staged

FAN = 16
STRIDE = 2
SPAN = FAN**STRIDE
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass
class Manifest:
    """Stored levels: ``levels[j]`` has one row for each subtree, ``tree, block, n, nodes``; ``tree`` is a source, or null above ``sources``.

    ``documents``: subtrees of leaves with what is known of them. ``tops``: subtrees of the tree over all sources.
    """

    documents: list[DataFrame]
    tops: list[DataFrame]
    subroots: DataFrame
    root: DataFrame


def field(value: Column) -> Column:
    """A value as it enters a leaf: ``-`` for null, else its length in UTF-8 bytes, a colon, and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(**changed: Column) -> Column:
    """The leaf of a document, with some columns replaced."""
    return F.sha2(F.concat(*[field(changed.get(name, F.col(name))) for name in FIELDS]), 256)


def tampered_text() -> Column:
    """The text with A-Z lower-cased where 5 divides the CRC of the id; null elsewhere."""
    return F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.translate("text", _UPPER, _LOWER))


def _numbered(batches: Iterator[pa.RecordBatch], tree: str) -> Iterator[pa.RecordBatch]:
    """The rows of a task, sorted by tree, with ``at``: how many rows of the tree came before in this task."""
    last, n = object(), 0
    for batch in batches:
        codes = batch[tree].dictionary_encode()
        code = codes.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        names = codes.dictionary.to_pylist()
        starts = np.flatnonzero(np.diff(code, prepend=-2))
        at = np.arange(len(code)) - np.repeat(starts, np.diff(np.append(starts, len(code))))
        if len(code):
            name = lambda c: None if c < 0 else names[c]
            if name(code[0]) == last:
                at[:starts[1] if len(starts) > 1 else len(at)] += n
            last, n = name(code[-1]), int(at[-1]) + 1
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at.astype(np.int64))], names=[*batch.schema.names, "at"])


def _positions(nodes: DataFrame, name: str, *order: str) -> DataFrame:
    """``nodes`` with ``at``, the row's place in its tree by ``order``, and ``n``, the tree's size.

    Rows are dealt out in ranges of tree and order, so a tree of any size spreads over many tasks; a row's place is its place in its task
    plus the tree's rows in the tasks before, of which there is one sum for each task and tree.
    """
    keys = ["tree", *order]
    nodes = nodes.withColumn("row", F.monotonically_increasing_id())  # deals out equal rows, too; they are alike in any order
    dealt = nodes.repartitionByRange(*keys, "row").sortWithinPartitions(*keys, "row")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
    local = staged(dealt.mapInArrow(partial(_numbered, tree="tree"), schema + ", at bigint").withColumn("task", F.spark_partition_id()).drop("row"), f"{name}-local")
    before = Window.partitionBy("tree").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    sums = (local.groupBy("tree", "task").agg(F.count(F.lit(1)).alias("c"))
            .select("tree", "task", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"), F.sum("c").over(Window.partitionBy("tree")).alias("n")))
    x, y = local.alias("x"), sums.alias("y")
    same = F.col("x.tree").eqNullSafe(F.col("y.tree")) & (F.col("x.task") == F.col("y.task"))
    return x.join(y, same).select("x.*", "y.before", "y.n").withColumn("at", F.col("at") + F.col("before")).drop("before", "task")


def _subtrees(nodes: DataFrame, *carried: str) -> DataFrame:
    """One row for each aligned subtree: ``tree, block, n, nodes`` with the nodes in order (``at, hash`` and what is carried)."""
    return (nodes.groupBy("tree", F.expr(f"at div {SPAN}").alias("block"), "n")
            .agg(F.array_sort(F.collect_list(F.struct("at", "hash", *carried))).alias("nodes")))


def _parents(hashes: Column) -> Column:
    """The level above an array of nodes: each run of ``FAN`` as its hash."""
    runs = F.sequence(F.lit(0), F.floor((F.size(hashes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(hashes, i * FAN + 1, FAN), ""), 256))


def _grow(nodes: DataFrame, name: str, *carried: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels above ``tree, at, n, hash`` and ``tree, hash`` of the last node of every tree."""
    levels = [staged(_subtrees(nodes, *carried), f"{name}-0")]
    while True:
        low = levels[-1]
        runs = low.where("n > 1").select("tree", "block", "n", F.transform("nodes", lambda x: x["hash"]).alias("hashes")).withColumn("runs", _parents(F.col("hashes")))
        top = F.when(F.col("n") <= FAN, F.col("runs")[0]).otherwise(_parents(F.col("runs"))[0])
        up = runs.select("tree", F.col("block").alias("at"), F.expr(f"(n + {SPAN - 1}) div {SPAN}").alias("n"), top.alias("hash"))
        up = staged(_subtrees(up), f"{name}-{len(levels)}")
        if up.isEmpty():
            break
        levels.append(up)
    ends = [level.where("n = 1").select("tree", F.col("nodes")[0]["hash"].alias("hash")) for level in levels]
    roots = ends[0]
    for more in ends[1:]:
        roots = roots.unionByName(more)
    return levels, roots


def build_manifest(docs: DataFrame) -> Manifest:
    """The trees of ``docs``: one for each source over its documents by ascending id, and one over the sources (null first, then by bytes).

    Rows of a source that share an id are ordered by leaf; null ids come first. Every column may be null. Levels are written below ``spark.checkpoint.dir``.
    """
    leaves = staged(docs.select(F.col("source").alias("tree"), "doc_id", leaf_hash().alias("hash"), F.when(tampered_text().isNotNull(), leaf_hash(text=tampered_text())).alias("tampered")), "merkle-leaves")
    placed = _positions(leaves, "merkle", "doc_id", "hash")
    documents, subroots = _grow(placed, "merkle-docs", "doc_id", "tampered")
    subroots = staged(subroots, "merkle-subroots")
    over = _positions(subroots.select(F.lit(None).cast("string").alias("tree"), F.col("tree").alias("source"), "hash"), "merkle-tops", "source")
    tops, root = _grow(over, "merkle-tops", "source")
    return Manifest(documents, tops, subroots, staged(root, "merkle-root"))


def _siblings(hashes: Column, at: Column) -> Column:
    """What stands left and right of place ``at`` in its run."""
    first = F.floor(at / FAN).cast("int") * FAN
    return F.struct(F.array_join(F.slice(hashes, first + 1, at - first), "").alias("left"), F.array_join(F.slice(hashes, at + 2, first + FAN - 1 - at), "").alias("right"))


def _cut_proofs(levels: list[DataFrame], over: DataFrame, *carried: str) -> DataFrame:
    """``tree, hash, subroot, path`` and what is carried for every node of the lowest level; ``path``: siblings level by level up to the last root.

    ``over`` has ``tree, subroot, above``, the path of every tree's own root. From the top down, each stored subtree meets the path of its root in one
    equi join by subtree, regenerates its inner level, and hands to each of its nodes that node's siblings and the path above.
    """
    above = None
    for low in range(len(levels) - 1, -1, -1):
        x, y = levels[low].alias("x"), over.alias("y")
        level = x.where("n = 1").join(y, F.col("x.tree").eqNullSafe(F.col("y.tree"))).select("x.*", "y.subroot", "y.above")
        if above is not None:
            y = above.alias("y")
            level = level.unionByName(x.where("n > 1").join(y, F.col("x.tree").eqNullSafe(F.col("y.tree")) & (F.col("x.block") == F.col("y.at")))
                                      .select("x.*", "y.subroot", "y.above"))
        hashes = F.transform("nodes", lambda node: node["hash"])
        inner = level.withColumn("hashes", hashes).withColumn("up", F.when(F.col("n") > FAN, _parents(F.col("hashes"))))
        each = inner.select("tree", "n", "hashes", "up", "subroot", "above", F.posexplode("nodes").alias("i", "node"))
        own = F.array(_siblings(F.col("hashes"), F.col("i")))
        higher = F.array(_siblings(F.col("up"), F.floor(F.col("i") / FAN).cast("int")))
        path = F.when(F.col("n") <= 1, F.col("above")).when(F.col("n") <= FAN, F.concat(own, "above")).otherwise(F.concat(own, higher, "above"))
        names = ("at",) if low else ("hash", *carried)
        above = each.select("tree", "subroot", *[F.col(f"node.{c}").alias(c) for c in names], path.alias("above"))
    return above.withColumnRenamed("above", "path")


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda node, level: F.sha2(F.concat(level["left"], node, level["right"]), 256))


def proof_hash(path: Column) -> Column:
    """The hash of all siblings of a path, in order."""
    return F.sha2(F.array_join(F.transform(path, lambda level: F.concat(level["left"], level["right"])), ""), 256)


def extract_proofs(manifest: Manifest) -> DataFrame:
    """The proof of every document: ``doc_id, tree, hash, tampered, subroot, root, path``."""
    none = F.array().cast("array<struct<left:string,right:string>>")
    start = manifest.root.select("tree", F.lit(None).cast("string").alias("subroot"), none.alias("above"))
    over = staged(_cut_proofs(manifest.tops, start, "source").select(F.col("source").alias("tree"), F.col("hash").alias("subroot"), F.col("path").alias("above")), "merkle-paths")
    root = manifest.root.first()
    return _cut_proofs(manifest.documents, over, "doc_id", "tampered").withColumn("root", F.lit(root["hash"] if root else None).cast("string"))


def verify_documents(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified`` for every row of ``docs``.

    ``folded_root`` is what the proof makes of the leaf, or of the tampered leaf where a document is tampered with; ``verified`` says
    whether that is the root. A tampered text without A-Z (or null) still verifies. Repeated rows are leaves of their own; a null id
    is never tampered with. An empty table gives no rows.
    """
    proofs = extract_proofs(build_manifest(docs))
    folded = fold(F.coalesce("tampered", "hash"), F.col("path"))
    return (proofs.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))

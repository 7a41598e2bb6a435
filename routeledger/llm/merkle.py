"""Merkle manifest of a table: a persistent 8-ary hash tree per partition value, in aligned blocks of leaves.

Leaves are numbered per partition value (range partitions, then prefix sums of their counts). A block is
`BLOCK` consecutive nodes of one level; a task builds a block's levels, and block roots are the nodes of the
next stage, until one node is left per tree. The roots of all trees, by value, are the leaves of one more tree.
Sibling paths go down the same stages: a block gets the path above its root once, and all versions in it share
that path and the block's untouched nodes. A tampered leaf is a version: only its ancestors in the block are
copied, and its way up goes on along the shared path.

Defined results: null fields are `-`, an empty text is `0:`; equal doc_ids are ordered by leaf, equal leaves
arbitrarily (they are interchangeable); a null doc_id comes first and is never tampered; an empty table has no
rows and no root; extra columns are not read. A single leaf is its tree's root.
"""

from __future__ import annotations

import hashlib
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from routeledger.llm import shared

FANOUT = 8
BLOCK = FANOUT ** 3

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_STEP = "struct<left:string,right:string>"
_NODES = "tree string, place long, n long, hash string"


def field(c: Column) -> Column:
    """A value as `-` or byte count, colon, UTF-8 bytes."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(*columns: Column) -> Column:
    """Lowercase hex sha256 of the fields."""
    return F.sha2(F.concat(*map(field, columns)), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (tree, ...) with place, from 0 by `order` within each tree, and n, the tree's rows.

    Only the table of counts per (tree, range partition) is ordered as a whole; equal rows are told apart by
    where they are stored, so that no range is larger than the others.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    stored = shared.landed(rows, "unordered").withColumn("tie", F.monotonically_increasing_id())
    keys = ["tree", *order, "tie"]
    ordered = shared.landed(
        stored.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("tie")
        .withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.shiftright("at", 33)), "ordered")
    whole = Window.partitionBy("tree")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    start = ordered.groupBy("tree", "part").agg(F.min("at").alias("low"), F.count(F.lit(1)).alias("own")).select(
        "tree", "part", F.sum("own").over(whole).alias("n"),
        (F.coalesce(F.sum("own").over(before), F.lit(0)) - F.col("low")).alias("shift"))
    return ordered.join(start, ["tree", "part"]).withColumn("place", F.col("at") + F.col("shift")).drop(
        "at", "part", "shift")


def _levels(hashes: list[str], n: int) -> list[list[str]]:
    """A block's nodes by level, leaves first: up to the block's root, or to the tree's if n nodes end below it."""
    out, width, span = [hashes], n, BLOCK
    while width > 1 and span > 1:
        last = out[-1]
        out.append([_hash("".join(last[i:i + FANOUT])) for i in range(0, len(last), FANOUT)])
        width, span = -(-width // FANOUT), span // FANOUT
    return out


def _siblings(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """What stands left and right of node `at` in its run, level by level below the block's root."""
    path = []
    for level in levels[:-1]:
        low = at - at % FANOUT
        path.append(("".join(level[low:at]), "".join(level[at + 1:low + FANOUT])))
        at //= FANOUT
    return path


def _sorted(group: pa.Table) -> pa.Table:
    return group.sort_by("place").combine_chunks()


def _raise(group: pa.Table) -> pa.Table:
    group = _sorted(group)
    n, place = group.column("n")[0].as_py(), group.column("place")[0].as_py()
    top = _levels(group.column("hash").to_pylist(), n)[-1][0]
    return pa.table({"tree": group.column("tree").slice(0, 1), "place": pa.array([place // BLOCK]),
                     "n": pa.array([-(-n // BLOCK)]), "hash": pa.array([top])})


def _path_arrays(paths: list[list[tuple[str, str]]]) -> pa.Array:
    return pa.array([[{"left": a, "right": b} for a, b in p] for p in paths],
                    pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())])))


def _lower(group: pa.Table, above: pa.Table) -> pa.Table:
    """Each node's path to the top: siblings in its block, then the path of the block."""
    group = _sorted(group)
    places = group.column("place").to_pylist()
    levels = _levels(group.column("hash").to_pylist(), group.column("n")[0].as_py())
    rest = [(x["left"], x["right"]) for x in above.column("path")[0].as_py()]
    paths = [_siblings(levels, p - places[0]) + rest for p in places]
    return pa.table({"tree": group.column("tree"), "place": group.column("place"), "path": _path_arrays(paths)})


def _block() -> Column:
    return F.floor(F.col("place") / BLOCK).cast("long")


class Stages:
    """The nodes of every stage of a forest, from its leaves (tree, place, n, hash) up to one node per tree."""

    def __init__(self, leaves: DataFrame) -> None:
        self.nodes = [leaves]
        most = leaves.agg(F.max("n")).first()[0] or 0
        while most > 1:
            self.nodes.append(shared.landed(
                self.nodes[-1].select("tree", _block().alias("block"), "place", "n", "hash")
                .groupBy("tree", "block").applyInArrow(_raise, _NODES), "nodes"))
            most = -(-most // BLOCK)

    @property
    def top(self) -> DataFrame:
        """(tree, hash): the root of each tree."""
        return self.nodes[-1].select("tree", "hash")

    def paths(self, above: DataFrame, stage: int) -> DataFrame:
        """(tree, place, path to the top) of a stage's nodes, 0 the leaves; above: (tree, path) of the roots."""
        path = above.select("tree", F.lit(0).cast("long").alias("place"), "path")
        for nodes in reversed(self.nodes[stage:-1]):
            blocks = nodes.select("tree", _block().alias("block"), "place", "n", "hash").groupBy("tree", "block")
            path = blocks.cogroup(path.withColumnRenamed("place", "block").groupBy("tree", "block")).applyInArrow(
                _lower, f"tree string, place long, path array<{_STEP}>")
        return path


def above_roots(roots: DataFrame) -> DataFrame:
    """Of (tree, hash): (tree, path, root), the way up to the root over all of them, ordered by tree."""
    rows = shared.landed(ranked(
        roots.select(F.lit("").alias("tree"), F.col("tree").alias("own"), "hash"), ["own"]), "roots")
    stages = Stages(rows.select("tree", "place", "n", "hash"))
    path = stages.paths(rows.select("tree", F.array().cast(f"array<{_STEP}>").alias("path")).distinct(), 0)
    return rows.join(path, ["tree", "place"]).join(stages.top.withColumnRenamed("hash", "root"), "tree").select(
        F.col("own").alias("tree"), "path", "root")


_PROOF = "doc_id long, tree string, place long, leaf string, changed string, subroot string, root string, " \
    "proof array<string>, copies array<string>, folded_root string"


def _versions(group: pa.Table, above: pa.Table) -> pa.Table:
    """Per leaf its proof, and the path copied for its version: new nodes from the leaf up to the root."""
    group = _sorted(group)
    places, leaves = group.column("place").to_pylist(), group.column("hash").to_pylist()
    levels = _levels(leaves, group.column("n")[0].as_py())
    rest = [(x["left"], x["right"]) for x in above.column("path")[0].as_py()]
    proofs, copies = [], []
    for at, own, new in zip((p - places[0] for p in places), leaves, group.column("changed").to_pylist()):
        path = _siblings(levels, at) + rest
        proofs.append([a + b for a, b in path])
        node = own if new is None else new
        up = []
        for a, b in path:
            node = _hash(a + node + b)
            up.append(node)
        copies.append(up)
    folded = [up[-1] if up else (own if new is None else new)
              for up, own, new in zip(copies, leaves, group.column("changed").to_pylist())]
    same = lambda c: pa.array([above.column(c)[0].as_py()] * len(places), pa.string())
    copies = [up if new is not None else None for up, new in zip(copies, group.column("changed").to_pylist())]
    return pa.table({
        "doc_id": group.column("doc_id"), "tree": group.column("tree"), "place": group.column("place"),
        "leaf": group.column("hash"), "changed": group.column("changed"), "subroot": same("subroot"),
        "root": same("root"), "proof": pa.array(proofs, pa.list_(pa.string())),
        "copies": pa.array(copies, pa.list_(pa.string())), "folded_root": pa.array(folded, pa.string())})


class Manifest:
    """The hash trees of a table of leaves (tree, doc_id, hash, changed): changed is the tampered leaf or null."""

    def __init__(self, leaves: DataFrame) -> None:
        self.leaves = shared.landed(ranked(leaves, ["doc_id", "hash"]), "leaves")
        self.stages = Stages(self.leaves.select("tree", "place", "n", "hash"))
        subroots = shared.landed(self.stages.top, "subroots")
        #: (tree, subroot, path from the subroot to the root, root)
        self.trees = shared.landed(
            subroots.withColumnRenamed("hash", "subroot").join(above_roots(subroots), "tree"), "trees")

    def versions(self) -> DataFrame:
        """Per leaf: doc_id, tree, place, leaf, changed, subroot, root, proof (siblings, a string a level),
        copies (a version's new nodes from above its leaf to its root), folded_root."""
        path = self.stages.paths(self.trees.select("tree", "path"), 1).join(
            self.trees.select("tree", "subroot", "root"), "tree")
        leaves = self.leaves.select("doc_id", "tree", _block().alias("block"), "place", "n", "hash", "changed")
        return leaves.groupBy("tree", "block").cogroup(
            path.withColumnRenamed("place", "block").groupBy("tree", "block")).applyInArrow(_versions, _PROOF)


def leaves(docs: DataFrame) -> DataFrame:
    """(tree, doc_id, hash, changed): a leaf a row; tampering lower-cases A-Z where crc32(doc_id) divides by 3.

    A tree's name is the language behind `=`, empty for null, so that names sort as the languages do.
    """
    own = [F.col(c) for c in FIELDS]
    text = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return docs.select(
        F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf(*own).alias("hash"),
        F.when(tampered, leaf(*own[:-1], text)).alias("changed"))


def manifest(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified."""
    return Manifest(leaves(docs)).versions().select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))

"""A Merkle manifest of a dataset: a root over all documents, and a proof for each.

``H`` is SHA-256 in lowercase hex of its inputs put together as text. A document's leaf is ``H`` of its
fields, each ``-`` if null, else its size in UTF-8 bytes, ``:`` and its value. The leaves of a source
stand in the order of ``doc_id``; runs of ``FANOUT`` nodes become their ``H``, until one node is left, the
source's subroot. Subroots, in the order of sources, are reduced to the root in the same way.

The work is one exchange of superblocks, ``SPAN`` consecutive leaves of a source:

1. Leaves are hashed where they are read; texts are not shuffled. Sorting by source and id over a range
   partitioning, and the sizes of the parts before, give each leaf its place, however large a source is.
2. Superblocks are reduced to one node each, and these level by level, runs of ``FANOUT`` at a time.
3. From the root down each node gets the runs that it and its ancestors stand in: the outer nodes of its proofs.
4. Leaves and outer nodes are cogrouped by superblock. There the local levels are reduced, proofs joined and
   the (tampered) leaves folded up to a root. A task holds a superblock at a time.

Defined results: a null ``doc_id`` comes before all others, documents of equal ids stand in the order of their
leaves, and equal rows get the proofs of their places. A null source comes before all others. Other columns
than the five named are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterable
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from twinloom.session import materialize

BITS = 4
FANOUT = 1 << BITS
#: Levels within a superblock, and the leaves that it spans.
HEIGHT = 3
SPAN = FANOUT ** HEIGHT
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

RUN = "struct<place:int,members:array<string>>"
PROVEN = (
    "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
)


def digest(parts: Iterable[str]) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def depth(nodes: int) -> int:
    """How many reductions leave one node."""
    levels = 0
    while nodes > 1:
        nodes, levels = -(-nodes // FANOUT), levels + 1
    return levels


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


def lower_cased(text: Column) -> Column:
    """The tampering that the manifest is tried on: A-Z of the text in lower case."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


# --- Places -------------------------------------------------------------------


def placed(rows: DataFrame, group: str, order: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` stored in order with ``part``, ``at`` (their place in it), and ``part, group, first, before, n``.

    A row's place in its group is ``before + at - first``; ``n`` is the size of the group. The sort is spread over
    ranges, so a group may be of any size; only the counts of its parts meet in one task.
    """
    by = [F.asc_nulls_first(c) for c in (group, *order)]
    numbered = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_n", F.monotonically_increasing_id())
    stored = materialize(numbered, name).select(
        *rows.columns, F.shiftright("_n", 33).alias("part"), F.col("_n").bitwiseAND((1 << 33) - 1).alias("at")
    )
    parts = stored.groupBy("part", group).agg(F.min("at").alias("first"), F.count("*").alias("size"))
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counted = parts.select(
        "part", group, "first", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(whole).alias("n"),
    )
    return stored, materialize(counted, f"{name}-parts")


# --- Nodes --------------------------------------------------------------------


def runs_of(nodes: DataFrame) -> DataFrame:
    """``tree, n, run, members`` of ``tree, n, idx, node``: nodes in runs of ``FANOUT``, in order."""
    members = F.sort_array(F.collect_list(F.struct("idx", "node")))
    runs = nodes.groupBy("tree", "n", F.shiftright("idx", BITS).alias("run")).agg(members.alias("m"))
    return runs.select("tree", "n", "run", F.transform("m", lambda x: x["node"]).alias("members"))


def reduced(runs: DataFrame) -> DataFrame:
    """Each run as a node of the level above."""
    return runs.select("tree", "n", F.col("run").alias("idx"), F.sha2(F.array_join("members", ""), 256).alias("node"))


@dataclass(frozen=True)
class Level:
    """The runs of trees that have several nodes at this level."""

    runs: DataFrame
    size: int  # leaves below each node


def levels_above(nodes: DataFrame, size: int, largest: int, name: str) -> tuple[list[Level], DataFrame]:
    """All levels over ``tree, n, idx, node``, whose nodes stand for ``size`` leaves each, and the last nodes."""
    levels = []
    while largest > size:
        runs = materialize(runs_of(nodes.where(F.col("n") > size)), f"{name}-runs")
        levels.append(Level(runs, size))
        nodes = materialize(nodes.where(F.col("n") <= size).unionByName(reduced(runs)), f"{name}-nodes")
        size *= FANOUT
    return levels, nodes


def paths_below(tops: DataFrame, levels: list[Level], name: str) -> DataFrame:
    """``idx`` and ``path`` of the lowest nodes, from ``tree, n, path`` of the last ones; other columns are handed down.

    A path lists the runs that a node and its ancestors stand in, upwards. A run has one parent and
    ``FANOUT`` children at most, so that nothing meets more than that many rows.
    """
    carried = [c for c in tops.columns if c not in ("tree", "path")]
    paths = tops.select("tree", *carried, F.lit(0).cast("long").alias("idx"), "path")
    for level in reversed(levels):
        met = level.runs.drop("n").join(paths.withColumnRenamed("idx", "run"), ["tree", "run"]).select(
            "tree", *carried, "run", "members", "path", F.explode(F.sequence(F.lit(0), F.size("members") - 1)).alias("place")
        )
        below = met.select(
            "tree", *carried, (F.col("run") * FANOUT + F.col("place")).alias("idx"),
            F.concat(F.array(F.struct("place", "members")), F.col("path")).alias("path"),
        )
        paths = materialize(paths.where(F.col("n") <= level.size).unionByName(below), name)
    return paths


def subtree_node(block: pd.DataFrame) -> pd.DataFrame:
    """A superblock's leaves reduced to its node: ``tree, n, idx, node``."""
    block = block.sort_values("pos")
    level, n = list(block["leaf"]), int(block["n"].iloc[0])
    for _ in range(min(depth(n), HEIGHT)):
        level = [digest(level[k:k + FANOUT]) for k in range(0, len(level), FANOUT)]
    return pd.DataFrame(
        {"tree": [int(block["tree"].iloc[0])], "n": [n], "idx": [int(block["block"].iloc[0])], "node": [level[0]]}
    )


def prove_block(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proofs of a superblock's leaves, from themselves and the one row of nodes outside."""
    block = block.sort_values("pos", ignore_index=True)
    around = []  # for each local level: what stands before and after each node in its run
    level = list(block["leaf"])
    for _ in range(min(depth(int(block["n"].iloc[0])), HEIGHT)):
        sides, above = [], []
        for k in range(0, len(level), FANOUT):
            run = level[k:k + FANOUT]
            above.append(digest(run))
            sides += [("".join(run[:j]), "".join(run[j + 1:])) for j in range(len(run))]
        around.append(sides)
        level = above
    beyond = [("".join(r["members"][:r["place"]]), "".join(r["members"][r["place"] + 1:])) for r in outer["path"].iloc[0]]
    tail = "".join(before + after for before, after in beyond)

    proofs, folded = [], []
    for at, (leaf, tampered) in enumerate(zip(block["leaf"], block["tampered"])):
        node, siblings = leaf if tampered is None else tampered, []
        for sides in around:
            before, after = sides[at]
            siblings += (before, after)
            node, at = digest((before, node, after)), at // FANOUT
        for before, after in beyond:
            node = digest((before, node, after))
        proofs.append(digest((*siblings, tail)))
        folded.append(node)
    root = outer["root"].iloc[0]
    return pd.DataFrame({
        "doc_id": block["doc_id"], "leaf": block["leaf"], "subroot": outer["subroot"].iloc[0], "root": root,
        "proof_sha256": proofs, "folded_root": folded, "verified": [node == root for node in folded],
    })


# --- The manifest -------------------------------------------------------------


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Each document's leaf, its source's subroot, the root, the digest of its proof, and what it folds up to.

    ``tampered`` (a condition on the columns of ``docs``) marks documents whose text is changed after the
    manifest was made: their fold starts from the leaf of the changed text.
    """
    doc_id, source, lang, n_chars, text = (
        F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string") for c in FIELDS
    )
    changed = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = docs.select(
        doc_id.alias("doc_id"), source.alias("source"), leaf_of(doc_id, source, lang, n_chars, text).alias("leaf"),
        F.when(changed, leaf_of(doc_id, source, lang, n_chars, lower_cased(text))).alias("tampered"),
    )
    stored, parts = placed(leaves, "source", ["doc_id", "leaf"], "manifest-leaves")

    # Sources by number: their places are the leaves of the tree above.
    sizes = parts.select("source", F.lit(0).alias("all")).distinct()
    listed, ranges = placed(sizes, "all", ["source"], "manifest-sources")
    trees = materialize(listed.join(ranges.drop("all"), "part").select(
        F.col("source").alias("_named"), (F.col("before") + F.col("at") - F.col("first")).alias("tree")
    ), "manifest-trees")
    numbered = parts.join(trees, F.col("source").eqNullSafe(F.col("_named"))).select(
        F.col("part").alias("_part"), "_named", "first", "before", "n", "tree"
    )
    found = (F.col("part") == F.col("_part")) & F.col("source").eqNullSafe(F.col("_named"))
    leaves = stored.join(numbered, found).select(
        "tree", "n", (F.col("before") + F.col("at") - F.col("first")).alias("pos"),
        F.col("doc_id").cast("string").alias("doc_id"), "leaf", "tampered",
    ).withColumn("block", F.shiftright("pos", BITS * HEIGHT))

    largest, sources = parts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0], trees.count()
    reduced_blocks = leaves.groupBy("tree", "block").applyInPandas(subtree_node, "tree long, n long, idx long, node string")
    blocks = materialize(reduced_blocks, "manifest-blocks")
    levels, subroots = levels_above(blocks, SPAN, largest, "manifest")
    ends = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.lit(sources).cast("long").alias("n"), F.col("tree").alias("idx"), "node"
    )
    top_levels, tops = levels_above(ends, 1, sources, "manifest-top")

    start = tops.select("tree", "n", F.array().cast(f"array<{RUN}>").alias("path"), F.col("node").alias("subroot"))
    above = paths_below(start, top_levels, "manifest-top-paths").select(
        F.col("idx").alias("tree"), "path", F.col("subroot").alias("root")
    )
    start = subroots.join(above, "tree").select("tree", "n", "path", F.col("node").alias("subroot"), "root")
    outer = paths_below(start, levels, "manifest-paths").withColumnRenamed("idx", "block")
    proven = leaves.groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(prove_block, PROVEN)
    return proven.withColumn("doc_id", F.col("doc_id").cast("long"))

"""Merkle manifest of a dataset, with an inclusion proof for every row, by a butterfly exchange.

Each part of the rows (a language, say) is a tree over its leaves in a stated order: every ``fanout``
consecutive nodes become their digest until one node remains, the part's subroot; the subroots, in
the order of the parts, give the root the same way.

* Rows are range-sorted and numbered by per-slice counts, so no task holds a whole part.
* ``fanout ** LEVELS`` consecutive leaves form an aligned block, whose subtree one task hashes.
* Blocks then meet in rounds.  In round r the ``fanout`` blocks that differ only in digit r of their
  number swap the roots of their aligned subtrees.  Each hashes the common ancestor for itself, so it
  knows its siblings on every level when the rounds are over, without a pass back down.  Where the
  last subtree of a run is short, its blocks also serve the numbers it lacks.  Every group has at
  most ``fanout`` members, and all rounds shuffle one narrow row per block.
* The subroots meet by the same rounds, one block per part.

The manifest is data: ``fold`` and ``proof_digest`` are plain column expressions over a leaf and its
proof, which check a row without the other rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch

FANOUT = 8
LEVELS = 4


def leaf_digest(columns: Sequence[Column]) -> Column:
    """Digest of some values: ``-`` for null, else byte count, ``:`` and the value as text."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*[field(c) for c in columns]).cast("binary"), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """Root that follows from a leaf digest and its proof."""
    return F.aggregate(proof, leaf, lambda node, p: F.sha2(F.concat(p["before"], node, p["after"]).cast("binary"), 256))


def proof_digest(proof: Column) -> Column:
    """Digest of all sibling digests, from the leaf's level up, left to right."""
    return F.sha2(F.array_join(F.transform(proof, lambda p: F.concat(p["before"], p["after"])), "").cast("binary"), 256)


def positions(rows: DataFrame, part: Sequence[str], order: Sequence[str], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with ``position`` (from 0, within its part, nulls first) and ``size`` (rows of the part).

    One range shuffle; what is added up on the way is one row per slice and part.  Rows equal in
    ``order`` are split too, so no group of copies lands in one slice."""
    keys = [F.col(c).asc_nulls_first() for c in (*part, *order)]
    sorted_ = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys, F.col("tie")).sortWithinPartitions(*keys, "tie")
    placed = scratch.put(name, sorted_.select(
        *rows.columns, F.spark_partition_id().alias("slice"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at")))
    counts = placed.groupBy("slice", *part).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    whole = Window.partitionBy(*[F.col(c) for c in part] or [F.lit(0)])
    before = F.coalesce(F.sum("n").over(whole.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(F.col("slice").alias("slice2"), *[F.col(c).alias(f"{c}2") for c in part],
                           (before - F.col("first")).alias("shift"), F.sum("n").over(whole).alias("size"))
    same = F.col("slice") == F.col("slice2")
    for c in part:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}2"))
    return placed.join(counts, same).select(*rows.columns, (F.col("at") + F.col("shift")).alias("position"), "size")


def _tree(leaves: list[str], size: int, fanout: int, height: int) -> list[list[str]]:
    """Levels of a block's subtree.  A part of one block stops at its subroot; a block of several is
    hashed up to its full height, lone nodes too, because others remain beside it."""
    levels = [leaves]
    while len(levels) <= height and (size > fanout ** height or len(levels[-1]) > 1):
        low = levels[-1]
        levels.append([hashlib.sha256("".join(low[i:i + fanout]).encode()).hexdigest() for i in range(0, len(low), fanout)])
    return levels


def _leaves(table: pa.Table) -> tuple[pa.Table, list[str], int]:
    table = table.sort_by("position")
    return table, [b.hex() for b in table.column("leaf").to_pylist()], table.column("size")[0].as_py()


def _block_root(fanout: int, height: int):
    def root(table: pa.Table) -> pa.Table:
        table, leaves, size = _leaves(table)
        top = _tree(leaves, size, fanout, height)[-1][0]
        return pa.table({"tree": table.column("tree")[:1], "block": table.column("block")[:1],
                         "n_blocks": pa.array([-(-size // fanout ** height)], pa.int64()), "node": pa.array([top], pa.string())})
    return root


def _block_proofs(fanout: int, height: int, carry: list[str]):
    step = pa.struct([("before", pa.string()), ("after", pa.string())])

    def proofs(table: pa.Table, above: pa.Table) -> pa.Table:
        table, leaves, size = _leaves(table)
        levels = _tree(leaves, size, fanout, height)
        before, after, index, base = [], [], [], 0
        at = np.arange(len(leaves))
        for nodes in levels[:-1]:
            for i in range(len(nodes)):
                run = i - i % fanout
                before.append("".join(nodes[run:i]))
                after.append("".join(nodes[i + 1:run + fanout]))
            index.append(base + at)
            base, at = base + len(nodes), at // fanout
        for s in above.column("up")[0].as_py():
            before.append(s["before"])
            after.append(s["after"])
            index.append(np.full(len(leaves), base))
            base += 1
        steps = pa.StructArray.from_arrays([pa.array(before, pa.string()), pa.array(after, pa.string())], fields=list(step))
        take = np.stack(index, 1).reshape(-1) if index else np.zeros(0, np.int64)
        proof = pa.ListArray.from_arrays(pa.array(np.arange(len(leaves) + 1) * len(index), pa.int32()), steps.take(pa.array(take, pa.int64())))
        same = lambda c: pa.array([above.column(c)[0].as_py()] * len(leaves), pa.string())
        return pa.table({**{c: table.column(c) for c in carry}, "position": table.column("position"),
                         "subroot": same("subroot"), "root": same("root"), "proof": proof})
    return proofs


def butterfly(blocks: DataFrame, most: int, fanout: int = FANOUT) -> DataFrame:
    """(tree, block, node, up) after all rounds over ``blocks`` (tree, block, n_blocks, node): node is
    the root of the block's tree, up the siblings on the way to it, from below.  ``most``: the
    largest n_blocks."""
    step = "array<struct<before:string,after:string>>"
    x = blocks.withColumn("up", F.array().cast(step))
    span = 1
    while span < most:
        low, sub = F.col("block") % span, F.floor(F.col("block") / span)
        meets = F.col("n_blocks") > span
        members = F.least(F.lit(span).cast("long"), F.col("n_blocks") - sub * span)
        sent = x.select("tree", "block", "n_blocks", "node", "up", sub.alias("sub"), low.alias("low"),
                        F.floor(F.col("block") / (span * fanout)).alias("run"),
                        F.explode(F.when(meets, F.sequence(low, F.lit(span - 1).cast("long"), members)).otherwise(F.array(low))).alias("number"))
        own = F.col("number") == F.col("low")
        met = sent.groupBy("tree", "run", "number").agg(
            F.array_sort(F.collect_list(F.struct("sub", "node"))).alias("nodes"),
            F.collect_list(F.when(own, F.struct("block", "n_blocks", "node", "up", "sub"))).alias("here"))
        one = met.select("tree", "nodes", F.explode("here").alias("b"))
        text = lambda keep: F.array_join(F.transform(F.filter("nodes", keep), lambda n: n["node"]), "")
        meets = F.col("b.n_blocks") > span
        x = one.select(
            "tree", "b.block", "b.n_blocks",
            F.when(meets, F.sha2(text(lambda n: F.lit(True)).cast("binary"), 256)).otherwise(F.col("b.node")).alias("node"),
            F.when(meets, F.concat("b.up", F.array(F.struct(text(lambda n: n["sub"] < F.col("b.sub")).alias("before"),
                                                            text(lambda n: n["sub"] > F.col("b.sub")).alias("after")))))
            .otherwise(F.col("b.up")).alias("up"))
        span *= fanout
    return x.select("tree", "block", "node", "up")


def prove(rows: DataFrame, part: str, order: str, leaf: str = "leaf", carry: Sequence[str] = (), fanout: int = FANOUT,
          height: int = LEVELS) -> DataFrame:
    """One row per input row: the columns ``carry``, position (in its part), subroot (of its part),
    root (of all) and proof, an array with the siblings of each level, from the leaf's up: the digests
    before the own node and those after it, concatenated.

    ``leaf`` holds hex digests.  Leaves of a part ascend by ``order``, nulls first; rows equal in it
    ascend by leaf, and identical leaves come in the order of the input.  Parts ascend by the bytes of
    their text, null first, and a null part is a part.  A single leaf is the root, with an empty
    proof; an empty table gives an empty result.  Columns not named are ignored, whatever their names.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "merkle")
    kept = [f"c{k}" for k in range(len(carry))]
    # The range sort samples its input first: what it samples is the digests, not the rows they are made of.
    given = scratch.put("digests", rows.select(F.col(part).alias("part"), F.col(order).alias("ord"), F.unhex(leaf).alias("leaf"),
                                               *[F.col(c).alias(k) for c, k in zip(carry, kept)]))
    placed = positions(given, ["part"], ["ord", "leaf"], scratch, "leaves")
    # One row per part, numbered in the order of the parts.
    parts = placed.groupBy("part").agg(F.first("size").alias("n_leaves"))
    parts = scratch.put("parts", positions(parts, [], ["part"], scratch, "part_names")
                        .select(F.col("part").alias("part2"), F.col("position").alias("tree"), F.col("n_leaves"), F.col("size").alias("n_parts")))
    most = parts.agg(F.max("n_leaves").alias("n"), F.max("n_parts").alias("k")).first()
    block = fanout ** height
    numbered = (placed.join(parts.select("part2", "tree"), F.col("part").eqNullSafe(F.col("part2")))
                .select("tree", F.floor(F.col("position") / block).alias("block"), "position", "size", "leaf", *kept))

    roots = numbered.select("tree", "block", "position", "size", "leaf").groupBy("tree", "block").applyInArrow(
        _block_root(fanout, height), "tree long, block long, n_blocks long, node string")
    own = scratch.put("blocks", butterfly(roots, -(-(most["n"] or 0) // block), fanout))
    subroots = own.filter("block = 0").select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("block"),
                                              F.lit(most["k"] or 0).cast("long").alias("n_blocks"), "node")
    tops = scratch.put("tops", butterfly(subroots, most["k"] or 0, fanout)).select(
        F.col("block").alias("tree"), F.col("node").alias("root"), F.col("up").alias("top"))
    above = own.join(tops, "tree").select("tree", "block", F.col("node").alias("subroot"), "root", F.concat("up", "top").alias("up"))

    types = ", ".join(f"{k} {given.schema[k].dataType.simpleString()}" for k in kept)
    schema = f"{types}{', ' if kept else ''}position long, subroot string, root string, proof array<struct<before:string,after:string>>"
    out = numbered.groupBy("tree", "block").cogroup(above.groupBy("tree", "block")).applyInArrow(_block_proofs(fanout, height, kept), schema)
    return out.select(*[F.col(k).alias(c) for c, k in zip(carry, kept)], "position", "subroot", "root", "proof")

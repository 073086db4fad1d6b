"""Mixing sources to target weights along a time-varying curriculum (DataFrame functions only).

Targets.  Each source weighs a value of a repeating cycle, in code-point order of its name, and the
sources share a word budget by weight.  A source's target stops at ``max_copies`` times its words;
the excess is shared out again by weight.  The result is the water-filling level: target =
min(cap, level * weight) with the targets summing to the budget.

Positions.  Training time runs from 0 to 1.  A source's weight at time t is proportional to
1 + a(2t - 1), a linear schedule with slope a, so its demand up to t integrates to
target * (t + a(t^2 - t)).  The source's documents, in an order fixed by a hash of their id, supply
words one after another, up to ``max_copies`` times over; the document whose words start at demand
d is trained at the t where the cumulative demand reaches d (the closed-form inverse below).
Sorting by t (a range partitioning) gives the training order.

Scale.  The running word count of a source never passes through one task: a source is split by
hash into 256 x 256 cells, whose sums give each cell's offset; rows are only ordered inside a cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, n_words, order_hash

WEIGHTS = (5, 2, 1)
SLOPES = (0.5, 0.0, -0.5)
BUDGET = 1.5
MAX_COPIES = 2

_SOURCE = ["_named", "_source"]


def _cycle(rank: Column, values: tuple) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), ((rank % len(values)) + 1).cast("int"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, slopes=SLOPES, budget=BUDGET, max_copies=MAX_COPIES) -> DataFrame:
    """One row per source (_named, _source, source_size): weight, slope and target words.  The
    table has as many rows as there are sources, which is why single-partition windows are fine."""
    everything = Window.partitionBy()
    ranked = (sizes.withColumn("_rank", F.row_number().over(Window.orderBy(F.desc("_named"), F.asc("_source"))) - 1)
              .withColumn("weight", _cycle(F.col("_rank"), weights)).withColumn("slope", _cycle(F.col("_rank"), slopes))
              .withColumn("_cap", (F.col("source_size") * max_copies).cast("double"))
              .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(budget))))
    by_ratio = Window.orderBy(F.col("_cap") / F.col("weight"), "_rank")
    before = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("_budget") - before) / rest
    return (ranked.withColumn("_level", level)
            .withColumn("_level", F.max(F.when(F.col("_level") <= F.col("_cap") / F.col("weight"), F.col("_level"))).over(everything))
            .withColumn("target", F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap"))))
            .select(*_SOURCE, "source_size", "weight", "slope", "target"))


def demand_time(share: Column, slope: Column) -> Column:
    """Time at which a source has asked for ``share`` of its words: t with t + a(t^2 - t) = share."""
    b = F.lit(1.0) - slope
    return F.lit(2.0) * share / (b + F.sqrt(b * b + F.lit(4.0) * slope * share))


def mix(docs: DataFrame, carry: list[str] | None = None, weights=WEIGHTS, slopes=SLOPES, budget=BUDGET,
        max_copies=MAX_COPIES) -> DataFrame:
    """One row per document: its ``carry`` columns (default doc_id), size, source_size, target,
    taken, and copies - an array of (epoch, position, words) for each time the mix takes words of it.

    Null and empty texts have size 0 and are taken 0 times; a null source is a source of its own,
    the last.  Rows with a null or repeated doc_id are documents like any other (ties in the order
    are broken by size; equal rows are interchangeable).  The last document a source supplies may
    be taken in part, so a source's words add up to its target rounded down.  An empty table gives
    an empty result.  Columns other than doc_id, text, source and ``carry`` are ignored.
    """
    carry = list(carry or ["doc_id"])
    h = order_hash(F.col("doc_id"))
    base = docs.select(
        *[F.col(c).alias(f"c_{c}") for c in carry], F.col("doc_id").alias("_id"),
        F.col("source").isNotNull().alias("_named"), F.coalesce("source", F.lit("")).alias("_source"),
        n_words(F.col("text")).alias("size"), h.alias("_h"),
        F.substring(h, 1, 2).alias("_a"), F.substring(h, 3, 2).alias("_b"))
    if "text" not in carry:  # narrow rows: count the words once
        base = Scratch(docs.sparkSession, "mix").put("sizes", base)

    cells = base.groupBy(*_SOURCE, "_a", "_b").agg(F.sum("size").alias("n"))
    strips = base.groupBy(*_SOURCE, "_a").agg(F.sum("size").alias("n"))
    targets = source_targets(base.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size")), weights, slopes, budget, max_copies)
    past = (Window.unboundedPreceding, -1)
    strips = (strips.withColumn("_off_a", F.coalesce(F.sum("n").over(Window.partitionBy(*_SOURCE).orderBy("_a").rowsBetween(*past)), F.lit(0)))
              .join(targets, _SOURCE).drop("n"))
    cells = (cells.withColumn("_off_b", F.coalesce(F.sum("n").over(Window.partitionBy(*_SOURCE, "_a").orderBy("_b").rowsBetween(*past)), F.lit(0)))
             .join(strips, [*_SOURCE, "_a"])
             .select(*_SOURCE, "_a", "_b", (F.col("_off_a") + F.col("_off_b")).alias("_off"), "source_size", "slope", "target"))
    inside = Window.partitionBy(*_SOURCE, "_a", "_b").orderBy("_h", "_id", "size").rowsBetween(*past)
    rows = (base.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(cells, [*_SOURCE, "_a", "_b"]))

    start = F.col("_off") + F.col("_in")
    wanted = F.floor("target")

    def copy(epoch: int) -> Column:
        at = start + F.col("source_size") * epoch
        words = F.greatest(F.lit(0), F.least(F.col("size"), wanted - at)).cast("long")
        return F.struct(F.lit(epoch).alias("epoch"), demand_time(F.try_divide(at, F.col("target")), F.col("slope")).alias("position"), words.alias("words"))

    copies = F.filter(F.array(*[copy(e) for e in range(max_copies)]), lambda c: c["words"] > 0)
    return (rows.withColumn("copies", copies)
            .withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda s, c: s + c["words"]))
            .select(*[F.col(f"c_{c}").alias(c) for c in carry], "size", "source_size", "target", "taken", "copies"))


def training_order(mixed: DataFrame) -> DataFrame:
    """One row per taken copy, with epoch, position and words, range-sorted by position."""
    cols = [c for c in mixed.columns if c not in ("copies", "size", "source_size", "target", "taken")]
    return (mixed.select(*cols, F.explode("copies").alias("_c"))
            .select(*cols, F.col("_c.epoch").alias("epoch"), F.col("_c.position").alias("position"), F.col("_c.words").alias("words"))
            .orderBy("position", "doc_id", "epoch"))

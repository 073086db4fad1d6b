"""Removal of globally repeated multi-line chunks (DataFrame functions only).

A text's lines are hashed; a rolling (shift and exclusive-or) hash over the last two line hashes decides
after which lines a chunk ends.  A boundary depends on two neighbouring lines only, so text inserted
or removed elsewhere does not move it.  Chunks of two or more lines that occur more than once, in
any documents, are compared byte by byte (smallest against largest of each hash group, merged
map-side) and all occurrences but the first are removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch

MASK = 3        # a chunk ends after one line in MASK + 1, on average
MIN_LINES = 2   # chunks of fewer lines stay

_KEY = ["_id", "_t"]


def line_hashes(lines: Column) -> Column:
    """60 bits of each line's MD5, the same in any engine."""
    return F.transform(lines, lambda x: F.conv(F.substring(F.md5(x.cast("binary")), 1, 15), 16, 10).cast("long"))


def chunk_ends(hashes: Column, mask: int = MASK) -> Column:
    """1-based numbers of the lines after which a chunk ends; the last line is always one."""
    def rolled(i: Column) -> Column:
        last, before = F.element_at(hashes, i), F.element_at(hashes, F.greatest(i - 1, F.lit(1)))
        return F.shiftleft(before, 1).bitwiseXOR(last)

    n = F.size(hashes)
    return F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (rolled(i).bitwiseAND(F.lit(mask).cast("long")) == 0))


def _chunks(docs: DataFrame, mask: int, min_lines: int) -> DataFrame:
    """(_id, _t, no, start, len, chunk, h, n) of each chunk of enough lines."""
    lines = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_t"), F.split("text", "\n").alias("lines"))
    cut = (lines.withColumn("hashes", line_hashes(F.col("lines")))
           .select(*_KEY, "lines", chunk_ends(F.col("hashes"), mask).alias("ends")))
    spans = F.transform("ends", lambda e, i: F.struct(
        F.when(i == 0, F.lit(1)).otherwise(F.element_at(F.col("ends"), F.greatest(i, F.lit(1))) + 1).alias("start"), e.alias("end")))
    kept = F.filter(spans, lambda s: s["end"] - s["start"] + 1 >= min_lines)
    out = (cut.select(*_KEY, "lines", F.explode(kept).alias("s"))
           .select(*_KEY, F.col("s.start").alias("start"), (F.col("s.end") - F.col("s.start") + 1).alias("len"), "lines")
           .select(*_KEY, "start", "len", F.array_join(F.slice("lines", F.col("start"), F.col("len")), "\n").alias("chunk")))
    return out.select(*_KEY, "start", "len", "chunk", F.xxhash64("chunk").alias("h"), F.length("chunk").alias("n"))


def repeated_chunks(docs: DataFrame, mask: int = MASK, min_lines: int = MIN_LINES) -> DataFrame:
    """(_id, _t, start, len) of each chunk occurrence that repeats an earlier one (in the order of
    doc_id, nulls last, then text hash and line)."""
    chunks = _chunks(docs, mask, min_lines)
    where = F.struct(F.col("_id").isNull().alias("a"), F.col("_id").alias("b"), F.col("_t").alias("c"), F.col("start").alias("d"))
    chunks = chunks.withColumn("at", where)
    groups = (chunks.groupBy("h", "n").agg(F.count(F.lit(1)).alias("copies"), F.min("at").alias("first"),
                                           F.min("chunk").alias("lo"), F.max("chunk").alias("hi"))
              .filter(F.col("copies") > 1).select("h", "n", "first", (F.col("lo") == F.col("hi")).alias("same")))
    groups = Scratch(docs.sparkSession, "lines").put("groups", groups)
    rows = chunks.drop("chunk").join(groups.filter("same"), ["h", "n"]).filter(~F.col("at").eqNullSafe(F.col("first")))
    out = rows.select(*_KEY, "start", "len")
    if groups.filter(~F.col("same")).head(1):  # hash collisions: regroup those chunks by their bytes
        odd = chunks.join(groups.filter(~F.col("same")).select("h", "n"), ["h", "n"], "left_semi")
        firsts = odd.groupBy("chunk").agg(F.count(F.lit(1)).alias("copies"), F.min("at").alias("first")).filter("copies > 1")
        again = odd.join(firsts, "chunk").filter(~F.col("at").eqNullSafe(F.col("first")))
        out = out.unionByName(again.select(*_KEY, "start", "len"))
    return out


def dedup_lines(docs: DataFrame, mask: int = MASK, min_lines: int = MIN_LINES) -> DataFrame:
    """All rows and columns of ``docs`` with ``text`` cut down to its kept lines, plus n_lines and
    n_removed (both long).

    A null text stays null (0 lines); an empty text is one empty line and stays.  Rows with a null
    doc_id take part like any other and rank last.  Rows that repeat a doc_id and its text are one
    document: what stays in one stays in the other.  A column of ``docs`` called n_lines or
    n_removed is replaced.  An empty table gives an empty result.
    """
    gone = (repeated_chunks(docs, mask, min_lines).distinct()
            .groupBy(F.col("_id").isNull().alias("__null"), F.coalesce("_id", F.lit(0)).alias("__id"), F.col("_t").alias("__hash"))
            .agg(F.collect_list(F.struct("start", "len")).alias("__gone")))
    base = docs.drop("n_lines", "n_removed")
    rows = (base.withColumns({"__null": F.col("doc_id").isNull(), "__id": F.coalesce("doc_id", F.lit(0)), "__hash": F.xxhash64("text")})
            .join(gone, ["__null", "__id", "__hash"], "left"))
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x, i: ~F.exists("__gone", lambda g: (i + 1 >= g["start"]) & (i + 1 < g["start"] + g["len"])))
    removed = F.coalesce(F.aggregate("__gone", F.lit(0), lambda s, g: s + g["len"]), F.lit(0)).cast("long")
    return rows.select(
        *[F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text") if c == "text" else F.col(c)
          for c in base.columns],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias("n_lines"), removed.alias("n_removed"))

"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(id, component) of each id in ``links`` (u, v); component is the smallest id reachable.

    Each round links the larger neighbours of every id to its smallest neighbour, then the smaller
    ones, which shortens paths by a constant factor; the table that comes out is written to the
    shared folder.  Minima merge map-side and the joins are plain equi-joins, so an id with very
    many links is split like any skewed key.  Only a row count and a checksum come to the driver.
    """
    now = scratch.put(f"{name}0", links.select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))
                      .filter("u <> v").select("u", "v").distinct())
    mark, step = None, 0
    while True:
        state = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == mark or not state["n"]:
            break
        mark, step = (state["n"], state["s"]), step + 1
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).filter("u <> v").distinct())
        after = scratch.put(f"{name}{step}", small)
        scratch.drop(f"{name}{step - 1}")
        now = after
    ids = now.groupBy(F.col("u").alias("id")).agg(F.min("v").alias("component"))
    return ids.unionByName(ids.select(F.col("component").alias("id"), "component").distinct())

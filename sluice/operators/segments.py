"""The trapezoidal integral as an algebra of segments.

A segment sums up consecutive readings of a series: the first and the last of them, and the gallons and
minutes between.  Two neighbouring segments combine into one by adding the interval from the last reading
of the left to the first of the right.  That is associative, so segments of short slices of time are
merged by aggregates, in any grouping, and stored: a late reading changes the segment of its slice
and nothing else.

Slices do not cross the months of the report's zone; an interval counts in the month in which it ends.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.dates import check_flow_scale, epoch_ms, finite, year_month_in_tz
from sluice.operators.flow import HOUR_MS, month_table

FIELDS = ["first_t", "first_v", "last_t", "last_v", "gallons", "minutes"]


def _gallons(t0: Column, v0: Column, t1: Column, v1: Column) -> Column:
    out = (v0 + v1) / F.lit(2.0) * ((t1 - t0) / F.lit(60000.0))
    return F.when(finite(out), out).otherwise(F.lit(0.0))


def combine(a: Column, b: Column) -> Column:
    """The segment of ``a`` and, after it, ``b``."""
    return F.struct(
        a["first_t"].alias("first_t"), a["first_v"].alias("first_v"), b["last_t"].alias("last_t"), b["last_v"].alias("last_v"),
        (a["gallons"] + b["gallons"] + _gallons(a["last_t"], a["last_v"], b["first_t"], b["first_v"])).alias("gallons"),
        (a["minutes"] + b["minutes"] + (b["first_t"] - a["last_t"]) / F.lit(60000.0)).alias("minutes"))


def flow_segments(rows: DataFrame, *, tz: str, ts: str = "record_ts", value: str = "metric_value",
                  tiebreak: Sequence[str] = ("serial", "source_file_id"), series: Sequence[str] = (),
                  slice_ms: int = HOUR_MS, scale: float = 1.0) -> DataFrame:
    """One row per (series, month, slice) with its segment.  The rows are shuffled once, by a key each has
    by itself; the sums are taken where the window has put them."""
    key = [*series, "month", "slice"]
    base = rows.select(*series, *[c for c in tiebreak if c not in series], F.col(ts).alias("o"), epoch_ms(ts).alias("t"),
                       (F.col(value).cast("double") * F.lit(check_flow_scale(scale))).alias("v"), year_month_in_tz(ts, tz).alias("month"))
    base = base.withColumn("slice", F.floor(F.col("t") / F.lit(slice_ms)))
    w = Window.partitionBy(*key).orderBy("o", *tiebreak)
    x = base.withColumns({"pt": F.lag("t").over(w), "pv": F.lag("v").over(w), "at": F.row_number().over(w)})
    follows = F.col("pt").isNotNull()
    end = F.struct("t", "v")
    return (x.groupBy(*key).agg(
        F.min_by(end, "at").alias("f"), F.max_by(end, "at").alias("l"),
        F.sum(F.when(follows, _gallons(F.col("pt"), F.col("pv"), F.col("t"), F.col("v"))).otherwise(0.0)).alias("gallons"),
        F.sum(F.when(follows, (F.col("t") - F.col("pt")) / F.lit(60000.0)).otherwise(0.0)).alias("minutes"))
        .select(*key, F.col("f.t").alias("first_t"), F.col("f.v").alias("first_v"), F.col("l.t").alias("last_t"), F.col("l.v").alias("last_v"),
                "gallons", "minutes"))


def merge(segments: DataFrame, by: Sequence[str]) -> DataFrame:
    """One segment per ``by``: its segments combined in the order of time.  A group holds the slices of a
    month, or the months of a period; their number does not follow the readings."""
    in_order = F.array_sort(F.collect_list(F.struct(*FIELDS)))
    out = segments.groupBy(*by).agg(in_order.alias("s")).select(
        *by, F.aggregate(F.slice("s", 2, F.size("s")), F.get("s", F.lit(0)), combine).alias("m"))
    return out.select(*by, "m.*")


def monthly_from_segments(segments: DataFrame, period_start, *, year: int, end_inclusive, series: Sequence[str] = (),
                          with_total: bool = True) -> DataFrame:
    """G6 + J6 + G7: the monthly summary, of segments.  The first reading's interval begins at
    ``period_start`` at its own rate; an interval that would be negative counts nothing."""
    start = F.unix_millis(period_start if isinstance(period_start, Column) else F.lit(period_start).cast("timestamp"))
    months = merge(segments, [*series, "month"])
    # A row per series and month.
    w = (Window.partitionBy(*series) if series else Window.partitionBy(F.lit(0))).orderBy("first_t")
    x = months.withColumns({"pt": F.lag("last_t").over(w), "pv": F.lag("last_v").over(w)})
    since = F.coalesce("pt", start)
    ahead = F.when(F.col("pt").isNull(), F.col("first_v")).otherwise(F.col("pv"))
    forward = F.col("first_t") >= since
    per_month = x.groupBy("month").agg(
        F.sum(F.col("gallons") + F.when(forward, _gallons(since, ahead, F.col("first_t"), F.col("first_v"))).otherwise(0.0)).alias("gallons"),
        F.sum(F.col("minutes") + F.when(forward, (F.col("first_t") - since) / F.lit(60000.0)).otherwise(0.0)).alias("minutes"))
    return month_table(per_month, year=year, end_inclusive=end_inclusive, with_total=with_total)


def refresh(segments: DataFrame, rows: DataFrame, late: DataFrame, *, tz: str, series: Sequence[str] = (), slice_ms: int = HOUR_MS,
            ts: str = "record_ts", **kw) -> DataFrame:
    """``segments`` after ``late`` rows have come to ``rows`` (which hold them): the slices they fall into
    are summed up anew, the others stay as they are."""
    key = [*series, "month", "slice"]
    keyed = lambda df: df.withColumns({"month": year_month_in_tz(ts, tz), "slice": F.floor(epoch_ms(ts) / F.lit(slice_ms))})
    touched = keyed(late).select(*key).distinct()
    again = flow_segments(keyed(rows).join(touched, key, "left_semi").drop("month", "slice"), tz=tz, series=series, slice_ms=slice_ms, ts=ts, **kw)
    return segments.join(touched, key, "left_anti").unionByName(again)

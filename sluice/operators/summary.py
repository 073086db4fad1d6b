"""Maintained summaries of readings (G1, W4, G3): mergeable partials per span of time and series.

A partial counts and adds up the readings of a series in one span and holds the latest of them.
Partials of the same span merge by adding and by the latest, so every batch writes its own, and what
is asked of them is another aggregate: the latest reading of anything a series is part of, and averages
over buckets of any multiple of the span.  Their number follows time and series, not readings.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice import schemas as SC

SPAN_MS = 3_600_000
SERIES = ["physical_group", "source_system", "metric_key", "unit"]


def span_start(ts, span_ms: int = SPAN_MS) -> Column:
    ms = F.unix_millis(ts) if isinstance(ts, Column) else F.unix_millis(F.col(ts))
    return F.timestamp_millis(F.floor(ms / F.lit(span_ms)) * F.lit(span_ms))


def partials(readings: DataFrame, span_ms: int = SPAN_MS) -> DataFrame:
    """Rows of the summary table for some readings; null values count as readings but not as values."""
    order = F.struct("record_ts", "serial", "source_file_id")
    return (readings.groupBy(F.to_date("record_ts").alias("dt"), span_start("record_ts", span_ms).alias("span"), *SERIES)
            .agg(F.count(F.lit(1)).alias("n"), F.count("metric_value").alias("n_values"), F.sum("metric_value").alias("total"),
                 F.max_by(F.struct("record_ts", "serial", "source_file_id", "metric_value"), order).alias("_l"))
            .select("span", *SERIES, "n", "n_values", "total", F.col("_l.record_ts").alias("last_ts"), F.col("_l.serial").alias("last_serial"),
                    F.col("_l.source_file_id").alias("last_file"), F.col("_l.metric_value").alias("last_value"), "dt"))


def latest_readings(summary: DataFrame) -> DataFrame:
    """The latest reading of each partial, as rows of the readings table.  Whatever takes the latest
    reading by group, source, metric or unit finds the same among these as among all readings."""
    typed = dict((f.name, f.dataType) for f in SC.READINGS.fields)
    own = {"record_ts": "last_ts", "serial": "last_serial", "source_file_id": "last_file", "metric_value": "last_value"}
    return summary.select(*[
        F.col(own[c]).alias(c) if c in own else F.col(c) if c in SERIES else F.lit(None).cast(t).alias(c) for c, t in typed.items()])


def bucket_averages(summary: DataFrame, edges: DataFrame, interval: str, where: Column, by: Sequence[str] = ()) -> DataFrame:
    """G3 from partials: (time, *by, value, n) per bucket of ``interval``, a multiple of the span, over the
    series for which ``where`` holds.  ``edges``: the readings of spans that the range cuts."""
    bucket = F.window("t", interval).start.alias("time")
    whole = summary.where(where).select(F.col("span").alias("t"), *by, "total", "n_values")
    cut = edges.where(where).select(F.col("record_ts").alias("t"), *by, F.col("metric_value").alias("total"),
                                    F.col("metric_value").isNotNull().cast("long").alias("n_values"))
    return (whole.unionByName(cut).groupBy(bucket, *by).agg(F.sum("total").alias("_s"), F.sum("n_values").alias("n"))
            .select("time", *by, F.when(F.col("n") > 0, F.col("_s") / F.col("n")).alias("value"), "n"))

"""Queries over maintained summaries (G1, W4, G3): partials of all readings and what is asked of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.dates import round_half_up as r
from sluice.operators import summary as sm
from sluice.operators.dashboards import latest
from sluice.plans.catalog import register
from sluice.plans.sqlparts import rnd, with_views
from sluice.sources import driver_tables as dt

_PARTIALS = with_views("readings") + """
, p AS (SELECT date_trunc('hour', record_ts) AS span, physical_group, source_system, metric_key, unit, count(*) AS n, count(metric_value) AS n_values,
               sum(metric_value) AS total, max(record_ts) AS last_ts,
               arg_max(metric_value, (record_ts, serial, source_file_id)) AS last_value
        FROM readings GROUP BY ALL)"""


@register("summary_partials", sql=_PARTIALS + f"""
SELECT span, physical_group, source_system, metric_key, unit, CAST(n AS BIGINT) AS n, CAST(n_values AS BIGINT) AS n_values,
       {rnd('total')} AS total, last_ts, {rnd('last_value')} AS last_value FROM p""")
def summary_partials(spark, sf_dir):
    """The summary rows one batch of all readings writes: counts, sums and latest reading per hour and series."""
    p = sm.partials(dt.readings(spark, sf_dir))
    return p.select("span", *sm.SERIES, "n", "n_values", r("total", 4).alias("total"), "last_ts", r("last_value", 4).alias("last_value"))


@register("summary_latest_by_group", sql=with_views("readings") + """
SELECT physical_group, max(record_ts) AS record_ts, arg_max(metric_value, (record_ts, serial, source_file_id, metric_key)) AS metric_value FROM readings GROUP BY physical_group""")
def summary_latest_by_group(spark, sf_dir):
    """W4 from the summary: the latest reading of every physical group, as the full scan gives it."""
    rows = sm.latest_readings(sm.partials(dt.readings(spark, sf_dir)))
    return latest(rows, by=["physical_group"]).select("physical_group", "record_ts", "metric_value")


@register("summary_bucket_averages", sql=with_views("readings") + f"""
SELECT time_bucket(INTERVAL 6 HOUR, record_ts, TIMESTAMP '1970-01-01') AS time, source_system, {rnd('sum(metric_value)')} AS total,
       CAST(count(metric_value) AS BIGINT) AS n
FROM readings WHERE unit = 'kW' GROUP BY 1, 2""")
def summary_bucket_averages(spark, sf_dir):
    """G3 from the summary: averages over six-hour buckets by source, out of hourly partials."""
    readings = dt.readings(spark, sf_dir)
    out = sm.bucket_averages(sm.partials(readings), readings.limit(0), "6 hours", F.col("unit") == "kW", ["source_system"])
    # Averages of sixteen cents lie on rounding ties; their sums do not.
    return out.select("time", "source_system", r(F.col("value") * F.col("n"), 4).alias("total"), "n")

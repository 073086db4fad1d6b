"""Flow-to-volume integration and the water-diversion report.

Scale notes
-----------
* ``flow_intervals`` needs each reading's predecessor in one global (ts, tiebreak) order.
  A ``Window.orderBy`` without ``partitionBy`` would pull the whole series into one task,
  so the series is cut into time slices (one hour by default), a key each row has by itself:
  the first shuffle is already on (series, slice).  ``lag`` runs per slice in parallel, and the
  first row of every slice takes its predecessor from the last row of the previous non-empty
  slice (a carry table with one row per slice).
* The monthly summary is a partial (map-side) aggregate keyed by month: its shuffle carries
  one row per (task, month).  The month spine is bounded by the report window (≤ 12 rows
  per year) and is the only side ever broadcast explicitly.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.dates import (
    US_GALLONS_PER_ACRE_FOOT, check_flow_scale, epoch_ms, finite, local_date, local_time,
    report_window, year_month_in_tz,
)

HOUR_MS = 3_600_000


# --- predicates -------------------------------------------------------------------------

def plant_predicate(stream: str, device_address: str | None = None) -> Column:
    """rows that belong to the report's plant."""
    g, s, m = F.col("physical_group"), F.col("source_system"), F.col("metric_key")
    if stream == "booster":
        booster = (g == "booster_pump") | (s == "booster_pump")
        if device_address:
            return booster | (((g == "hydro_plant") | (s == "hydro_plant")) & m.like("flow_avg%"))
        return booster
    if stream == "wyman":
        return (g == "hydro_plant") | (s == "hydro_plant")
    raise ValueError(f"stream must be wyman or booster (got {stream})")


def gpm_unit_predicate(stream: str) -> Column:
    """unit contains ``gpm`` case-insensitively; booster also accepts a blank unit."""
    u = F.coalesce(F.trim(F.lower(F.col("unit"))), F.lit(""))
    is_gpm = u.like("%gpm%")
    if stream == "booster":
        return is_gpm | (F.coalesce(F.trim(F.col("unit")), F.lit("")) == "")
    return is_gpm


def booster_metric_plan(metric_key: str) -> tuple[list[str], bool]:
    """``flow_avg`` on the booster means both keys, preferring ``flow_avg_A`` per instant."""
    if metric_key == "flow_avg":
        return ["flow_avg_A", "flow_avg"], True
    return [metric_key], False


def select_flow_rows(readings: DataFrame, *, year: int, end_inclusive, tz: str = "America/Los_Angeles",
                     stream: str = "wyman", metric_key: str | None = None, serial: str | None = None,
                     device_address: str | None = None) -> DataFrame:
    """F6-F9 + W2: the report's input rows (record_ts, metric_value, serial, source_file_id).

    Booster default: device ``mb-003``, metrics ``flow_avg_A``/``flow_avg`` with one row per
    instant (W2).  The half-open window ``[Jan 1, end+1d)`` in ``tz`` is folded to literals,
    so it reaches the scan as a pushed filter.
    """
    if stream == "booster" and not device_address:
        device_address = "mb-003"
    if metric_key is None:
        metric_key = "flow_avg" if stream == "booster" else "flow_wyman_avg"
    t0, t1 = report_window(year, end_inclusive, tz)
    keys, distinct_on = booster_metric_plan(metric_key) if stream == "booster" else ([metric_key], False)
    cond = (plant_predicate(stream, device_address)
            & (F.col("metric_key").isin(keys) if len(keys) > 1 else (F.col("metric_key") == keys[0]))
            & gpm_unit_predicate(stream)
            & (F.col("record_ts") >= t0) & (F.col("record_ts") < t1))
    if serial:
        cond = cond & (F.col("serial") == serial)
    if device_address:
        cond = cond & (F.col("device_address") == device_address)
    rows = readings.where(cond).select("record_ts", "metric_value", "serial", "source_file_id", "metric_key")
    if distinct_on:
        rows = distinct_on_instant(rows)
    return rows.drop("metric_key")


def distinct_on_instant(rows: DataFrame, priority: Sequence[str] = ("flow_avg_A", "flow_avg")) -> DataFrame:
    """One row per ``record_ts``; ``priority`` keys first, then (serial, file) as tiebreak.

    Keyed by the instant, so the shuffle spreads evenly over time; a partial top-1 per
    instant (``min_by`` over a struct) replaces a sort of every duplicate group.
    """
    rank = F.when(F.col("metric_key") == priority[0], 1)
    for i, k in enumerate(priority[1:], start=2):
        rank = rank.when(F.col("metric_key") == k, i)
    rank = rank.otherwise(len(priority) + 1)
    best = F.min_by(F.struct("metric_value", "serial", "source_file_id", "metric_key"),
                    F.struct(rank, F.col("serial"), F.col("source_file_id")))
    return rows.groupBy("record_ts").agg(best.alias("b")).select("record_ts", "b.*")


# --- W1: trapezoidal integral ---------------------------------------------------------

def flow_intervals(rows: DataFrame, period_start, *, ts: str = "record_ts", value: str = "metric_value",
                   tiebreak: Sequence[str] = ("serial", "source_file_id"), series: Sequence[str] = (),
                   slice_ms: int = HOUR_MS, scale: float = 1.0) -> DataFrame:
    """Gallons and minutes for every reading interval.

    Row i (in (ts, tiebreak) order within ``series``): the interval ends at its own
    timestamp; the first row starts at ``period_start`` and uses its own rate, the others
    start at the previous reading and use the mean of both rates.  Negative intervals count
    0 gallons / 0 minutes and non-finite gallons count 0.  Adds ``gpm`` (scaled value),
    ``dt_minutes`` and ``gallons``.

    Rows are windowed by (series, time slice), a key that each row has by itself, so the first
    shuffle already spreads a busy day over its slices.  Between slices only the last row of each
    is carried; their number follows the time span, not the number of rows.
    """
    scale = check_flow_scale(scale)
    start_ms = F.unix_millis(period_start if isinstance(period_start, Column)
                             else F.lit(period_start).cast("timestamp"))
    series = list(series)
    order = [F.col(ts)] + [F.col(c) for c in tiebreak]
    base = (rows.withColumn("_t", epoch_ms(ts))
            .withColumn("gpm", F.col(value).cast("double") * F.lit(scale))
            .withColumn("_slice", F.floor(F.col("_t") / F.lit(slice_ms))))
    part = [*series, "_slice"]

    w = Window.partitionBy(*part).orderBy(*order)
    lagged = (base.withColumn("_pt", F.lag("_t").over(w))
              .withColumn("_pv", F.lag("gpm").over(w))
              .withColumn("_is_last", F.lead("_t").over(w).isNull()))

    # Carry: last row of the previous non-empty slice of the same series.
    ws = Window.partitionBy(*series).orderBy("_slice") if series else Window.orderBy("_slice")
    carry = (lagged.where("_is_last")
             .select(*part, F.struct(F.col("_t").alias("t"), F.col("gpm").alias("v")).alias("_last"))
             .select(*part, F.lag("_last").over(ws).alias("_carry")))
    x = lagged.join(carry, part, "left")

    first_in_chunk = F.col("_pt").isNull()
    pt = F.when(first_in_chunk, F.col("_carry.t")).otherwise(F.col("_pt"))
    pv = F.when(first_in_chunk, F.col("_carry.v")).otherwise(F.col("_pv"))
    is_first = pt.isNull()
    dt_ms = F.when(is_first, F.col("_t") - start_ms).otherwise(F.col("_t") - pt)
    dt_min = dt_ms / F.lit(60000.0)
    rate = F.when(is_first, F.col("gpm")).otherwise((F.col("gpm") + pv) / F.lit(2.0))
    gal = rate * dt_min
    return (x.withColumn("dt_minutes", F.when(dt_ms < 0, F.lit(0.0)).otherwise(dt_min))
            .withColumn("gallons", F.when(dt_ms < 0, F.lit(0.0))
                        .when(finite(gal), gal).otherwise(F.lit(0.0)))
            .drop("_t", "_slice", "_pt", "_pv", "_carry", "_is_last"))


# --- K12 / G6 / G7 / J6 ---------------------------------------------------------------

def sheet_rows(intervals: DataFrame, tz: str, flow_unit: str = "GALLONS PER MINUTE",
               volume_unit: str = "GALLONS", beneficial_use: str | None = None,
               water_right: str | None = None, rediversion_status: str | None = None,
               place_of_use: str | None = None) -> DataFrame:
    """One diversion-report row per reading (local date/time, flow, gallons to 3 dp)."""
    opt = {"beneficial_use": beneficial_use, "water_right": water_right,
           "rediversion_status": rediversion_status, "place_of_use": place_of_use}
    return intervals.select(
        "record_ts",
        local_date("record_ts", tz).alias("local_date"),
        local_time("record_ts", tz).alias("local_time"),
        F.col("gpm").alias("flow"),
        F.lit(flow_unit).alias("flow_unit"),
        (F.floor(F.col("gallons") * 1000.0 + 0.5) / 1000.0).alias("gallons"),
        F.lit(volume_unit).alias("volume_unit"),
        *[F.lit(v).cast("string").alias(k) for k, v in opt.items()],
    )


def month_spine(spark, year: int, end_inclusive) -> DataFrame:
    """J6 spine: every ``yyyy-MM`` from January of ``year`` through the end month."""
    end = end_inclusive if isinstance(end_inclusive, _dt.date) else _dt.date.fromisoformat(str(end_inclusive))
    start = _dt.date(int(year), 1, 1)
    if end < start:  # e.g. default window evaluated on Jan 1: empty report, not an error
        return spark.range(0).select(F.lit("").alias("month"))
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end.replace(day=1)), F.expr("interval 1 month"))).alias("m")
    ).select(F.date_format("m", "yyyy-MM").alias("month"))


def monthly_summary(intervals: DataFrame, *, year: int, end_inclusive, tz: str = "America/Los_Angeles",
                    with_total: bool = True) -> DataFrame:
    """G6 + J6 + G7: gallons, minutes, average GPM and acre-feet per month of the interval's
    end timestamp in ``tz``; months without rows give 0 gallons and a NULL average.  The
    period-total row (``month = 'total'``) uses the same ratios."""
    per_month = (intervals.groupBy(year_month_in_tz("record_ts", tz).alias("month"))
                 .agg(F.sum("gallons").alias("gallons"), F.sum("dt_minutes").alias("minutes")))
    return month_table(per_month, year=year, end_inclusive=end_inclusive, with_total=with_total)


def month_table(per_month: DataFrame, *, year: int, end_inclusive, with_total: bool = True) -> DataFrame:
    """J6 + G7 over ``(month, gallons, minutes)``: every month of the period, the ratios and the total."""
    spark = per_month.sparkSession
    spine = month_spine(spark, year, end_inclusive)
    # Rows were filtered to the report window, so ``per_month`` has at most one row per month
    # of that window (≤ 12 per report year): a size-bounded broadcast.
    months = spine.join(F.broadcast(per_month), "month", "left").select(
        "month", F.coalesce("gallons", F.lit(0.0)).alias("gallons"),
        F.coalesce("minutes", F.lit(0.0)).alias("minutes"))
    if with_total:
        # ROLLUP over the (small) month table: the total row needs no second pass over the data.
        months = (months.rollup("month").agg(F.sum("gallons").alias("gallons"), F.sum("minutes").alias("minutes"))
                  .select(F.coalesce("month", F.lit("total")).alias("month"), "gallons", "minutes"))
    return months.select(
        "month", "gallons", "minutes",
        F.when(F.col("minutes") > 0, F.col("gallons") / F.col("minutes")).alias("avg_gpm"),
        (F.col("gallons") / F.lit(US_GALLONS_PER_ACRE_FOOT)).alias("acre_feet"),
    )


def diversion_report(readings: DataFrame, *, year: int, end_inclusive, tz: str = "America/Los_Angeles",
                     stream: str = "wyman", metric_key: str | None = None, serial: str | None = None,
                     device_address: str | None = None, flow_scale: float = 1.0,
                     **sheet_opts) -> tuple[DataFrame, DataFrame]:
    """E2 as one lazy plan: filtered rows → W2 → W1 → (sheet rows, monthly summary)."""
    rows = select_flow_rows(readings, year=year, end_inclusive=end_inclusive, tz=tz, stream=stream,
                            metric_key=metric_key, serial=serial, device_address=device_address)
    t0, _ = report_window(year, end_inclusive, tz)
    iv = flow_intervals(rows, t0, scale=flow_scale)
    return sheet_rows(iv, tz, **sheet_opts), monthly_summary(iv, year=year, end_inclusive=end_inclusive, tz=tz)

"""Diversion-report queries (E2): W1 intervals, K12 sheet rows, G6/J6/G7 monthly summary, W2."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from sluice.functions.dates import report_window, round_half_up as r
from sluice.operators import flow
from sluice.operators import segments as sg
from sluice.plans.catalog import register
from sluice.plans.sqlparts import END, TZ, YEAR, local, ms, rnd, utc_of_local, with_views
from sluice.sources import driver_tables as dt

_END_PLUS_1 = (_dt.date.fromisoformat(END) + _dt.timedelta(days=1)).isoformat()
_T0 = utc_of_local(f"{YEAR}-01-01 00:00:00")
_T1 = utc_of_local(f"{_END_PLUS_1} 00:00:00")


def _intervals_sql(where: str, source: str = "readings") -> str:
    return f"""
sel AS (SELECT record_ts, metric_value AS gpm, serial, source_file_id FROM {source} WHERE {where}
          AND record_ts >= {_T0} AND record_ts < {_T1}),
o AS (SELECT *, {ms('record_ts')} AS t,
             lag({ms('record_ts')}) OVER w AS pt, lag(gpm) OVER w AS pv
      FROM sel WINDOW w AS (ORDER BY record_ts, serial, source_file_id)),
d AS (SELECT *, CASE WHEN pt IS NULL THEN t - {ms(_T0)} ELSE t - pt END AS dt_ms FROM o),
iv AS (SELECT record_ts, serial, source_file_id, gpm,
              CASE WHEN dt_ms < 0 THEN 0.0 ELSE dt_ms / 60000.0 END AS dt_minutes,
              CASE WHEN dt_ms < 0 THEN 0.0
                   WHEN pt IS NULL THEN gpm * (dt_ms / 60000.0)
                   ELSE ((gpm + pv) / 2.0) * (dt_ms / 60000.0) END AS gallons
       FROM d)"""


_WYMAN_WHERE = """(physical_group = 'hydro_plant' OR source_system = 'hydro_plant')
          AND metric_key = 'flow_wyman_avg' AND COALESCE(TRIM(lower(unit)), '') LIKE '%gpm%'"""

_BOOSTER_SEL = f"""
bsel AS (SELECT record_ts,
           arg_min(metric_value, (CASE metric_key WHEN 'flow_avg_A' THEN 1 WHEN 'flow_avg' THEN 2 ELSE 3 END,
                                  serial, source_file_id)) AS metric_value,
           arg_min(serial, (CASE metric_key WHEN 'flow_avg_A' THEN 1 WHEN 'flow_avg' THEN 2 ELSE 3 END,
                            serial, source_file_id)) AS serial,
           arg_min(source_file_id, (CASE metric_key WHEN 'flow_avg_A' THEN 1 WHEN 'flow_avg' THEN 2 ELSE 3 END,
                                    serial, source_file_id)) AS source_file_id
         FROM readings
         WHERE ((physical_group = 'booster_pump' OR source_system = 'booster_pump')
                OR ((physical_group = 'hydro_plant' OR source_system = 'hydro_plant') AND metric_key LIKE 'flow_avg%'))
           AND metric_key IN ('flow_avg_A', 'flow_avg')
           AND (COALESCE(TRIM(lower(unit)), '') LIKE '%gpm%' OR COALESCE(TRIM(unit), '') = '')
           AND device_address = 'mb-003'
           AND record_ts >= {_T0} AND record_ts < {_T1}
         GROUP BY record_ts)"""


def _rows(spark, sf_dir, stream):
    return flow.select_flow_rows(dt.readings(spark, sf_dir), year=YEAR, end_inclusive=END, tz=TZ, stream=stream)


def _intervals(spark, sf_dir, stream):
    t0, _ = report_window(YEAR, END, TZ)
    return flow.flow_intervals(_rows(spark, sf_dir, stream), t0)


@register("flow_intervals_wyman", sql=with_views("readings") + "," + _intervals_sql(_WYMAN_WHERE) + f"""
SELECT record_ts, serial, source_file_id, {rnd('gpm', 4)} AS gpm, {rnd('dt_minutes', 4)} AS dt_minutes,
       {rnd('gallons', 4)} AS gallons FROM iv""")
def flow_intervals_wyman(spark, sf_dir):
    """W1 over the Wyman intake series (F6, F7, F8 filters)."""
    iv = _intervals(spark, sf_dir, "wyman")
    return iv.select("record_ts", "serial", "source_file_id", r("gpm", 4).alias("gpm"),
                     r("dt_minutes", 4).alias("dt_minutes"), r("gallons", 4).alias("gallons"))


@register("flow_sheet_wyman", sql=with_views("readings") + "," + _intervals_sql(_WYMAN_WHERE) + f"""
SELECT record_ts, strftime({local('record_ts')}, '%Y-%m-%d') AS local_date,
       strftime({local('record_ts')}, '%H:%M:%S') AS local_time,
       {rnd('gpm', 4)} AS flow, 'GALLONS PER MINUTE' AS flow_unit,
       {rnd('floor(gallons * 1000.0 + 0.5) / 1000.0', 3)} AS gallons, 'GALLONS' AS volume_unit
FROM iv""")
def flow_sheet_wyman(spark, sf_dir):
    """K12 sheet rows (local date/time in America/Los_Angeles, gallons to 3 dp)."""
    rows = flow.sheet_rows(_intervals(spark, sf_dir, "wyman"), TZ)
    return rows.select("record_ts", "local_date", "local_time", r("flow", 4).alias("flow"), "flow_unit",
                       r("gallons", 3).alias("gallons"), "volume_unit")


def _monthly_sql(iv_source_sql: str) -> str:
    return iv_source_sql + f""",
pm AS (SELECT strftime({local('record_ts')}, '%Y-%m') AS month, sum(gallons) AS gallons,
              sum(dt_minutes) AS minutes FROM iv GROUP BY 1),
spine AS (SELECT strftime(m, '%Y-%m') AS month
          FROM generate_series(TIMESTAMP '{YEAR}-01-01', TIMESTAMP '{END[:8]}01', INTERVAL 1 MONTH) t(m)),
mo AS (SELECT s.month, COALESCE(pm.gallons, 0.0) AS gallons, COALESCE(pm.minutes, 0.0) AS minutes
       FROM spine s LEFT JOIN pm ON s.month = pm.month),
al AS (SELECT * FROM mo UNION ALL SELECT 'total', sum(gallons), sum(minutes) FROM mo)
SELECT month, {rnd('gallons', 2)} AS gallons, {rnd('minutes', 4)} AS minutes,
       {rnd('CASE WHEN minutes > 0 THEN gallons / minutes END', 4)} AS avg_gpm,
       {rnd('gallons / 325851.0', 4)} AS acre_feet
FROM al"""


def _round_monthly(df):
    return df.select("month", r("gallons", 2).alias("gallons"), r("minutes", 4).alias("minutes"),
                     r("avg_gpm", 4).alias("avg_gpm"), r("acre_feet", 4).alias("acre_feet"))


@register("flow_monthly_wyman", sql=_monthly_sql(with_views("readings") + "," + _intervals_sql(_WYMAN_WHERE)))
def flow_monthly_wyman(spark, sf_dir):
    """G6 + J6 + G7: monthly gallons / minutes / avg GPM / acre-feet with zero-filled months."""
    iv = _intervals(spark, sf_dir, "wyman")
    return _round_monthly(flow.monthly_summary(iv, year=YEAR, end_inclusive=END, tz=TZ))


@register("flow_monthly_booster", sql=_monthly_sql(
    with_views("readings") + "," + _BOOSTER_SEL + "," + _intervals_sql("TRUE", source="bsel")))
def flow_monthly_booster(spark, sf_dir):
    """Booster stream: W2 (one row per instant, flow_avg_A preferred) then W1 and G6/G7."""
    iv = _intervals(spark, sf_dir, "booster")
    return _round_monthly(flow.monthly_summary(iv, year=YEAR, end_inclusive=END, tz=TZ))


@register("flow_distinct_on_booster", sql=with_views("readings") + "," + _BOOSTER_SEL + f"""
SELECT record_ts, {rnd('metric_value', 4)} AS metric_value, serial, source_file_id FROM bsel""")
def flow_distinct_on_booster(spark, sf_dir):
    """W2 alone: DISTINCT ON (record_ts) with metric priority flow_avg_A > flow_avg."""
    rows = _rows(spark, sf_dir, "booster")
    return rows.select("record_ts", r("metric_value", 4).alias("metric_value"), "serial", "source_file_id")


@register("flow_monthly_segments", sql=_monthly_sql(with_views("readings") + "," + _intervals_sql(_WYMAN_WHERE)))
def flow_monthly_segments(spark, sf_dir):
    """W1 + G6 + G7 by segments: slices of a quarter hour, merged to months, merged to the report."""
    t0, _ = report_window(YEAR, END, TZ)
    segments = sg.flow_segments(_rows(spark, sf_dir, "wyman"), tz=TZ, slice_ms=900_000)
    return _round_monthly(sg.monthly_from_segments(segments, t0, year=YEAR, end_inclusive=END))

"""Alert queries (E3): stale groups, hydro checks, alarm rows, sustained-for, bundle + fingerprint."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.dates import round_half_up as r
from sluice.operators import alerts as al
from sluice.operators.dashboards import latest
from sluice.plans.catalog import register
from sluice.plans.sqlparts import RANGE_FROM, RANGE_TO, ms, rnd, with_views
from sluice.sources import driver_tables as dt

# Explicit evaluation instant shortly after the last demo reading (the reference uses NOW()).
ALERT_AS_OF = "2024-01-31 00:30:00"
_AS_OF = f"TIMESTAMP '{ALERT_AS_OF}'"
_LATEST_ORDER = "record_ts DESC, serial DESC, source_file_id DESC, metric_key DESC"
_HYDRO = ("(physical_group = 'hydro_plant' OR source_system = 'hydro_plant') AND unit = 'kW' "
          "AND metric_key LIKE 'power_instantaneous%'")


@register("alert_stale_groups", sql=with_views("readings") + f"""
, per AS (SELECT COALESCE(physical_group, 'unknown') AS physical_group, max(record_ts) AS latest_ts
          FROM readings GROUP BY 1)
SELECT physical_group, latest_ts FROM per WHERE latest_ts < {_AS_OF} - INTERVAL 30 MINUTE
UNION ALL
SELECT '(no rows)', CAST(NULL AS TIMESTAMP) FROM (SELECT count(*) AS n FROM readings) c WHERE n = 0""")
def alert_stale_groups(spark, sf_dir):
    """A1 / G1: groups whose latest reading is older than 30 minutes at the as-of instant."""
    return al.stale_groups(dt.readings(spark, sf_dir), ALERT_AS_OF, stale_after_minutes=30)


_HYDRO_OUT_SQL = f"""
, best AS (SELECT metric_value, record_ts, metric_key FROM readings WHERE {_HYDRO}
           ORDER BY {_LATEST_ORDER} LIMIT 1),
h AS (SELECT *, {ms(_AS_OF)} - {ms('record_ts')} AS age_ms FROM best),
o AS (SELECT metric_value AS value, record_ts, metric_key,
             CAST(floor(age_ms / 60000.0 + 0.5) AS BIGINT) AS age_minutes,
             (age_ms <= 60 * 60000 AND age_ms >= -120000) AS recent FROM h)"""


@register("alert_hydro_out", sql=with_views("readings") + _HYDRO_OUT_SQL + f"""
SELECT {rnd('value')} AS value, record_ts, metric_key, age_minutes, recent,
       (recent AND isfinite(value) AND value < 5.0) AS fire,
       CASE WHEN NOT recent THEN 'reading_not_recent' END AS reason
FROM o""")
def alert_hydro_out(spark, sf_dir):
    """A2: latest hydro kW reading, recency gate (−2 min … 60 min) and the < 5 kW test."""
    out = al.hydro_out(dt.readings(spark, sf_dir), ALERT_AS_OF, recent_minutes=60, min_kw=5.0)
    return out.withColumn("value", r("value", 4))


@register("alert_hydro_below_10kw", sql=with_views("readings") + f"""
, best AS (SELECT record_ts AS time, metric_value AS value FROM readings
           WHERE record_ts BETWEEN TIMESTAMP '{RANGE_FROM}' AND TIMESTAMP '{RANGE_TO}'
             AND source_system = 'hydro_plant' AND metric_key = 'power_instantaneous'
           ORDER BY {_LATEST_ORDER} LIMIT 1)
SELECT time, {rnd('value')} AS value, value < 10.0 AS firing FROM best""")
def alert_hydro_below_10kw(spark, sf_dir):
    """A3: last hydro instantaneous power in the range compared with 10 kW."""
    out = al.below_threshold_rule(dt.readings(spark, sf_dir), RANGE_FROM, RANGE_TO, threshold=10.0, strict=False)
    return out.withColumn("value", r("value", 4))


@register("alert_hydro_out_rule", sql=with_views("readings") + f"""
, best AS (SELECT record_ts AS time, metric_value AS value FROM readings
           WHERE record_ts BETWEEN TIMESTAMP '{RANGE_FROM}' AND TIMESTAMP '{RANGE_TO}'
             AND physical_group = 'hydro_plant' AND metric_key = 'power_instantaneous' AND unit = 'kW'
           ORDER BY {_LATEST_ORDER} LIMIT 1)
SELECT time, {rnd('value')} AS value, value < 5.0 AS firing FROM best""")
def alert_hydro_out_rule(spark, sf_dir):
    """A4: strict hydro-out rule (group hydro, exact key, kW) against 5 kW."""
    out = al.below_threshold_rule(dt.readings(spark, sf_dir), RANGE_FROM, RANGE_TO, threshold=5.0, strict=True)
    return out.withColumn("value", r("value", 4))


@register("alert_alarm_rows", sql=with_views("readings") + f"""
SELECT serial, metric_key, record_ts, low_alarm, high_alarm, physical_group, source_file_id
FROM readings
WHERE (low_alarm OR high_alarm) AND record_ts >= {_AS_OF} - INTERVAL 1440 MINUTE
ORDER BY record_ts DESC, serial, metric_key, source_file_id
LIMIT 40""")
def alert_alarm_rows(spark, sf_dir):
    """Newest 40 low/high alarm readings of the last 24 hours."""
    return al.alarm_rows(dt.readings(spark, sf_dir), ALERT_AS_OF, lookback_minutes=1440, limit=40)


def _evaluations(spark, sf_dir):
    """Hourly evaluation ticks of the below-10 kW hydro rule: the condition at a tick is the
    last hydro power reading of that hour being under 10 kW (hours without readings are
    not evaluated)."""
    rd = dt.readings(spark, sf_dir).where((F.col("source_system") == "hydro_plant")
                                         & (F.col("metric_key") == "power_instantaneous"))
    rd = rd.withColumn("tick", F.window("record_ts", "1 hour").end)
    last = latest(rd, by=["tick"], cols=("metric_value",))
    return last.select(F.lit("hydro_below_10kw").alias("rule"), "tick",
                       (F.col("metric_value") < 10.0).alias("condition"))


@register("alert_sustained", sql=with_views("readings") + f"""
, rd AS (SELECT *, time_bucket(INTERVAL '1 hour', record_ts) + INTERVAL 1 HOUR AS tick FROM readings
         WHERE source_system = 'hydro_plant' AND metric_key = 'power_instantaneous'),
ev AS (SELECT 'hydro_below_10kw' AS rule, tick,
              arg_max(metric_value, (record_ts, serial, source_file_id, metric_key)) < 10.0 AS condition
       FROM rd GROUP BY tick),
isl AS (SELECT *, sum(CASE WHEN condition THEN 0 ELSE 1 END) OVER (PARTITION BY rule ORDER BY tick
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS island FROM ev),
s AS (SELECT *, min(CASE WHEN condition THEN tick END) OVER (PARTITION BY rule, island ORDER BY tick
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS since FROM isl)
SELECT rule, tick, condition,
       COALESCE(condition AND ({ms('tick')} - {ms('since')}) >= 60 * 60000, FALSE) AS firing,
       COALESCE(condition AND NOT (({ms('tick')} - {ms('since')}) >= 60 * 60000), FALSE) AS pending
FROM s""")
def alert_sustained(spark, sf_dir):
    """A5: evaluate_for 1 h over hourly evaluations (gaps and islands)."""
    return al.sustained(_evaluations(spark, sf_dir), by=["rule"], for_minutes=60)


def _bundle(spark, sf_dir):
    return al.bundle(dt.readings(spark, sf_dir), dt.schedule(spark, sf_dir), ALERT_AS_OF,
                     stale_after_minutes=30, hydro_recent_minutes=60, hydro_min_kw=5.0,
                     alarm_lookback_minutes=1440, alarm_limit=40)


@register("alert_bundle", sql=with_views("readings", "schedule") + _HYDRO_OUT_SQL + f"""
, per AS (SELECT COALESCE(physical_group, 'unknown') AS physical_group, max(record_ts) AS latest_ts
          FROM readings GROUP BY 1),
st AS (SELECT physical_group, latest_ts FROM per WHERE latest_ts < {_AS_OF} - INTERVAL 30 MINUTE
       UNION ALL SELECT '(no rows)', CAST(NULL AS TIMESTAMP) FROM (SELECT count(*) AS n FROM readings) c WHERE n = 0),
hy AS (SELECT *, (recent AND isfinite(value) AND value < 5.0) AS fire FROM o),
wa AS (SELECT count(*) AS cnt FROM schedule WHERE next_due_date IS NOT NULL
         AND next_due_date <= CAST(CAST({_AS_OF} AS DATE) + INTERVAL 45 DAY AS DATE)
         AND next_due_date >= CAST(CAST({_AS_OF} AS DATE) - INTERVAL 30 DAY AS DATE)),
ar AS (SELECT serial, metric_key, record_ts, low_alarm, high_alarm, physical_group FROM readings
       WHERE (low_alarm OR high_alarm) AND record_ts >= {_AS_OF} - INTERVAL 1440 MINUTE
       ORDER BY record_ts DESC, serial, metric_key, source_file_id LIMIT 40),
parts AS (SELECT
  (SELECT count(*) FROM st) AS n_stale,
  COALESCE((SELECT fire FROM hy), FALSE) AS hydro_fire,
  (SELECT cnt FROM wa) AS water_count,
  (SELECT count(*) FROM ar) AS n_alarms,
  COALESCE((SELECT array_to_string(list_sort(list(physical_group || chr(9) ||
      COALESCE(strftime(latest_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z', 'null'))), ';') FROM st), '') AS stale_txt,
  COALESCE((SELECT CASE WHEN fire THEN '1' ELSE '0' END || '|' ||
      CASE WHEN value IS NOT NULL AND isfinite(value)
           THEN printf('%.2f', CASE WHEN value < 0 THEN -1 ELSE 1 END * (floor(abs(value) * 100.0 + 0.5) / 100.0))
           ELSE '' END || '|' || COALESCE(metric_key, '') FROM hy), 'norow') AS hydro_txt,
  COALESCE((SELECT array_to_string(list_sort(list(serial || '|' || metric_key || '|' || CAST(low_alarm AS VARCHAR)
      || '|' || CAST(high_alarm AS VARCHAR) || '|' || COALESCE(physical_group, 'null'))), ';') FROM ar), '') AS alarm_txt)
SELECT CAST(n_stale AS INTEGER) AS n_stale, hydro_fire, CAST(water_count AS BIGINT) AS water_count,
       FALSE AS water_skipped, CAST(n_alarms AS INTEGER) AS n_alarms,
       (n_stale > 0 OR hydro_fire OR water_count > 0 OR n_alarms > 0) AS any_fire,
       array_to_string(list_filter([CASE WHEN n_stale > 0 THEN 'stale data' END,
                                    CASE WHEN hydro_fire THEN 'hydro < 5 kW' END,
                                    CASE WHEN water_count > 0 THEN 'water sampling due' END,
                                    CASE WHEN n_alarms > 0 THEN 'alarm flags' END], lambda x: x IS NOT NULL), ' · ')
           AS sections,
       'STALE' || chr(10) || stale_txt || chr(10) || 'HYDRO' || chr(10) || hydro_txt || chr(10) || 'WATER'
           || chr(10) || 'ok|' || CAST(water_count AS VARCHAR) || chr(10) || 'ALRM' || chr(10) || alarm_txt
           AS fingerprint
FROM parts""")
def alert_bundle(spark, sf_dir):
    """A7 + A8 + G9: bundle counts, any-fire, section labels and the cooldown fingerprint."""
    return _bundle(spark, sf_dir).select("n_stale", "hydro_fire", "water_count", "water_skipped", "n_alarms",
                                         "any_fire", "sections", "fingerprint")

"""Dashboard queries (E4): HUD latest values, bucket series, labelled union, series, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.dates import round_half_up as r
from sluice.operators import dashboards as db
from sluice.plans.catalog import register
from sluice.plans.sqlparts import AS_OF, RANGE_FROM, RANGE_TO, rnd, with_views
from sluice.sources import driver_tables as dt

INTERVAL = "1 hour"
_RANGE = f"record_ts BETWEEN TIMESTAMP '{RANGE_FROM}' AND TIMESTAMP '{RANGE_TO}'"


def _panel_sql(panel: str) -> str:
    p = db.HUD_PANELS[panel]
    gcol, gval = p["group"]
    op, m = p["metric"]
    uop, u = p["unit"]
    metric = f"metric_key = '{m}'" if op == "=" else f"metric_key LIKE '{m}'"
    unit = f"unit = '{u}'" if uop == "=" else "UPPER(COALESCE(unit, '')) LIKE '%GPM%'"
    return f"device_address = '{p['device']}' AND {gcol} = '{gval}' AND {metric} AND {unit}"


def _state_sql(panel: str, v: str = "value") -> str:
    parts = []
    for lo, hi, text in db.STATE_RANGES[panel]:
        conds = [c for c in ((f"{v} >= {lo}" if lo is not None else None),
                             (f"{v} <= {hi}" if hi is not None else None)) if c]
        parts.append(f"WHEN {' AND '.join(conds)} THEN '{text}'")
    return "CASE " + " ".join(parts) + " END"


def _step_sql(name: str, v: str = "value") -> str:
    steps = db.THRESHOLD_STEPS[name]
    parts = [f"WHEN {v} >= {b} THEN '{n}'" for b, n in reversed(steps) if b is not None]
    return "CASE " + " ".join(parts) + f" ELSE '{steps[0][1]}' END"


_ORDER = {
    "intake": "(metric_key = 'flow_wyman_avg') DESC, ",
    "booster": "(metric_key = 'flow_avg_A') DESC, (metric_key = 'flow_avg') DESC, (metric_key LIKE '%avg%') DESC, ",
}


def _now_sql(panel: str) -> str:
    state = f", {_state_sql(panel)} AS state" if panel in db.STATE_RANGES else ""
    return with_views("readings") + f"""
, best AS (SELECT record_ts AS time, metric_value AS value FROM readings
           WHERE {_panel_sql(panel)} AND {_RANGE}
           ORDER BY {_ORDER.get(panel, '')}record_ts DESC, serial DESC, source_file_id DESC, metric_key DESC
           LIMIT 1)
SELECT time, {rnd('value')} AS value{state}, {_step_sql(panel)} AS severity FROM best"""


def _now_query(panel: str):
    def q(spark, sf_dir):
        out = db.hud_now(dt.readings(spark, sf_dir), panel, RANGE_FROM, RANGE_TO)
        return out.withColumn("value", r("value", 4))
    q.__doc__ = f"W4/W5 + S29/S30: current '{panel}' HUD value with state text and severity."
    return q


for _p in ("solar", "grid", "hydro", "intake", "booster"):
    register(f"hud_{_p}_now", sql=_now_sql(_p))(_now_query(_p))


_SERIES_EXTRA = {"intake": " AND metric_key = 'flow_wyman_avg'",
                 "booster": " AND metric_key IN ('flow_avg', 'flow_avg_A')"}


def _series_sql(panel: str) -> str:
    return with_views("readings") + f"""
SELECT time_bucket(INTERVAL '{INTERVAL}', record_ts) AS time, {rnd('avg(metric_value)')} AS value
FROM readings WHERE {_panel_sql(panel)}{_SERIES_EXTRA.get(panel, '')} AND {_RANGE}
GROUP BY 1"""


def _series_query(panel: str):
    def q(spark, sf_dir):
        out = db.hud_series(dt.readings(spark, sf_dir), panel, INTERVAL, RANGE_FROM, RANGE_TO)
        return out.select("time", r("value", 4).alias("value"))
    q.__doc__ = f"G3: hourly average of the '{panel}' HUD series."
    return q


for _p in ("solar", "intake", "booster"):
    register(f"hud_{_p}_series", sql=_series_sql(_p))(_series_query(_p))


@register("hud_grid_vs_hydro", sql=with_views("readings") + f"""
SELECT time_bucket(INTERVAL '{INTERVAL}', record_ts) AS time, {rnd('avg(metric_value)')} AS value, 'Grid' AS metric
FROM readings WHERE {_panel_sql('grid')} AND {_RANGE} GROUP BY 1
UNION ALL
SELECT time_bucket(INTERVAL '{INTERVAL}', record_ts) AS time, {rnd('avg(metric_value)')} AS value, 'Hydro' AS metric
FROM readings WHERE {_panel_sql('hydro')} AND {_RANGE} GROUP BY 1""")
def hud_grid_vs_hydro(spark, sf_dir):
    """Labelled union of the grid and hydro hourly series (single pass)."""
    out = db.labelled_series(dt.readings(spark, sf_dir), {"Grid": "grid", "Hydro": "hydro"}, INTERVAL,
                             RANGE_FROM, RANGE_TO)
    return out.select("time", r("value", 4).alias("value"), "metric")


@register("hydro_power_series", sql=with_views("readings") + f"""
SELECT record_ts AS time, {rnd('metric_value')} AS value, CONCAT(serial, ' / ', source_system) AS metric
FROM readings WHERE {_RANGE} AND metric_key = 'power_instantaneous' AND source_system = 'hydro_plant'""")
def hydro_power_series(spark, sf_dir):
    """F15 + S34: hydro instantaneous power points labelled 'serial / source_system'."""
    out = db.series_extract(dt.readings(spark, sf_dir), RANGE_FROM, RANGE_TO)
    return out.withColumn("value", r("value", 4))


@register("hydro_latest_500", sql=with_views("readings") + f"""
SELECT record_ts, serial, metric_key, {rnd('metric_value')} AS metric_value, unit, source_system, physical_group,
       source_file_id
FROM readings
WHERE record_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR
  AND (source_system = 'hydro_plant' OR physical_group = 'hydro_plant')
ORDER BY record_ts DESC, serial, metric_key, source_file_id
LIMIT 500""")
def hydro_latest_500(spark, sf_dir):
    """Latest 500 hydro readings of the 24 hours before the as-of instant."""
    out = db.plant_recent(dt.readings(spark, sf_dir), AS_OF, hours=24, n=500)
    return out.withColumn("metric_value", r("metric_value", 4))


@register("hydro_latest_500_week", sql=with_views("readings") + f"""
SELECT record_ts, serial, metric_key, {rnd('metric_value')} AS metric_value, unit, source_system, physical_group,
       source_file_id
FROM readings
WHERE record_ts >= TIMESTAMP '{AS_OF}' - INTERVAL 168 HOUR
  AND (source_system = 'hydro_plant' OR physical_group = 'hydro_plant')
ORDER BY record_ts DESC, serial, metric_key, source_file_id
LIMIT 500""")
def hydro_latest_500_week(spark, sf_dir):
    """T1 with a window wide enough that the top-500 limit is active (tiebreak exercised)."""
    out = db.plant_recent(dt.readings(spark, sf_dir), AS_OF, hours=168, n=500)
    return out.withColumn("metric_value", r("metric_value", 4))


@register("hud_state_labels", sql=with_views("readings") + f"""
SELECT record_ts, serial, source_file_id, metric_key, {rnd('metric_value')} AS metric_value,
       CASE WHEN metric_key LIKE 'power_instantaneous%' AND physical_group = 'solar_field' THEN {_state_sql('solar', 'metric_value')}
            WHEN metric_key = 'power_instantaneous' AND physical_group = 'electrical_grid' THEN {_state_sql('grid', 'metric_value')}
            WHEN metric_key LIKE 'power_instantaneous%' THEN {_state_sql('hydro', 'metric_value')}
            WHEN metric_key LIKE 'flow_wyman%' THEN {_state_sql('intake', 'metric_value')}
       END AS state,
       CASE WHEN metric_key LIKE 'flow_avg%' THEN {_step_sql('booster', 'metric_value')} END AS booster_step
FROM readings""")
def hud_state_labels(spark, sf_dir):
    """S29/S30 applied to every reading (whole table): state text per panel family."""
    x = dt.readings(spark, sf_dir)
    m, g, v = F.col("metric_key"), F.col("physical_group"), F.col("metric_value")
    state = (F.when(m.like("power_instantaneous%") & (g == "solar_field"), db.state_label(v, db.STATE_RANGES["solar"]))
             .when((m == "power_instantaneous") & (g == "electrical_grid"), db.state_label(v, db.STATE_RANGES["grid"]))
             .when(m.like("power_instantaneous%"), db.state_label(v, db.STATE_RANGES["hydro"]))
             .when(m.like("flow_wyman%"), db.state_label(v, db.STATE_RANGES["intake"])))
    step = F.when(m.like("flow_avg%"), db.threshold_step(v, db.THRESHOLD_STEPS["booster"]))
    return x.select("record_ts", "serial", "source_file_id", "metric_key", r("metric_value", 4).alias("metric_value"),
                    state.alias("state"), step.alias("booster_step"))

"""Dashboard operators over the readings table.

* Latest-value lookups use ``max_by`` over a struct: a partial + final hash aggregate with
  one row per task in the shuffle, never a global sort.
* Time buckets use ``window(ts, interval)``; the bucket key spreads rows over many
  reducers and the average is partially aggregated before the shuffle.
* The time-range macro of the panels becomes an inclusive ``between(from, to)`` on
  ``record_ts`` with explicit instants.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import col_of, pg_concat

# Panel selections of the utilities HUD (device, group/system column, metric, unit).
HUD_PANELS = {
    "solar": dict(device="mb-005", group=("physical_group", "solar_field"),
                  metric=("=", "power_instantaneous_A"), unit=("=", "kW")),
    "grid": dict(device="mb-001", group=("physical_group", "electrical_grid"),
                 metric=("=", "power_instantaneous"), unit=("=", "kW")),
    "hydro": dict(device="mb-005", group=("source_system", "hydro_plant"),
                  metric=("like", "power_instantaneous%"), unit=("=", "kW")),
    "intake": dict(device="mb-006", group=("physical_group", "hydro_plant"),
                   metric=("like", "flow_wyman%"), unit=("=", "Gpm")),
    "booster": dict(device="mb-003", group=("physical_group", "booster_pump"),
                    metric=("like", "flow%"), unit=("gpm", None)),
}

# Value → state text ranges (first listed range wins, bounds inclusive).
STATE_RANGES = {
    "solar": [(None, 5, "IDLE"), (5, 60, "RAMPING"), (60, None, "PEAK")],
    "grid": [(None, 5, "LIGHT LOAD"), (5, 15, "MODERATE"), (15, None, "HEAVY")],
    "hydro": [(None, 10, "IDLE"), (10, 50, "RUNNING"), (50, None, "FULL")],
    "intake": [(None, 100, "LOW"), (100, 500, "NORMAL"), (500, None, "HIGH")],
}

# Threshold steps (highest step whose bound ≤ value wins); names replace colours.
THRESHOLD_STEPS = {
    "overdue": [(None, "ok"), (1, "warning"), (3, "critical")],
    "due_45": [(None, "ok"), (1, "notice"), (5, "warning")],
    "notes_flagged": [(None, "ok"), (1, "critical")],
    "solar": [(None, "idle"), (5, "ramping"), (60, "peak")],
    "grid": [(None, "light"), (5, "moderate"), (15, "heavy")],
    "hydro": [(None, "idle"), (10, "running"), (50, "full")],
    "intake": [(None, "low"), (100, "normal"), (500, "high")],
    "booster": [(None, "off"), (0.01, "on")],
}


def in_range(ts_from, ts_to, ts: str = "record_ts") -> Column:
    """Panel time filter: ``from <= ts <= to`` (both inclusive)."""
    return F.col(ts).between(F.lit(ts_from).cast("timestamp"), F.lit(ts_to).cast("timestamp"))


def panel_predicate(panel: str) -> Column:
    p = HUD_PANELS[panel]
    gcol, gval = p["group"]
    cond = (F.col("device_address") == p["device"]) & (F.col(gcol) == gval)
    op, m = p["metric"]
    cond &= (F.col("metric_key") == m) if op == "=" else F.col("metric_key").like(m)
    uop, u = p["unit"]
    cond &= (F.col("unit") == u) if uop == "=" else F.upper(F.coalesce(F.col("unit"), F.lit(""))).like("%GPM%")
    return cond


def state_label(value, ranges: Sequence[tuple]) -> Column:
    """First range (inclusive bounds) containing the value."""
    v = col_of(value)
    expr = None
    for lo, hi, text in ranges:
        cond = F.lit(True)
        if lo is not None:
            cond = cond & (v >= lo)
        if hi is not None:
            cond = cond & (v <= hi)
        expr = F.when(cond, text) if expr is None else expr.when(cond, text)
    return expr


def threshold_step(value, steps: Sequence[tuple]) -> Column:
    """Name of the highest step whose bound is ≤ value (the first step has no bound)."""
    v = col_of(value)
    expr = None
    for bound, name in reversed(steps):
        if bound is None:
            expr = F.lit(name) if expr is None else expr.otherwise(name)
        else:
            expr = F.when(v >= bound, name) if expr is None else expr.when(v >= bound, name)
    return expr


def latest(df: DataFrame, *, by: Sequence[str] = (), order: Sequence = (), ts: str = "record_ts",
           tiebreak: Sequence[str] = ("serial", "source_file_id", "metric_key"),
           cols: Sequence[str] = ("record_ts", "metric_value", "metric_key")) -> DataFrame:
    """The latest row (per ``by`` group) — ``order`` expressions rank before recency.

    ``max_by(struct(cols), struct(*order, ts, tiebreak))``: Postgres ``ORDER BY … DESC LIMIT 1``
    with a deterministic tiebreak.
    """
    key = F.struct(*[col_of(o) for o in order], F.col(ts), *[F.col(c) for c in tiebreak])
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), key).alias("_b")
    agg = df.groupBy(*by).agg(best) if by else df.agg(best)
    return agg.where(F.col("_b").isNotNull()).select(*by, "_b.*")


def hud_now(readings: DataFrame, panel: str, ts_from, ts_to) -> DataFrame:
    """Current value of a HUD panel with its state text and severity step."""
    rows = readings.where(panel_predicate(panel) & in_range(ts_from, ts_to))
    order: list[Column] = []
    if panel == "intake":
        order = [F.col("metric_key") == "flow_wyman_avg"]
    elif panel == "booster":
        order = [F.col("metric_key") == "flow_avg_A", F.col("metric_key") == "flow_avg",
                 F.col("metric_key").like("%avg%")]
    out = latest(rows, order=order).select(F.col("record_ts").alias("time"), F.col("metric_value").alias("value"))
    extra = []
    if panel in STATE_RANGES:
        extra.append(state_label("value", STATE_RANGES[panel]).alias("state"))
    extra.append(threshold_step("value", THRESHOLD_STEPS[panel]).alias("severity"))
    return out.select("time", "value", *extra)


def bucket_avg(df: DataFrame, interval: str, ts: str = "record_ts", value: str = "metric_value") -> DataFrame:
    """Average per time bucket (buckets aligned to the epoch; empty buckets absent)."""
    return (df.groupBy(F.window(ts, interval).start.alias("time"))
            .agg(F.avg(value).alias("value")))


def hud_series(readings: DataFrame, panel: str, interval: str, ts_from, ts_to) -> DataFrame:
    rows = readings.where(panel_predicate(panel) & in_range(ts_from, ts_to))
    if panel == "intake":
        rows = rows.where(F.col("metric_key") == "flow_wyman_avg")
    elif panel == "booster":
        rows = rows.where(F.col("metric_key").isin("flow_avg", "flow_avg_A"))
    return bucket_avg(rows, interval)


def labelled_series(readings: DataFrame, panels: dict[str, str], interval: str, ts_from, ts_to) -> DataFrame:
    """UNION ALL of labelled bucket series, done in one pass — each row appears once
    for every panel it belongs to, then rows are bucketed by (label, bucket)."""
    labels = F.array_compact(F.array(*[F.when(panel_predicate(panel), F.lit(name)) for name, panel in panels.items()]))
    rows = readings.where(in_range(ts_from, ts_to)).withColumn("metric", F.explode(labels))
    return (rows.groupBy(F.window("record_ts", interval).start.alias("time"), "metric")
            .agg(F.avg("metric_value").alias("value")))


def series_extract(readings: DataFrame, ts_from, ts_to, metric_key: str = "power_instantaneous",
                   source_system: str = "hydro_plant") -> DataFrame:
    """F15 + S34: (time, value, 'serial / source_system') points of one metric."""
    return readings.where(in_range(ts_from, ts_to) & (F.col("metric_key") == metric_key)
                          & (F.col("source_system") == source_system)).select(
        F.col("record_ts").alias("time"), F.col("metric_value").alias("value"),
        pg_concat("serial", F.lit(" / "), "source_system").alias("metric"))


def latest_n(df: DataFrame, n: int, ts: str = "record_ts",
             tiebreak: Sequence[str] = ("serial", "metric_key", "source_file_id")) -> DataFrame:
    """Newest ``n`` rows (``TakeOrderedAndProject``: a per-task top-n, then a merge)."""
    return df.orderBy(F.col(ts).desc(), *[F.col(c).asc() for c in tiebreak]).limit(n)


def plant_recent(readings: DataFrame, as_of, hours: int = 24, n: int = 500,
                 plant: str = "hydro_plant") -> DataFrame:
    """Latest ``n`` plant readings in the ``hours`` before ``as_of``."""
    since = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(0), F.lit(hours))
    rows = readings.where((F.col("record_ts") >= since)
                          & ((F.col("source_system") == plant) | (F.col("physical_group") == plant)))
    return latest_n(rows, n).select("record_ts", "serial", "metric_key", "metric_value", "unit",
                                    "source_system", "physical_group", "source_file_id")

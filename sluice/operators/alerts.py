"""Alert checks over readings and schedule.

Every check is an aggregate or a top-k with an explicit ``as_of`` instant (the reference uses
the database clock).  The bundle is one row built from bounded pieces: at most one row per
physical group (stale), one latest reading (hydro), one count (water) and at most
``alarm_limit`` alarm rows — so the ``collect_list`` calls below are bounded by design.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluice.functions.values import is_finite
from sluice.operators.dashboards import latest, latest_n
from sluice.operators.schedule import due_counts

ALERT_KEY = "email_ops_bundle_v1"


def _ts(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("timestamp")


def _minutes(n) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n))


def iso_ms(ts) -> Column:
    """``Date.prototype.toISOString`` text of an instant (NULL → ``null``)."""
    return F.coalesce(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"), F.lit("null"))


def js_number_text(x: float) -> str:
    """``String(number)`` for the threshold shown in a section label."""
    return str(int(x)) if float(x).is_integer() else repr(float(x))


def to_fixed2(v) -> Column:
    """``Number.prototype.toFixed(2)``: the hundredth nearest to the exact binary value (so 10.235,
    which is stored a little below, gives 10.23), ties away from zero."""
    x = F.abs(v)
    product = x * F.lit(100.0)
    # x * 100 = product + error exactly: x is split into halves whose products need no rounding.
    c = x * F.lit(134217729.0)
    high = c - (c - x)
    error = (high * F.lit(100.0) - product) + (x - high) * F.lit(100.0)
    whole = F.floor(product)
    n = whole + F.when((product - whole) - F.lit(0.5) + error >= 0, 1).otherwise(0)
    text = F.concat(F.floor(n / 100).cast("string"), F.lit("."), F.lpad(F.pmod(n, F.lit(100)).cast("string"), 2, "0"))
    small = x < F.lit(1e13)
    return F.when(small, F.concat(F.when((v < 0) & (n > 0), F.lit("-")).otherwise(F.lit("")), text)).otherwise(F.format_string("%.2f", v))


# --- A1 / G1 ---------------------------------------------------------------------------

def stale_groups(readings: DataFrame, as_of, stale_after_minutes: int = 240) -> DataFrame:
    """Latest reading per physical group (NULL → ``unknown``) older than the threshold.

    An empty table yields one sentinel row ``('(no rows)', NULL)``.  Both parts are
    aggregates (the sentinel is a global count filtered to zero), so nothing is cross-joined.
    """
    grp = F.coalesce(F.col("physical_group"), F.lit("unknown"))
    per = readings.groupBy(grp.alias("physical_group")).agg(F.max("record_ts").alias("latest_ts"))
    stale = per.where(F.col("latest_ts") < _ts(as_of) - _minutes(stale_after_minutes))
    sentinel = readings.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0).select(
        F.lit("(no rows)").alias("physical_group"), F.lit(None).cast("timestamp").alias("latest_ts"))
    return stale.unionByName(sentinel)


# --- A2 / A3 / A4 ----------------------------------------------------------------------

def hydro_latest(readings: DataFrame, *, strict: bool = False) -> DataFrame:
    """Latest hydro kW reading.  Default (email check, A2): group OR source is hydro and the
    key starts with ``power_instantaneous``; ``strict`` (A4 rule): group hydro, exact key."""
    if strict:
        cond = ((F.col("physical_group") == "hydro_plant") & (F.col("metric_key") == "power_instantaneous")
                & (F.col("unit") == "kW"))
    else:
        cond = (((F.col("physical_group") == "hydro_plant") | (F.col("source_system") == "hydro_plant"))
                & (F.col("unit") == "kW") & F.col("metric_key").like("power_instantaneous%"))
    return latest(readings.where(cond))


def hydro_out(readings: DataFrame, as_of, *, recent_minutes: int = 60, min_kw: float = 5.0) -> DataFrame:
    """A2: fire iff the latest reading is recent (−2 min ≤ age ≤ window) and below ``min_kw``.

    Zero rows when no hydro reading exists.  ``age_minutes`` is rounded half up."""
    row = hydro_latest(readings)
    age_ms = F.unix_millis(_ts(as_of)) - F.unix_millis("record_ts")
    recent = (age_ms <= recent_minutes * 60_000) & (age_ms >= -120_000)
    v = F.col("metric_value")
    return row.select(
        F.col("metric_value").alias("value"), "record_ts", "metric_key",
        F.floor(age_ms / 60_000.0 + 0.5).cast("long").alias("age_minutes"),
        recent.alias("recent"),
        (recent & is_finite(v) & (v < F.lit(float(min_kw)))).alias("fire"),
        F.when(~recent, F.lit("reading_not_recent")).alias("reason"),
    )


def below_threshold_rule(readings: DataFrame, ts_from, ts_to, *, threshold: float, strict: bool) -> DataFrame:
    """A3 / A4: last value in the range compared with a threshold.

    A3 (``strict=False``): source hydro, exact ``power_instantaneous`` (any unit).
    A4 (``strict=True``): group hydro, exact key, unit kW."""
    rng = F.col("record_ts").between(_ts(ts_from), _ts(ts_to))
    if strict:
        cond = ((F.col("physical_group") == "hydro_plant") & (F.col("metric_key") == "power_instantaneous")
                & (F.col("unit") == "kW"))
    else:
        cond = (F.col("source_system") == "hydro_plant") & (F.col("metric_key") == "power_instantaneous")
    last = latest(readings.where(cond & rng))
    return last.select(F.col("record_ts").alias("time"), F.col("metric_value").alias("value"),
                       (F.col("metric_value") < F.lit(float(threshold))).alias("firing"))


# --- A5 ---------------------------------------------------------------------------------

def sustained(evaluations: DataFrame, *, by: Sequence[str], ts: str = "tick", cond: str = "condition",
              for_minutes: int, slice_ms: int = 86_400_000) -> DataFrame:
    """A5 ``evaluate_for``: a rule fires at a tick once its condition has held at every tick
    for at least ``for_minutes``.

    A run of true ticks starts at the tick after the last false one.  Ticks are windowed by (rule,
    time slice), so a rule's history is not one task; per slice only its first tick and the start
    it leaves open are carried to the others (a row per rule and slice)."""
    keys = [*by, "_slice"]
    x = evaluations.withColumn("_slice", F.floor(F.unix_millis(F.col(ts)) / F.lit(slice_ms)))
    within = Window.partitionBy(*keys).orderBy(ts)
    slices = Window.partitionBy(*by).orderBy("_slice")
    first = (x.groupBy(*keys).agg(F.min(ts).alias("_first"))
             .withColumn("_after", F.lead("_first").over(slices)).withColumn("_origin", F.min("_first").over(Window.partitionBy(*by))))
    held = F.coalesce(F.col(cond), F.lit(False))
    x = (x.join(first.select(*keys, "_after", "_origin"), keys)
         .withColumn("_start", F.when(~held, F.coalesce(F.lead(ts).over(within), F.col("_after")))))
    left = (x.groupBy(*keys).agg(F.max("_start").alias("_open"))
            .withColumn("_carried", F.max("_open").over(slices.rowsBetween(Window.unboundedPreceding, -1))))
    running = F.max("_start").over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    x = (x.withColumn("_run", running).join(left.select(*keys, "_carried"), keys)
         .withColumn("_since", F.coalesce("_run", "_carried", "_origin")))
    long_enough = (F.unix_millis(F.col(ts)) - F.unix_millis("_since")) >= for_minutes * 60_000
    return (x.withColumn("firing", held & long_enough).withColumn("pending", held & ~long_enough)
            .drop("_slice", "_after", "_origin", "_start", "_run", "_carried", "_since"))


# --- T2 ---------------------------------------------------------------------------------

def alarm_rows(readings: DataFrame, as_of, *, lookback_minutes: int = 240, limit: int = 40) -> DataFrame:
    """low/high alarm readings in the look-back window, newest first, at most ``limit``."""
    rows = readings.where((F.col("low_alarm") | F.col("high_alarm"))
                          & (F.col("record_ts") >= _ts(as_of) - _minutes(lookback_minutes)))
    return latest_n(rows, limit).select("serial", "metric_key", "record_ts", "low_alarm", "high_alarm",
                                        "physical_group", "source_file_id")


# --- A6-A8 ------------------------------------------------------------------------------

def water_due(schedule: DataFrame | None, as_of) -> DataFrame:
    """Schedule rows due in [−30 d, +45 d]; ``skipped`` when there is no schedule table."""
    if schedule is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        return spark.range(1).select(F.lit(0).cast("long").alias("count"), F.lit(True).alias("skipped"))
    return due_counts(schedule, as_of).select(F.col("alert_window").cast("long").alias("count"),
                                              F.lit(False).alias("skipped"))


def bundle(readings: DataFrame, schedule: DataFrame | None, as_of, *, stale_after_minutes: int = 240,
           hydro_recent_minutes: int = 60, hydro_min_kw: float = 5.0, alarm_lookback_minutes: int = 240,
           alarm_limit: int = 40, recent: DataFrame | None = None) -> DataFrame:
    """A7 + A8 + G9: one row with every section, the any-fire flag, the firing-section labels
    and the cooldown fingerprint.  ``recent``: the readings for the alarm section, if the caller can
    read fewer of them (a pruned scan that covers the look-back window)."""
    stale = stale_groups(readings, as_of, stale_after_minutes).agg(
        F.collect_list(F.struct("physical_group", "latest_ts")).alias("stale"))
    hydro = hydro_out(readings, as_of, recent_minutes=hydro_recent_minutes, min_kw=hydro_min_kw).agg(
        F.first(F.struct("value", "record_ts", "metric_key", "age_minutes", "recent", "fire", "reason"),
                ignorenulls=True).alias("hydro"))
    water = water_due(schedule, as_of).select(F.struct("count", "skipped").alias("water"))
    alarms = alarm_rows(readings if recent is None else recent, as_of, lookback_minutes=alarm_lookback_minutes, limit=alarm_limit).agg(
        F.collect_list(F.struct("serial", "metric_key", "record_ts", "low_alarm", "high_alarm",
                                "physical_group")).alias("alarms"))
    # Each piece is one row: stack them and take the first non-null of each column (no join).
    b = _stack_one_row(stale, hydro, water, alarms)
    fire = ((F.size("stale") > 0) | F.coalesce(F.col("hydro.fire"), F.lit(False))
            | (~F.col("water.skipped") & (F.col("water.count") > 0)) | (F.size("alarms") > 0))
    labels = F.array_compact(F.array(
        F.when(F.size("stale") > 0, F.lit("stale data")),
        F.when(F.coalesce(F.col("hydro.fire"), F.lit(False)), F.lit(f"hydro < {js_number_text(hydro_min_kw)} kW")),
        F.when(~F.col("water.skipped") & (F.col("water.count") > 0), F.lit("water sampling due")),
        F.when(F.size("alarms") > 0, F.lit("alarm flags"))))
    return b.select(
        F.size("stale").alias("n_stale"),
        F.coalesce(F.col("hydro.fire"), F.lit(False)).alias("hydro_fire"),
        F.col("water.count").alias("water_count"), F.col("water.skipped").alias("water_skipped"),
        F.size("alarms").alias("n_alarms"),
        fire.alias("any_fire"),
        F.array_join(labels, " · ").alias("sections"),
        fingerprint().alias("fingerprint"),
        "stale", "hydro", "water", "alarms",
    )


def fingerprint() -> Column:
    """The cooldown payload — sorted stale lines, hydro part, water part, sorted alarm
    lines without timestamps, newline-joined (value is included even when not firing)."""
    stale_lines = F.array_sort(F.transform("stale", lambda s: F.concat(
        s["physical_group"], F.lit("\t"), iso_ms(s["latest_ts"]))))
    h = F.col("hydro")
    value = F.when(h["value"].isNotNull() & is_finite(h["value"]), to_fixed2(h["value"])).otherwise(F.lit(""))
    hydro = F.when(h.isNull(), F.lit("norow")).otherwise(F.concat(
        F.when(h["fire"], "1").otherwise("0"), F.lit("|"), value, F.lit("|"), F.coalesce(h["metric_key"], F.lit(""))))
    water = F.concat(F.when(F.col("water.skipped"), "skip").otherwise("ok"), F.lit("|"),
                     F.col("water.count").cast("string"))

    def s(c):
        return F.coalesce(c.cast("string"), F.lit("null"))
    alarm_lines = F.array_sort(F.transform("alarms", lambda a: F.concat_ws(
        "|", s(a["serial"]), s(a["metric_key"]), s(a["low_alarm"]), s(a["high_alarm"]), s(a["physical_group"]))))
    return F.concat_ws("\n", F.lit("STALE"), F.array_join(stale_lines, ";"), F.lit("HYDRO"), hydro,
                       F.lit("WATER"), water, F.lit("ALRM"), F.array_join(alarm_lines, ";"))


def _stack_one_row(*parts: DataFrame) -> DataFrame:
    """Combine single-row frames with disjoint columns into one row (union + first non-null)."""
    cols = [(c, t) for p in parts for c, t in p.dtypes]
    padded = [p.select(*[F.col(c) if c in p.columns else F.lit(None).cast(t).alias(c) for c, t in cols])
              for p in parts]
    u = padded[0]
    for p in padded[1:]:
        u = u.unionByName(p)
    return u.agg(*[F.first(c, ignorenulls=True).alias(c) for c, _ in cols])


# --- A9 ---------------------------------------------------------------------------------

def cooldown(bundle_row: DataFrame, state: DataFrame, as_of, *, cooldown_minutes: int = 360,
             force: bool = False, alert_key: str = ALERT_KEY) -> tuple[DataFrame, DataFrame]:
    """Decide whether to send; returns (decision row, new state table).

    Suppressed iff the stored payload equals the new fingerprint and less than the cooldown
    has passed; no stored state → send; ``force`` bypasses.  State is updated only when the
    bundle fires and is sent."""
    st = state.where(F.col("alert_key") == alert_key).select("last_sent_at", "last_payload")
    j = _stack_one_row(bundle_row.select("any_fire", "fingerprint"), st)
    same = F.coalesce(F.col("last_payload") == F.col("fingerprint"), F.lit(False))
    within = (F.unix_millis(_ts(as_of)) - F.unix_millis("last_sent_at")) < cooldown_minutes * 60_000
    suppressed = F.lit(False) if force else F.coalesce(same & within, F.lit(False))
    decision = j.select(
        "any_fire", "fingerprint", "last_sent_at",
        (F.col("any_fire") & ~suppressed).alias("send"),
        F.when(~F.col("any_fire"), F.lit("nothing_firing"))
        .when(suppressed, F.lit("cooldown_same_bundle_payload")).alias("reason"))
    sent = decision.where("send").select(F.lit(alert_key).alias("alert_key"),
                                         _ts(as_of).alias("last_sent_at"), F.col("fingerprint").alias("last_payload"))
    kept = state.join(sent.select("alert_key"), "alert_key", "left_anti")
    return decision, kept.unionByName(sent)

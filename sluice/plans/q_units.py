"""Queries over scalars and landing operators
and over semi-structured values (VARIANT)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F

from sluice.functions import metrics as M
from sluice.functions.dates import report_window, round_half_up as r, yesterday
from sluice.operators import alerts as al
from sluice.operators import flow
from sluice.operators.readings import parse_files
from sluice.plans.catalog import register
from sluice.plans.q_flow import _WYMAN_WHERE, _intervals_sql, _monthly_sql, _round_monthly
from sluice.plans.sqlparts import END, TZ, YEAR, local, rnd, with_views
from sluice.sources import config as C
from sluice.sources import driver_tables as dt
from sluice.sources import objects as ob

# --- landing (K11, S16, S18) ---------------------------------------------------------------------


@register("landing_routes", sql="""
WITH p AS (SELECT event_id, event_id // 4 AS upload_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE 'SN/' || user_id || ' #' END AS serial,
                  CASE event_id % 4 WHEN 0 THEN 'LOGFILE' WHEN 1 THEN 'LogFile' WHEN 2 THEN 'STATUSFILE' ELSE 'blob' END AS field,
                  CASE WHEN event_id % 4 <= 1 THEN 'acq (' || event_id // 8 || ').log.gz' WHEN user_id % 3 = 0 THEN 'notes.TXT'
                       WHEN user_id % 3 = 1 THEN '' ELSE 'img ü.bin' END AS filename,
                  event_id % 4 = 0 AS is_log, ts FROM events),
k AS (SELECT *, max(CASE WHEN is_log THEN filename END) OVER (PARTITION BY upload_id) AS log_name FROM p)
SELECT event_id, CASE WHEN is_log THEN 'log-gz' WHEN contains(lower(field), 'status') OR contains(lower(filename), 'status') OR ends_with(lower(filename), '.txt')
                      THEN 'status' ELSE 'other' END AS kind,
       CASE WHEN is_log THEN 'log-gz' WHEN contains(lower(field), 'status') OR contains(lower(filename), 'status') OR ends_with(lower(filename), '.txt')
            THEN 'status' ELSE 'other' END || '/' || regexp_replace(coalesce(serial, 'unknown_serial'), '[^a-zA-Z0-9._-]', '_', 'g') || strftime(ts, '/%Y/%m/%d/')
       || regexp_replace(CASE WHEN filename = '' THEN field || '.bin' ELSE filename END, '[^a-zA-Z0-9._-]', '_', 'g') AS object_key
FROM k WHERE NOT (NOT is_log AND lower(field) = 'logfile' AND filename IS NOT DISTINCT FROM log_name)""")
def landing_routes(spark, sf_dir):
    """Object keys of uploads of up to four parts, one of which may repeat the log part."""
    e = dt.table(spark, sf_dir, "events")
    n, u = F.col("event_id") % 4, F.col("user_id")
    name = (F.when(n <= 1, F.concat(F.lit("acq ("), F.floor(F.col("event_id") / 8).cast("string"), F.lit(").log.gz")))
            .when(u % 3 == 0, "notes.TXT").when(u % 3 == 1, "").otherwise("img ü.bin"))
    parts = e.select(
        "event_id", F.floor(F.col("event_id") / 4).alias("upload_id"),
        F.when(u % 5 == 0, F.lit(None)).otherwise(F.concat(F.lit("SN/"), u.cast("string"), F.lit(" #"))).alias("serial"),
        F.when(n == 0, "LOGFILE").when(n == 1, "LogFile").when(n == 2, "STATUSFILE").otherwise("blob").alias("field"), name.alias("filename"),
        (n == 0).alias("is_log"), F.col("ts").cast("timestamp").alias("received_at"))
    return ob.route_parts(parts).select("event_id", "kind", "object_key")


# Fixed value: the column order of the device whose header line is canonical.
_ORDER = ["time(UTC)", "error", "lowalarm", "highalarm", "Flow (Gpm)"]


@register("landing_headers", sql="""
WITH f AS (SELECT event_id, event_id % 5 AS kind, user_id % 3 AS u FROM events)
SELECT event_id, CASE WHEN kind = 4 OR u = 2 THEN NULL WHEN kind IN (0, 1) THEN 'matched' ELSE 'prepended' END AS status,
       CASE WHEN kind = 4 OR u = 2 THEN NULL ELSE '006' END AS code,
       CAST(CASE kind WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 13 ELSE 1 END
            + CASE WHEN u <> 2 AND kind IN (2, 3) THEN 1 ELSE 0 END AS INTEGER) AS n_lines
FROM f""")
def landing_headers(spark, sf_dir):
    """Canonical header lines matched (behind a BOM, with blanks around cells, below
    a junk line, but not beyond the twelfth line) or put in front."""
    e = dt.table(spark, sf_dir, "events")
    kind, u = F.col("event_id") % 5, F.col("user_id") % 3
    row = F.concat(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), F.lit("\t0\t0\t0\t"), F.col("value").cast("string"))
    header = "\t".join(_ORDER)
    text = (F.when(kind == 0, F.concat(F.lit("﻿" + header + "\n"), row))
            .when(kind == 1, F.concat(F.lit("# junk\r\n " + " \t".join(_ORDER) + "\r\n"), row))
            .when(kind == 2, F.concat(F.lit("#\n" * 12 + header)))
            .otherwise(row))
    code = F.when(u == 0, "mb-006").when(u == 1, "MB_6").otherwise("m-006")
    files = e.select("event_id", F.concat(F.lit("log-gz/S/"), code, F.lit("_x.log.gz")).alias("object_key"), text.alias("text"), (kind != 4).alias("is_gzip"))
    labels = C.default_labels(spark)
    schema = labels.where("code = '006'").first().schema_id
    canonical = C.canonical_header_lines(labels, C.default_schemas(spark, {schema: _ORDER}))
    out = ob.normalise_header(files, canonical)
    return out.select("event_id", F.col("csv_header_status").alias("status"), F.col("csv_header_code").alias("code"),
                      F.size(F.split("text", "\r?\n", -1)).cast("int").alias("n_lines"))


# --- headers (S5, S6, S7, S14) ----------------------------------------------------------------------

_FORMS = ["{}  Instntaneous Pwer (kW)", " {} Avrage\tCurent ", "Total {} Flow (gallons per minute)", "{} Reactve Enrgy Sumation (kWh)",
          "{} Hydo Presure (psi (abs))", "{} Pulse Facotr", "{} Status"]


def _nested(sql: str) -> str:
    for wrong, right in M.TYPO_CORRECTIONS:
        sql = f"replace({sql}, '{wrong}', '{right}')"
    return sql


_SPACE = r"[\t\n\x0B\f\r \x{00a0}]"


@register("header_rules", sql=f"""
WITH h AS (SELECT p_partkey, CASE p_partkey % 7 {' '.join(f"WHEN {k} THEN " + "'" + f.replace('{}', "' || upper(p_name) || '") + "'" for k, f in enumerate(_FORMS))} END AS header
           FROM part),
t AS (SELECT p_partkey, header, regexp_replace(header, '^{_SPACE}+|{_SPACE}+$', '', 'g') AS clean FROM h),
u AS (SELECT *, regexp_extract(clean, '\\(([^()]*)\\){_SPACE}*$', 1) AS inner_unit, regexp_matches(clean, '\\(([^()]*)\\){_SPACE}*$') AS has_unit FROM t)
SELECT p_partkey, {_nested(f"regexp_replace(lower(clean), '{_SPACE}+', ' ', 'g')")} AS source,
       CASE WHEN has_unit THEN replace(replace(inner_unit, 'per minute', '/min'), 'per hour', '/hr') END AS unit,
       regexp_matches(lower(header), 'pulse|power|flow|pressure|energy') AS measurable,
       CASE WHEN p_partkey % 7 = 6 THEN 'State' ELSE CASE WHEN has_unit THEN regexp_replace(regexp_replace(clean, '\\([^()]*\\){_SPACE}*$', ''), '{_SPACE}+$', '') ELSE clean END
       END AS canonical
FROM u""")
def header_rules(spark, sf_dir):
    """S5, S6, S7, S14 over headers with misspelt words, odd blanks, units and aliases."""
    p = dt.table(spark, sf_dir, "part")
    header = F.lit(None).cast("string")
    for k, form in reversed(list(enumerate(_FORMS))):
        a, b = form.split("{}")
        header = F.when(F.col("p_partkey") % 7 == k, F.concat(F.lit(a), F.upper("p_name"), F.lit(b))).otherwise(header)
    base, unit = M.split_unit("header")
    x = p.select("p_partkey", header.alias("header"), F.lower(F.concat("p_name", F.lit(" status"))).alias("alias"))
    aliases = F.create_map(F.col("alias"), F.lit("State"))
    return x.select("p_partkey", M.normalize_source("header").alias("source"), unit.alias("unit"), M.is_measurable("header").alias("measurable"),
                    M.canonicalize(base, aliases).alias("canonical"))


_STRICT_HEADER = "time(UTC),error,lowalarm,highalarm,Hydo Plant Power Min (kW),Unlisted Plant Power (kW),Solar Array Power Max (kW)"


@register("strict_schema_readings", sql=f"""
WITH e AS (SELECT event_id, date_trunc('second', ts) AS record_ts, value, event_id % 2 = 0 AS listed FROM events)
SELECT event_id, record_ts, 'hydro_plant' AS source_system, 'power_min' AS base_key, {rnd('value')} AS metric_value FROM e
UNION ALL SELECT event_id, record_ts, 'solar_field', 'power_max', {rnd('value + 2')} FROM e
UNION ALL SELECT event_id, record_ts, 'unknown', 'power', {rnd('value + 1')} FROM e WHERE NOT listed""")
def strict_schema_readings(spark, sf_dir):
    """Files of a schema with an allow-list (a misspelt header is listed by its alias, another header
    is not) and of one without, parsed strictly."""
    e = dt.table(spark, sf_dir, "events")
    row = F.concat_ws(",", F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"), F.lit("0,0,0"), *[(F.col("value") + k).cast("string") for k in range(3)])
    key = F.concat(F.when(F.col("event_id") % 2 == 0, F.lit("log-gz/S/mb-005_")).otherwise(F.lit("log-gz/S/mb-004_")), F.col("event_id").cast("string"), F.lit(".log"))
    files = e.select(key.alias("object_key"), F.lit("v").alias("version_token"), F.col("ts").cast("timestamp").alias("last_modified"),
                     F.concat(F.lit(_STRICT_HEADER + "\n"), row).alias("text"))
    p = parse_files(files, C.default_labels(spark), C.default_schemas(spark), strict=True, ingested_at="2024-02-01 00:00:00",
                    spread=spark.sparkContext.defaultParallelism * 2, carry=["object_key"])
    return p.readings.select(F.regexp_extract("object_key", r"_(\d+)\.log", 1).cast("long").alias("event_id"), "record_ts", "source_system",
                             F.regexp_replace("metric_key", "_[A-C]$", "").alias("base_key"), r("metric_value", 4).alias("metric_value"))


# --- report parameters (S25, S28, F9) --------------------------------------------------------------------

@register("report_end_days", sql=f"""
SELECT event_id, strftime(CAST({local('ts')} AS DATE) - 1, '%Y-%m-%d') AS end_day FROM events""")
def report_end_days(spark, sf_dir):
    """The default report end, the day before, as of every event."""
    return dt.table(spark, sf_dir, "events").select("event_id", yesterday(F.col("ts").cast("timestamp"), TZ).cast("string").alias("end_day"))


@register("flow_monthly_scaled", sql=_monthly_sql(with_views("readings") + ", scaled AS (SELECT * REPLACE (metric_value * 4.0 AS metric_value) FROM readings),"
                                                  + _intervals_sql(_WYMAN_WHERE + " AND serial = 'SN3'", source="scaled")))
def flow_monthly_scaled(spark, sf_dir):
    """The monthly summary of one serial with a flow scale of 4."""
    rows = flow.select_flow_rows(dt.readings(spark, sf_dir), year=YEAR, end_inclusive=END, tz=TZ, stream="wyman", serial="SN3")
    t0, _ = report_window(YEAR, END, TZ)
    return _round_monthly(flow.monthly_summary(flow.flow_intervals(rows, t0, scale=4), year=YEAR, end_inclusive=END, tz=TZ))


# --- cooldown (A9, K6) ------------------------------------------------------------------------------------

_EVALUATIONS = [_dt.datetime(2024, 1, 10) + _dt.timedelta(hours=3 * k) for k in range(8)]
_KEY = "high_values"


@register("alert_cooldown", sql=f"""
WITH RECURSIVE a AS (SELECT k, TIMESTAMP '2024-01-10' + to_hours(3 * k) AS eval_at FROM range(8) t(k)),
b AS (SELECT k, eval_at, (SELECT count(*) FROM events WHERE value > 150 AND ts > eval_at - INTERVAL 12 HOUR AND ts <= eval_at) AS n FROM a),
f AS (SELECT k, eval_at, n > 0 AS any_fire, 'high=' || least(n, 3) AS fingerprint FROM b),
s AS (SELECT -1::BIGINT AS k, NULL::TIMESTAMP AS sent_at, NULL::VARCHAR AS payload, NULL::TIMESTAMP AS eval_at, FALSE AS any_fire, '' AS fingerprint, FALSE AS send
      UNION ALL
      SELECT f.k, CASE WHEN x.send THEN f.eval_at ELSE s.sent_at END, CASE WHEN x.send THEN f.fingerprint ELSE s.payload END, f.eval_at, f.any_fire, f.fingerprint, x.send
      FROM s JOIN f ON f.k = s.k + 1,
           LATERAL (SELECT f.any_fire AND NOT coalesce(s.payload = f.fingerprint AND f.eval_at - s.sent_at < INTERVAL 360 MINUTE, FALSE) AS send) x)
SELECT eval_at, any_fire, fingerprint, send, CASE WHEN NOT any_fire THEN 'nothing_firing' WHEN NOT send THEN 'cooldown_same_bundle_payload' END AS reason
FROM s WHERE k >= 0""")
def alert_cooldown(spark, sf_dir):
    """Eight evaluations of the events, three hours apart, each with the state the last one left."""
    e = dt.table(spark, sf_dir, "events")
    state = spark.createDataFrame([], "alert_key string, last_sent_at timestamp, last_payload string")
    out = None
    for at in _EVALUATIONS:
        ts = F.col("ts").cast("timestamp")
        n = e.where((F.col("value") > 150) & (ts > F.lit(at - _dt.timedelta(hours=12))) & (ts <= F.lit(at))).agg(F.count(F.lit(1)).alias("n"))
        bundle = n.select((F.col("n") > 0).alias("any_fire"), F.concat(F.lit("high="), F.least("n", F.lit(3)).cast("string")).alias("fingerprint"))
        # One row each, evaluated once, as the alert job does: what follows depends on them.
        bundle = spark.createDataFrame(bundle.collect(), bundle.schema)
        decision, state = al.cooldown(bundle, state, at, alert_key=_KEY)
        decision, state = (spark.createDataFrame(x.collect(), x.schema) for x in (decision, state))
        row = decision.select(F.lit(at).alias("eval_at"), "any_fire", "fingerprint", "send", "reason")
        out = row if out is None else out.unionByName(row)
    return out


# --- semi-structured values --------------------------------------------------------------------------------

@register("event_properties", sql="""
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_type(props, '$.k') = 'UBIGINT' AS whole, json_extract_string(props, '$.missing') IS NULL AS absent
FROM events""")
def event_properties(spark, sf_dir):
    """Typed values out of JSON text by VARIANT, without a schema."""
    e = dt.table(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("v"))
    k = F.try_variant_get("v", "$.k", "bigint")
    return e.select("event_id", k.alias("k"), F.schema_of_variant(F.variant_get("v", "$.k", "variant")).isin("BIGINT").alias("whole"),
                    F.try_variant_get("v", "$.missing", "string").isNull().alias("absent"))

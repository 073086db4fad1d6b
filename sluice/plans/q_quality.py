"""Listing, diagnostics and replay queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.dates import report_window
from sluice.operators import quality as qa
from sluice.operators import replay as rp
from sluice.plans.catalog import register
from sluice.plans.q_ingest import _KEY_SQL, parsed
from sluice.plans.sqlparts import END, TZ, YEAR, utc_of_local, with_views
from sluice.sources import driver_tables as dt
from sluice.sources import objects as ob

K = 200
_NEWEST = f"""
, top AS (SELECT * FROM objects ORDER BY COALESCE(last_modified, TIMESTAMP '1970-01-01') DESC, object_key ASC
          LIMIT {K}),
ck AS (SELECT object_key, COALESCE(NULLIF(version_token, ''), 'no_etag') AS version_token FROM objects
       WHERE version_token = 'F')"""


@register("objects_newest_first", sql=with_views("objects") + _NEWEST + """
SELECT object_key, version_token, size, last_modified FROM top""")
def objects_newest_first(spark, sf_dir):
    """Newest-first top-200 of the object manifest (ties in key order)."""
    return ob.newest_first(dt.objects(spark, sf_dir), K)


@register("objects_unprocessed", sql=with_views("objects") + _NEWEST + """
SELECT t.object_key, COALESCE(NULLIF(t.version_token, ''), 'no_etag') AS version_token, t.size, t.last_modified
FROM top t ANTI JOIN ck USING (object_key, version_token)""")
def objects_unprocessed(spark, sf_dir):
    """R1 then J1 (reference order): the newest 200, minus checkpointed (key, version) pairs."""
    return ob.select_batch(dt.objects(spark, sf_dir), dt.checkpoints(spark, sf_dir), K)


@register("objects_unprocessed_first", sql=with_views("objects") + _NEWEST + f"""
, un AS (SELECT o.object_key, COALESCE(NULLIF(o.version_token, ''), 'no_etag') AS version_token, o.size,
                o.last_modified FROM objects o ANTI JOIN ck USING (object_key, version_token))
SELECT * FROM un ORDER BY COALESCE(last_modified, TIMESTAMP '1970-01-01') DESC, object_key ASC LIMIT {K}""")
def objects_unprocessed_first(spark, sf_dir):
    """J1 then R1 (option): skip processed objects before taking the newest 200."""
    return ob.select_batch(dt.objects(spark, sf_dir), dt.checkpoints(spark, sf_dir), K, skip_processed_first=True)


@register("quality_run_stats", sql=with_views("objects") + _NEWEST + """
SELECT CAST(count(*) AS BIGINT) AS listed,
       CAST(count(*) FILTER (WHERE ck.object_key IS NOT NULL) AS BIGINT) AS skipped,
       CAST(0 AS BIGINT) AS succeeded, CAST(0 AS BIGINT) AS failed,
       CAST(count(*) FILTER (WHERE ck.object_key IS NULL) AS BIGINT) AS pending,
       count(*) > 0 AND count(*) FILTER (WHERE ck.object_key IS NOT NULL) = count(*) AS all_skipped
FROM top t LEFT JOIN ck ON t.object_key = ck.object_key
  AND COALESCE(NULLIF(t.version_token, ''), 'no_etag') = ck.version_token""")
def quality_run_stats(spark, sf_dir):
    """Listed / skipped / succeeded / failed / pending for a run over the newest 200."""
    return qa.run_stats(ob.newest_first(dt.objects(spark, sf_dir), K), dt.checkpoints(spark, sf_dir))


@register("quality_run_outcome", sql=with_views("objects") + """
, o AS (SELECT version_token = 'F' AS done, size FROM objects)
SELECT CAST(count(*) AS BIGINT) AS listed, CAST(count(*) FILTER (WHERE done) AS BIGINT) AS skipped,
       CAST(count(*) FILTER (WHERE NOT done AND size % 11 <> 0 AND size % 7 <> 0) AS BIGINT) AS succeeded,
       CAST(count(*) FILTER (WHERE NOT done AND size % 11 <> 0 AND size % 7 = 0) AS BIGINT) AS failed,
       CAST(count(*) FILTER (WHERE NOT done AND size % 11 = 0) AS BIGINT) AS pending,
       bool_and(done) AS all_skipped
FROM o""")
def quality_run_outcome(spark, sf_dir):
    """G8 + J1 without a batch limit: a run over every object that is not checkpointed, some of which
    failed to parse (sizes divisible by 7) or were not reached (by 11)."""
    listed, done = dt.objects(spark, sf_dir), dt.checkpoints(spark, sf_dir)
    todo = ob.select_batch(listed, done, None)
    registry = todo.where(F.col("size") % 11 != 0).select(
        "object_key", "version_token", F.when(F.col("size") % 7 == 0, "error").otherwise("parsed").alias("parse_status"))
    return qa.run_stats(listed, done, registry)


_T0 = utc_of_local(f"{YEAR}-01-01 00:00:00")
_T1 = utc_of_local("2024-04-01 00:00:00")


@register("quality_flow_diagnostics", sql=with_views("readings") + f"""
, g AS (SELECT metric_key, unit AS u, device_address AS d, CAST(count(*) AS BIGINT) AS n FROM readings
        WHERE (physical_group = 'hydro_plant' OR source_system = 'hydro_plant')
          AND record_ts >= {_T0} AND record_ts < {_T1}
        GROUP BY metric_key, unit, device_address
        ORDER BY n DESC, metric_key, u NULLS FIRST, d NULLS FIRST LIMIT 40)
SELECT metric_key, COALESCE(u, '') AS unit, COALESCE(d, '') AS device_address, n FROM g""")
def quality_flow_diagnostics(spark, sf_dir):
    """Key, raw unit and raw device counts of the plant in the report window (top 40)."""
    t0, t1 = report_window(YEAR, END, TZ)
    return qa.flow_key_diagnostics(dt.readings(spark, sf_dir), t0, t1, stream="wyman")


_FILES = f"""
WITH ev AS (SELECT *, {_KEY_SQL} AS object_key FROM events),
f AS (SELECT object_key,
        CASE WHEN event_type = 'signup' THEN 2 ELSE 1 END AS n_records,
        CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 2 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 2
             ELSE CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END END AS n_tall,
        CASE event_type WHEN 'click' THEN 2 WHEN 'view' THEN 1 WHEN 'purchase' THEN 1 WHEN 'signup' THEN 1
             ELSE CASE WHEN event_id % 2 = 0 THEN 1 ELSE 0 END END AS n_kept,
        NOT (event_type = 'error' AND event_id % 2 = 1) AS has_data,
        CASE event_type WHEN 'click' THEN 'mb-006' WHEN 'view' THEN 'mb-003' WHEN 'purchase' THEN 'mb-008'
             WHEN 'signup' THEN 'mb-005' ELSE CASE WHEN event_id % 2 = 0 THEN 'mb-001' ELSE 'mb-002' END END
             AS device_address
      FROM ev)"""


@register("quality_file_diagnostics", sql=_FILES + """
SELECT object_key, device_address, has_data, CAST(n_records AS BIGINT) AS n_records,
       CAST(n_tall AS BIGINT) AS n_tall, CAST(n_tall AS BIGINT) AS n_tall_with_ts,
       has_data AND n_records > 0 AND n_tall = 0 AS no_readings, FALSE AS no_timestamps
FROM f""")
def quality_file_diagnostics(spark, sf_dir):
    """Q2 / Q3: per-file record and melted-reading counts with the two warning flags."""
    p = parsed(spark, sf_dir, stage=True)
    d = qa.file_diagnostics(p.layout, p.lines, p.candidates)
    return d.select("object_key", "device_address", "has_data", "n_records", "n_tall", "n_tall_with_ts",
                    "no_readings", "no_timestamps")


@register("quality_raw_vs_tall", sql=_FILES + """
SELECT object_key, CAST(n_records AS BIGINT) AS raw_rows, CAST(n_kept AS BIGINT) AS tall_rows
FROM f ORDER BY object_key LIMIT 50""")
def quality_raw_vs_tall(spark, sf_dir):
    """Raw vs stored reading counts of the latest 50 parsed files."""
    p = parsed(spark, sf_dir, stage=True)
    return qa.raw_vs_tall(p.registry, p.records, p.readings, 50).select("object_key", "raw_rows", "tall_rows")


@register("replay_flow_devices", sql=_FILES + """
SELECT CAST(sum(CASE WHEN device_address IN ('mb-003', 'mb-006', 'mb-008') THEN n_kept ELSE 0 END) AS BIGINT)
           AS tall_deleted,
       CAST(sum(CASE WHEN device_address IN ('mb-003', 'mb-006', 'mb-008') THEN n_records ELSE 0 END) AS BIGINT)
           AS raw_deleted,
       CAST(count(*) FILTER (WHERE device_address IN ('mb-003', 'mb-006', 'mb-008')) AS BIGINT)
           AS checkpoints_deleted
FROM f""")
def replay_flow_devices(spark, sf_dir):
    """K7: GPM readings, raw records and checkpoints removed for the flow-meter devices
    (every parsed file counts as checkpointed)."""
    p = parsed(spark, sf_dir, stage=True)
    ck = p.registry.select("object_key", "version_token")
    out = rp.replay_flow_devices(p.registry, p.records, p.readings, ck)
    return out["counts"]


@register("replay_booster_correction", sql=with_views("readings") + """
SELECT record_ts, serial, source_file_id, metric_key, device_address,
       CASE WHEN device_address = 'mb-003' AND (physical_group = 'hydro_plant'
                 OR (physical_group = 'unknown' AND source_system = 'hydro_plant')) THEN 'booster_pump'
            ELSE physical_group END AS physical_group,
       CASE WHEN device_address = 'mb-003' AND (physical_group = 'hydro_plant'
                 OR (physical_group = 'unknown' AND source_system = 'hydro_plant')) THEN 'booster_pump'
            ELSE source_system END AS source_system
FROM readings""")
def replay_booster_correction(spark, sf_dir):
    """K8: in-place group correction of mis-tagged booster rows (whole table)."""
    out = rp.correct_booster_group(dt.readings(spark, sf_dir))
    return out.select("record_ts", "serial", "source_file_id", "metric_key", "device_address", "physical_group",
                      "source_system")


# --- warnings of a run -------------------------------------------------------------------------

# Fixed value: header line of the rendered files.
_HEADER = "time(UTC),error,lowalarm,highalarm,F2 - Wyman Creek Flow Ave (Gpm),Hydro Plant Power Instantaneous (kW)"


def flawed_files(spark, sf_dir):
    """One file per event, by its number: whole, without a valid time, without a numeric value, of a
    device without data (with and without measurable headers), and a line without header or ``=``."""
    e = dt.table(spark, sf_dir, "events")
    kind = F.col("event_id") % 6
    time = F.when(kind == 1, F.lit("noon")).otherwise(F.date_format(F.col("ts").cast("timestamp"), "yyyy-MM-dd HH:mm:ss"))
    v = F.when(kind == 2, F.lit("offline")).otherwise(F.col("value").cast("string"))
    header = F.when(kind == 4, F.lit("time(UTC),error,lowalarm,highalarm,Signal")).otherwise(F.lit(_HEADER))
    text = F.when(kind == 5, F.concat(F.lit("started, "), F.col("event_id").cast("string"))).otherwise(
        F.concat(header, F.lit("\n"), F.concat_ws(",", time, F.lit("0"), F.lit("0"), F.lit("0"), v, F.when(kind != 4, F.lit("")))))
    code = F.when(kind.isin(3, 4), "002").otherwise("006")
    key = F.concat(F.lit("log-gz/SN1/logger_mb-"), code, F.lit("_"), F.col("event_id").cast("string"), F.lit(".log"))
    return e.select(key.alias("object_key"), F.lit("v").alias("version_token"), F.col("ts").cast("timestamp").alias("last_modified"), text.alias("text"))


def _flawed(spark, sf_dir):
    from sluice.operators.readings import parse_files
    from sluice.sources import config as C

    return parse_files(flawed_files(spark, sf_dir), C.default_labels(spark), C.default_schemas(spark), ingested_at="2024-02-01 00:00:00",
                       spread=spark.sparkContext.defaultParallelism * 2, stage=True)


_FLAWED_KEY = "'log-gz/SN1/logger_mb-' || CASE WHEN event_id % 6 IN (3, 4) THEN '002' ELSE '006' END || '_' || event_id || '.log'"


@register("quality_run_warnings", sql=f"""
WITH e AS (SELECT {_FLAWED_KEY} AS object_key, event_id % 6 AS kind FROM events)
SELECT object_key, 'readings but no timestamps' AS kind, 'rows=1 tall=1' AS detail FROM e WHERE kind = 1
UNION ALL SELECT object_key, 'records but no readings', 'rows=1 tall=0' FROM e WHERE kind IN (2, 5)
UNION ALL SELECT object_key, 'device marked without data, but measurable headers',
                 'F2 - Wyman Creek Flow Ave (Gpm) | Hydro Plant Power Instantaneous (kW)' FROM e WHERE kind = 3
UNION ALL SELECT object_key, 'no header line and no column order for its schema', 'hydro_flex_v1' FROM e WHERE kind = 5""")
def quality_run_warnings(spark, sf_dir):
    """Q1, Q2, Q3: what a run says of files whose device, values or times are amiss."""
    from sluice.plans.ingest import run_warnings

    return run_warnings(_flawed(spark, sf_dir)).select("object_key", "kind", "detail")


@register("quality_dry_run", sql=f"""
SELECT {_FLAWED_KEY} AS object_key, CAST(1 AS BIGINT) AS rows, CAST(CASE WHEN event_id % 6 IN (2, 5) THEN 0 ELSE 1 END AS BIGINT) AS tall FROM events""")
def quality_dry_run(spark, sf_dir):
    """Q7: records and melted readings of each file, before hasData, times and duplicates count."""
    p = _flawed(spark, sf_dir)
    return qa.dry_run(p.layout, p.records, p.melted).select("object_key", "rows", "tall")

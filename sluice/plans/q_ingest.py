"""Ingest queries (E1 core): every ``events`` row is rendered as one small device log file —
five layouts (CSV with named hydro streams, tab header after a junk line with comma or tab
rows and a repeated header, semicolon, CRLF with a repeated instant, loose key=value) — and
parsed back into registry, records and readings rows.

No grouping is needed to build the files: each file's text comes from one event row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.functions.dates import round_half_up as r
from sluice.operators.readings import parse_files
from sluice.plans.catalog import register
from sluice.plans.sqlparts import rnd
from sluice.sources import config as C
from sluice.sources import driver_tables as dt

# Headers of the rendered demo files.
H_CLICK = "time(UTC),error,lowalarm,highalarm,F2 - Wyman Creek Flow Ave (Gpm),F-1 Reservoir By-pass Ave (Gpm)"
H_VIEW = "time(UTC)\terror\tlowalarm\thighalarm\tBooster Pump Flow Ave (Gpm)\tBooster Pump Flow Ave (Gpm)"
H_PURCHASE = "time(UTC),error,lowalarm,highalarm,Deep Well Pump Output (Gpm)"
H_SIGNUP = "time(UTC),error,lowalarm,highalarm,Hydro Plant Power Instantaneous (kW)"


def event_files(spark, sf_dir):
    """(object_key, version_token, last_modified, text) — one rendered log file per event."""
    e = dt.table(spark, sf_dir, "events")
    et, eid = F.col("event_type"), F.col("event_id")
    ts = F.col("ts").cast("timestamp")
    iso_ms = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    quoted = F.concat(F.lit("'"), F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit("'"))
    short = F.date_format(ts, "yyyy-M-d H:mm:ss")
    epoch = F.unix_millis(ts).cast("string")
    iso_us = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    v = F.col("value").cast("string")
    low = F.when(F.col("value") < 1, "1").otherwise("0")
    high = F.when(F.col("value") > 300, "1").otherwise("0")
    code = (F.when(et == "click", "006").when(et == "view", "003").when(et == "purchase", "008")
            .when(et == "signup", "005").when(eid % 2 == 0, "001").otherwise("002"))
    key = F.concat(F.lit("log-gz/SN"), (F.col("user_id") % 5).cast("string"), F.lit("/"),
                   F.date_format(ts, "yyyy/MM/dd"), F.lit("/logger_mb-"), code, F.lit("_"),
                   eid.cast("string"), F.lit(".log.gz"))
    view_sep = F.when(eid % 2 == 0, F.lit(",")).otherwise(F.lit("\t"))
    text = (
        F.when(et == "click", F.concat_ws("\n", F.lit(H_CLICK), F.concat_ws(
            ",", iso_ms, F.lit("0"), low, high, v, (F.col("value") / 2).cast("string"))))
        .when(et == "view", F.concat_ws("\n", F.lit("# exported by data logger"), F.lit(H_VIEW), F.concat_ws(
            "", quoted, view_sep, F.lit("0"), view_sep, low, view_sep, high, view_sep, v, view_sep,
            (F.col("value") + 1).cast("string"))))
        .when(et == "purchase", F.concat_ws("\n", F.lit(H_PURCHASE),
                                            F.concat_ws(";", short, F.lit("0"), low, high, v)))
        .when(et == "signup", F.concat(F.lit(H_SIGNUP), F.lit("\r\n"),
                                       F.concat_ws(",", epoch, F.lit("0"), low, high, v), F.lit("\r\n"),
                                       F.concat_ws(",", epoch, F.lit("0"), low, high,
                                                   (F.col("value") * 2).cast("string")), F.lit("\n\n")))
        .otherwise(F.concat(F.lit("ts="), iso_us, F.lit(" kw="), v, F.lit(" status=ok")))
    )
    return e.select(key.alias("object_key"), F.concat(F.lit("e"), eid.cast("string")).alias("version_token"),
                    ts.alias("last_modified"), text.alias("text"))


def parsed(spark, sf_dir, carry=(), stage=False):
    return parse_files(event_files(spark, sf_dir), C.default_labels(spark), C.default_schemas(spark),
                       ingested_at="2024-02-01 00:00:00", spread=spark.sparkContext.defaultParallelism * 2, carry=carry, stage=stage)


_KEY_SQL = """'log-gz/SN' || CAST(user_id % 5 AS VARCHAR) || '/' || strftime(ts, '%Y/%m/%d') || '/logger_mb-'
    || CASE event_type WHEN 'click' THEN '006' WHEN 'view' THEN '003' WHEN 'purchase' THEN '008'
            WHEN 'signup' THEN '005' ELSE CASE WHEN event_id % 2 = 0 THEN '001' ELSE '002' END END
    || '_' || CAST(event_id AS VARCHAR) || '.log.gz'"""
_MS = "make_timestamp((epoch_us(ts) // 1000) * 1000)"
_SEC = "date_trunc('second', ts)"


@register("ingest_readings", sql=f"""
WITH ev AS (SELECT *, {_KEY_SQL} AS object_key, 'SN' || CAST(user_id % 5 AS VARCHAR) AS serial,
                   value < 1 AS lo, value > 300 AS hi FROM events),
r AS (
  SELECT object_key, serial, {_MS} AS record_ts, 'flow_wyman_avg' AS metric_key, value AS metric_value, 'Gpm' AS unit,
         'hydro_plant' AS source_system, lo AS low_alarm, hi AS high_alarm, 'mb-006' AS device_address,
         'hydro_plant' AS physical_group FROM ev WHERE event_type = 'click'
  UNION ALL
  SELECT object_key, serial, {_MS}, 'flow_bypass_avg', value / 2, 'Gpm', 'hydro_plant', lo, hi, 'mb-006', 'hydro_plant'
  FROM ev WHERE event_type = 'click'
  UNION ALL
  SELECT object_key, serial, {_SEC}, 'flow_avg_A', value, 'Gpm', 'booster_pump', lo, hi, 'mb-003', 'booster_pump'
  FROM ev WHERE event_type = 'view'
  UNION ALL
  SELECT object_key, serial, {_SEC}, 'flow', value, 'Gpm', 'deep_well', lo, hi, 'mb-008', 'deep_well'
  FROM ev WHERE event_type = 'purchase'
  UNION ALL
  SELECT object_key, serial, {_MS}, 'power_instantaneous', value, 'kW', 'hydro_plant', lo, hi, 'mb-005', 'hydro_plant'
  FROM ev WHERE event_type = 'signup'
  UNION ALL
  SELECT object_key, serial, ts, 'kw', value, NULL, 'unknown', FALSE, FALSE, 'mb-001', 'electrical_grid'
  FROM ev WHERE event_type = 'error' AND event_id % 2 = 0)
SELECT object_key, serial, record_ts, metric_key, {rnd('metric_value')} AS metric_value, unit, source_system,
       FALSE AS error_flag, low_alarm, high_alarm, device_address, physical_group
FROM r""")
def ingest_readings(spark, sf_dir):
    """F1/F2 melt + S1/S2/S4/S13 + P1-P11 + J2/F4 (hasData) + W3 first-wins: parsed readings."""
    p = parsed(spark, sf_dir, carry=["object_key"])
    return p.readings.select(
        "object_key", "serial", "record_ts", "metric_key", r("metric_value", 4).alias("metric_value"), "unit",
        "source_system", "error_flag", "low_alarm", "high_alarm", "device_address", "physical_group")


_V = "CAST(value AS VARCHAR)"
_FLAGS = "';error=0;lowalarm=' || (value < 1)::INT || ';highalarm=' || (value > 300)::INT || ';'"


@register("ingest_records", sql=f"""
WITH ev AS (SELECT *, {_KEY_SQL} AS object_key FROM events)
SELECT object_key, CAST(2 AS INTEGER) AS line_no, {_MS} AS record_ts, CAST(6 AS INTEGER) AS n_fields,
       'time(UTC)=' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') || {_FLAGS} || 'F2 - Wyman Creek Flow Ave (Gpm)=' || {_V}
       || ';F-1 Reservoir By-pass Ave (Gpm)=' || (value / 2) AS fields
FROM ev WHERE event_type = 'click'
UNION ALL SELECT object_key, 3, {_SEC}, 6, 'time(UTC)=''' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '''' || {_FLAGS} || 'Booster Pump Flow Ave (Gpm)=' || {_V}
       || ';Booster Pump Flow Ave (Gpm)__5=' || (value + 1) FROM ev WHERE event_type = 'view'
UNION ALL SELECT object_key, 2, {_SEC}, 5, 'time(UTC)=' || strftime(ts, '%Y-%-m-%-d %-H:%M:%S') || {_FLAGS} || 'Deep Well Pump Output (Gpm)=' || {_V}
FROM ev WHERE event_type = 'purchase'
UNION ALL SELECT object_key, 2, {_MS}, 5, 'time(UTC)=' || (epoch_us(ts) // 1000) || {_FLAGS} || 'Hydro Plant Power Instantaneous (kW)=' || {_V}
FROM ev WHERE event_type = 'signup'
UNION ALL SELECT object_key, 3, {_MS}, 5, 'time(UTC)=' || (epoch_us(ts) // 1000) || {_FLAGS} || 'Hydro Plant Power Instantaneous (kW)=' || (value * 2)
FROM ev WHERE event_type = 'signup'
UNION ALL SELECT object_key, 1, ts, 3, 'ts=' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || ';kw=' || {_V} || ';status=ok' FROM ev WHERE event_type = 'error'""")
def ingest_records(spark, sf_dir):
    """K2 rows: one record per data line (line numbers over non-blank lines, header counted) and all its values."""
    p = parsed(spark, sf_dir, carry=["object_key"])
    values = F.array_join(F.transform(F.map_entries("parsed"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return p.records.select(
        "object_key", "line_no", "record_ts", F.size("parsed").cast("int").alias("n_fields"), values.alias("fields"))


@register("ingest_registry", sql=f"""
SELECT {_KEY_SQL} AS object_key, 'e' || CAST(event_id AS VARCHAR) AS version_token,
       'SN' || CAST(user_id % 5 AS VARCHAR) AS serial, 'parsed' AS parse_status,
       CASE event_type WHEN 'click' THEN 'mb-006' WHEN 'view' THEN 'mb-003' WHEN 'purchase' THEN 'mb-008'
            WHEN 'signup' THEN 'mb-005' ELSE CASE WHEN event_id % 2 = 0 THEN 'mb-001' ELSE 'mb-002' END END
            AS device_address,
       CASE event_type WHEN 'click' THEN 'hydro_plant' WHEN 'view' THEN 'booster_pump' WHEN 'purchase' THEN 'deep_well'
            WHEN 'signup' THEN 'solar_field' ELSE CASE WHEN event_id % 2 = 0 THEN 'electrical_grid'
            ELSE 'modhopper_status' END END AS physical_group,
       CASE event_type WHEN 'click' THEN 'hydro_flex_v1' WHEN 'view' THEN 'booster_flex_v1'
            WHEN 'purchase' THEN 'deep_well_flex_v1' WHEN 'signup' THEN 'solar_hydro_pulse_v1'
            ELSE CASE WHEN event_id % 2 = 0 THEN 'power_pulse_v1' ELSE 'status_only_v1' END END AS schema_id
FROM events""")
def ingest_registry(spark, sf_dir):
    """K1 rows: file registry with label device, group and schema."""
    return parsed(spark, sf_dir).registry.select(
        "object_key", "version_token", "serial", "parse_status", "device_address", "physical_group", "schema_id")


# --- loose lines over whole free texts -----------------------------------------------------

def document_files(spark, sf_dir):
    """Every ``documents`` text as one headerless log file (no time column → loose lines)."""
    d = dt.table(spark, sf_dir, "documents")
    key = F.concat(F.lit("docs/"), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".log"))
    return d.select(key.alias("object_key"), F.lit("d").alias("version_token"),
                    F.lit(None).cast("timestamp").alias("last_modified"), F.col("text"))


# Whitespace class of the JavaScript regex \s / trim, in RE2 syntax for the oracle.
_WS = r"\t\n\x0B\f\r \x{00a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}"


@register("loose_documents", sql=f"""
WITH d AS (SELECT 'docs/' || lang || '/' || CAST(doc_id AS VARCHAR) || '.log' AS object_key,
                  regexp_replace(text, '^\\x{{feff}}', '') AS t FROM documents),
s AS (SELECT object_key, string_split_regex(t, '\\r?\\n') AS arr FROM d),
u AS (SELECT object_key, UNNEST(arr) AS line, UNNEST(range(1, len(arr) + 1)) AS idx FROM s),
k AS (SELECT object_key, line, row_number() OVER (PARTITION BY object_key ORDER BY idx) AS line_no
      FROM u WHERE regexp_matches(line, '[^{_WS}]')),
p AS (SELECT object_key, line, line_no,
             list_filter(list_transform(string_split_regex(line, '[,{_WS}]+'),
                                        lambda x: regexp_replace(x, '^[{_WS}]+|[{_WS}]+$', '', 'g')),
                         lambda x: x <> '' AND contains(x, '=')) AS pieces FROM k)
SELECT object_key, CAST(line_no AS INTEGER) AS line_no,
       CAST(CASE WHEN len(pieces) > 0
                 THEN len(list_distinct(list_filter(list_transform(pieces,
                          lambda x: regexp_replace(split_part(x, '=', 1), '^[{_WS}]+|[{_WS}]+$', '', 'g')),
                          lambda x: x <> '')))
                 ELSE len(string_split(line, ',')) END AS INTEGER) AS n_fields,
       len(pieces) > 0 AS key_value
FROM p""")
def loose_documents(spark, sf_dir):
    """R4/R5/P10/P11 over whole free texts: every non-blank line of every document becomes a
    record; ``key=value`` lines give one field per distinct key, other lines one per comma
    piece."""
    p = parse_files(document_files(spark, sf_dir), C.default_labels(spark), C.default_schemas(spark),
                    ingested_at="2024-02-01 00:00:00", spread=spark.sparkContext.defaultParallelism * 2)
    keys = p.registry.select("file_id", "object_key")
    kv = F.exists(F.map_keys("parsed"), lambda k: ~k.rlike(r"^col_\d+$"))
    return p.records.join(keys, "file_id").select(
        "object_key", "line_no", F.size("parsed").cast("int").alias("n_fields"),
        (kv | (F.size("parsed") == 0)).alias("key_value"))


# --- headerless files: line items of an order as the data rows of one device file ----------------

# Fixed value: the column order of the rendered headerless files.
HEADERLESS_ORDER = ["time(UTC)", "error", "lowalarm", "highalarm", "F2 - Wyman Creek Flow Ave (Gpm)", "Hydro Plant Power Instantaneous (kW)"]

_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag", "l_discount"]


def order_files(spark, sf_dir):
    """One file per order without a header line, a row per line item.  Times come plain, past
    midnight (hour 24) and with a zone; rows come whole, one cell short and one cell long."""
    li = dt.table(spark, sf_dir, "lineitem")
    day, n = F.col("l_shipdate").cast("timestamp"), F.col("l_linenumber").cast("int")
    minute = F.lpad(n.cast("string"), 2, "0")
    time = (F.when(n % 3 == 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T12:"), minute, F.lit(":00+01:00")))
            .when(n % 3 == 1, F.concat(F.date_format(day, "yyyy-M-d"), F.lit(" 24:"), minute, F.lit(":00")))
            .otherwise(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(" 08:"), minute, F.lit(":00"))))
    flag = F.col("l_returnflag")
    cells = F.concat(
        F.array(time, F.when(F.col("l_discount") > 0.05, "1").otherwise("0"), F.lit("0x0"),
                F.when(flag == "N", "1d").otherwise("0x10"), F.col("l_quantity").cast("string")),
        F.when(flag != "R", F.array(F.col("l_extendedprice").cast("string"))).otherwise(F.array()),
        F.when(flag == "A", F.array(F.lit("99"))).otherwise(F.array()))
    rows = li.select("l_orderkey", F.struct(*_LINE_ORDER, F.array_join(cells, "\t").alias("line")).alias("row"))
    # An order has a handful of line items: its file is bounded.
    text = F.array_join(F.transform(F.array_sort(F.collect_list("row")), lambda x: x["line"]), "\n")
    # Parsing follows in the same tasks: with an explicit count AQE does not merge them by their few bytes.
    parts = max(spark.sparkContext.defaultParallelism * 2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    files = rows.repartition(parts, "l_orderkey").groupBy("l_orderkey").agg(text.alias("text"))
    key = F.concat(F.lit("log-gz/SN"), (F.col("l_orderkey") % 5).cast("string"), F.lit("/logger_mb-006_"),
                   F.col("l_orderkey").cast("string"), F.lit(".log.gz"))
    return files.select(key.alias("object_key"), F.lit("v1").alias("version_token"),
                        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("last_modified"), "text")


@register("ingest_headerless", sql="""
WITH l AS (SELECT *, CAST(l_shipdate AS TIMESTAMP) + to_minutes(CAST(l_linenumber AS BIGINT)) + CASE l_linenumber % 3
                         WHEN 0 THEN INTERVAL 11 HOUR WHEN 1 THEN INTERVAL 24 HOUR ELSE INTERVAL 8 HOUR END AS record_ts,
                  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                     l_extendedprice, l_shipdate, l_returnflag, l_discount) AS n
           FROM lineitem),
m AS (SELECT l_orderkey, n, record_ts, 'flow_wyman_avg' AS metric_key, l_quantity AS metric_value, 'Gpm' AS unit,
             l_discount > 0.05 AS error_flag, l_returnflag <> 'N' AS high_alarm FROM l
      UNION ALL
      SELECT l_orderkey, n, record_ts, 'power_instantaneous', l_extendedprice, 'kW', l_discount > 0.05, l_returnflag <> 'N'
      FROM l WHERE l_returnflag <> 'R'),
f AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, record_ts, metric_key ORDER BY n) AS k FROM m)
SELECT l_orderkey AS file_key, record_ts, metric_key, metric_value, unit, error_flag, FALSE AS low_alarm, high_alarm
FROM f WHERE k = 1""")
def ingest_headerless(spark, sf_dir):
    """Files without a header line, parsed by their schema's column order."""
    labels = C.default_labels(spark)
    schema = labels.where("code = '006'").first().schema_id
    p = parse_files(order_files(spark, sf_dir), labels, C.default_schemas(spark, {schema: HEADERLESS_ORDER}),
                    ingested_at="2024-02-01 00:00:00", carry=["object_key"])
    return p.readings.select(
        F.regexp_extract("object_key", r"_(\d+)\.log", 1).cast("long").alias("file_key"), "record_ts", "metric_key", "metric_value", "unit", "error_flag", "low_alarm", "high_alarm")

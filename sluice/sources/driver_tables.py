"""Views over the driver's parquet tables.

The driver ships TPC-H-like tables plus an ``events`` stream.  These functions re-shape
them into the domain tables the operators work on, as plain projections that Catalyst
folds into the scan (column pruning and filter pushdown still reach the parquet reader).

* ``readings``   ← events       (tall measurement table)
* ``objects``    ← orders       (object-store manifest) and ``checkpoints`` (processed set)
* ``schedule``   ← orders ⋈ customer (water-sampling schedule)
* ``wide_rows``  ← lineitem     (wide device rows with header-named columns)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions.dates import as_instant

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed mapping of event types onto the readings vocabulary (demo data only).
EVENT_METRIC = {
    "click": "flow_wyman_avg",
    "view": "flow_avg_A",
    "purchase": "flow_avg",
    "signup": "power_instantaneous",
    "error": "power_instantaneous_A",
}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tall readings (schema of the readings table) derived from ``events``."""
    e = table(spark, sf_dir, "events")
    et = F.col("event_type")
    uid = F.col("user_id")
    metric = F.when(et == "click", "flow_wyman_avg").when(et == "view", "flow_avg_A") \
        .when(et == "purchase", "flow_avg").when(et == "signup", "power_instantaneous") \
        .otherwise("power_instantaneous_A")
    source = F.when(et == "click", "hydro_plant").when(et == "view", "booster_pump") \
        .when(et == "purchase", F.when(uid % 4 == 0, "hydro_plant").otherwise("booster_pump")) \
        .when(et == "signup", "hydro_plant").otherwise("solar_field")
    group = F.when(et == "click", "hydro_plant").when(et == "view", "booster_pump") \
        .when(et == "purchase", F.when(uid % 4 == 0, "hydro_plant").otherwise("booster_pump")) \
        .when(et == "signup", F.when(uid % 2 == 0, "hydro_plant").otherwise("electrical_grid")) \
        .otherwise("solar_field")
    return e.select(
        F.concat(F.lit("SN"), (uid % 5).cast("string")).alias("serial"),
        as_instant("ts").alias("record_ts"),
        metric.alias("metric_key"),
        F.col("value").alias("metric_value"),
        F.when(et.isin("click", "view", "purchase"), "Gpm").otherwise("kW").alias("unit"),
        F.lit(None).cast("string").alias("quality"),
        (F.col("event_id") % 50).alias("source_file_id"),
        source.alias("source_system"),
        F.lit(False).alias("error_flag"),
        (F.col("value") < 1).alias("low_alarm"),
        (F.col("value") > 300).alias("high_alarm"),
        F.concat(F.lit("mb-00"), (uid % 9 + 1).cast("string")).alias("device_address"),
        group.alias("physical_group"),
    )


READINGS_SQL = """
SELECT 'SN' || CAST(user_id % 5 AS VARCHAR) AS serial,
       CAST(ts AS TIMESTAMP) AS record_ts,
       CASE event_type WHEN 'click' THEN 'flow_wyman_avg' WHEN 'view' THEN 'flow_avg_A'
            WHEN 'purchase' THEN 'flow_avg' WHEN 'signup' THEN 'power_instantaneous'
            ELSE 'power_instantaneous_A' END AS metric_key,
       value AS metric_value,
       CASE WHEN event_type IN ('click','view','purchase') THEN 'Gpm' ELSE 'kW' END AS unit,
       CAST(NULL AS VARCHAR) AS quality,
       event_id % 50 AS source_file_id,
       CASE event_type WHEN 'click' THEN 'hydro_plant' WHEN 'view' THEN 'booster_pump'
            WHEN 'purchase' THEN CASE WHEN user_id % 4 = 0 THEN 'hydro_plant' ELSE 'booster_pump' END
            WHEN 'signup' THEN 'hydro_plant' ELSE 'solar_field' END AS source_system,
       FALSE AS error_flag,
       value < 1 AS low_alarm,
       value > 300 AS high_alarm,
       'mb-00' || CAST(user_id % 9 + 1 AS VARCHAR) AS device_address,
       CASE event_type WHEN 'click' THEN 'hydro_plant' WHEN 'view' THEN 'booster_pump'
            WHEN 'purchase' THEN CASE WHEN user_id % 4 = 0 THEN 'hydro_plant' ELSE 'booster_pump' END
            WHEN 'signup' THEN CASE WHEN user_id % 2 = 0 THEN 'hydro_plant' ELSE 'electrical_grid' END
            ELSE 'solar_field' END AS physical_group
FROM events
"""


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-store manifest (key, version token, size, last modified) derived from ``orders``."""
    o = table(spark, sf_dir, "orders")
    day = F.date_format(F.col("o_orderdate"), "yyyy/MM/dd")
    key = F.concat(F.lit("log-gz/SN"), (F.col("o_custkey") % 5).cast("string"), F.lit("/"), day,
                   F.lit("/logger_mb-00"), (F.col("o_orderkey") % 9 + 1).cast("string"), F.lit("_"),
                   F.col("o_orderkey").cast("string"), F.lit(".log.gz"))
    return o.select(
        key.alias("object_key"),
        F.col("o_orderstatus").alias("version_token"),
        F.floor("o_totalprice").cast("long").alias("size"),
        as_instant("o_orderdate").alias("last_modified"),
    )


OBJECTS_SQL = """
SELECT 'log-gz/SN' || CAST(o_custkey % 5 AS VARCHAR) || '/' || strftime(o_orderdate, '%Y/%m/%d')
       || '/logger_mb-00' || CAST(o_orderkey % 9 + 1 AS VARCHAR) || '_' || CAST(o_orderkey AS VARCHAR)
       || '.log.gz' AS object_key,
       o_orderstatus AS version_token,
       CAST(floor(o_totalprice) AS BIGINT) AS size,
       CAST(o_orderdate AS TIMESTAMP) AS last_modified
FROM orders
"""


def checkpoints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processed set: finished orders count as already-ingested objects."""
    return objects(spark, sf_dir).where(F.col("version_token") == "F") \
        .select("object_key", "version_token")


def schedule(spark: SparkSession, sf_dir: str, with_key: bool = False) -> DataFrame:
    """Water-sampling schedule rows derived from ``orders ⋈ customer``."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    j = o.join(c, o.o_custkey == c.c_custkey)
    last = F.to_date(F.col("o_orderdate"))
    freq = ((F.col("o_orderkey") % 4 + 1) * 12).cast("int")
    due = F.last_day(F.add_months(last, freq))
    status = F.col("o_orderstatus")
    return j.select(
        F.concat(F.lit("PS"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("ps_code"),
        F.when(F.col("o_orderpriority").startswith("1-"), "LEAD_COPPER")
        .when(F.col("o_orderpriority").startswith("4-"), F.lit(" "))
        .otherwise(F.col("o_orderpriority")).alias("group_name"),
        (F.col("o_orderkey") % 100).cast("string").alias("analyte_number"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None)).otherwise(F.col("c_mktsegment"))
        .alias("analyte_name"),
        last.alias("last_sampled"),
        freq.alias("frequency_months"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit(None).cast("date")).otherwise(due).alias("next_due_date"),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("none"))
        .otherwise(F.date_format(due, "yyyy/M")).alias("next_due_raw"),
        F.when(status == "P", "DUE NOW").when((status == "O") & (F.col("o_orderkey") % 5 == 0), 'past due, "call" lab')
        .when(status == "O", F.lit(None)).otherwise(F.lit("routine")).alias("notes"),
        F.when(F.col("c_custkey") % 3 == 0, "active_well_2024.csv")
        .when(F.col("c_custkey") % 3 == 1, "Standby_Well_2024.csv")
        .otherwise("schedule_export.csv").alias("source_file"),
        as_instant("o_orderdate").alias("imported_at"),
        *([F.col("o_orderkey").alias("row_key")] if with_key else []),
    )


SCHEDULE_SQL = """
SELECT 'PS' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS ps_code,
       CASE WHEN starts_with(o_orderpriority, '1-') THEN 'LEAD_COPPER'
            WHEN starts_with(o_orderpriority, '4-') THEN ' '
            ELSE o_orderpriority END AS group_name,
       CAST(o_orderkey % 100 AS VARCHAR) AS analyte_number,
       CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN NULL ELSE c_mktsegment END AS analyte_name,
       CAST(o_orderdate AS DATE) AS last_sampled,
       CAST((o_orderkey % 4 + 1) * 12 AS INTEGER) AS frequency_months,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL
            ELSE last_day(CAST(o_orderdate AS DATE) + to_months(CAST((o_orderkey % 4 + 1) * 12 AS INTEGER))) END
            AS next_due_date,
       CASE WHEN o_orderkey % 7 = 0 THEN 'none'
            ELSE strftime(last_day(CAST(o_orderdate AS DATE) + to_months(CAST((o_orderkey % 4 + 1) * 12 AS INTEGER))), '%Y/')
                 || CAST(month(CAST(o_orderdate AS DATE) + to_months(CAST((o_orderkey % 4 + 1) * 12 AS INTEGER))) AS VARCHAR)
       END AS next_due_raw,
       CASE WHEN o_orderstatus = 'P' THEN 'DUE NOW'
            WHEN o_orderstatus = 'O' AND o_orderkey % 5 = 0 THEN 'past due, "call" lab'
            WHEN o_orderstatus = 'O' THEN NULL ELSE 'routine' END AS notes,
       CASE WHEN c_custkey % 3 = 0 THEN 'active_well_2024.csv'
            WHEN c_custkey % 3 = 1 THEN 'Standby_Well_2024.csv'
            ELSE 'schedule_export.csv' END AS source_file,
       CAST(o_orderdate AS TIMESTAMP) AS imported_at
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def wide_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide device rows: one row per line item, measured columns named like device headers."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit("SN"), (F.col("l_suppkey") % 5).cast("string")).alias("serial"),
        F.col("l_orderkey").alias("source_file_id"),
        F.col("l_linenumber").alias("line_no"),
        as_instant("l_shipdate").alias("record_ts"),
        F.col("l_quantity").alias("Pulse #1"),
        F.col("l_extendedprice").alias("Power Sum (kW)"),
        F.col("l_discount").alias("Booster Pump Flow Rate Ave (Gpm)"),
        F.col("l_tax").alias("Creek Pressure (psi)"),
    )

"""Queries over large device files (R3, R5, R6): line items as gzip objects of many thousand lines, read
as blocks and parsed block by block.

A file holds the line items of 4096 order numbers, which bounds it: a junk line, a quoted CSV header,
a row per line item with quoted cells, CRLF line ends and blank lines in between.
"""

from __future__ import annotations

import gzip
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from sluice.operators.readings import parse_files
from sluice.plans.catalog import register
from sluice.sources import config as C
from sluice.sources import driver_tables as dt
from sluice.sources.blocks import line_blocks

ORDERS_A_FILE = 4096
# Small enough that these files have many blocks.
BLOCK_BYTES = 64 << 10
FILES_A_PART = 16

# The first two lines of the rendered files and their column names.
JUNK = "# exported by data logger"
COLUMNS = ["time(UTC)", "error", "lowalarm", "highalarm", "F2 - Wyman Creek Flow Ave (Gpm)", "Hydro Plant Power Instantaneous (kW)"]
OFFLINE = "n/a, offline"

_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate", "l_returnflag", "l_discount", "l_linestatus"]


def _zipped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text as a gzip of two members, one at a time: a batch of texts may be large."""
    for b in batches:
        for k in range(b.num_rows):
            t = b.column("text")[k].as_py().encode()
            zipped = gzip.compress(t[:len(t) // 2], 1) + gzip.compress(t[len(t) // 2:], 1)
            keep = [b.column(c).slice(k, 1) for c in ("object_key", "version_token", "last_modified")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array([zipped], pa.binary())], names=["object_key", "version_token", "last_modified", "content"])


def large_objects(spark, sf_dir):
    """(object_key, version_token, last_modified, content): gzip objects of thousands of lines."""
    li = dt.table(spark, sf_dir, "lineitem")
    at = F.col("l_shipdate").cast("timestamp") + F.make_dt_interval(F.lit(0), (F.col("l_orderkey") % 24).cast("int"), F.col("l_linenumber").cast("int"))
    cells = F.concat_ws(
        ",", F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.when(F.col("l_discount") > 0.05, "1").otherwise("0"), F.lit("0"),
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0"), F.col("l_quantity").cast("string"),
        F.when(F.col("l_returnflag") == "N", F.lit(f'"{OFFLINE}"')).otherwise(F.concat(F.lit('"'), F.col("l_extendedprice").cast("string"), F.lit('"'))))
    end = F.when(F.col("l_orderkey") % 2 == 0, F.lit("\r\n")).otherwise(F.lit("\n"))
    line = F.concat(cells, end, F.when(F.col("l_linestatus") == "F", F.lit(" \t\n")).otherwise(F.lit("")))
    rows = li.select(F.floor(F.col("l_orderkey") / ORDERS_A_FILE).alias("file"), F.struct(*_ORDER, line.alias("line")).alias("row"))
    head = JUNK + "\n" + ",".join(f'"{c}"' for c in COLUMNS) + "\r\n"
    text = F.concat(F.lit(head), F.array_join(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["line"]), ""))
    # As many parts as hold FILES_A_PART files each: a worker is handed the texts of a part at once.
    parts = max(spark.sparkContext.defaultParallelism * 2, rows.select("file").distinct().count() // FILES_A_PART + 1)
    files = rows.repartition(parts, "file").groupBy("file").agg(text.alias("text"))
    key = F.concat(F.lit("log-gz/SN1/logger_mb-006_"), F.col("file").cast("string"), F.lit(".log.gz"))
    return files.select(key.alias("object_key"), F.lit("v1").alias("version_token"), F.lit("2024-02-01 00:00:00").cast("timestamp").alias("last_modified"),
                        "text").mapInArrow(_zipped, "object_key string, version_token string, last_modified timestamp, content binary")


def parsed_blocks(spark, sf_dir):
    blocks = line_blocks(large_objects(spark, sf_dir), BLOCK_BYTES)
    return parse_files(blocks, C.default_labels(spark), C.default_schemas(spark), ingested_at="2024-02-01 00:00:00", carry=["object_key"], stage=True)


def _file_key():
    return F.regexp_extract("object_key", r"_(\d+)\.log", 1).cast("long").alias("file_key")


_LINES = f"""
WITH l AS (SELECT l_orderkey // {ORDERS_A_FILE} AS file_key,
                  CAST(l_shipdate AS TIMESTAMP) + to_hours(l_orderkey % 24) + to_minutes(CAST(l_linenumber AS BIGINT)) AS record_ts,
                  row_number() OVER (PARTITION BY l_orderkey // {ORDERS_A_FILE} ORDER BY {', '.join(_ORDER)}) + 2 AS line_no,
                  l_discount > 0.05 AS error_flag, l_returnflag = 'R' AS high_alarm, l_returnflag = 'N' AS offline, l_quantity, l_extendedprice
           FROM lineitem)"""


@register("ingest_blocks", sql=_LINES + """,
m AS (SELECT file_key, line_no, record_ts, 'flow_wyman_avg' AS metric_key, l_quantity AS metric_value, 'Gpm' AS unit, error_flag, high_alarm FROM l
      UNION ALL
      SELECT file_key, line_no, record_ts, 'power_instantaneous', l_extendedprice, 'kW', error_flag, high_alarm FROM l WHERE NOT offline),
f AS (SELECT *, row_number() OVER (PARTITION BY file_key, record_ts, metric_key ORDER BY line_no) AS k FROM m)
SELECT file_key, record_ts, metric_key, metric_value, unit, error_flag, FALSE AS low_alarm, high_alarm FROM f WHERE k = 1""")
def ingest_blocks(spark, sf_dir):
    """R3, R5, F1, W3 over gzip objects of thousands of lines in blocks: their readings."""
    return parsed_blocks(spark, sf_dir).readings.select(
        _file_key(), "record_ts", "metric_key", "metric_value", "unit", "error_flag", "low_alarm", "high_alarm")


@register("ingest_block_records", sql=_LINES + """
SELECT file_key, CAST(line_no AS INTEGER) AS line_no, record_ts,
       'time(UTC)=' || strftime(record_ts, '%Y-%m-%d %H:%M:%S') || ';error=' || error_flag::INT || ';lowalarm=0;highalarm=' || high_alarm::INT
       || ';F2 - Wyman Creek Flow Ave (Gpm)=' || l_quantity || ';Hydro Plant Power Instantaneous (kW)='
       || CASE WHEN offline THEN 'n/a, offline' ELSE CAST(l_extendedprice AS VARCHAR) END AS fields
FROM l""")
def ingest_block_records(spark, sf_dir):
    """R6, K2, P1, P5, P8 over the same objects: every record with its line number and all values."""
    values = F.array_join(F.transform(F.map_entries("parsed"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
    return parsed_blocks(spark, sf_dir).records.select(_file_key(), "line_no", "record_ts", values.alias("fields"))

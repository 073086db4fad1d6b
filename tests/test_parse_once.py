"""Queries that read several results of a parse read their files once; the parse does no work per file or
line that a schema or a file settles."""

import datetime as dt

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from sluice.functions import metrics as M
from sluice.operators import structure as S
from sluice.plans import q_blocks, q_ingest
from sluice.sources import config as C

HEADERS = ["time(UTC)", "error", "Well Flow Ave Rate (gallons per minute)", "Well Ave", "Pump Minimal", "-", 'Averages "x" (kW)', "Flow Rated (Gpm)"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("tables"))
    at = dt.datetime(2024, 1, 2, 3, 4, 5)
    kinds = ["click", "view", "purchase", "signup", "error", "error"]
    spark.createDataFrame([(i, at, i % 3, kinds[i % 6], i + 0.5, "{}") for i in range(12)],
                          "event_id long, ts timestamp, user_id long, event_type string, value double, props string").write.parquet(f"{root}/events.parquet")
    spark.createDataFrame([(i // 3, 1, 1, i % 3, 5.0, 10.0 + i, 0.01, dt.date(2024, 1, 2), "NRA"[i % 3], "FO"[i % 2]) for i in range(12)],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
                          "l_shipdate date, l_returnflag string, l_linestatus string").write.parquet(f"{root}/lineitem.parquet")
    return root


@pytest.mark.parametrize("name", ["quality_run_warnings", "quality_raw_vs_tall", "replay_flow_devices", "quality_file_diagnostics",
                                  "ingest_blocks", "ingest_block_records"])
def test_source_is_read_once(spark, tables, name):
    files = E.queries()[name](spark, tables).inputFiles()
    assert files and not any("events.parquet" in f or "lineitem.parquet" in f for f in files)


def test_specs_of_a_column_order_are_its_schemas(spark):
    schemas = S.order_specs(C.default_schemas(spark, {"s": HEADERS}))
    got = schemas.where("schema_id = 's'").select("order_specs").first()[0]
    want = spark.range(1).select(M.column_specs(F.array(*map(F.lit, HEADERS)))).first()[0]
    assert got == want and [x and (x.metric, x.unit) for x in got] == [
        None, None, ("flow_avg_rate_A", "gallons /min"), ("avg_A", None), ("value", None), None, ("power", "kW"), ("flow", "Gpm")]


def test_a_file_is_zipped_at_a_time():
    names = ["object_key", "version_token", "last_modified", "text"]
    batch = pa.RecordBatch.from_arrays([pa.array(["a", "b"]), pa.array(["v", "v"]), pa.array([None, None], pa.timestamp("us", "UTC")), pa.array(["x" * 9, "y"])], names=names)
    assert [(b.num_rows, b.column("object_key").to_pylist()) for b in q_blocks._zipped(iter([batch]))] == [(1, ["a"]), (1, ["b"])]


def test_parts_of_built_files(spark, tables):
    least = spark.sparkContext.defaultParallelism * 2
    assert q_ingest.order_files(spark, tables).rdd.getNumPartitions() >= least
    assert q_blocks.large_objects(spark, tables).rdd.getNumPartitions() >= least

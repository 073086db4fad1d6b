"""Maintained summaries: equal to what all readings give, after batches, retries and corrections."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice import schemas as SC
from sluice.operators import alerts as al
from sluice.operators.dashboards import bucket_avg, latest
from sluice.operators.summary import SERIES, partials
from sluice.plans.alerts_job import run_alerts
from sluice.sinks.tables import IngestTables, correct_booster, rebuild_summary, replay_devices, reset, with_dt, write_batch

T0 = dt.datetime(2026, 3, 1)


def _batch(spark, seed, n=400, file=1):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        g = r.choice(["hydro_plant", "solar_field", "booster_pump", None])
        rows.append((f"S{k % 3}", T0 + dt.timedelta(minutes=r.randint(0, 6000), seconds=r.randint(0, 59)),
                     r.choice(["power_instantaneous", "power_instantaneous_A", "flow_avg"]), r.choice([None, round(r.random() * 9, 2)]), r.choice(["kW", "Gpm", None]), None,
                     file, r.choice(["hydro_plant", "unknown"]), False, r.random() < 0.02, False, r.choice(["mb-003", "mb-005"]), g))
    return spark.createDataFrame(rows, SC.READINGS).dropDuplicates(["serial", "record_ts", "metric_key", "source_file_id"])


def _registry(spark, file):
    key = f"log-gz/S/{file}_mb-003.log.gz"
    return spark.createDataFrame([(file, key, "v", "S", T0, None, "x", "parsed", None, "mb-003", "booster_pump", None, T0)], SC.REGISTRY)


def _records(spark, file):
    return spark.createDataFrame([(file, 1, "x", {"a": "b"}, "003", "L", T0)], SC.RECORDS)


def _merged(df):
    return {tuple(r[:5]): (r.n, r.v, round(r.s or 0, 6), r.t) for r in df.groupBy("span", *SERIES).agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("v"), F.sum("total").alias("s"), F.max("last_ts").alias("t")).collect()}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    t = IngestTables(spark, str(tmp_path_factory.mktemp("summary")))
    for file in (1, 2, 3):
        write_batch(t, _registry(spark, file), _records(spark, file), _batch(spark, file, file=file), "r", T0)
    return t


def test_batches_add_up_and_a_retry_does_not_count_twice(spark, tables):
    t = tables
    want = _merged(partials(t.readings_df()))
    assert _merged(t.summary.read()) == want and t.summary.read().count() > len(want)
    t.checkpoint.replace(t.checkpoint.read().limit(0))
    write_batch(t, _registry(spark, 3), _records(spark, 3), _batch(spark, 3, file=3), "r2", T0)
    assert _merged(t.summary.read()) == want == _merged(partials(t.readings_df()))
    rebuild_summary(t)
    assert _merged(t.summary.read()) == want and t.summary.read().count() == len(want)


def test_latest_readings_and_alerts_equal_the_full_scan(spark, tables):
    t = tables
    for cond in (F.col("unit") == "kW", F.col("physical_group") == "hydro_plant", F.col("metric_key").like("power%") & (F.col("source_system") == "hydro_plant")):
        assert latest(t.latest_df().where(cond)).collect() == latest(t.readings_df().where(cond)).collect()
    for hours in (90, 100, 101, 130):
        now = T0 + dt.timedelta(hours=hours)
        got, _ = run_alerts(spark, t.registry.path.rsplit("/", 1)[0], now, dry_run=True)
        assert got.drop("stale").collect() == al.bundle(t.readings_df(), None, now).drop("stale").collect()


def test_alerts_do_not_scan_the_history(spark, tables):
    plan = al.bundle(tables.latest_df(), None, T0, recent=tables.readings_df(T0))._jdf.queryExecution().optimizedPlan().toString()
    scans = plan.count("low_alarm#")
    assert "last_ts" in plan and scans
    text = al.bundle(tables.latest_df(), None, T0, recent=tables.readings_df(T0))._jdf.queryExecution().executedPlan().toString()
    for line in text.splitlines():
        if "FileScan" in line and "/readings/" in line:
            assert "PartitionFilters: []" not in line and "dt" in line.split("PartitionFilters")[1]


@pytest.mark.parametrize("a,b", [(90, 6200), (60, 180), (61, 119), (75, 135), (0, 600), (7, 8)])
def test_bucket_series_from_partials(spark, tables, a, b):
    lo, hi = T0 + dt.timedelta(minutes=a), T0 + dt.timedelta(minutes=b)
    cond = F.col("metric_key") == "flow_avg"
    for width in ("1 hour", "6 hours"):
        got = {r.time: r.value for r in tables.bucket_series(width, cond, lo, hi).collect()}
        rows = tables.readings_df().where(cond & (F.col("record_ts") >= F.lit(lo)) & (F.col("record_ts") <= F.lit(hi)))
        want = {r.time: r.value for r in bucket_avg(rows, width).collect()}
        assert got.keys() == want.keys() and all((got[k] is None) == (want[k] is None) and (got[k] is None or got[k] == pytest.approx(want[k])) for k in want)


def test_corrections_replays_and_reset_keep_the_summary(spark, tmp_path):
    t = IngestTables(spark, str(tmp_path))
    write_batch(t, _registry(spark, 1), _records(spark, 1), _batch(spark, 1), "r", T0)
    correct_booster(t)
    assert _merged(t.summary.read()) == _merged(partials(t.readings_df()))
    replay_devices(t)
    assert _merged(t.summary.read()) == _merged(partials(t.readings_df()))
    reset(t)
    assert t.summary.read().count() == 0
    assert with_dt(t.readings_df()).count() == 0

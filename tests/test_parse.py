"""Log parsing, timestamps, numbers, labels and groups (reference unit cases, FIXTURES §2-3)."""

import datetime as dt
import gzip

from pyspark.sql import functions as F

from sluice.functions.naming import header_code, label_code, physical_group
from sluice.functions.values import coerce_number, parse_flag, parse_utc_time
from sluice.operators.readings import parse_files
from sluice.sources import config as C
from sluice.sources.objects import _inflate

T = "\t"


def _parse(spark, files, orders=None, labels=None):
    df = spark.createDataFrame([(k, "e", dt.datetime(2026, 1, 1), t) for k, t in files],
                               "object_key string, version_token string, last_modified timestamp, text string")
    return parse_files(df, labels or C.default_labels(spark), C.default_schemas(spark, orders))


def _readings(p):
    return sorted((r.metric_key, r.metric_value, r.unit, r.source_system, r.physical_group)
                  for r in p.readings.collect())


def test_key_value_lines(spark):
    p = _parse(spark, [("log-gz/SN1/a/kv.log.gz",
                        "ts=2026-03-20T00:00:00Z kwh=12.5 kw=3.2 status=ok\n"
                        "ts=2026-03-20T00:15:00Z kwh=13.1 kw=3.4 status=ok\n")])
    assert p.records.count() == 2
    rows = p.readings.orderBy("record_ts", "metric_key").collect()
    assert len(rows) == 4
    assert [(r.metric_key, r.metric_value) for r in rows[:2]] == [("kw", 3.2), ("kwh", 12.5)]
    assert all(r.unit is None and r.source_system == "unknown" for r in rows)


def test_csv_with_header(spark):
    p = _parse(spark, [("log-gz/SN1/a/x_mb-005.log.gz",
                        "time(UTC),error,lowalarm,highalarm,Solar Array Power (kWh),Solar Array Power Demand (kW)\n"
                        "2026-03-20T00:00:00Z,0,0,0,12.5,3.2\n")])
    assert p.records.count() == 1
    r = _readings(p)
    assert len(r) == 2
    assert {x[3] for x in r} == {"solar_field"}
    assert ("power_A", 12.5, "kWh", "solar_field", "solar_field") in r
    assert p.layout.select(F.size("measurable_headers")).first()[0] == 2


def test_junk_first_line_and_quoted_time(spark):
    p = _parse(spark, [("log-gz/SN1/a/j.log.gz",
                        "# junk or comment line\n"
                        f"time(UTC){T}error{T}lowalarm{T}highalarm{T}Solar Array Power (kWh)\n"
                        f"'2026-02-23 20:45:00'{T}0{T}0{T}0{T}12.5\n")])
    rec = p.records.collect()
    assert len(rec) == 1 and rec[0].line_no == 3
    assert rec[0].record_ts == dt.datetime(2026, 2, 23, 20, 45)
    assert not any(k.startswith("col_") for k, *_ in _readings(p))


def test_headerless_with_column_order(spark):
    order = {"wattnode_64_v1": ["time(UTC)", "error", "lowalarm", "highalarm", "Solar Array Power (kWh)"]}
    p = _parse(spark, [("log-gz/SN1/a/h_mb-009.log.gz", f"'2026-02-23 20:45:00'{T}0{T}0{T}0{T}99.5\n")], orders=order)
    r = p.readings.collect()
    assert len(r) == 1
    assert r[0].record_ts == dt.datetime(2026, 2, 23, 20, 45) and r[0].physical_group == "solar_field"


def test_tab_header_comma_row(spark):
    p = _parse(spark, [("log-gz/SN1/a/t.log.gz",
                        f"time(UTC){T}error{T}lowalarm{T}highalarm{T}Solar Array Power (kWh)\n"
                        "'2026-04-22 18:00:00',0,0,0,12.5\n")])
    rec = p.records.first()
    assert rec.line_no == 2 and rec.record_ts == dt.datetime(2026, 4, 22, 18)
    assert p.readings.first().metric_value == 12.5


def test_named_hydro_streams(spark):
    p = _parse(spark, [("log-gz/SN1/a/s_mb-006.log.gz",
                        "time(UTC),error,lowalarm,highalarm,F-1 Reservoir By-pass Ave (Gpm),"
                        "F2 - Wyman Creek Flow Ave (Gpm)\n2026-04-22T12:00:00Z,0,0,0,12,340\n")])
    r = {x[0]: x for x in _readings(p)}
    assert set(r) == {"flow_bypass_avg", "flow_wyman_avg"}
    assert r["flow_wyman_avg"][1] == 340 and r["flow_wyman_avg"][3] == "hydro_plant"


def test_collision_first_wins_and_repeated_header(spark):
    p = _parse(spark, [("log-gz/SN1/a/c.log.gz",
                        "time(UTC),error,lowalarm,highalarm,Power from SCE Main Power Pulse #1 (kW),"
                        "Power to SCE #2 Pulse from SCE net meter (kW),-,-\n"
                        "2026-03-20T00:00:00Z,0,0,0,7,9,1,2\n"
                        "2026-03-20T00:00:00Z,0,0,0,8,9,1,2\n")])
    r = p.readings.collect()
    assert [(x.metric_key, x.metric_value) for x in r] == [("power", 7.0)]
    keys = p.records.orderBy("line_no").first().parsed
    assert "-" in keys and "-__7" in keys


def test_non_finite_cell_keeps_record(spark):
    p = _parse(spark, [("log-gz/SN1/a/n.log.gz",
                        "time(UTC),error,lowalarm,highalarm,Solar Array Power (kWh)\n2026-03-20T00:00:00Z,0,1,0,1e999\n")])
    assert p.records.count() == 1 and p.readings.count() == 0


def test_has_data_false_writes_records_only(spark):
    p = _parse(spark, [("log-gz/SN1/a/m_mb-002.log.gz",
                        "time(UTC),error,lowalarm,highalarm,Pulse #1\n2026-03-20T00:00:00Z,0,0,0,5\n")])
    assert p.records.count() == 1 and p.readings.count() == 0


def test_plain_bytes_named_gz():
    text = "time(UTC),error,lowalarm,highalarm,x\n"
    assert _inflate(text.encode()) == text
    assert _inflate(gzip.compress(text.encode())) == text


def test_timestamps(spark):
    cases = {
        "2026-02-23 14:30:00": dt.datetime(2026, 2, 23, 14, 30),
        "2026-02-23 9:05:07": dt.datetime(2026, 2, 23, 9, 5, 7),
        "'2026-02-23 20:45:00'": dt.datetime(2026, 2, 23, 20, 45),
        "2026-13-01 00:00:00": dt.datetime(2027, 1, 1),
        "2026-03-20T00:00:00.1239Z": dt.datetime(2026, 3, 20, 0, 0, 0, 123000),
        "3/20/2026 10:00:00": dt.datetime(2026, 3, 20, 10),
        "1700000000": dt.datetime(2023, 11, 14, 22, 13, 20),
        "": None,
        "abc": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.ts for r in df.select("v", parse_utc_time("v").alias("ts")).collect()}
    assert got == cases


def test_numbers_and_flags(spark):
    vals = ["12.5", "-3", "1e3", "+1", ".5", "1.", "1,000", "'7'", "abc", ""]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r.v: (r.n, r.f) for r in df.select("v", coerce_number("v").alias("n"), parse_flag("v").alias("f")).collect()}
    assert got["12.5"] == (12.5, True) and got["-3"] == (-3.0, True) and got["1e3"] == (1000.0, True)
    assert got["+1"][0] is None and got[".5"][0] is None and got["1."][0] is None and got["1,000"][0] is None
    assert got["'7'"] == (7.0, False) and got["abc"] == (None, False) and got[""] == (None, False)


def test_label_codes_and_groups(spark):
    df = spark.createDataFrame([("Site_Logger_mb-002.5880AEA2_2.log.csv",), ("no-code-file.log.gz",),
                                ("device-mb-5-x.log.gz",)], "n string")
    out = [(r.c, r.h) for r in df.select(label_code("n").alias("c"), header_code("n").alias("h")).collect()]
    assert out == [("002", "002"), ("unknown", None), ("unknown", "005")]
    g = spark.createDataFrame([("hydro_plant", "solar_field"), ("unknown", "deep_well"), ("", "deep_well")],
                              "s string, l string")
    assert [r[0] for r in g.select(physical_group("s", "l")).collect()] == ["hydro_plant", "deep_well", "deep_well"]


def test_label_resolution(spark):
    labels = spark.createDataFrame([("003", "Booster", "mb-003", "booster_pump", None, True)], C.LABEL_SCHEMA)
    df = spark.createDataFrame([("foo_mb-003_bar.log.gz",), ("foo_mb-009_bar.log.gz",), ("no-code.log.gz",)], "n string")
    df = df.withColumn("label_code", label_code("n"))
    out = {r.n: r for r in C.resolve_label(df, labels).collect()}
    assert out["foo_mb-009_bar.log.gz"].device_address == "mb-009"
    assert out["foo_mb-009_bar.log.gz"].label_name == "Unknown Label"
    assert out["no-code.log.gz"].label_group == "unknown" and out["no-code.log.gz"].schema_id == "default_v1"
    assert out["foo_mb-003_bar.log.gz"].has_data is True

"""Label-map loading, strict header allow-list with aliases, canonical header lines, listing
guard, hasData conflicts and dry run."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from sluice.operators import quality as qa
from sluice.operators.readings import parse_files
from sluice.sources import config as C
from sluice.sources import objects as O


def _files(spark, items):
    return spark.createDataFrame([(k, "e", dt.datetime(2026, 1, 1), t) for k, t in items],
                                 "object_key string, version_token string, last_modified timestamp, text string")


def test_load_label_map(spark, tmp_path):
    doc = {"labels": {"005": {"labelName": "Solar", "deviceAddress": "mb-005", "physicalGroup": "solar_field",
                              "schemaId": "s1"}, "002": {"labelName": "Hopper", "hasData": False}},
           "schemas": {"s1": {"expectedHeaders": ["Hydro Plant Power"],
                              "headerAliases": {"hydo plant power": "Hydro Plant Power"}}}}
    p = tmp_path / "labels.json"
    p.write_text(json.dumps(doc))
    labels, schemas = C.load_label_map(spark, str(p))
    lab = {r.code: r for r in labels.collect()}
    assert lab["002"].has_data is False and lab["002"].device_address == "mb-002"
    assert lab["005"].has_data is True and lab["005"].schema_id == "s1"
    assert schemas.first().header_aliases == {"hydo plant power": "Hydro Plant Power"}
    bad = tmp_path / "bad.json"
    bad.write_text(json.dumps({"schemas": {}}))
    with pytest.raises(ValueError):
        C.load_label_map(spark, str(bad))


def test_strict_allow_list_and_aliases(spark):
    text = ("time(UTC),error,lowalarm,highalarm,Hydo Plant Power Instantaneous (kW),Mystery Power (kW)\n"
            "2026-01-01T00:00:00Z,0,0,0,4,9\n")
    f = _files(spark, [("log-gz/S/x_mb-005.log.gz", text)])
    loose = parse_files(f, C.default_labels(spark), C.default_schemas(spark))
    strict = parse_files(f, C.default_labels(spark), C.default_schemas(spark), strict=True)
    assert sorted(r.metric_key for r in loose.readings.collect()) == ["power", "power_instantaneous"]
    got = [(r.metric_key, r.metric_value, r.source_system) for r in strict.readings.collect()]
    assert got == [("power_instantaneous", 4.0, "hydro_plant")]


def test_canonical_header_lines(spark):
    labels = C.default_labels(spark)
    schemas = C.default_schemas(spark, {"power_pulse_v1": ["time(UTC)", "error", "Pulse #1"]})
    lines = {r.code: r.header_line for r in C.canonical_header_lines(labels, schemas).collect()}
    assert lines == {"001": "time(UTC)\terror\tPulse #1"}


def test_listing_guard(spark):
    m = spark.createDataFrame([(f"k{i:03d}", "v", 1, None) for i in range(10)],
                              "object_key string, version_token string, size long, last_modified timestamp")
    with pytest.raises(RuntimeError):
        O.check_listing(m, 5)
    assert [r.object_key for r in O.check_listing(m, 5, strict=False).collect()] == [f"k{i:03d}" for i in range(5)]
    assert O.check_listing(m, 10).count() == 10
    assert O.batch_limit("nan") == 200 and O.batch_limit(0) == 200 and O.batch_limit("7") == 7
    top = O.newest_first(m.withColumn("last_modified", F.when(F.col("object_key") == "k009",
                                                               F.lit(dt.datetime(2026, 1, 1)))), 2)
    assert [r.object_key for r in top.collect()] == ["k009", "k000"]


def test_has_data_conflicts_and_dry_run(spark):
    text = "time(UTC),error,lowalarm,highalarm,Pulse #1,Flow (Gpm)\n2026-01-01T00:00:00Z,0,0,0,1,2\n"
    p = parse_files(_files(spark, [("log-gz/S/x_mb-002.log.gz", text), ("log-gz/S/y_mb-006.log.gz", text)]),
                    C.default_labels(spark), C.default_schemas(spark))
    c = qa.has_data_conflicts(p.layout).collect()
    assert [(r.device_address, r.measurable_preview) for r in c] == [("mb-002", "Pulse #1 | Flow (Gpm)")]
    d = {r.object_key: (r.rows, r.tall) for r in qa.dry_run(p.layout, p.records, p.readings).collect()}
    assert d == {"log-gz/S/x_mb-002.log.gz": (1, 0), "log-gz/S/y_mb-006.log.gz": (1, 2)}

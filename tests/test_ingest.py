"""End-to-end ingest: gzip objects → tables; re-runs are idempotent; batch = stream; replay."""

import datetime as dt
import gzip
import os

from pyspark.sql import functions as F

from sluice.operators import replay as rp
from sluice.plans.ingest import run_ingest
from sluice.sinks.tables import IngestTables, correct_booster, forget_object, mark_processed, replay_devices, reset
from sluice.sources.objects import normalise_header, route_parts
from sluice.streaming.ingest_stream import start_ingest_stream

CSV = ("time(UTC),error,lowalarm,highalarm,F2 - Wyman Creek Flow Ave (Gpm),Hydro Plant Power Instantaneous (kW)\n"
       "2026-04-22T12:00:00Z,0,0,0,340,12\n2026-04-22T12:15:00Z,0,1,0,330,11\n")


def _write_objects(root):
    d = root / "log-gz" / "SN7" / "2026" / "04" / "22"
    d.mkdir(parents=True)
    (d / "acq_mb-006_a.log.gz").write_bytes(gzip.compress(CSV.encode()))
    (d / "acq_mb-005_b.log.gz").write_bytes(b"ts=2026-04-22T12:00:00Z kw=3.5\n")   # plain text named .gz
    (d / "acq_mb-002_c.log.gz").write_bytes(gzip.compress(CSV.encode()))          # hasData=false
    (d / "acq_mb-001_d.log.gz").write_bytes(b"ts=yesterday-ish kw=1\n")             # invalid loose ts → error
    os.utime(d / "acq_mb-006_a.log.gz", (1_700_000_000, 1_700_000_000))


def _counts(t):
    return (t.registry.read().count(), t.records.read().count(), t.readings.read().count(),
            t.checkpoint.read().count())


def test_batch_ingest_idempotent(spark, tmp_path):
    _write_objects(tmp_path / "bucket")
    tables = str(tmp_path / "tables")
    now = dt.datetime(2026, 4, 23)
    r1 = run_ingest(spark, str(tmp_path / "bucket"), tables, now=now, run_id="r1")
    s = r1.stats.first()
    assert (s.listed, s.skipped, s.succeeded, s.failed) == (4, 0, 3, 1)
    t = IngestTables(spark, tables)
    assert _counts(t) == (4, 2 + 1 + 2, 4 + 1, 3)
    reg = {r.object_key.split("/")[-1]: r for r in t.registry.read().collect()}
    assert reg["acq_mb-001_d.log.gz"].parse_status == "error"
    rd = t.readings_df()
    assert rd.where(F.col("metric_key") == "flow_wyman_avg").count() == 2
    assert rd.where(F.col("low_alarm")).count() == 2
    # second run: the failed file is retried (still failing), nothing is duplicated
    r2 = run_ingest(spark, str(tmp_path / "bucket"), tables, now=now + dt.timedelta(hours=2), run_id="r2")
    s2 = r2.stats.first()
    assert (s2.listed, s2.skipped, s2.failed) == (4, 3, 1)
    assert _counts(t) == (4, 5, 5, 3)
    # K9 replay of one file: re-ingested without duplicate readings
    key = [k for k in reg if "mb-006" in k][0]
    row = reg[key]
    t.checkpoint.replace(rp.replay_file(t.checkpoint.read(), row.object_key, row.version_token))
    run_ingest(spark, str(tmp_path / "bucket"), tables, now=now + dt.timedelta(hours=4), run_id="r3")
    assert _counts(t) == (4, 5, 5, 3)


def test_stream_matches_batch(spark, tmp_path):
    _write_objects(tmp_path / "bucket")
    batch_t, stream_t = str(tmp_path / "tb"), str(tmp_path / "ts")
    run_ingest(spark, str(tmp_path / "bucket"), batch_t, now=dt.datetime(2026, 4, 23), run_id="b")
    q = start_ingest_stream(spark, str(tmp_path / "bucket"), stream_t, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    tb, ts = IngestTables(spark, batch_t), IngestTables(spark, stream_t)
    cols = ["serial", "record_ts", "metric_key", "metric_value", "source_file_id"]
    a = sorted(tuple(r) for r in tb.readings_df().select(*cols).collect())
    b = sorted(tuple(r) for r in ts.readings_df().select(*cols).collect())
    assert a == b and len(a) == 5
    # restarting the stream finds nothing new
    q = start_ingest_stream(spark, str(tmp_path / "bucket"), stream_t, str(tmp_path / "ckpt"))
    q.awaitTermination(300)
    assert ts.readings_df().count() == 5


def test_replay_and_correction(spark, tmp_path):
    _write_objects(tmp_path / "bucket")
    tables = str(tmp_path / "tables")
    run_ingest(spark, str(tmp_path / "bucket"), tables, now=dt.datetime(2026, 4, 23), run_id="r1")
    t = IngestTables(spark, tables)
    out = rp.replay_flow_devices(t.registry.read(), t.records.read(), t.readings_df(), t.checkpoint.read())
    c = out["counts"].first()
    assert (c.tall_deleted, c.raw_deleted, c.checkpoints_deleted) == (2, 2, 1)
    assert out["readings"].count() == 5 - 2 and out["records"].count() == 5 - 2
    fixed = rp.correct_booster_group(spark.createDataFrame(
        [("mb-003", "hydro_plant", "x"), ("mb-003", "unknown", "hydro_plant"), ("mb-006", "hydro_plant", "x")],
        "device_address string, physical_group string, source_system string")).collect()
    assert [(r.physical_group, r.source_system) for r in fixed] == [
        ("booster_pump", "booster_pump"), ("booster_pump", "booster_pump"), ("hydro_plant", "x")]
    empty = rp.reset_ingest(spark)
    assert all(df.count() == 0 for df in empty.values())
    mark_processed(t, spark.createDataFrame([("k", "v", "r", dt.datetime(2026, 1, 1))], t.checkpoint.schema))
    mark_processed(t, spark.createDataFrame([("k", "v", "r", dt.datetime(2026, 1, 1))], t.checkpoint.schema))
    assert t.checkpoint.read().where("object_key = 'k'").count() == 1


def test_header_normaliser(spark):
    canon = spark.createDataFrame([("001", "time(UTC)\terror\tlowalarm\thighalarm\tx")], "code string, header_line string")
    files = spark.createDataFrame([
        ("a/device-mb-001-foo.log.gz", "﻿time(UTC)\terror\tlowalarm\thighalarm\tx\n1\t0\t0\t0\t1", True),
        ("a/mb-001.log.gz", "2025-01-01T00:00:00\t0\t0\t1", True),
        ("a/unknown.log.gz", "2025-01-01T00:00:00\t0\t0\t1", True),
        ("a/mb-001.log", "2025-01-01T00:00:00\t0\t0\t1", False),
    ], "object_key string, text string, is_gzip boolean")
    out = {r.object_key: r for r in normalise_header(files, canon).collect()}
    assert out["a/device-mb-001-foo.log.gz"].csv_header_status == "matched"
    assert out["a/mb-001.log.gz"].csv_header_status == "prepended"
    assert out["a/mb-001.log.gz"].text.startswith("time(UTC)\t")
    assert out["a/unknown.log.gz"].csv_header_status is None and out["a/mb-001.log"].csv_header_status is None
    dflt = {r.object_key: r for r in normalise_header(files, canon, default_code="1").collect()}
    assert dflt["a/unknown.log.gz"].csv_header_status == "prepended"


def test_landing_routes(spark):
    t = dt.datetime(2026, 4, 22, 23, 59)
    parts = spark.createDataFrame([
        ("u1", "SN/1", "LOGFILE", "x y.log.gz", True, t),
        ("u1", "SN/1", "LOGFILE", "x y.log.gz", False, t),
        ("u1", "SN/1", "STATUSFILE", "s.bin", False, t),
        ("u1", "SN/1", "other", "notes.TXT", False, t),
        ("u1", "SN/1", "blob", "b.bin", False, t),
        ("u2", None, "LOGFILE", None, True, t),
    ], "upload_id string, serial string, field string, filename string, is_log boolean, received_at timestamp")
    keys = sorted(r.object_key for r in route_parts(parts).collect())
    assert keys == sorted([
        "log-gz/SN_1/2026/04/22/x_y.log.gz", "status/SN_1/2026/04/22/s.bin", "status/SN_1/2026/04/22/notes.TXT",
        "other/SN_1/2026/04/22/b.bin", f"log-gz/unknown_serial/2026/04/22/acq_{int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)}.log.gz"])


def test_stream_ingests_a_replaced_object(spark, tmp_path):
    _write_objects(tmp_path / "bucket")
    tables = str(tmp_path / "t")
    start_ingest_stream(spark, str(tmp_path / "bucket"), tables, str(tmp_path / "ckpt")).awaitTermination(300)
    t = IngestTables(spark, tables)
    before = t.readings_df().count()
    f = tmp_path / "bucket" / "log-gz" / "SN7" / "2026" / "04" / "22" / "acq_mb-006_a.log.gz"
    f.write_bytes(gzip.compress((CSV + "2026-04-22T12:30:00Z,0,0,0,320,10\n").encode()))
    start_ingest_stream(spark, str(tmp_path / "bucket"), tables, str(tmp_path / "ckpt")).awaitTermination(300)
    assert t.readings_df().count() == before + 6
    assert t.registry.read().where(F.col("object_key").endswith("acq_mb-006_a.log.gz")).count() == 2


def test_interrupted_write_does_not_block_later_runs(spark, tmp_path):
    _write_objects(tmp_path / "bucket")
    t = IngestTables(spark, str(tmp_path / "t"))
    # A crash leaves folders without the commit marker.
    for table in (t.registry, t.records, t.readings, t.checkpoint):
        os.makedirs(f"{table.path}/_v={0:012d}")
    run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "t"), now=dt.datetime(2026, 4, 23), run_id="r1")
    assert _counts(t) == (4, 5, 5, 3)
    os.makedirs(f"{t.checkpoint.path}/_v={7:012d}")
    key = t.checkpoint.read().first()
    forget_object(t, key.object_key, key.version_token)
    assert t.checkpoint.current() == 8 and t.checkpoint.read().count() == 2


def test_run_cut_short_between_steps_is_completed(spark, tmp_path, monkeypatch):
    _write_objects(tmp_path / "bucket")
    t = IngestTables(spark, str(tmp_path / "t"))
    import sluice.sinks.tables as sinks
    real, calls = sinks.Table.append, []

    def dies(self, df):
        calls.append(self.path)
        if self.path.endswith("readings"):
            raise OSError("executor lost")
        real(self, df)

    monkeypatch.setattr(sinks.Table, "append", dies)
    try:
        run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "t"), run_id="r1")
        raise AssertionError("the write should have failed")
    except OSError:
        pass
    assert t.records.read().count() == 5 and t.checkpoint.read().count() == 0
    monkeypatch.setattr(sinks.Table, "append", real)
    run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "t"), run_id="r2")
    assert _counts(t) == (4, 5, 5, 3)


def test_vanished_large_and_oddly_named_objects(spark, tmp_path):
    from sluice.sources import objects as O
    _write_objects(tmp_path / "bucket")
    d = tmp_path / "bucket" / "log-gz" / "SN[7]" / "2026"
    d.mkdir(parents=True)
    (d / "acq_mb-006_{x}.log.gz").write_bytes(gzip.compress(CSV.encode()) + b"trailing")
    (d / "acq_mb-006_two.log.gz").write_bytes(gzip.compress(CSV[:120].encode()) + gzip.compress(CSV[120:].encode()))
    root = str(tmp_path / "bucket")
    listed = O.list_objects(spark, root).checkpoint()
    assert listed.count() == 6
    (tmp_path / "bucket" / "log-gz" / "SN7" / "2026" / "04" / "22" / "acq_mb-005_b.log.gz").unlink()
    rows = {r.object_key.rsplit("/", 1)[-1]: r for r in O.read_objects(spark, listed.drop("path"), root, max_bytes=300).collect()}
    assert len(rows) == 6
    assert rows["acq_mb-005_b.log.gz"].read_error == "object not found"
    assert rows["acq_mb-006_{x}.log.gz"].text == CSV and rows["acq_mb-006_two.log.gz"].text == CSV
    small = O.read_objects(spark, listed, max_bytes=40).collect()
    assert sum(r.read_error == "object larger than 40 bytes" for r in small) == 4
    r = run_ingest(spark, root, str(tmp_path / "t"), run_id="r")
    assert (r.stats.first().listed, r.stats.first().failed) == (5, 1)


def test_headerless_files_use_the_column_orders(spark, tmp_path):
    import json
    d = tmp_path / "bucket" / "log-gz" / "SN7"
    d.mkdir(parents=True)
    (d / "acq_mb-006_h.log.gz").write_bytes(gzip.compress("\n".join(CSV.splitlines()[1:]).encode()))
    from sluice.sources import config as C
    schema = C.default_labels(spark).where("code = '006'").first().schema_id
    orders = tmp_path / "orders.json"
    orders.write_text(json.dumps({schema: CSV.splitlines()[0].split(",")}))
    none = run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "a"), run_id="a")
    assert any("column order" in w.kind for w in none.warnings.collect())
    run = run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "b"), run_id="b", column_orders=str(orders))
    assert IngestTables(spark, str(tmp_path / "b")).readings_df().count() == 4
    assert run.warnings.count() == 0
    plan = run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "c"), run_id="c", column_orders=str(orders), dry_run=True)
    assert plan.plan.first().tall == 4 and IngestTables(spark, str(tmp_path / "c")).registry.read().count() == 0


def test_replay_correction_and_reset_jobs_store_their_result(spark, tmp_path):
    _write_objects(tmp_path / "bucket")
    t = IngestTables(spark, str(tmp_path / "t"))
    run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "t"), run_id="r1")
    whole = sorted(map(repr, t.readings_df().collect()))
    assert replay_devices(t) == {"tall_deleted": 2, "raw_deleted": 2, "checkpoints_deleted": 1}
    assert _counts(t) == (4, 3, 3, 2)
    run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "t"), run_id="r2")
    assert sorted(map(repr, t.readings_df().collect())) == whole
    wrong = t.readings.read().withColumn("device_address", F.lit("mb-003")).withColumn("physical_group", F.lit("hydro_plant"))
    t.readings.replace(wrong)
    correct_booster(t)
    assert {r.physical_group for r in t.readings.read().collect()} == {"booster_pump"} and t.readings.read().count() == 5
    reset(t)
    assert _counts(t) == (0, 0, 0, 0)

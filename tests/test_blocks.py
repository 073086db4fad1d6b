"""Objects cut into blocks of lines: the same lines, rows and readings as whole files, in bounded rows."""

import datetime as dt
import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from sluice.operators.readings import parse_files
from sluice.plans import ingest as I
from sluice.sinks.tables import IngestTables
from sluice.sources import config as C
from sluice.functions.text import JS_WS_TEXT
from sluice.sources.blocks import blocks_of, line_blocks
from sluice.sources.objects import _inflate

HEADER = "time(UTC),error,lowalarm,highalarm,F2 - Wyman Creek Flow Ave (Gpm),Hydro Plant Power Instantaneous (kW)"


def _objects(spark, rows):
    """rows of (key, bytes)."""
    return spark.createDataFrame([(k, "v", dt.datetime(2026, 1, 1), bytearray(b) if b is not None else None) for k, b in rows],
                                 "object_key string, version_token string, last_modified timestamp, content binary")


def test_blocks_hold_the_lines_of_the_whole():
    r = random.Random(3)
    for _ in range(400):
        text = "".join(r.choice(["a", "b\n", "\r\n", "\n", " ", "é", "﻿", "\r", "語", "x,y\n", "\n\n"]) for _ in range(r.randint(0, 200))).encode()
        halves = gzip.compress(text[:len(text) // 2]), gzip.compress(text[len(text) // 2:])
        for data in (text, gzip.compress(text), halves[0] + halves[1], halves[0] + halves[1] + b"trail\x1f\x8b",
                     halves[0] + halves[1][:-5], halves[0][:-9], b"\x1f\x8bno gzip\nat all"):
            want = [x for x in re.split(r"\r?\n", re.sub("^﻿", "", _inflate(data))) if x.strip(JS_WS_TEXT)]
            for size in (1, 7, 64, 1 << 20):
                blocks = list(blocks_of(data, size))
                assert [x for b in blocks for x in b["lines"]] == want
                assert [b["first_line"] for b in blocks] == [sum(len(b["lines"]) for b in blocks[:k]) for k in range(len(blocks))]
                assert [b["block"] for b in blocks] == list(range(len(blocks))) and all(b["head"] == want[:8] for b in blocks)
                assert blocks[0]["whole"] == (len(blocks) == 1) or not blocks[0]["whole"]


def test_a_small_gzip_of_more_than_two_gigabytes():
    member = gzip.compress(b"k=1 " + b" " * ((1 << 20) - 5) + b"\n", 1)
    lines = size = 0
    for b in blocks_of(member * 2200, 4 << 20):
        lines += len(b["lines"])
        size = max(size, sum(map(len, b["lines"])))
    assert lines == 2200 and size <= 12 << 20


def test_blocked_files_parse_as_whole_files(spark):
    r = random.Random(1)
    row = lambda k: f"2026-04-{k // 96 % 28 + 1:02d}T{k // 4 % 24:02d}:{k % 4 * 15:02d}:00Z,0,{k % 2},0,{r.randint(0, 999) / 10},{k}"
    csv = "\n".join(["junk line", HEADER, *map(row, range(3000))])
    loose = "\n".join(f"ts=2026-04-22T12:{k % 60:02d}:{k // 60:02d}Z kw={k}" for k in range(900))
    files = [("log-gz/SN7/a_mb-006.log.gz", gzip.compress(csv.encode())), ("log-gz/SN7/b_mb-005.log.gz", loose.encode()),
             ("log-gz/SN7/c_mb-002.log.gz", gzip.compress(csv.encode())), ("log-gz/SN7/d_mb-006.log.gz", b""), ("log-gz/SN7/e_mb-006.log.gz", None),
             ("log-gz/SN7/f_mb-001.log.gz", (loose + "\nts=yesterday kw=1\n" + loose).encode())]   # fails as a whole, in a late block
    labels, schemas = C.default_labels(spark), C.default_schemas(spark)
    whole = spark.createDataFrame([(k, "v", dt.datetime(2026, 1, 1), _inflate(b or b"")) for k, b in files],
                                  "object_key string, version_token string, last_modified timestamp, text string")
    want = parse_files(whole, labels, schemas, ingested_at="2026-01-02 00:00:00")
    blocks = line_blocks(_objects(spark, files), block_bytes=4000)
    assert blocks.agg(F.max(F.octet_length(F.array_join("lines", "\n")))).first()[0] < 8000 and blocks.count() > 60
    got = parse_files(blocks, labels, schemas, ingested_at="2026-01-02 00:00:00")
    for name in ("registry", "records", "readings"):
        a, b = getattr(want, name), getattr(got, name)
        key = lambda df: sorted(map(str, df.withColumn("parsed", F.to_json("parsed")).collect() if "parsed" in df.columns else df.collect()))
        assert key(b.select(*a.columns)) == key(a), name
    # Times repeat after 28 days: 2688 instants of two metrics.
    assert got.records.count() == 3000 * 2 + 900 and got.readings.count() == 2688 * 2 + 900


def test_one_bad_object_does_not_touch_the_others(spark, tmp_path):
    d = tmp_path / "bucket" / "log-gz" / "SN7" / "2026"
    d.mkdir(parents=True)
    good = "\n".join([HEADER, "2026-04-22T12:00:00Z,0,0,0,340,12"]).encode()
    (d / "a_mb-006.log.gz").write_bytes(gzip.compress(good))
    (d / "b_mb-006.log.gz").write_bytes(gzip.compress(good + b"\n" + b"x" * 5000 + b"\n2026-04-22T12:15:00Z,0,0,0,340,12"))
    from sluice.sources import objects as O
    blocks = O.read_blocks(spark, O.list_objects(spark, str(tmp_path / "bucket")), block_bytes=100, line_bytes=1000)
    t = IngestTables(spark, str(tmp_path / "t"))
    I.ingest_blocks(spark, blocks, t, run_id="r", now=dt.datetime(2026, 4, 23))
    reg = {r.object_key[-15:]: r for r in t.registry.read().collect()}
    assert len(reg) == 2 and reg["a_mb-006.log.gz"].parse_status == "parsed"
    assert reg["b_mb-006.log.gz"].parse_status == "error" and "longer than 1000 bytes" in reg["b_mb-006.log.gz"].error_text
    assert (t.readings_df().count(), t.records.read().count(), t.checkpoint.read().count()) == (2, 1, 1)


def test_an_object_that_inflates_past_two_gigabytes_is_ingested(spark, tmp_path):
    d = tmp_path / "bucket" / "log-gz" / "SN7" / "2026"
    d.mkdir(parents=True)
    start = dt.datetime(2026, 4, 1)
    row = lambda k: f"{(start + dt.timedelta(minutes=k)).isoformat()}Z,0,0,0,{k},1\n".encode()
    blank = gzip.compress(b" " * (1 << 20) + b"\n", 1)
    (d / "a_mb-006.log.gz").write_bytes(gzip.compress(HEADER.encode() + b"\n") + b"".join(gzip.compress(row(k)) + blank for k in range(2100)))
    r = I.run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "t"), run_id="r")
    t = IngestTables(spark, str(tmp_path / "t"))
    assert r.stats.first().succeeded == 1 and t.readings_df().count() == 4200
    assert [x.line_no for x in t.records.read().orderBy("line_no").collect()] == list(range(2, 2102))


@pytest.mark.parametrize("dry", [False, True])
def test_warnings_and_dry_run(spark, tmp_path, dry):
    """Q1-Q3, Q7: what is said of a device without data, a file without readings, one without times."""
    d = tmp_path / "bucket" / "log-gz" / "SN7" / "2026"
    d.mkdir(parents=True)
    ok = "2026-04-22T12:00:00Z,0,0,0,340,12"
    files = {"a_mb-002": [HEADER, ok], "b_mb-006": [HEADER, "not a time,0,0,0,340,12"], "c_mb-006": [HEADER, "2026-04-22T12:00:00Z,0,0,0,n/a,"],
             "d_mb-006": [HEADER, ok], "e_mb-002": ["time(UTC),error,lowalarm,highalarm,Other", "2026-04-22T12:00:00Z,0,0,0,x"]}
    for name, lines in files.items():
        (d / f"{name}.log.gz").write_bytes(gzip.compress("\n".join(lines).encode()))
    r = I.run_ingest(spark, str(tmp_path / "bucket"), str(tmp_path / "t"), run_id="r", dry_run=dry)
    said = sorted((w.object_key[-15:-7], w.kind, w.detail) for w in r.warnings.collect())
    headers = "F2 - Wyman Creek Flow Ave (Gpm) | Hydro Plant Power Instantaneous (kW)"
    assert said == [("a_mb-002", I.MEASURABLE_WITHOUT_DATA, headers), ("b_mb-006", I.NO_TIMESTAMPS, "rows=1 tall=2"),
                    ("c_mb-006", I.NO_READINGS, "rows=1 tall=0")]
    if dry:
        plan = {x.object_key[-15:-7]: (x.rows, x.tall) for x in r.plan.collect()}
        assert plan == {"a_mb-002": (1, 2), "b_mb-006": (1, 2), "c_mb-006": (1, 0), "d_mb-006": (1, 2), "e_mb-002": (1, 0)}
        assert IngestTables(spark, str(tmp_path / "t")).registry.read().count() == 0
    else:
        assert IngestTables(spark, str(tmp_path / "t")).readings_df().count() == 2

"""Object listing as a data source: equal to the file listing, pruned, and as a stream that is restarted."""

import datetime as dt
import gzip
import os
import time

from pyspark.sql import functions as F

from sluice.sinks.tables import IngestTables
from sluice.sources import objects as O
from sluice.sources.listing import NAME, Listing, ObjectListing, last_day
from sluice.streaming.ingest_stream import listing_stream, start_ingest_stream

HEADER = "time(UTC),error,lowalarm,highalarm,F2 - Wyman Creek Flow Ave (Gpm)"


def put(root, key, n=1, at=None, text=None):
    f = root / key
    f.parent.mkdir(parents=True, exist_ok=True)
    rows = [f"2026-04-22T{k // 60:02d}:{k % 60:02d}:00Z,0,0,0,{k}" for k in range(n)]
    f.write_bytes(gzip.compress((text or "\n".join([HEADER, *rows])).encode()))
    if at:
        os.utime(f, (at, at))


def names(df):
    return sorted(r.object_key.rsplit("/", 1)[-1] for r in df.collect())


def test_listing_equals_the_file_listing(spark, tmp_path):
    keys = ["log-gz/SN1/2026/04/22/a_mb-006.log.gz", "log-gz/SN1/2026/04/23/b_mb-006.log.gz", "log-gz/SN[2]/2025/12/31/c mb-006.log.gz",
            "log-gz/SN3/d_mb-006.log.gz", "log-gz/e_mb-006.log.gz", "log-gz/SN4/x/y/z/w/f_mb-006.log.gz"]
    for k in keys:
        put(tmp_path, k)
    put(tmp_path, "other/SN1/g.log.gz")
    spark.dataSource.register(ObjectListing)
    got = spark.read.format(NAME).option("root", str(tmp_path)).load()
    want = O.list_objects(spark, str(tmp_path))
    cols = ["object_key", "version_token", "size", "last_modified"]
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))
    assert sorted(r.object_key for r in got.collect()) == sorted(keys)
    # A partition per folder that the planner finds, not per object, and nothing of the store on the driver.
    assert got.rdd.getNumPartitions() == 5
    assert spark.read.format(NAME).option("root", str(tmp_path / "none")).load().count() == 0


def test_old_days_are_not_listed(tmp_path):
    for day in ("2024/12/30", "2025/01/01", "2026/03/31", "2026/04/20", "2026/04/22"):
        put(tmp_path, f"log-gz/SN1/{day}/a.log.gz", at=dt.datetime(2026, 4, 22, 12, tzinfo=dt.timezone.utc).timestamp())
    listing = Listing({"root": str(tmp_path), "lookback_days": "2"})
    since = int(dt.datetime(2026, 4, 22, tzinfo=dt.timezone.utc).timestamp() * 1000)
    seen, found = [], []
    for folder, deep in listing.folders(since):
        for b in listing.objects(folder, deep, since, since + 10 ** 9, seen):
            found += b.column("object_key").to_pylist()
    assert sorted(found) == ["log-gz/SN1/2026/04/20/a.log.gz", "log-gz/SN1/2026/04/22/a.log.gz"]
    assert sorted(seen) == ["log-gz/SN1/2026", "log-gz/SN1/2026/04", "log-gz/SN1/2026/04/20", "log-gz/SN1/2026/04/22"]
    assert last_day("2026") == dt.date(2026, 12, 31) and last_day("2026/02") == dt.date(2026, 2, 28)
    assert last_day("2026/12") == dt.date(2026, 12, 31) and last_day("x") is None and last_day("2026/13") is None and last_day("") is None


def test_stream_lists_what_was_modified(spark, tmp_path):
    root, ckpt, out = tmp_path / "b", str(tmp_path / "c"), []

    def drain():
        out.clear()
        q = (listing_stream(spark, str(root), settle_ms=0).writeStream.foreachBatch(lambda df, _: out.extend(names(df)))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination(120)
        return sorted(out)

    old = time.time() - 7200
    put(root, "log-gz/S/2026/01/01/a.gz", at=old)
    put(root, "log-gz/S/2026/01/02/b.gz", at=old)
    assert drain() == ["a.gz", "b.gz"]
    assert drain() == []
    put(root, "log-gz/S/2026/01/01/a.gz", n=3)                     # replaced
    put(root, "log-gz/T/2026/01/03/c.gz")                          # new serial
    put(root, "log-gz/S/2026/01/02/late.gz", at=time.time() - 60)  # turns up with an earlier time
    time.sleep(0.05)
    assert drain() == ["a.gz", "c.gz", "late.gz"]


def test_ingest_stream_restarts_replaces_and_retries(spark, tmp_path):
    root, tables = tmp_path / "b", str(tmp_path / "t")
    run = lambda: start_ingest_stream(spark, str(root), tables, str(tmp_path / "c"), settle_ms=0).awaitTermination(300)
    put(root, "log-gz/S/2026/04/22/a_mb-006.log.gz", n=5)
    put(root, "log-gz/S/2026/04/22/bad_mb-001.log.gz", text="ts=some-day kw=1")
    time.sleep(0.05)
    run()
    t = IngestTables(spark, tables)
    runs = lambda: t.checkpoint.read().select("run_id").distinct().count()
    assert (t.readings_df().count(), t.checkpoint.read().count(), t.registry.read().count()) == (5, 1, 2)
    run()
    assert (t.readings_df().count(), t.checkpoint.read().count(), t.registry.read().count(), runs()) == (5, 1, 2, 1)
    put(root, "log-gz/S/2026/04/22/a_mb-006.log.gz", n=7)          # a new version: other rows, other file
    put(root, "log-gz/S/2026/04/23/b_mb-006.log.gz", n=2)
    time.sleep(0.05)
    run()
    assert (t.readings_df().count(), t.checkpoint.read().count(), t.registry.read().count()) == (5 + 7 + 2, 3, 4)
    # The failed object was looked at again, and once it is put right it is ingested.
    bad = t.registry.read().where(F.col("parse_status") == "error").collect()
    assert len(bad) == 1 and bad[0].object_key.endswith("bad_mb-001.log.gz")
    assert names(O.failed_before(spark, str(root), t)) == ["bad_mb-001.log.gz"]
    put(root, "log-gz/S/2026/04/22/bad_mb-001.log.gz", text="ts=2026-04-22T00:00:00Z kw=1")
    assert names(O.failed_before(spark, str(root), t)) == []
    time.sleep(0.05)
    run()
    assert (t.readings_df().count(), t.checkpoint.read().count()) == (15, 4)

"""Stateful streaming operators over file streams (availableNow), compared with batch results."""

import datetime as dt

from pyspark.sql import functions as F

from sluice import schemas as SC
from sluice.operators.dashboards import bucket_avg
from sluice.streaming.stateful import bucket_avg_stream, cooldown_stream, stale_groups_stream, sustained_stream

T0 = dt.datetime(2026, 1, 1)


def _drain(df, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    return df.sparkSession.table(name)


def _readings_dir(spark, path, rows):
    full = [(s, ts, "m", v, "kW", None, 1, g, False, False, False, "mb-1", g) for s, ts, v, g in rows]
    spark.createDataFrame(full, SC.READINGS).write.parquet(str(path))
    return spark.readStream.schema(SC.READINGS).parquet(str(path))


def test_bucket_avg_stream_equals_batch(spark, tmp_path):
    rows = [("S", T0 + dt.timedelta(minutes=7 * i), float(i), "g") for i in range(200)]
    stream = _readings_dir(spark, tmp_path / "r", rows)
    got = _drain(bucket_avg_stream(stream, "1 hour", watermark="0 seconds"), "g3s")
    batch = bucket_avg(spark.read.parquet(str(tmp_path / "r")), "1 hour")
    # the last (still open) bucket is emitted only when the watermark passes it
    want = {r.time: r.value for r in batch.collect()}
    have = {r.time: r.value for r in got.collect()}
    assert have and all(want[k] == v for k, v in have.items())
    assert len(have) >= len(want) - 1


def test_stale_groups_stream(spark, tmp_path):
    rows = [("S", T0 + dt.timedelta(minutes=10 * i), 1.0, "busy") for i in range(60)] + \
           [("S", T0, 1.0, "quiet")]
    stream = _readings_dir(spark, tmp_path / "r", rows)
    got = _drain(stale_groups_stream(stream, stale_after_minutes=120, watermark="0 seconds"), "a1s")
    out = {(r.physical_group, r.status) for r in got.collect()}
    assert ("quiet", "stale") in out and ("busy", "stale") not in out


def test_cooldown_and_sustained_streams(spark, tmp_path):
    b = [("k", T0 + dt.timedelta(minutes=60 * i), True, "same") for i in range(8)]
    spark.createDataFrame(b, "alert_key string, eval_ts timestamp, any_fire boolean, fingerprint string") \
        .write.parquet(str(tmp_path / "b"))
    s = spark.readStream.schema("alert_key string, eval_ts timestamp, any_fire boolean, fingerprint string") \
        .parquet(str(tmp_path / "b"))
    got = [r.send for r in _drain(cooldown_stream(s, cooldown_minutes=360), "a9s").orderBy("eval_ts").collect()]
    assert got == [True, False, False, False, False, False, True, False]
    ev = [("r", T0 + dt.timedelta(minutes=15 * i), c) for i, c in enumerate([True] * 5 + [False, True])]
    spark.createDataFrame(ev, "rule string, tick timestamp, condition boolean").write.parquet(str(tmp_path / "e"))
    es = spark.readStream.schema("rule string, tick timestamp, condition boolean").parquet(str(tmp_path / "e"))
    fired = [r.firing for r in _drain(sustained_stream(es, 60), "a5s").orderBy("tick").collect()]
    assert fired == [False, False, False, False, True, False, False]


def test_result_does_not_depend_on_arrow_batches(spark, tmp_path):
    rows = [("r", T0 + dt.timedelta(minutes=15 * i), True) for i in range(8)]
    schema = "rule string, tick timestamp, condition boolean"
    spark.createDataFrame(list(reversed(rows)), schema).coalesce(1).write.parquet(str(tmp_path / "e"))
    fired = {}
    for n in ("10000", "2"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", n)
        try:
            s = spark.readStream.schema(schema).parquet(str(tmp_path / "e"))
            fired[n] = [r.firing for r in _drain(sustained_stream(s, 60), f"a5n{n}").orderBy("tick").collect()]
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert fired["2"] == fired["10000"] == [False] * 4 + [True] * 4


# --- shuffled and late input over many triggers -----------------------------------------------------

def _shuffled(spark, path, rows, schema, seed, files=6, spread=40):
    """A stream that reads ``rows``, out of order by up to ``spread`` places, in ``files`` triggers."""
    import os
    import random
    r = random.Random(seed)
    mixed = [x for _, x in sorted((k + r.random() * spread, x) for k, x in enumerate(rows))]
    step = -(-len(mixed) // files)
    for k in range(0, len(mixed), step):
        d = path / f"p{k:06d}"
        spark.createDataFrame(mixed[k:k + step], schema).coalesce(1).write.parquet(str(d))
        part = next(d.glob("*.parquet"))
        (path / "in").mkdir(exist_ok=True)
        part.rename(path / "in" / f"{k:06d}.parquet")
        os.utime(path / "in" / f"{k:06d}.parquet", (1_700_000_000 + k, 1_700_000_000 + k))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path / "in"))


def _rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_sustained_stream_of_shuffled_ticks_equals_batch(spark, tmp_path):
    import random
    from sluice.operators.alerts import sustained
    r = random.Random(2)
    schema = "rule string, tick timestamp, condition boolean"
    rows = [(f"r{k % 3}", T0 + dt.timedelta(minutes=5 * (k // 3), microseconds=k), r.random() < 0.85) for k in range(300)]
    end = ("end", T0 + dt.timedelta(days=9), False)   # moves the watermark past every tick
    stream = _shuffled(spark, tmp_path, [*rows, end], schema, 1)
    cols = ["rule", "tick", "condition", "firing", "pending"]
    got = _rows(_drain(sustained_stream(stream, 30, watermark="4 hours"), "a5x").where("rule <> 'end'"), *cols)
    assert got == _rows(sustained(spark.createDataFrame(rows, schema), by=["rule"], for_minutes=30), *cols) and any(x[3] for x in got)


def test_cooldown_stream_of_shuffled_bundles_equals_the_batch_decisions(spark, tmp_path):
    import random
    from sluice.operators.alerts import ALERT_KEY, cooldown
    r = random.Random(3)
    schema = "alert_key string, eval_ts timestamp, any_fire boolean, fingerprint string"
    rows = [(ALERT_KEY, T0 + dt.timedelta(minutes=50 * k), r.random() < 0.8, r.choice("aab")) for k in range(40)]
    stream = _shuffled(spark, tmp_path, [*rows, ("end", T0 + dt.timedelta(days=90), False, "x")], schema, 4, spread=8)
    got = _drain(cooldown_stream(stream, 360, watermark="12 hours"), "a9x").where("alert_key <> 'end'").orderBy("eval_ts").collect()
    state, want = spark.createDataFrame([], "alert_key string, last_sent_at timestamp, last_payload string"), []
    for key, at, fires, payload in rows[:12]:
        decision, state = cooldown(spark.createDataFrame([(fires, payload)], "any_fire boolean, fingerprint string"), state, at)
        state = spark.createDataFrame(state.collect(), state.schema)
        want.append((at, decision.first().send, decision.first().reason))
    assert [(x.eval_ts, x.send, x.reason) for x in got][:12] == want and len(got) == 40


def test_silences_of_shuffled_readings(spark, tmp_path):
    import random
    r = random.Random(5)
    after, rows = 60, []
    for g in ("a", "b", None):
        t = 0.0
        for _ in range(120):
            t += r.choice([1, 2, 5, 30, 59, 60, 60.01, 61, 150])
            rows.append(("S", T0 + dt.timedelta(minutes=t), 1.0, g))
    want = []
    for g in ("a", "b", None):
        times = sorted(x[1] for x in rows if x[3] == g)
        for x, y in zip(times, times[1:]):
            if y - x > dt.timedelta(minutes=after):
                want += [(g or "unknown", x, "stale"), (g or "unknown", y, "fresh")]
        want.append((g or "unknown", times[-1], "stale"))
    rows.sort(key=lambda x: x[1])
    full = [(s, ts, "m", v, "kW", None, 1, g, False, False, False, "mb-1", g) for s, ts, v, g in [*rows, ("S", T0 + dt.timedelta(days=99), 1.0, "end")]]
    stream = _shuffled(spark, tmp_path, full, SC.READINGS, 6, files=8)
    got = _drain(stale_groups_stream(stream, after, watermark="2 days"), "a1x").where("physical_group <> 'end'")
    assert _rows(got, "physical_group", "latest_ts", "status") == sorted(want)


def test_first_wins_stream_forgets_behind_the_watermark(spark, tmp_path):
    from sluice.streaming.stateful import first_wins_stream
    rows = [("S", T0 + dt.timedelta(minutes=k // 2), float(k), "g") for k in range(200)]
    full = [(s, ts, "m", v, "kW", None, 1, g, False, False, False, "mb-1", g) for s, ts, v, g in rows]
    stream = _shuffled(spark, tmp_path, full, SC.READINGS, 7, files=10, spread=10)
    out = first_wins_stream(stream, "20 minutes")
    q = out.writeStream.format("memory").queryName("w3x").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.table("w3x")
    assert got.count() == got.select("record_ts").distinct().count() == 100
    assert max(p.stateOperators[0].numRowsTotal for p in q.recentProgress) < 60

"""Alert bundle, fingerprint, sections, recency gate, cooldown and sustained-for (FIXTURES §5)."""

import datetime as dt

from pyspark.sql import functions as F

from sluice import schemas as SC
from sluice.operators import alerts as al

NOW = dt.datetime(2026, 1, 2, 12, 0)


def _readings(spark, rows):
    full = [(r.get("serial", "S1"), r["ts"], r.get("metric_key", "power_instantaneous"), r.get("value", 1.0),
             r.get("unit", "kW"), None, r.get("file", 1), r.get("source", "hydro_plant"), False,
             r.get("low", False), r.get("high", False), r.get("device", "mb-005"), r.get("group", "hydro_plant"))
            for r in rows]
    return spark.createDataFrame(full, SC.READINGS)


def test_empty_readings_sentinel(spark):
    st = al.stale_groups(spark.createDataFrame([], SC.READINGS), NOW).collect()
    assert [(r.physical_group, r.latest_ts) for r in st] == [("(no rows)", None)]


def test_recency_gate(spark):
    rd = _readings(spark, [{"ts": NOW - dt.timedelta(minutes=61), "value": 1.0}])
    h = al.hydro_out(rd, NOW, recent_minutes=60, min_kw=5).first()
    assert h.fire is False and h.reason == "reading_not_recent" and h.age_minutes == 61
    rd = _readings(spark, [{"ts": NOW - dt.timedelta(minutes=10), "value": 2.0}])
    h = al.hydro_out(rd, NOW).first()
    assert h.fire is True and h.reason is None


def test_fingerprint_ignores_alarm_timestamps(spark):
    a = _readings(spark, [{"ts": NOW - dt.timedelta(minutes=5), "low": True, "value": 9.0}])
    b = _readings(spark, [{"ts": NOW - dt.timedelta(minutes=50), "low": True, "value": 9.0}])
    fa = al.bundle(a, None, NOW, stale_after_minutes=240).first()
    fb = al.bundle(b, None, NOW, stale_after_minutes=240).first()
    assert fa.n_alarms == 1 and fb.n_alarms == 1
    assert fa.fingerprint.split("ALRM")[1] == fb.fingerprint.split("ALRM")[1]


def test_sections_and_any_fire(spark):
    stale = _readings(spark, [{"ts": NOW - dt.timedelta(days=1), "group": "solar_field", "source": "solar_field",
                               "metric_key": "x"}])
    b = al.bundle(stale, None, NOW).first()
    assert b.sections == "stale data" and b.any_fire and b.water_skipped
    sched = spark.createDataFrame([(NOW.date() + dt.timedelta(days=3),), (NOW.date(),)], "next_due_date date") \
        .withColumn("notes", F.lit(None).cast("string"))
    fire = _readings(spark, [{"ts": NOW - dt.timedelta(minutes=1), "value": 2.0}])
    b = al.bundle(fire, sched, NOW).first()
    assert b.sections == "hydro < 5 kW · water sampling due"
    quiet = _readings(spark, [{"ts": NOW - dt.timedelta(minutes=1), "value": 50.0}])
    b = al.bundle(quiet, None, NOW).first()
    assert not b.any_fire and b.sections == ""
    assert b.fingerprint.startswith("STALE\n\nHYDRO\n0|50.00|power_instantaneous\nWATER\nskip|0\nALRM\n")


def test_cooldown(spark):
    fire = _readings(spark, [{"ts": NOW - dt.timedelta(minutes=1), "value": 2.0}])
    b = al.bundle(fire, None, NOW)
    empty_state = spark.createDataFrame([], SC.ALERT_STATE)
    d, state = al.cooldown(b, empty_state, NOW)
    assert d.first().send is True and state.count() == 1
    d2, state2 = al.cooldown(b, state, NOW + dt.timedelta(minutes=30))
    assert d2.first().send is False and d2.first().reason == "cooldown_same_bundle_payload"
    d3, _ = al.cooldown(b, state2, NOW + dt.timedelta(minutes=400))
    assert d3.first().send is True
    d4, _ = al.cooldown(b, state, NOW + dt.timedelta(minutes=30), force=True)
    assert d4.first().send is True


def test_sustained(spark):
    ev = spark.createDataFrame([("r", NOW + dt.timedelta(minutes=15 * i), c) for i, c in
                                enumerate([True, True, True, True, True, False, True])],
                               "rule string, tick timestamp, condition boolean")
    out = [r.firing for r in al.sustained(ev, by=["rule"], for_minutes=60).orderBy("tick").collect()]
    assert out == [False, False, False, False, True, False, False]


def test_sustained_is_the_same_for_any_slice(spark):
    import random
    r = random.Random(4)
    rows = [(k, NOW + dt.timedelta(minutes=15 * i), r.random() < 0.8) for k in ("a", "b") for i in range(200)]
    ev = spark.createDataFrame(rows, "rule string, tick timestamp, condition boolean")
    want, since = {}, {}
    for k, t, c in rows:
        since[k] = (since.get(k) or t) if c else None
        want[k, t] = bool(c and t - since[k] >= dt.timedelta(minutes=60))
    for ms in (60_000, 3_600_000, 10**12):
        assert {(x.rule, x.tick): x.firing for x in al.sustained(ev, by=["rule"], for_minutes=60, slice_ms=ms).collect()} == want


def test_fixed_two_decimals_follow_the_binary_value(spark):
    cases = {10.235: "10.23", 1.005: "1.00", 8.345: "8.35", 0.125: "0.13", -0.125: "-0.13", 10.24: "10.24", 0.0: "0.00", 1e6 + 0.555: "1000000.56", -0.001: "0.00"}
    df = spark.createDataFrame([(k, v) for k, v in cases.items()], "x double, want string")
    from decimal import ROUND_HALF_UP, Decimal
    for r in df.select("x", "want", al.to_fixed2(F.col("x")).alias("got")).collect():
        assert abs(Decimal(r.got)) == abs(Decimal(r.x)).quantize(Decimal("0.01"), ROUND_HALF_UP), (r.x, r.got)
        assert r.got == r.want


def test_alert_job_cooldown_state(spark, tmp_path):
    from sluice.plans.alerts_job import run_alerts
    from sluice.sinks.tables import IngestTables, with_dt
    t = IngestTables(spark, str(tmp_path / "tables"))
    t.readings.append(with_dt(_readings(spark, [{"ts": NOW - dt.timedelta(minutes=5), "value": 1.0}])))
    b, d = run_alerts(spark, str(tmp_path / "tables"), NOW)
    assert b.first().water_skipped and d.first().send
    assert t.alert_state.read().count() == 1
    _, d2 = run_alerts(spark, str(tmp_path / "tables"), NOW + dt.timedelta(minutes=10))
    assert not d2.first().send and d2.first().reason == "cooldown_same_bundle_payload"

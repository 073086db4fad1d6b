"""Trapezoidal flow integral and monthly summary (FIXTURES §6) and chunked-window equivalence."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from sluice.operators import flow

TZ = "America/Los_Angeles"
START = dt.datetime(2026, 1, 1, 8, 0)  # local midnight in UTC


def _rows(spark, data):
    return spark.createDataFrame(data, "record_ts timestamp, metric_value double, serial string, source_file_id long")


def test_intervals_fixture(spark):
    rows = _rows(spark, [
        (dt.datetime(2026, 1, 1, 8, 10), 100.0, "S", 1),
        (dt.datetime(2026, 1, 1, 8, 20), 200.0, "S", 1),
        (dt.datetime(2026, 1, 1, 8, 20), 50.0, "S", 2),
        (dt.datetime(2026, 2, 1, 8, 0), 50.0, "S", 3),
    ])
    iv = flow.flow_intervals(rows, F.lit(START)).orderBy("record_ts", "source_file_id").collect()
    assert [r.dt_minutes for r in iv] == [10.0, 10.0, 0.0, 44620.0]
    assert [r.gallons for r in iv] == [1000.0, 1500.0, 0.0, 44620.0 * 50]
    m = {r.month: r for r in flow.monthly_summary(flow.flow_intervals(rows, F.lit(START)),
                                                    year=2026, end_inclusive="2026-03-31", tz=TZ).collect()}
    assert m["2026-01"].gallons == 2500 and m["2026-01"].minutes == 20 and m["2026-01"].avg_gpm == 125
    assert round(m["2026-01"].acre_feet, 4) == 0.0077
    assert m["2026-02"].avg_gpm == 50 and round(m["2026-02"].acre_feet, 4) == 6.8467
    assert m["2026-03"].gallons == 0 and m["2026-03"].avg_gpm is None and m["2026-03"].acre_feet == 0
    assert m["total"].gallons == 2500 + 2231000


def test_negative_interval_and_scale(spark):
    rows = _rows(spark, [(dt.datetime(2026, 1, 1, 7, 0), 10.0, "S", 1), (dt.datetime(2026, 1, 1, 7, 30), 10.0, "S", 1)])
    iv = flow.flow_intervals(rows, F.lit(START), scale=4).orderBy("record_ts").collect()
    assert iv[0].gallons == 0 and iv[0].dt_minutes == 0          # before the period start
    assert iv[1].gallons == 40.0 * 30 and iv[1].gpm == 40.0
    with pytest.raises(ValueError):
        flow.flow_intervals(rows, F.lit(START), scale=0)


def test_empty_window_on_new_year(spark):
    spine = flow.month_spine(spark, 2027, "2026-12-31")
    assert spine.count() == 0


def _global(rows):
    """Plain Python reference: one ordered pass over the whole series."""
    rows = sorted(rows, key=lambda r: (r[0], r[2], r[3]))
    out, prev = [], None
    start_ms = int(START.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    for ts, v, s, f in rows:
        t = int(ts.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
        if prev is None:
            d, rate = t - start_ms, v
        else:
            d, rate = t - prev[0], (v + prev[1]) / 2
        out.append(((ts, s, f), 0.0 if d < 0 else rate * (d / 60000.0)))
        prev = (t, v)
    return dict(out)


@pytest.mark.parametrize("slice_ms", [3_600_000, 60_000, 86_400_000])
def test_chunked_equals_global(spark, slice_ms):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        ts = START + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 20), milliseconds=rnd.randint(0, 999))
        data.append((ts, round(rnd.uniform(0, 500), 2), f"S{rnd.randint(0, 2)}", rnd.randint(0, 9)))
    rows = _rows(spark, data)
    iv = flow.flow_intervals(rows, F.lit(START), slice_ms=slice_ms)
    got = {(r.record_ts, r.serial, r.source_file_id): r.gallons for r in iv.collect()}
    want = _global(data)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) <= 1e-9 * max(1.0, abs(want[k])) for k in want)


def test_distinct_on_prefers_flow_avg_a(spark):
    rows = spark.createDataFrame([
        (dt.datetime(2026, 1, 2), 1.0, "S", 1, "flow_avg"),
        (dt.datetime(2026, 1, 2), 2.0, "S", 2, "flow_avg_A"),
        (dt.datetime(2026, 1, 3), 3.0, "S", 1, "flow_avg"),
    ], "record_ts timestamp, metric_value double, serial string, source_file_id long, metric_key string")
    out = {r.record_ts.day: r.metric_value for r in flow.distinct_on_instant(rows).collect()}
    assert out == {2: 2.0, 3: 3.0}


def test_first_shuffle_is_on_the_slice(spark):
    rows = spark.createDataFrame([(dt.datetime(2024, 1, 1), 1.0, "a", 1)], "record_ts timestamp, metric_value double, serial string, source_file_id bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = flow.flow_intervals(rows, F.lit(START))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and all("_slice" in line for line in exchanges)


# --- segments -----------------------------------------------------------------------------------

def _series(seed, n=500, days=70):
    r = random.Random(seed)
    out = []
    for k in range(n):
        v = r.choice([r.uniform(0, 500)] * 9 + [float("nan")])
        out.append((START + dt.timedelta(milliseconds=r.randint(-3_600_000, days * 86_400_000)), v, r.choice("AB"), r.randint(1, 3)))
    # several readings of one instant, and times on both sides of a month's end in the zone
    out += [(START + dt.timedelta(days=5), 7.0, s, f) for s in "AB" for f in (1, 2)]
    out += [(dt.datetime(2026, 2, 1, 8, 0) + dt.timedelta(milliseconds=ms), 9.0, "A", 1) for ms in (-1, 0, 1)]
    return out


def _months(df):
    return {x.month: (round(x.gallons, 6), round(x.minutes, 6), x.avg_gpm and round(x.avg_gpm, 9)) for x in df.collect()}


@pytest.mark.parametrize("slice_ms", [60_000, 900_000, 3_600_000, 86_400_000 * 40])
def test_segments_equal_the_window_form(spark, slice_ms):
    from sluice.operators import segments as sg
    rows = _rows(spark, _series(1)).repartition(5)
    args = dict(year=2026, end_inclusive="2026-04-30")
    want = flow.monthly_summary(flow.flow_intervals(rows, F.lit(START)), tz=TZ, **args)
    assert _months(sg.monthly_from_segments(sg.flow_segments(rows, tz=TZ, slice_ms=slice_ms), F.lit(START), **args)) == _months(want)


def test_late_readings_change_their_slices_only(spark):
    from sluice.operators import segments as sg
    data = _series(2)
    late = [data[k] for k in range(0, len(data), 25)]
    early = _rows(spark, [x for k, x in enumerate(data) if k % 25])
    rows, args = _rows(spark, data), dict(year=2026, end_inclusive="2026-04-30")
    before = sg.flow_segments(early, tz=TZ)
    after = sg.refresh(before, rows, _rows(spark, late), tz=TZ)
    fields = lambda df: {(x.month, x.slice): str(x) for x in df.collect()}
    a, b, want = fields(before), fields(after), fields(sg.flow_segments(rows, tz=TZ))
    assert b == want
    touched = {int(x[0].replace(tzinfo=dt.timezone.utc).timestamp() * 1000) // 3_600_000 for x in late}
    assert {k for k in b if a.get(k) != b[k]} <= {k for k in b if k[1] in touched}
    assert _months(sg.monthly_from_segments(after, F.lit(START), **args)) == _months(flow.monthly_summary(flow.flow_intervals(rows, F.lit(START)), tz=TZ, **args))


def test_combining_is_associative_and_rows_are_shuffled_once(spark):
    from sluice.operators import segments as sg
    rows = _rows(spark, [x for x in _series(3) if x[1] == x[1]])
    s = sg.flow_segments(rows, tz=TZ)
    days = sg.merge(s.withColumn("day", F.floor(F.col("slice") / 24)), ["month", "day"])
    by_day = {x.month: x for x in sg.merge(days, ["month"]).collect()}
    direct = {x.month: x for x in sg.merge(s, ["month"]).collect()}
    for k, x in direct.items():
        y = by_day[k]
        assert (x.first_t, x.last_t, x.first_v, x.last_v) == (y.first_t, y.last_t, y.first_v, y.last_v)
        assert x.gallons == pytest.approx(y.gallons) and x.minutes == pytest.approx(y.minutes)
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert plan.split("Initial Plan")[-1].count("Exchange hashpartitioning") == 1


def test_segments_by_series_and_before_the_period(spark):
    from sluice.operators import segments as sg
    data = [(dt.datetime(2026, 1, 1, 7, 0), 10.0, "S", 1), (dt.datetime(2026, 1, 1, 7, 30), 10.0, "S", 1),
            (dt.datetime(2026, 1, 1, 9, 0), 30.0, "T", 1), (dt.datetime(2026, 1, 1, 9, 10), 50.0, "T", 1)]
    rows, args = _rows(spark, data), dict(year=2026, end_inclusive="2026-01-31")
    want = flow.monthly_summary(flow.flow_intervals(rows, F.lit(START), series=["serial"], scale=4), tz=TZ, **args)
    got = sg.monthly_from_segments(sg.flow_segments(rows, tz=TZ, series=["serial"], scale=4), F.lit(START), series=["serial"], **args)
    assert _months(got) == _months(want)
    assert _months(sg.monthly_from_segments(sg.flow_segments(rows.limit(0), tz=TZ), F.lit(START), **args)) == {"2026-01": (0, 0, None), "total": (0, 0, None)}

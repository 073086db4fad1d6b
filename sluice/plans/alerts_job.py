"""One alert evaluation over the stored tables.

bundle (stale groups, hydro check, water due, alarm rows) → fingerprint → cooldown against
the stored alert state → the new state is written only when the bundle fires and is sent.
Delivery (e-mail) is outside the library: callers act on ``decision.send``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession

from sluice.operators import alerts as al
from sluice.session import configure
from sluice.sinks.tables import IngestTables


def run_alerts(spark: SparkSession, tables_root: str, as_of: _dt.datetime, *, stale_after_minutes: int = 240,
               cooldown_minutes: int = 360, hydro_recent_minutes: int = 60, hydro_min_kw: float = 5.0,
               alarm_lookback_minutes: int = 240, alarm_limit: int = 40, force: bool = False,
               dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """Returns (bundle row, decision row)."""
    configure(spark)
    t = IngestTables(spark, tables_root)
    schedule = t.schedule.read() if t.schedule.current() is not None else None   # A6: skipped when absent
    # Stale groups and the hydro check ask for latest readings, which the summary holds; history is not read.
    b = al.bundle(t.latest_df(), schedule, as_of, stale_after_minutes=stale_after_minutes,
                  hydro_recent_minutes=hydro_recent_minutes, hydro_min_kw=hydro_min_kw,
                  alarm_lookback_minutes=alarm_lookback_minutes, alarm_limit=alarm_limit,
                  recent=t.readings_df(as_of - _dt.timedelta(minutes=alarm_lookback_minutes)))
    b = spark.createDataFrame(b.collect(), b.schema)   # one row: evaluate the bundle once
    decision, new_state = al.cooldown(b, t.alert_state.read(), as_of, cooldown_minutes=cooldown_minutes,
                                      force=force)
    decision = spark.createDataFrame(decision.collect(), decision.schema)  # one row
    if not dry_run and decision.first().send:
        t.alert_state.replace(new_state)
    return b, decision

"""Stateful streaming operators.

* ``bucket_avg_stream`` — G3 over a readings stream (event-time windows, watermark bounds state).
* ``first_wins_stream`` — W3 over a readings stream, duplicates of earlier micro-batches included.
* ``stale_groups_stream`` — A1: when each group fell silent and when it reported again.
* ``sustained_stream`` — A5 ``evaluate_for`` per rule over a stream of evaluations.
* ``cooldown_stream`` — A9: suppress a payload already sent within the cooldown.

The alert operators are ``transformWithState`` processors that decide in event time: what arrives is
kept until the watermark has passed it, and is then taken in the order of time, whatever trigger,
file or Arrow batch it came in.  Shuffled and late input gives what the batch operators give; only rows
behind the watermark are dropped.  State is per key (group, rule, alert key) and holds what the
watermark has not passed.  It lives in the RocksDB state store, which ``session.configure`` selects.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from sluice.session import configure

# Workers need not have the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def bucket_avg_stream(readings: DataFrame, interval: str = "1 hour", watermark: str = "2 hours",
                      by: tuple[str, ...] = ()) -> DataFrame:
    """G3 on a stream: average per (bucket, *by); a bucket is emitted once the watermark passes it."""
    return (readings.withWatermark("record_ts", watermark)
            .groupBy(F.window("record_ts", interval).alias("w"), *by)
            .agg(F.avg("metric_value").alias("value"), F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("time"), *by, "value", "n"))


def first_wins_stream(readings: DataFrame, watermark: str = "1 day",
                      key: Sequence[str] = ("source_file_id", "serial", "record_ts", "metric_key")) -> DataFrame:
    """W3 on a stream: of readings with equal ``key`` the one that arrives first, as long as the others
    arrive within ``watermark``, after which the key is forgotten."""
    return readings.withWatermark("record_ts", watermark).dropDuplicatesWithinWatermark(list(key))


class InTimeOrder(StatefulProcessor):
    """Keeps rows (``t`` in microseconds, then ``fields``) until the watermark has passed them, and hands them
    to ``step`` in the order of time: step(state or None, row) -> (state, output after key and t)."""

    def __init__(self, fields: str, state: str, step: Callable, output: Sequence[str]):
        self.fields, self.state, self.step, self.output = fields, state, step, list(output)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", f"t long, {self.fields}")
        self.memory = handle.getValueState("memory", self.state)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for pdf in rows:
            new = [tuple(None if pd.isna(v) else v for v in r) for r in pdf[pdf.columns[1:]].astype(object).itertuples(index=False)]
            self.waiting.appendList(new)
            low = min(r[0] for r in new)
            first = low if first is None else min(first, low)
        if first is not None:
            self.handle.registerTimer(-(-first // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        held = list(self.waiting.get())
        ready = sorted((r for r in held if r[0] <= passed), key=lambda r: r[0])
        if not ready:
            return
        rest = [r for r in held if r[0] > passed]
        if rest:
            self.waiting.put(rest)
            self.handle.registerTimer(-(-min(r[0] for r in rest) // 1000))
        else:
            self.waiting.clear()
        state, out = self.memory.get(), []
        for r in ready:
            state, row = self.step(state, r)
            out.append((key[0], r[0], *row))
        if state is not None:
            self.memory.update(state)
        yield pd.DataFrame(out, columns=self.output)

    def close(self) -> None:
        pass


def _ordered(df: DataFrame, key: str, ts: str, watermark: str, processor: StatefulProcessor, columns: Sequence[str], schema: str) -> DataFrame:
    configure(df.sparkSession)
    rows = df.withWatermark(ts, watermark).select(F.col(key), F.unix_micros(F.col(ts)).alias("t"), *columns)
    out = rows.groupBy(key).transformWithStateInPandas(processor, f"{key} string, t long, {schema}", "append", "EventTime")
    return out.withColumn("t", F.timestamp_micros("t")).withColumnRenamed("t", ts)


def cooldown_stream(bundles: DataFrame, cooldown_minutes: int = 360, watermark: str = "0 seconds") -> DataFrame:
    """A9 on a stream of evaluated bundles ``(alert_key, eval_ts, any_fire, fingerprint)``: one decision per
    bundle, once the watermark has passed it — send unless the same payload was sent within the
    cooldown.  The state per alert key is the last sent payload and time, written only after a send."""
    cool = cooldown_minutes * 60_000_000

    def step(state, row):
        t, fires, payload = row
        if not fires:
            return state, (False, "nothing_firing")
        if state is not None and payload is not None and state[1] == payload and t - state[0] < cool:
            return state, (False, "cooldown_same_bundle_payload")
        return (t, payload), (True, None)

    processor = InTimeOrder("any_fire boolean, fingerprint string", "last_at long, last_payload string", step,
                            ["alert_key", "t", "send", "reason"])
    return _ordered(bundles, "alert_key", "eval_ts", watermark, processor, ["any_fire", "fingerprint"], "send boolean, reason string")


def sustained_stream(evaluations: DataFrame, for_minutes: int, watermark: str = "0 seconds") -> DataFrame:
    """A5 on a stream of ``(rule, tick, condition)``: a tick fires once its run of true ticks has lasted
    ``for_minutes``; it comes out when the watermark has passed it.  The state per rule is the start
    of the current run."""
    need = for_minutes * 60_000_000

    def step(state, row):
        t, holds = row
        if not holds:
            return (None,), (False, False, False)
        since = t if state is None or state[0] is None else state[0]
        held = t - since >= need
        return (since,), (True, held, not held)

    processor = InTimeOrder("condition boolean", "since long", step, ["rule", "t", "condition", "firing", "pending"])
    return _ordered(evaluations, "rule", "tick", watermark, processor, ["condition"], "condition boolean, firing boolean, pending boolean")


class Silences(StatefulProcessor):
    """When a group fell silent for longer than ``after`` microseconds, and when it reported again.

    Of the readings the watermark has not passed only the first and the last of each span of length
    ``after`` are kept: between readings of one span no silence fits."""

    def __init__(self, after: int):
        self.after = after

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.spans = handle.getMapState("spans", "span long", "first long, last long")
        self.memory = handle.getValueState("memory", "last long, stale boolean")

    def _wake(self, t: int) -> None:
        self.handle.registerTimer(-(-t // 1000))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for pdf in rows:
            for span, t in pdf.groupby(pdf["t"] // self.after)["t"]:
                low, high = int(t.min()), int(t.max())
                old = self.spans.getValue((int(span),)) if self.spans.containsKey((int(span),)) else (low, high)
                self.spans.updateValue((int(span),), (min(low, old[0]), max(high, old[1])))
                self._wake(min(low, old[0]))
                self._wake((int(span) + 1) * self.after)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs() * 1000
        last, stale = self.memory.get() or (None, False)
        out = []
        for (span,), (first, high) in sorted(self.spans.iterator()):
            if first > passed:
                break
            if last is not None and first - last > self.after:
                if not stale:
                    out.append((last, "stale"))
                out.append((first, "fresh"))
                stale = False
            elif stale and last is not None and first > last:
                out.append((first, "fresh"))
                stale = False
            last = first if last is None else max(last, first)
            if (span + 1) * self.after > passed:
                break       # more of this span may come; no silence ends inside it
            last = max(last, high)
            self.spans.removeKey((span,))
        if last is not None:
            if not stale and passed - last > self.after:
                out.append((last, "stale"))
                stale = True
            elif not stale:
                self._wake(last + self.after + 1000)
            self.memory.update((last, stale))
        if out:
            yield pd.DataFrame([(key[0], t, s) for t, s in out], columns=["physical_group", "t", "status"])

    def close(self) -> None:
        pass


def stale_groups_stream(readings: DataFrame, stale_after_minutes: int = 240, watermark: str = "10 minutes"
                        ) -> DataFrame:
    """A1: ``(physical_group, latest_ts, status)`` — ``stale`` with the last reading before each silence
    of more than ``stale_after_minutes`` of event time, once the watermark has passed that span, and
    ``fresh`` with the reading that ends it."""
    configure(readings.sparkSession)
    rows = readings.withWatermark("record_ts", watermark).select(
        F.coalesce(F.col("physical_group"), F.lit("unknown")).alias("physical_group"), F.unix_micros("record_ts").alias("t"))
    out = rows.where(F.col("t").isNotNull()).groupBy("physical_group").transformWithStateInPandas(
        Silences(stale_after_minutes * 60_000_000), "physical_group string, t long, status string", "append", "EventTime")
    return out.select("physical_group", F.timestamp_micros("t").alias("latest_ts"), "status")

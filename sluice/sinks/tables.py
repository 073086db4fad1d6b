"""Parquet table sinks with idempotent write semantics (K1-K5, K7-K10 writes).

Each table lives under ``<root>/<name>/_v=<n>/`` (parquet, optionally partitioned).  Readers
use the highest committed version (one with a ``_SUCCESS`` marker):

* ``append``  adds files to the current version (new batches of records / readings);
* ``replace`` writes the full new contents as version ``n+1`` — the copy-on-write step behind
  upserts (K1), schedule imports (K5), deletes (K7, K9) and resets (K10).  The version
  being read is never overwritten; the switch happens when the new version commits;
* ``replace_partitions`` overwrites whole partitions of the current version (the days that a
  replay or a correction touches).

Filesystem calls go through the Hadoop FileSystem of the session, so the same code works
on HDFS, object stores and local disks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice import schemas as SC
from sluice.operators.summary import latest_readings, partials, bucket_averages, span_start


class Table:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()):
        self.spark, self.path, self.schema, self.partition_by = spark, path.rstrip("/"), schema, list(partition_by)

    # -- filesystem helpers -------------------------------------------------------------
    def _fs(self):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(self.path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), jvm

    def versions(self, committed: bool = True) -> list[int]:
        """Version numbers; with ``committed`` false also those of writes that were cut short."""
        fs, jvm = self._fs()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        if not fs.exists(root):
            return []
        out = []
        for st in fs.listStatus(root):
            name = st.getPath().getName()
            if st.isDirectory() and name.startswith("_v="):
                if not committed or fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                    out.append(int(name[3:]))
        return sorted(out)

    def current(self) -> int | None:
        v = self.versions()
        return v[-1] if v else None

    def _next(self) -> int:
        """A number no write has used, finished or not: a crashed write never blocks the next one."""
        v = self.versions(committed=False)
        return v[-1] + 1 if v else 0

    def _vpath(self, v: int) -> str:
        return f"{self.path}/_v={v:012d}"

    # -- reads / writes -----------------------------------------------------------------
    def read(self) -> DataFrame:
        v = self.current()
        if v is None:
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.schema(self.schema).parquet(self._vpath(v))
        return df.select(*self.schema.fieldNames())

    def _writer(self, df: DataFrame):
        w = df.select(*self.schema.fieldNames()).write
        return w.partitionBy(*self.partition_by) if self.partition_by else w

    def append(self, df: DataFrame) -> None:
        v = self.current()
        if v is None:
            self._writer(df).mode("errorifexists").parquet(self._vpath(self._next()))
        else:
            self._writer(df).mode("append").parquet(self._vpath(v))

    def replace(self, df: DataFrame) -> int:
        v = self._next()
        self._writer(df).mode("errorifexists").parquet(self._vpath(v))
        return v

    def replace_partitions(self, df: DataFrame, emptied: Sequence[dict] = ()) -> None:
        """Dynamic partition overwrite inside the current version; ``emptied`` lists partition
        specs (column → value) whose rows must disappear although ``df`` has none for them."""
        v = self.current()
        if v is None:
            self.append(df)
            v = self.current()
        prev = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            self._writer(df).mode("overwrite").parquet(self._vpath(v))
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)
        fs, jvm = self._fs()
        for spec in emptied:
            sub = "/".join(f"{k}={_escape(str(val))}" for k, val in spec.items())
            p = jvm.org.apache.hadoop.fs.Path(f"{self._vpath(v)}/{sub}")
            if fs.exists(p):
                fs.delete(p, True)


def _escape(v: str) -> str:
    # Hive-style partition path escaping for the characters that occur in file names.
    out = []
    for ch in v:
        if ch in '"#%\'*/:=?\\\x7f{[]^' or ord(ch) < 32:
            out.append("%{:02X}".format(ord(ch)))
        else:
            out.append(ch)
    return "".join(out)


class IngestTables:
    """The ingest tables under one root (registry, records, readings, checkpoint, and the summary of the
    readings), plus the schedule and the alert state."""

    def __init__(self, spark: SparkSession, root: str):
        r = root.rstrip("/")
        self.registry = Table(spark, f"{r}/registry", SC.REGISTRY)
        self.records = Table(spark, f"{r}/records", SC.RECORDS)
        self.readings = Table(spark, f"{r}/readings",
                              T.StructType(SC.READINGS.fields + [T.StructField("dt", T.DateType())]), ["dt"])
        self.checkpoint = Table(spark, f"{r}/checkpoint", SC.CHECKPOINT)
        self.schedule = Table(spark, f"{r}/schedule", SC.SCHEDULE, ["source_file"])
        self.alert_state = Table(spark, f"{r}/alert_state", SC.ALERT_STATE)
        self.summary = Table(spark, f"{r}/summary", SC.SUMMARY, ["dt"])

    def readings_df(self, ts_from=None, ts_to=None) -> DataFrame:
        """Stored readings; with bounds on ``record_ts`` only the partitions that can hold such rows
        are read (days of any zone: a day wider on both sides).  The bounds prune, they do not filter."""
        df = self.readings.read()
        if ts_from is not None:
            df = df.where(F.col("dt") >= F.date_sub(F.lit(ts_from).cast("timestamp").cast("date"), 1))
        if ts_to is not None:
            df = df.where(F.col("dt") <= F.date_add(F.lit(ts_to).cast("timestamp").cast("date"), 1))
        return df.drop("dt")

    def latest_df(self) -> DataFrame:
        """Readings among which every latest one is: the latest of each partial of the summary, or all,
        where readings were stored before there was a summary."""
        return latest_readings(self.summary.read()) if self.summary.current() is not None else self.readings_df()

    def bucket_series(self, interval: str, where: Column, ts_from, ts_to, by: Sequence[str] = ()) -> DataFrame:
        """G3 over ``[ts_from, ts_to]`` from the summary: spans inside the range are partials, those it
        cuts are read as readings.  ``where``: a condition on group, source, metric or unit."""
        a, b = (F.lit(x).cast("timestamp") for x in (ts_from, ts_to))
        first = span_start(a) + F.when(span_start(a) < a, F.make_dt_interval(F.lit(0), F.lit(1))).otherwise(F.make_dt_interval(F.lit(0), F.lit(0)))
        last = span_start(b)
        inside = (F.col("span") >= first) & (F.col("span") < last)
        partial = self.summary.read().where((F.col("dt") >= F.to_date(a)) & (F.col("dt") <= F.to_date(b)) & inside)
        ts = F.col("record_ts")
        edge = lambda lo, hi: self.readings.read().where((F.col("dt") == F.to_date(lo)) & (ts >= a) & (ts <= b) & (ts >= lo) & hi)
        # The cut spans: before the first whole one, and from the last one on (a single one, if none is whole).
        head = edge(span_start(a), (ts < first) & (ts < last))
        tail = edge(last, ts <= b)
        return bucket_averages(partial, head.unionByName(tail), interval, where, by)


def with_dt(readings: DataFrame) -> DataFrame:
    """Partition column of the readings table (UTC date).  Queries on ``record_ts`` should
    also filter ``dt`` to prune partitions."""
    return readings.withColumn("dt", F.to_date("record_ts"))


# --- K1-K4 --------------------------------------------------------------------------------

def upsert_registry(t: IngestTables, new_rows: DataFrame) -> bool:
    """K1: insert new (key, version) rows, update existing ones except ``ingested_at``.  Rows that
    are all new, the usual case, are appended; only a batch that repeats objects (a retry or a
    replay) rewrites the table, which has one row per object.  True if there were such rows."""
    keys = ["object_key", "version_token"]
    old = t.registry.read()
    again = old.join(new_rows.select(*keys), keys, "left_semi").select(*keys, F.col("ingested_at").alias("_old_at"))
    if not again.head(1):
        t.registry.append(new_rows)
        return False
    new = new_rows.join(again, keys, "left").withColumn("ingested_at", F.coalesce("_old_at", "ingested_at")).drop("_old_at")
    rest = old.join(new_rows.select(*keys), keys, "left_anti")
    t.registry.replace(rest.unionByName(new.select(*SC.REGISTRY.fieldNames())))
    return True


def write_batch(t: IngestTables, registry: DataFrame, records: DataFrame, readings: DataFrame,
                run_id: str, processed_at) -> None:
    """One ingest batch: registry, then records and readings, checkpoint last.

    Re-running a batch cut short before its checkpoint (or a replayed file) finds its files
    already registered; for those files only, records are kept insert-if-absent on
    (file_id, line_no) and readings on (serial, record_ts, metric_key, source_file_id) by an
    anti-join restricted to the batch's file ids and, for readings, to the days the batch holds.
    A batch of new files reads none of the stored rows.  Failed files get a registry row and no
    checkpoint, so the next run retries them."""
    files = registry.select("file_id")
    if upsert_registry(t, registry):
        old_records = t.records.read().join(files, "file_id", "left_semi").select("file_id", "line_no")
        records = records.join(old_records, ["file_id", "line_no"], "left_anti")
        rk = ["serial", "record_ts", "metric_key", "source_file_id"]
        span = readings.agg(F.min(F.to_date("record_ts")).alias("a"), F.max(F.to_date("record_ts")).alias("b")).first()
        old_readings = (t.readings.read().where(F.col("dt").between(F.lit(span.a), F.lit(span.b)))
                        .join(files.select(F.col("file_id").alias("source_file_id")), "source_file_id", "left_semi").select(*rk))
        readings = readings.join(old_readings, rk, "left_anti")
        # What a run cut short has summed up is not known: the days are summed up anew.
        t.records.append(records)
        t.readings.append(with_dt(readings))
        rebuild_summary(t, between=(span.a, span.b))
    else:
        t.records.append(records)
        t.readings.append(with_dt(readings))
        t.summary.append(partials(readings))

    ok = registry.where(F.col("parse_status") == "parsed").select(
        "object_key", "version_token", F.lit(run_id).alias("run_id"),
        F.lit(processed_at).cast("timestamp").alias("processed_at"))
    mark_processed(t, ok)


def rebuild_summary(t: IngestTables, days: Sequence | None = None, between: tuple | None = None) -> None:
    """The summary of some days (all without), from the stored readings.  Also folds the partials that
    single batches wrote into one per span and series."""
    readings = t.readings.read()
    if between is not None:
        if between[0] is None:
            return
        readings = readings.where(F.col("dt").between(F.lit(between[0]), F.lit(between[1])))
    elif days is not None:
        readings = readings.where(F.col("dt").isin(list(days)))
    new = partials(readings.drop("dt"))
    if days is None and between is None:
        t.summary.replace(new)
    else:
        t.summary.replace_partitions(new)


def mark_processed(t: IngestTables, rows: DataFrame) -> None:
    """K4: checkpoint insert-if-absent on (key, version): an append of the absent rows."""
    old = t.checkpoint.read().select("object_key", "version_token")
    t.checkpoint.append(rows.join(old, ["object_key", "version_token"], "left_anti"))


# --- K7-K10: stored tables -----------------------------------------------------------------

def replay_devices(t: IngestTables, devices=None) -> dict[str, int]:
    """K7 as a job: forget the stored rows of some devices' files, so that the next run ingests
    these files again.  Of the readings only the days that lose rows are rewritten.  Returns the
    three counts of deleted rows."""
    from sluice.operators import replay as R

    devices = R.DEFAULT_FLOW_DEVICES if devices is None else devices
    readings, records, checkpoints = t.readings.read(), t.records.read(), t.checkpoint.read()
    out = R.replay_flow_devices(t.registry.read(), records, readings, checkpoints, devices)
    counts = out["counts"].first().asDict()
    _rewrite_days(t, readings, out["readings"])
    if counts["raw_deleted"]:
        t.records.replace(out["records"])
    if counts["checkpoints_deleted"]:
        t.checkpoint.replace(out["checkpoints"])
    return counts


def correct_booster(t: IngestTables, device: str = "mb-003") -> None:
    """K8 as a job: the corrected rows' days are rewritten, no other partition is touched."""
    from sluice.operators import replay as R

    readings = t.readings.read()
    _rewrite_days(t, readings, R.correct_booster_group(readings, device))


def _rewrite_days(t: IngestTables, before: DataFrame, after: DataFrame) -> None:
    """Store ``after`` in place of ``before`` in the days (partitions) in which they differ; the days
    are few and named on the driver, the rows are not.  New contents are first written apart,
    because a partition cannot be read while it is replaced."""
    key = F.xxhash64(*[F.col(c) for c in SC.READINGS.fieldNames()]).cast("decimal(38,0)")
    total = lambda df, n: df.groupBy("dt").agg(F.count(F.lit(1)).alias(f"n_{n}"), F.sum(key).alias(f"s_{n}"))
    both = total(before, "a").join(total(after, "b"), "dt", "left")
    days = [r.dt for r in both.where(~(F.col("n_a").eqNullSafe(F.col("n_b")) & F.col("s_a").eqNullSafe(F.col("s_b")))).select("dt").collect()]
    if not days:
        return
    side = Table(t.readings.spark, f"{t.readings.path}_rewrite", t.readings.schema, ["dt"])
    side.replace(after.where(F.col("dt").isin(days)))
    new = side.read()
    kept = {r.dt for r in new.select("dt").distinct().collect()}
    gone = [{"dt": d} for d in days if d not in kept]
    t.readings.replace_partitions(new, gone)
    if t.summary.current() is not None:
        t.summary.replace_partitions(partials(new.drop("dt")), gone)


def forget_object(t: IngestTables, object_key: str, version_token: str | None) -> None:
    """K9 as a job: one object's checkpoint goes; the next run ingests the object again."""
    from sluice.operators import replay as R

    t.checkpoint.replace(R.replay_file(t.checkpoint.read(), object_key, version_token))


def reset(t: IngestTables) -> None:
    """K10 as a job: registry, records, readings (with their summary) and checkpoint become empty; the
    schedule stays."""
    for table in (t.registry, t.records, t.readings, t.checkpoint, t.summary):
        table.replace(table.spark.createDataFrame([], table.schema))


# --- K5 ------------------------------------------------------------------------------------

def replace_schedule_files(t: IngestTables, rows: DataFrame, imported_files: Sequence[str], imported_at) -> None:
    """K5: an import replaces every row of its source files (and nothing else); a file whose import
    produced no rows is cleared.  The table, a few rows per well, is written as a new version, so
    that a reader sees all of the old rows or all of the new, and an import that fails changes nothing."""
    new = rows.withColumn("imported_at", F.lit(imported_at).cast("timestamp")).select(*SC.SCHEDULE.fieldNames())
    others = t.schedule.read().where(~F.col("source_file").isin(list(imported_files)) | F.col("source_file").isNull())
    t.schedule.replace(others.unionByName(new))

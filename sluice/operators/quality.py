"""Data-quality checks and run diagnostics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.operators.flow import plant_predicate


def has_data_conflicts(layout: DataFrame) -> DataFrame:
    """Q1: files of devices flagged hasData=false whose headers still look measurable
    (first five shown)."""
    return layout.where(~F.col("has_data") & (F.size("measurable_headers") > 0)).select(
        "file_id", "object_key", "device_address",
        F.array_join(F.slice("measurable_headers", 1, 5), " | ").alias("measurable_preview"))


def file_diagnostics(layout: DataFrame, lines: DataFrame, candidates: DataFrame) -> DataFrame:
    """Q2/Q3: per-file record and melted-reading counts with the two warning flags, which only files of
    devices with data get.

    ``candidates`` are melted readings before the timestamp filter (F3) and de-duplication.
    Both counts are partial aggregates keyed by file (one row per file after the shuffle)."""
    rec = lines.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_records"))
    tall = candidates.groupBy("file_id").agg(F.count(F.lit(1)).alias("n_tall"),
                                             F.count("record_ts").alias("n_tall_with_ts"))
    f = layout.select("file_id", "object_key", "device_address", "schema_id", "has_data")
    j = f.join(rec, "file_id", "left").join(tall, "file_id", "left").fillna(0, ["n_records", "n_tall", "n_tall_with_ts"])
    return j.withColumn("no_readings", F.col("has_data") & (F.col("n_records") > 0) & (F.col("n_tall") == 0)) \
        .withColumn("no_timestamps", F.col("has_data") & (F.col("n_tall") > 0) & (F.col("n_tall_with_ts") == 0))


def raw_vs_tall(registry: DataFrame, records: DataFrame, readings: DataFrame, n: int = 50) -> DataFrame:
    """Raw-record and reading counts for the latest ``n`` parsed files (0 when none).

    The two counts are grouped aggregates (one row per file) left-joined to the top-n files,
    the decorrelated form of the reference's two correlated scalar subqueries."""
    top = (registry.where(F.col("parse_status") == "parsed")
           .orderBy(F.col("ingested_at").desc(), F.col("object_key").asc()).limit(n)
           .select("file_id", "object_key", "ingested_at"))
    raw = records.join(top.select("file_id"), "file_id", "left_semi").groupBy("file_id") \
        .agg(F.count(F.lit(1)).alias("raw_rows"))
    tall = readings.join(top.select(F.col("file_id").alias("source_file_id")), "source_file_id", "left_semi") \
        .groupBy("source_file_id").agg(F.count(F.lit(1)).alias("tall_rows")) \
        .withColumnRenamed("source_file_id", "file_id")
    return top.join(raw, "file_id", "left").join(tall, "file_id", "left").fillna(0, ["raw_rows", "tall_rows"])


def flow_key_diagnostics(readings: DataFrame, t0, t1, *, stream: str = "wyman", device_address: str | None = None,
                         n: int = 40) -> DataFrame:
    """Readings of the plant in the report window counted by (metric, raw unit, raw
    device); NULL and '' stay separate groups though both display as ''.  Top ``n`` by count."""
    if stream == "booster" and not device_address:
        device_address = "mb-003"
    cond = plant_predicate(stream, device_address) & (F.col("record_ts") >= t0) & (F.col("record_ts") < t1)
    g = readings.where(cond).groupBy("metric_key", F.col("unit").alias("_u"), F.col("device_address").alias("_d")) \
        .agg(F.count(F.lit(1)).alias("n"))
    top = g.orderBy(F.col("n").desc(), "metric_key", F.col("_u").asc_nulls_first(), F.col("_d").asc_nulls_first()) \
        .limit(n)
    return top.select("metric_key", F.coalesce("_u", F.lit("")).alias("unit"),
                      F.coalesce("_d", F.lit("")).alias("device_address"), "n")


def run_stats(listed: DataFrame, checkpoints: DataFrame, registry: DataFrame | None = None) -> DataFrame:
    """Listed / skipped / succeeded / failed for one run, plus the all-skipped warning.

    ``registry``: this run's registry rows (status per processed object); without it the
    not-skipped objects count as pending."""
    from sluice.sources.objects import checkpoint_pairs
    lst = listed.select("object_key", F.coalesce(F.nullif("version_token", F.lit("")), F.lit("no_etag"))
                        .alias("version_token"))
    done = checkpoint_pairs(checkpoints).withColumn("_done", F.lit(True))
    x = lst.join(done, ["object_key", "version_token"], "left")
    if registry is not None:
        st = registry.select("object_key", "version_token", "parse_status")
        x = x.join(st, ["object_key", "version_token"], "left")
    else:
        x = x.withColumn("parse_status", F.lit(None).cast("string"))
    s = x.agg(F.count(F.lit(1)).alias("listed"),
              F.count_if(F.coalesce("_done", F.lit(False))).alias("skipped"),
              F.count_if(~F.coalesce("_done", F.lit(False)) & (F.col("parse_status") == "parsed")).alias("succeeded"),
              F.count_if(~F.coalesce("_done", F.lit(False)) & (F.col("parse_status") == "error")).alias("failed"),
              F.count_if(~F.coalesce("_done", F.lit(False)) & F.col("parse_status").isNull()).alias("pending"))
    return s.withColumn("all_skipped", (F.col("listed") > 0) & (F.col("skipped") == F.col("listed")))


def dry_run(parsed_layout: DataFrame, records: DataFrame, melted: DataFrame) -> DataFrame:
    """Q7: per file, the records and the melted readings, before hasData, the timestamp filter and
    de-duplication, that a run would find, without writing anything.  Stored readings, which name
    their file ``source_file_id``, are counted as they are."""
    rec = records.groupBy("file_id").agg(F.count(F.lit(1)).alias("rows"))
    file = "file_id" if "file_id" in melted.columns else "source_file_id"
    tall = melted.groupBy(F.col(file).alias("file_id")).agg(F.count(F.lit(1)).alias("tall"))
    return parsed_layout.select("file_id", "object_key", "label_code").join(rec, "file_id", "left") \
        .join(tall, "file_id", "left").fillna(0, ["rows", "tall"])

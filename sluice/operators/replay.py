"""Replay and correction of past loads.

Parquet tables have no DELETE/UPDATE: every operator here returns the *new* contents of the
affected tables (a copy-on-write plan); ``sinks.tables`` writes them to a new version and
switches the table to it — a path being read is never overwritten.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice import schemas as SC

# The flow-meter devices replayed by default.
DEFAULT_FLOW_DEVICES = ("mb-003", "mb-006", "mb-008")


def replay_flow_devices(registry: DataFrame, records: DataFrame, readings: DataFrame, checkpoints: DataFrame,
                        devices: Sequence[str] = DEFAULT_FLOW_DEVICES) -> dict[str, DataFrame]:
    """K7: for files whose device is in ``devices``: drop their GPM readings (unit contains
    ``GPM`` case-insensitively), all their raw records and their checkpoints; keep the
    registry.  Returns the new tables and a one-row ``counts`` frame.

    The device files are an anti/semi-join key set (one row per file); AQE broadcasts it when
    small and shuffles otherwise — its size follows the data, so no broadcast is forced."""
    devs = [d.strip().lower() for d in devices if d and d.strip()]
    files = registry.where(F.lower(F.col("device_address")).isin(devs)).select("file_id", "object_key",
                                                                                 "version_token")
    gpm = F.upper(F.coalesce(F.col("unit"), F.lit(""))).like("%GPM%")
    dev_readings = readings.join(files.select(F.col("file_id").alias("source_file_id")), "source_file_id", "left_semi")
    drop_readings = dev_readings.where(gpm)
    keep_readings = readings.join(files.select(F.col("file_id").alias("source_file_id"))
                                  .withColumn("_dev", F.lit(True)), "source_file_id", "left") \
        .where(~(F.coalesce(F.col("_dev"), F.lit(False)) & gpm)).drop("_dev")
    keep_records = records.join(files.select("file_id"), "file_id", "left_anti")
    ck = checkpoints.withColumn("version_token", F.coalesce(F.nullif("version_token", F.lit("")), F.lit("no_etag")))
    keep_checkpoints = ck.join(files.select("object_key", "version_token"), ["object_key", "version_token"],
                               "left_anti")
    counts = (drop_readings.agg(F.count(F.lit(1)).alias("tall_deleted"))
              .unionByName(records.join(files.select("file_id"), "file_id", "left_semi")
                           .agg(F.count(F.lit(1)).alias("raw_deleted")), allowMissingColumns=True)
              .unionByName(ck.join(files.select("object_key", "version_token"), ["object_key", "version_token"],
                                   "left_semi").agg(F.count(F.lit(1)).alias("checkpoints_deleted")),
                           allowMissingColumns=True))
    counts = counts.agg(*[F.max(c).alias(c) for c in ("tall_deleted", "raw_deleted", "checkpoints_deleted")])
    return {"readings": keep_readings, "records": keep_records, "checkpoints": keep_checkpoints,
            "registry": registry, "counts": counts}


def correct_booster_group(readings: DataFrame, device: str = "mb-003") -> DataFrame:
    """K8: booster rows mis-tagged as hydro (group hydro, or group unknown with source hydro)
    get ``booster_pump`` in both columns.  A projection: no shuffle."""
    hit = (F.col("device_address") == device) & (
        (F.col("physical_group") == "hydro_plant")
        | ((F.col("physical_group") == "unknown") & (F.col("source_system") == "hydro_plant")))
    return readings.withColumn("_hit", hit) \
        .withColumn("physical_group", F.when(F.col("_hit"), F.lit("booster_pump")).otherwise(F.col("physical_group"))) \
        .withColumn("source_system", F.when(F.col("_hit"), F.lit("booster_pump")).otherwise(F.col("source_system"))) \
        .drop("_hit")


def replay_file(checkpoints: DataFrame, object_key: str, version_token: str) -> DataFrame:
    """K9: forget one processed object so the next run ingests it again."""
    ck = checkpoints.withColumn("version_token", F.coalesce(F.nullif("version_token", F.lit("")), F.lit("no_etag")))
    return ck.where(~((F.col("object_key") == object_key) & (F.col("version_token") == (version_token or "no_etag"))))


def reset_ingest(spark: SparkSession) -> dict[str, DataFrame]:
    """Empty registry, records, readings and checkpoint tables (schedule untouched)."""
    return {name: spark.createDataFrame([], schema) for name, schema in (
        ("registry", SC.REGISTRY), ("records", SC.RECORDS), ("readings", SC.READINGS), ("checkpoints", SC.CHECKPOINT))}

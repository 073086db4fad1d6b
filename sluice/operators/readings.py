"""Files → registry, records and readings tables (E1 core: J2, J3, F3, F4, S17, K1-K3 rows).

``parse_files`` is pure DataFrame → DataFrame; writing (idempotent sinks) lives in
``sluice.sinks``.  The label and schema dimensions are tiny (one row per device code /
schema) and broadcast; everything else is per-file or per-line work with a single
shuffle (W3) for the readings.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.functions.naming import file_name, label_code, physical_group, serial_from_key
from sluice.operators import structure as S
from sluice.session import checkpoint_dir
from sluice.sources import config as C


@dataclass
class Parsed:
    layout: DataFrame     # one row per file: mode, headers, specs, status
    blocks: DataFrame     # one row per block: the same, and the block's lines
    registry: DataFrame   # K1 rows
    records: DataFrame    # K2 rows
    readings: DataFrame   # K3 rows (after F3, F4 and W3)
    lines: DataFrame      # one row per record with parse columns (diagnostics)
    candidates: DataFrame  # melted readings before F3/W3 (diagnostics)
    melted: DataFrame     # the same of all files, F4 (hasData) left out (Q7)


def file_id(key_col="object_key", version_col="version_token"):
    """Stable file id from (object key, version token): no sequence, same on every re-run."""
    return F.xxhash64(F.col(key_col), F.coalesce(F.col(version_col), F.lit("no_etag")))


def attach_dims(files: DataFrame, labels: DataFrame, schemas: DataFrame, strict: bool = False) -> DataFrame:
    """J2 + J3: label by code from the file name, then schema fields (both broadcast)."""
    f = (files.withColumn("file_name", file_name("object_key"))
         .withColumn("label_code", label_code(F.col("file_name")))
         .withColumn("serial", serial_from_key("object_key")))
    f = C.resolve_label(f, labels)
    sch = F.broadcast(S.order_specs(schemas.select("schema_id", "expected_headers", "header_aliases", "column_order"), strict))
    return f.join(sch, "schema_id", "left")


# Fixed value: the registry's default ``source`` (the data model's column default).
DEFAULT_SOURCE = "acquisuite"


def plan_files(files: DataFrame, labels: DataFrame, schemas: DataFrame, *, strict: bool = False, spread: int | None = None) -> DataFrame:
    """Parse plan of every block of ``files``: rows with ``text``, or blocks of lines."""
    if spread:
        files = files.repartition(int(spread))
    return S.file_layout(attach_dims(files.withColumn("file_id", file_id()), labels, schemas, strict), strict=strict)


# Bytes of a row group of a stage: what a task parses at least.
STAGE_BYTES = 16 << 20
# Failed files whose ids are broadcast to the blocks; more are joined by a shuffle.
SMALL = 100_000


def staged(blocks: DataFrame) -> DataFrame:
    """``blocks`` as written under the checkpoint folder, whose row groups are dealt to all tasks when
    they are read back."""
    spark = blocks.sparkSession
    path = f"{checkpoint_dir(spark)}/parse-{uuid.uuid4().hex}"
    blocks.write.option("compression", "zstd").option("parquet.block.size", str(STAGE_BYTES)).parquet(path)
    return spark.read.schema(blocks.schema).parquet(path)


def parse_files(files: DataFrame, labels: DataFrame, schemas: DataFrame, *, strict: bool = False,
                ingested_at=None, source: str = DEFAULT_SOURCE, spread: int | None = None,
                carry: Sequence[str] = (), stage: bool = False) -> Parsed:
    """Parse decoded files ``(object_key, version_token, last_modified, text)``, or their blocks of lines
    (``sources.blocks``), of which a file has any number.

    ``spread``: re-distribute the files over that many tasks first.  Parsing is CPU-bound
    and a listing or a small input split can hold many files in one partition; an explicit
    partition count is kept as is by AQE (it would coalesce a count-free repartition of such
    small-in-bytes data back into one task).  ``carry``: file columns (such as ``object_key``) that
    records and readings keep, which saves a join with the registry.  ``stage``: the parse plan of all
    blocks is written once, for callers that read several of the results: each of them would otherwise read
    the files and their headers anew.
    """
    blocks = plan_files(files, labels, schemas, strict=strict, spread=spread)
    if stage:
        blocks = staged(blocks)
    if "lines" in files.columns:
        failed = S.failed_files(blocks)
        n = failed.limit(SMALL + 1).count() if stage else None
        if n != 0:
            blocks = S.mark_failed(blocks, failed, small=n is not None and n <= SMALL)
    return parse_plan(blocks, ingested_at=ingested_at, source=source, carry=carry)


def parse_plan(blocks: DataFrame, *, ingested_at=None, source: str = DEFAULT_SOURCE, carry: Sequence[str] = ()) -> Parsed:
    """The rows that follow from the parse plan of blocks."""
    layout = S.files_of(blocks)
    lines = S.structure_lines(blocks)
    ok = F.col("parse_error").isNull()

    # structure_lines already drops failed files; the F4 (hasData) and F3 (timestamp)
    # conditions gate the melt itself.
    records = lines.select(
        "file_id", "line_no", "raw_text", "parsed", "label_code", "label_name", "record_ts", *carry)

    melted = S.candidate_readings(lines, gate=F.col("has_data"))
    cand = S.candidate_readings(lines, gate=F.col("has_data") & F.col("record_ts").isNotNull()).select(
        F.col("file_id").alias("source_file_id"), "serial", "record_ts", "metric_key", "metric_value", "unit",
        "source_system", "error_flag", "low_alarm", "high_alarm", "device_address", "label_group",
        "line_no", "col_idx", *carry)
    dedup = S.first_wins(cand)
    readings = dedup.select(
        "serial", "record_ts", "metric_key", "metric_value", "unit",
        F.lit(None).cast("string").alias("quality"),
        "source_file_id",
        F.coalesce("source_system", F.lit("unknown")).alias("source_system"),
        "error_flag", "low_alarm", "high_alarm",
        F.coalesce(F.nullif("device_address", F.lit("")), F.lit("unknown")).alias("device_address"),
        physical_group("source_system", "label_group").alias("physical_group"),
        *carry,
    )

    at = F.current_timestamp() if ingested_at is None else F.lit(ingested_at).cast("timestamp")
    registry = layout.select(
        "file_id", "object_key", F.coalesce("version_token", F.lit("no_etag")).alias("version_token"),
        "serial", F.col("last_modified").alias("filetime"), F.lit(None).cast("string").alias("loopname"),
        F.lit(source).alias("source"),
        F.when(ok, "parsed").otherwise("error").alias("parse_status"),
        F.col("parse_error").alias("error_text"),
        F.nullif("device_address", F.lit("")).alias("device_address"),
        F.nullif("label_group", F.lit("")).alias("physical_group"),
        F.nullif("schema_id", F.lit("")).alias("schema_id"),
        at.alias("ingested_at"),
    )
    return Parsed(layout=layout, blocks=blocks, registry=registry, records=records, readings=readings, lines=lines,
                  candidates=melted, melted=S.candidate_readings(lines))

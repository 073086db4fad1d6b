"""The batch ingest job (A10 batch form).

list → optional guard (R2) and newest-first batch (R1) → skip checkpointed (J1) → read, inflate and cut
into blocks of lines (R3, R5, R6) → parse (P*, S*, F*, W3) → write registry / records / readings, checkpoint last (K1-K4).
Re-running it ingests nothing new; failed files are retried on the next run.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.operators import quality as Q
from sluice.operators import structure as S
from sluice.operators.readings import Parsed, parse_plan, plan_files
from sluice.session import checkpoint_dir, configure
from sluice.sinks.tables import IngestTables, write_batch
from sluice.sources import config as C
from sluice.sources import objects as O
from sluice.sources.blocks import BLOCK_BYTES


@dataclass
class IngestResult:
    run_id: str
    stats: DataFrame          # G8 one-row summary
    registry: DataFrame       # this run's registry rows
    warnings: DataFrame       # Q1-Q3, Q5: one row per file and finding
    plan: DataFrame | None = None   # Q7: what a dry run would write, per file


# Kinds of warnings.
MEASURABLE_WITHOUT_DATA = "device marked without data, but measurable headers"       # Q1
NO_READINGS = "records but no readings"                                              # Q2
NO_TIMESTAMPS = "readings but no timestamps"                                         # Q3
NO_COLUMN_ORDER = "no header line and no column order for its schema"

# Bytes of a row group of the stage: what a task parses at least.
STAGE_BYTES = 16 << 20
# Failed files whose ids are broadcast to the blocks; more are joined by a shuffle.
SMALL = 100_000


def ingest_blocks(spark: SparkSession, blocks: DataFrame, tables: IngestTables, *, run_id: str, now,
                  labels: DataFrame | None = None, schemas: DataFrame | None = None, strict_schema: bool = False,
                  column_orders: str | None = None, dry_run: bool = False) -> Parsed:
    """Parse blocks of lines (``sources.blocks``) and write them.

    ``column_orders``: path of the column orders file, read on every run, with which files
    without a header line are parsed (P9)."""
    labels = labels if labels is not None else C.default_labels(spark)
    schemas = schemas if schemas is not None else C.default_schemas(spark)
    if column_orders:
        schemas = C.with_column_orders(schemas, C.load_column_orders(spark, column_orders))
    # What was read is written once, apart: inflating is not repeated, and the blocks of a large file,
    # which one task has read, are dealt to all tasks when they are read back.
    stage = f"{checkpoint_dir(spark)}/ingest-{run_id}-{uuid.uuid4().hex[:8]}"
    blocks.write.option("compression", "zstd").option("parquet.block.size", str(STAGE_BYTES)).parquet(stage)
    blocks = spark.read.schema(blocks.schema).parquet(stage)
    plan = plan_files(blocks, labels, schemas, strict=strict_schema)
    # Kept while the batch is written, by several actions (recomputable from the stage if an executor is lost).
    plan.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        failed = S.failed_files(plan)
        n = failed.limit(SMALL + 1).count()
        p = parse_plan(S.mark_failed(plan, failed, small=n <= SMALL) if n else plan, ingested_at=now)
        if not dry_run:
            p.lines.persist(StorageLevel.MEMORY_AND_DISK)
            write_batch(tables, p.registry, p.records, p.readings, run_id=run_id, processed_at=now)
            p.lines.unpersist()
    finally:
        plan.unpersist()
    return p


def run_warnings(p: Parsed) -> DataFrame:
    """Q1-Q3 of this run: (kind, object_key, detail) per file and finding, and files without header
    whose schema has no column order, which the loose parse takes."""
    conflicts = Q.has_data_conflicts(p.layout).select(F.lit(MEASURABLE_WITHOUT_DATA).alias("kind"), "object_key",
                                                      F.col("measurable_preview").alias("detail"))
    d = Q.file_diagnostics(p.layout, p.lines, p.melted)
    counts = F.concat(F.lit("rows="), F.col("n_records").cast("string"), F.lit(" tall="), F.col("n_tall").cast("string"))
    silent = d.where("no_readings").select(F.lit(NO_READINGS).alias("kind"), "object_key", counts.alias("detail"))
    timeless = d.where("no_timestamps").select(F.lit(NO_TIMESTAMPS).alias("kind"), "object_key", counts.alias("detail"))
    keyed = (p.blocks.where((F.col("mode") == "loose") & F.exists("_lines", lambda l: l.contains("="))).select("file_id").distinct())
    headerless = (p.layout.where((F.col("mode") == "loose") & (F.size(F.coalesce("column_order", F.array().cast("array<string>"))) <= 0))
                  .join(keyed, "file_id", "left_anti")
                  .select(F.lit(NO_COLUMN_ORDER).alias("kind"), "object_key", F.col("schema_id").alias("detail")))
    return conflicts.unionByName(silent).unionByName(timeless).unionByName(headerless)


def run_ingest(spark: SparkSession, root: str, tables_root: str, *, prefix: str = "log-gz/",
               batch_limit: int | None = None, scan_cap: int | None = None,
               strict_listing: bool = True, skip_processed_first: bool = False, strict_schema: bool = False,
               labels: DataFrame | None = None, schemas: DataFrame | None = None, column_orders: str | None = None,
               dry_run: bool = False, now: _dt.datetime | None = None, run_id: str | None = None,
               block_bytes: int = BLOCK_BYTES, manifest: DataFrame | None = None) -> IngestResult:
    """One ingest run over everything unprocessed under ``root/prefix``, or in ``manifest`` (object_key,
    version_token, size, last_modified); ``batch_limit`` (the newest so many) and ``scan_cap`` (R2) are
    opt-in."""
    configure(spark)
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    run_id = run_id or now.strftime("%Y%m%d%H%M%S%f")
    tables = IngestTables(spark, tables_root)
    if manifest is None:
        manifest = O.list_objects(spark, root, prefix=prefix)
    manifest = O.check_listing(manifest, scan_cap, strict=strict_listing)
    checkpoints = tables.checkpoint.read()
    if batch_limit is not None:
        manifest = O.newest_first(O.unprocessed(manifest, checkpoints) if skip_processed_first else manifest, batch_limit)
    # A second look at the store could see other objects: the run works on one stored listing.
    checkpoint_dir(spark)
    listed = manifest.checkpoint()
    batch = O.unprocessed(listed, checkpoints)
    blocks = O.read_blocks(spark, batch, root, block_bytes=block_bytes)
    p = ingest_blocks(spark, blocks, tables, run_id=run_id, now=now, labels=labels, schemas=schemas,
                      strict_schema=strict_schema, column_orders=column_orders, dry_run=dry_run)
    stats = Q.run_stats(listed, checkpoints, p.registry)
    plan = Q.dry_run(p.layout, p.records, p.melted) if dry_run else None
    return IngestResult(run_id=run_id, stats=stats, registry=p.registry, warnings=run_warnings(p), plan=plan)

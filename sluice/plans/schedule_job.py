"""E5: import of schedule files into the stored schedule.

read → require a header → parse → replace the files' rows in one step.  A file without header or a
fractional frequency aborts the import before anything stored is touched.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.session import checkpoint_dir, configure
from sluice.sinks.tables import IngestTables, replace_schedule_files
from sluice.sources import schedule_csv as R


class ImportRejected(ValueError):
    """An import that would not replace what is stored; the message names the files."""


def import_schedule(spark: SparkSession, paths, tables_root: str, *, kind: str = "schedule",
                    imported_at: _dt.datetime | None = None, ps_code: str = "DST_LCR") -> DataFrame:
    """Import files of one ``kind`` ("schedule" or "lead_copper"); returns the rows per file."""
    configure(spark)
    checkpoint_dir(spark)
    imported_at = imported_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    files = R.read_files(spark, paths)
    names = [r.source_file for r in files.select("source_file").distinct().collect()]  # the files asked for
    if kind == "schedule":
        rows = R.parse_schedule_files(files).checkpoint()
        faults = rows.where(F.col("_no_header") | F.col("_bad_frequency")).groupBy("source_file").agg(
            F.max("_no_header").alias("no_header")).collect()
        if faults:
            raise ImportRejected("; ".join(
                f"{r.source_file}: {'no header line' if r.no_header else 'a frequency is not a whole number'}" for r in sorted(faults)))
        rows = rows.drop("_no_header", "_bad_frequency")
    else:
        lines = R.text_to_lines(files)
        have = {r.source_file for r in R.lead_copper_headers(lines).select("source_file").collect()}
        if missing := sorted(set(names) - have):
            raise ImportRejected("; ".join(f"{f}: no header line" for f in missing))
        rows = R.parse_lead_copper(lines, ps_code)
    tables = IngestTables(spark, tables_root)
    replace_schedule_files(tables, rows, names, imported_at)
    return tables.schedule.read().where(F.col("source_file").isin(names)).groupBy("source_file").count()

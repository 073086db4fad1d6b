"""A10 streaming form: new objects and new versions of objects → the same parse and sinks as the batch job.

A file stream source remembers paths, not versions, and would miss an object that is replaced.  The
stream reads ``sources.listing``: each micro-batch is the listing of what was modified since the last
one, made by executors, and the stream's checkpoint remembers up to when.  Of these, and of objects that
failed before and are still there, the (key, version) pairs that are not in the checkpoint table are
ingested, checkpoint last, as by the batch job.  Batch and streaming runs can be mixed.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from sluice.plans.ingest import run_ingest
from sluice.session import configure
from sluice.sinks.tables import IngestTables
from sluice.sources import objects as O
from sluice.sources.listing import NAME, ObjectListing


def listing_stream(spark: SparkSession, root: str, *, prefix: str = "log-gz/", lookback_days: int | None = None,
                   settle_ms: int = 1000) -> DataFrame:
    """The objects under ``root/prefix`` as a stream of (object_key, version_token, size, last_modified)."""
    spark.dataSource.register(ObjectListing)
    r = spark.readStream.format(NAME).option("root", O.qualified(spark, root)).option("prefix", prefix).option("settle_ms", str(settle_ms))
    return (r.option("lookback_days", str(lookback_days)) if lookback_days is not None else r).load()


def start_ingest_stream(spark: SparkSession, root: str, tables_root: str, checkpoint_location: str, *,
                        prefix: str = "log-gz/", available_now: bool = True, processing_time: str | None = None,
                        lookback_days: int | None = None, settle_ms: int | None = None, **ingest_opts):
    """Start the incremental ingest; returns the ``StreamingQuery``.  With ``available_now`` what is there
    is ingested once and the query ends; otherwise the store is listed at every ``processing_time``
    (default one minute).  A restart goes on where the stream's checkpoint says.  ``settle_ms``: age
    of what is listed at least (one second; with ``available_now`` none)."""
    configure(spark)
    if settle_ms is None:
        settle_ms = 0 if available_now else 1000

    def tick(df: DataFrame, epoch_id: int) -> None:
        manifest = df.unionByName(O.failed_before(spark, root, IngestTables(spark, tables_root)))
        run_ingest(spark, root, tables_root, prefix=prefix, manifest=manifest.dropDuplicates(["object_key", "version_token"]),
                   run_id=f"stream-{epoch_id}-{uuid.uuid4().hex[:8]}", **ingest_opts)

    w = (listing_stream(spark, root, prefix=prefix, lookback_days=lookback_days, settle_ms=settle_ms).writeStream
         .foreachBatch(tick).option("checkpointLocation", checkpoint_location))
    if available_now:
        return w.trigger(availableNow=True).start()
    return w.trigger(processingTime=processing_time or "1 minute").start()

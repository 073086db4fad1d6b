"""Object listing, checkpoint filtering and byte decoding.

The object store is whatever Hadoop filesystem Spark reads; a *manifest* is a DataFrame
``(object_key, version_token, size, last_modified)``.  ``list_objects`` builds it from
``binaryFile`` metadata only — the ``content`` column is pruned, so listing never reads file
bytes.  Gzip decoding is the single Python step of the ingest (Arrow batches): Spark has no built-in
inflate, and ``spark.read.text`` fails a whole task on a plain-text file named ``.gz``.
"""

from __future__ import annotations

import warnings
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.functions.naming import header_code
from sluice.functions.text import col_of, norm_header_line, safe_name
from sluice.sources.blocks import BLOCK_BYTES, LINE_BYTES, line_blocks

DEFAULT_BATCH_LIMIT = 200
DEFAULT_SCAN_CAP = 250_000
# An object is one row; this is the most bytes Spark puts in one.
MAX_ROW_BYTES = 2_147_483_647


def list_objects(spark: SparkSession, root: str, *, prefix: str = "log-gz/", version: str = "stat") -> DataFrame:
    """R1 input: manifest of every file under ``root/prefix`` (keys relative to ``root``).

    ``version``: ``"stat"`` → md5 of (size, modification time) — no bytes read; ``"content"``
    → sha-256 of the bytes (reads every listed file)."""
    base = root.rstrip("/")
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
          .load(f"{base}/{prefix}"))
    key = F.regexp_replace(F.col("path"), r"^.*?" + _quote(base.split("://")[-1]) + "/", "")
    if version == "content":
        token = F.sha2(F.col("content"), 256)
    else:
        token = stat_token("length", "modificationTime")
    return df.select(key.alias("object_key"), token.alias("version_token"),
                     F.col("length").alias("size"), F.col("modificationTime").alias("last_modified"),
                     F.col("path"))


def stat_token(size: str, modified: str) -> Column:
    """Version of an object from its size and modification time."""
    return F.md5(F.concat_ws(":", F.col(size).cast("string"), F.unix_millis(F.col(modified)).cast("string")))


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)


def check_listing(manifest: DataFrame, scan_cap: int | None = DEFAULT_SCAN_CAP, *, strict: bool = True) -> DataFrame:
    """R2, an opt-in check: a listing with more than ``scan_cap`` objects is refused (``strict``) or
    cut, with a warning, to the first ``scan_cap`` keys in key order (what a capped lexicographic
    listing returns).  None or 0: no cap."""
    if scan_cap and scan_cap > 0:
        n = manifest.limit(scan_cap + 1).count()
        if n > scan_cap:
            if strict:
                raise RuntimeError(f"listing truncated at {scan_cap} objects; raise the cap or narrow the prefix")
            warnings.warn(f"listing truncated at {scan_cap} objects; later keys are not considered", stacklevel=2)
            return manifest.orderBy("object_key").limit(scan_cap)
    return manifest


def batch_limit(k) -> int:
    try:
        k = int(float(k))
    except (TypeError, ValueError):
        return DEFAULT_BATCH_LIMIT
    return k if k > 0 else DEFAULT_BATCH_LIMIT


def newest_first(manifest: DataFrame, k=DEFAULT_BATCH_LIMIT) -> DataFrame:
    """The ``k`` most recently modified objects (missing time = epoch → last; ties in key
    order).  A top-k: each task keeps k rows, the driver merges them."""
    t = F.coalesce(F.col("last_modified"), F.lit(0).cast("timestamp"))
    return manifest.orderBy(t.desc(), F.col("object_key").asc()).limit(batch_limit(k))


def checkpoint_pairs(df: DataFrame) -> DataFrame:
    return df.select("object_key", F.coalesce(F.nullif(F.col("version_token"), F.lit("")), F.lit("no_etag"))
                     .alias("version_token"))


def unprocessed(listed: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Listed objects whose (key, version) pair is not checkpointed (empty version →
    ``no_etag``).  An anti-join; the checkpoint side is one row per processed object and is
    left to AQE (broadcast when small, shuffle otherwise)."""
    lst = listed.withColumn("version_token",
                            F.coalesce(F.nullif(F.col("version_token"), F.lit("")), F.lit("no_etag")))
    return lst.join(checkpoint_pairs(checkpoints), ["object_key", "version_token"], "left_anti")


def select_batch(manifest: DataFrame, checkpoints: DataFrame, k=DEFAULT_BATCH_LIMIT, *,
                 skip_processed_first: bool = False) -> DataFrame:
    """R1 + J1.  Reference order: take the newest ``k`` first, then drop processed ones (a
    batch can shrink to nothing while older objects wait); ``skip_processed_first`` applies
    the anti-join before the limit instead.  ``k`` None: everything unprocessed."""
    if k is None:
        return unprocessed(manifest, checkpoints)
    if skip_processed_first:
        return newest_first(unprocessed(manifest, checkpoints), k)
    return unprocessed(newest_first(manifest, k), checkpoints)


# --- R3: bytes → text -------------------------------------------------------------------

def _inflate(b: bytes | None) -> str | None:
    if b is None:
        return None
    out, rest = [], b
    while rest[:2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        try:
            part = member.decompress(rest)
        except zlib.error:
            break
        if not member.eof:
            break
        out.append(part)
        rest = member.unused_data
    # Members up to the first broken one count, bytes after them do not; without any, it is text.
    return (b"".join(out) if out else b).decode("utf-8", errors="replace")


@F.pandas_udf(T.StringType())
def inflate_text(content: pd.Series) -> pd.Series:
    """Gunzip member by member (trailing bytes are ignored), or treat the bytes as UTF-8 text
    when they are not gzip (Arrow batches)."""
    return content.map(_inflate)


def is_gzip(content) -> Column:
    return F.substring(col_of(content), 1, 2) == F.unhex(F.lit("1F8B"))


def qualified(spark: SparkSession, root: str) -> str:
    """``root`` with its scheme, as file sources report paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString()


def _existing_folders(spark: SparkSession, batch: DataFrame) -> list[str]:
    """Folders that hold objects of the batch (device and day: far fewer than objects), escaped for
    the reader's globs; folders that are gone are left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    out = []
    for r in batch.select(F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("f")).distinct().collect():
        path = jvm.org.apache.hadoop.fs.Path(r.f)
        if path.getFileSystem(conf).exists(path):
            out.append("".join("\\" + ch if ch in "{}[]*?\\" else ch for ch in r.f))
    return out


def failed_before(spark: SparkSession, root: str, tables) -> DataFrame:
    """Manifest of registered objects that failed, are not checkpointed, and are in the store in the very
    version that failed: what a stream, which lists modifications only, has to try again."""
    failed = (tables.registry.read().where(F.col("parse_status") == "error").select("object_key", "version_token")
              .join(checkpoint_pairs(tables.checkpoint.read()), ["object_key", "version_token"], "left_anti"))
    failed = failed.withColumn("path", F.concat(F.lit(qualified(spark, root) + "/"), F.col("object_key")))
    folders = _existing_folders(spark, failed)
    if not folders:
        return spark.createDataFrame([], "object_key string, version_token string, size long, last_modified timestamp")
    there = spark.read.format("binaryFile").option("ignoreMissingFiles", "true").load(folders)
    return (there.select("path", stat_token("length", "modificationTime").alias("version_token"), F.col("length").alias("size"),
                         F.col("modificationTime").alias("last_modified"))
            .join(failed, ["path", "version_token"]).select("object_key", "version_token", "size", "last_modified"))


def _contents(spark: SparkSession, batch: DataFrame, root: str | None, max_bytes: int | None) -> tuple[DataFrame, DataFrame]:
    """(objects with their bytes, objects without: (…, read_error)), each with object_key, version_token
    and last_modified.

    The folders of the batch are read and joined with it on the path, so the objects themselves
    are never listed on the driver.  Where the batch says when its objects were modified, files outside
    that span, which earlier runs have read, are left out before any byte is read.  The size test
    filters the scan too, so oversize bytes are neither read nor inflated."""
    if "path" not in batch.columns:
        if root is None:
            raise ValueError("batch has no path column: pass root")
        batch = batch.withColumn("path", F.concat(F.lit(qualified(spark, root) + "/"), F.col("object_key")))
    most = min(max_bytes or MAX_ROW_BYTES, MAX_ROW_BYTES)
    meta = batch.select("path", "object_key", "version_token")
    folders = _existing_folders(spark, meta)
    columns = "object_key string, version_token string, last_modified timestamp, read_error string"
    nothing = F.lit(None).cast("timestamp")
    if not folders:
        missing = meta.select("object_key", "version_token", nothing.alias("last_modified"), F.lit("object not found").alias("read_error"))
        empty = "object_key string, version_token string, last_modified timestamp, content binary"
        return spark.createDataFrame([], empty), missing.to(spark.createDataFrame([], columns).schema)
    reader = spark.read.format("binaryFile").option("ignoreMissingFiles", "true")
    if "last_modified" in batch.columns:
        second = F.date_trunc("second", "last_modified")
        span = batch.agg(F.date_format(F.min(second) - F.expr("INTERVAL 1 SECOND"), "yyyy-MM-dd'T'HH:mm:ss").alias("a"),
                         F.count_if(F.col("last_modified").isNull()).alias("unknown")).first()
        if span.a is not None and not span.unknown:
            # An object replaced since the listing is newer, never older.
            reader = reader.option("modifiedAfter", span.a).option("timeZone", spark.conf.get("spark.sql.session.timeZone"))
    raw = reader.load(folders)
    found = raw.where(F.col("length") <= most).join(meta, "path").select(
        "object_key", "version_token", F.col("modificationTime").alias("last_modified"), "content")
    sizes = raw.select("path", "length", "modificationTime")   # metadata only: no bytes are read
    failed = meta.join(sizes, "path", "left").where(F.col("length").isNull() | (F.col("length") > most)).select(
        "object_key", "version_token", F.col("modificationTime").alias("last_modified"),
        F.when(F.col("length").isNull(), F.lit("object not found")).otherwise(F.lit(f"object larger than {most} bytes")).alias("read_error"))
    return found, failed


def read_objects(spark: SparkSession, batch: DataFrame, root: str | None = None, *,
                 max_bytes: int | None = None) -> DataFrame:
    """The selected objects as a row each, decoded: ``(object_key, version_token, last_modified, text,
    is_gzip, read_error)``; for objects whose text fits a row (see ``read_blocks``).

    An object that has vanished since the listing, or is larger than ``max_bytes`` (default: what fits
    a row), keeps ``text`` NULL and a ``read_error`` for the registry; the others are not affected."""
    found, failed = _contents(spark, batch, root, max_bytes)
    return found.select("object_key", "version_token", "last_modified", inflate_text(F.col("content")).alias("text"),
                        is_gzip("content").alias("is_gzip"), F.lit(None).cast("string").alias("read_error")).unionByName(
        failed.select("object_key", "version_token", "last_modified", F.lit(None).cast("string").alias("text"),
                      F.lit(None).cast("boolean").alias("is_gzip"), "read_error"))


def read_blocks(spark: SparkSession, batch: DataFrame, root: str | None = None, *, max_bytes: int | None = None,
                block_bytes: int = BLOCK_BYTES, line_bytes: int = LINE_BYTES) -> DataFrame:
    """The selected objects as blocks of lines (see ``sources.blocks``), however far they inflate.  An
    object that has vanished, is larger than ``max_bytes`` as stored, or cannot be cut has a row
    with a ``read_error`` and block -1; the others are not affected."""
    found, failed = _contents(spark, batch, root, max_bytes)
    blocks = line_blocks(found, block_bytes, line_bytes)
    none = F.array().cast("array<string>")
    return blocks.unionByName(failed.select(
        "object_key", "version_token", "last_modified", F.lit(None).cast("boolean").alias("is_gzip"), "read_error", F.lit(-1).alias("block"),
        F.lit(0).cast("long").alias("first_line"), F.lit(False).alias("whole"), none.alias("head"), none.alias("lines")))


# --- K11: landing layout --------------------------------------------------------------

def route_parts(parts: DataFrame, received_at: str = "received_at") -> DataFrame:
    """Object key of each received upload part.

    ``parts``: ``(upload_id, serial, field, filename, is_log, received_at)``.  The log part goes
    to ``log-gz/``; other parts whose field or name mentions ``status`` or whose name ends in
    ``.txt`` go to ``status/``, the rest to ``other/``; then ``serial/yyyy/mm/dd/name`` by the
    UTC receive date.  A ``LOGFILE`` part repeating the log part's file name is skipped.  The
    window is per upload (a multipart request has a handful of parts)."""
    from pyspark.sql import Window
    ser = safe_name(F.coalesce(F.nullif(F.col("serial"), F.lit("")), F.lit("unknown_serial")))
    field = F.lower(F.coalesce("field", F.lit("")))
    fn = F.lower(F.coalesce("filename", F.lit("")))
    statusish = field.contains("status") | fn.contains("status") | fn.endswith(".txt")
    kind = F.when(F.col("is_log"), "log-gz").when(statusish, "status").otherwise("other")
    ts = F.col(received_at)
    default_name = F.when(F.col("is_log"), F.concat(F.lit("acq_"), F.unix_millis(ts).cast("string"), F.lit(".log.gz"))) \
        .otherwise(F.concat(F.coalesce(F.nullif(F.col("field"), F.lit("")), F.lit("part")), F.lit(".bin")))
    name = safe_name(F.coalesce(F.nullif(F.col("filename"), F.lit("")), default_name))
    key = F.concat_ws("/", kind, ser, F.date_format(ts, "yyyy"), F.date_format(ts, "MM"), F.date_format(ts, "dd"),
                      name)
    w = Window.partitionBy("upload_id")
    log_fn = F.max(F.when(F.col("is_log"), F.coalesce(F.col("filename"), F.lit("")))).over(w)
    dup = (~F.col("is_log")) & (field == "logfile") & (F.coalesce(F.col("filename"), F.lit("")) == log_fn)
    return parts.withColumn("_dup", F.coalesce(dup, F.lit(False))).where(~F.col("_dup")).drop("_dup") \
        .withColumn("kind", kind).withColumn("object_key", key)


# --- P13: canonical header normaliser ------------------------------------------------

HEADER_MATCH_LINES = 12


def normalise_header(files: DataFrame, canonical: DataFrame, default_code: str | None = None) -> DataFrame:
    """Gzip files whose device code has a canonical header line: tag ``matched`` when one
    of the first 12 lines equals it (after BOM strip and per-cell trim), otherwise prepend it
    and tag ``prepended``.  Non-gzip files, files without a code or header stay unchanged
    (status NULL).

    ``files``: ``(object_key, text, is_gzip)``; ``canonical``: ``(code, header_line)``, one row
    per device code (a fixed-size broadcast)."""
    f = files.withColumn("_code", header_code(F.element_at(F.split("object_key", "/"), -1), default_code))
    j = f.join(F.broadcast(canonical.select(F.col("code").alias("_code"), F.col("header_line").alias("_hdr"))),
               "_code", "left")
    want = norm_header_line(F.col("_hdr"))
    head = F.slice(F.split(F.col("text"), r"\r?\n", -1), 1, HEADER_MATCH_LINES)
    found = F.exists(head, lambda l: norm_header_line(l) == want)
    eligible = F.col("is_gzip") & F.col("_hdr").isNotNull() & (want != "") & F.col("text").isNotNull()
    status = F.when(eligible & found, "matched").when(eligible, "prepended")
    return j.withColumn("csv_header_status", status).withColumn(
        "text", F.when(status == "prepended", F.concat(F.col("_hdr"), F.lit("\n"), F.col("text"))).otherwise(F.col("text"))
    ).withColumn("csv_header_code", F.when(status.isNotNull(), F.col("_code"))).drop("_code", "_hdr")


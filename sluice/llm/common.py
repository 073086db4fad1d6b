"""Helpers shared by the operators: input tables, shared scratch tables, text units."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word of the contracts: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
WHITE = r"[\x20\x09-\x0D]+"

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: the one ``spark.checkpoint.dir`` names.  Where the setting is
    absent a local session gets a folder of its own; on a cluster that is an error."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    import tempfile

    own = tempfile.mkdtemp(prefix="sluice-shared-")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run within remove their shuffle files at their end, not when the driver happens to
    collect its garbage."""
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_TIDY)
        else:
            spark.conf.set(_TIDY, before)


class Scratch:
    """Tables written to the shared folder to cut lineage: a lost executor costs at most the stage
    that reads them, and what they hold is computed once.  With ``tidy`` the shuffle files of a table
    go as soon as it is written."""

    def __init__(self, spark: SparkSession, name: str, tidy: bool = False):
        self.spark, self.tidy = spark, tidy
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def put(self, name: str, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{name}"
        with tidy_shuffles(self.spark) if self.tidy else nullcontext():
            df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that nothing reads any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def lower_az(col: Column) -> Column:
    """Lower-case A-Z only, whatever the locale."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def n_words(col: Column) -> Column:
    """Number of words (runs of non-white characters); 0 for null."""
    parts = F.split(col, WHITE)
    edge = (F.when(F.element_at(parts, 1) == "", 1).otherwise(0)
            + F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0))
    return F.when(col.isNull(), F.lit(0)).otherwise(F.size(parts) - edge).cast("long")


def order_hash(col: Column) -> Column:
    """Hex text that orders rows at random yet the same in any engine."""
    return F.md5(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))

"""Corpus pipeline: language ID, line dedup, near-dedup, decontamination, mixing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns what the next
one gets, after it has been written as Parquet and read again.  All but the last return the columns
of ``documents``.  ``docs`` may hold nulls anywhere, repeated rows and further columns; only the
columns of ``documents`` go on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import common
from sluice.llm.decontaminate import decontaminate
from sluice.llm.language_id import fit, predict
from sluice.llm.line_dedup import dedup_lines
from sluice.llm.mixing import mix, training_order
from sluice.llm.near_dedup import near_duplicates

COLUMNS = common.DOCUMENT_COLUMNS


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised: those without a letter and those scored below the
    calibrated threshold go.  Without any labelled row nothing can be recognised and all go."""
    docs = docs.select(*COLUMNS)
    return predict(docs, fit(docs)).filter(~F.col("rejected")).select(*COLUMNS)


def dedup_line_chunks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated multi-line chunks, n_chars counted anew; documents go if they had lines
    and every one of them repeats an earlier document."""
    cut = dedup_lines(docs.select(*COLUMNS))
    return (cut.filter((F.col("n_removed") < F.col("n_lines")) | (F.col("n_lines") == 0))
            .select(*[F.length("text").cast("long").alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component: the one with the smallest doc_id.  Rows with a
    null doc_id stay; rows of one doc_id stay or go together."""
    docs = docs.select(*COLUMNS)
    gone = near_duplicates(docs).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs.select(*COLUMNS), common.table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The training sequence: a row for each time the mix takes a document, with epoch, position in
    training time and words taken, in the order of position."""
    return training_order(mix(docs, carry=COLUMNS))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_line_chunks),
    ("near_dedup", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("mix", mix_sources),
]

# Language ID and near-dedup cannot be put in SQL; tests check the run against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is a table in the shared folder."""
    docs = common.table(spark, sf_dir, "documents")
    scratch = common.Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.put(name, docs)
    return docs

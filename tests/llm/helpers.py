"""Small inputs for the operators' tests."""

import random

from pyspark.sql import functions as F
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


def sentences(seed, n, letters="abcdefghijklmnop"):
    r = random.Random(seed)
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 8))) for _ in range(n))


def docs(spark, rows):
    """rows of (doc_id, text) or (doc_id, text, lang, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] else None) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def messy_rows():
    body = sentences(1, 120)
    lines = "\n".join(sentences(k, 12) for k in range(20, 32))
    return [
        (1, body), (2, body.upper()), (3, None), (4, ""), (5, " \n\t "), (6, lines), (7, lines + "\n" + sentences(5, 30)),
        (8, sentences(9, 60000)), (8, sentences(10, 90)), (9, body), (9, body), (None, body), (None, None), (None, lines),
        (10, "x"), (11, "one two three four"), (12, "one two three four"), (13, "...\n!!! 12 %%%"), (14, "é ü ñ", None, None), (15, "a\n" * 50),
    ]


def messy(spark):
    """Nulls in every column, empty and long texts, repeated rows, and columns whose names the
    operators use themselves."""
    rows = [(*r, *(["en", "s"][len(r) - 2:] if len(r) < 4 else [])) for r in messy_rows()]
    df = docs(spark, rows)
    df = df.withColumn("source", F.when(F.col("doc_id") == 11, F.lit(None)).otherwise(F.col("source")))
    for c in ("id", "kept", "n", "u", "v", "key", "size", "taken", "copies", "target", "matches", "spans", "score", "rejected",
              "lang_pred", "n_lines", "n_removed", "grams", "component_id", "keep_id", "group_size", "position", "epoch", "words"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def duck(tables):
    """DuckDB connection with pandas frames as views."""
    import duckdb

    c = duckdb.connect()
    for name, pdf in tables.items():
        c.register(f"_{name}", pdf)
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM _{name}")
    return c

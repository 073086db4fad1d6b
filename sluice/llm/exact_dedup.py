"""Exact deduplication by composable polynomial fingerprints.

A text (A-Z lower-cased, UTF-8) is cut into chunks of ``CHUNK`` bytes.  Each chunk has a
polynomial hash; hashes of neighbouring pieces combine by length-shifted arithmetic,

    H(ab) = H(a) * r^len(b) + H(b)  (mod p),

so a huge text is the fold of chunk hashes that were computed apart.  Texts with equal (length,
fingerprints) are then compared chunk by chunk: for each fingerprint and chunk number the smallest
and the largest chunk must be the same bytes.  Minimum and maximum merge map-side, so a group of
copies of any size sends one row per task, and no task sees a whole group.  Fingerprints whose
chunks differ (collisions) are regrouped by their whole bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch, lower_az

CHUNK = 1 << 16
# Two primes below 2^31 and a base for each: products fit 64-bit integers in numpy and in the JVM.
PRIMES = (2147483647, 2147483629)
BASES = (1103515245, 1812433253)


def _powers(base: int, prime: int, n: int) -> np.ndarray:
    """base^0 .. base^n mod prime, by doubling."""
    out = np.ones(n + 1, np.int64)
    done, step = 1, base % prime
    while done <= n:
        take = min(done, n + 1 - done)
        out[done:done + take] = out[:take] * step % prime
        done, step = done + take, step * step % prime
    return out


PART = "n:bigint,h1:bigint,h2:bigint,p1:bigint,p2:bigint"


def chunk_hashes(chunk: int = CHUNK, primes: tuple[int, int] = PRIMES, bases: tuple[int, int] = BASES):
    """UDF: binary -> an entry per chunk of ``chunk`` bytes: length, hashes, and base^length (the shift)."""

    @F.arrow_udf(f"array<struct<{PART}>>")
    def hashes(texts: pa.Array) -> pa.Array:
        powers = [_powers(b, p, chunk) for b, p in zip(bases, primes)]
        cols, count = {c: [] for c in ("n", "h1", "h2", "p1", "p2")}, []
        for t in texts:
            raw = t.as_buffer() if t.is_valid else None
            b = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
            count.append(-(-len(b) // chunk))
            for at in range(0, len(b), chunk):
                part = b[at:at + chunk].astype(np.int64)
                cols["n"].append(len(part))
                for k in (0, 1):
                    # A term is below 2^39, a sum of 2^16 terms below 2^55.
                    cols[f"h{k + 1}"].append(int(np.dot(part, powers[k][len(part) - 1::-1]) % primes[k]))
                    cols[f"p{k + 1}"].append(int(powers[k][len(part)]))
        rows = pa.StructArray.from_arrays([pa.array(v, pa.int64()) for v in cols.values()], names=list(cols))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()), rows)

    return hashes


def combine(parts: Column, primes: tuple[int, int] = PRIMES) -> Column:
    """Fingerprint of the concatenation of hashed parts, in order; itself a part that combines on."""
    one = F.lit(1).cast("long")
    none = F.lit(0).cast("long")
    empty = F.struct(none.alias("n"), none.alias("h1"), none.alias("h2"), one.alias("p1"), one.alias("p2"))

    def step(acc: Column, x: Column) -> Column:
        return F.struct((acc["n"] + x["n"]).alias("n"),
                        *[((acc[f"h{k}"] * x[f"p{k}"] + x[f"h{k}"]) % F.lit(p)).alias(f"h{k}") for k, p in ((1, primes[0]), (2, primes[1]))],
                        *[(acc[f"p{k}"] * x[f"p{k}"] % F.lit(p)).alias(f"p{k}") for k, p in ((1, primes[0]), (2, primes[1]))])

    return F.aggregate(parts, empty, step)


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK,
                 primes: tuple[int, int] = PRIMES, bases: tuple[int, int] = BASES) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, and the fingerprint
    (n_bytes, h1, h2).

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  The row with the
    largest id of equal texts stays.  Rows with a null id are members of their group but never its
    survivor, unless all ids of the group are null: then keep_id is null and each of them stays.
    Rows that repeat an id and its text all stay, or go, together.  An empty table gives an empty
    result; other columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "exact")
    body = docs.select(F.col(id_col).alias("id"), lower_az(F.coalesce(F.col(text_col), F.lit(""))).cast("binary").alias("body"))
    print_ = combine(chunk_hashes(chunk, primes, bases)(F.col("body")), primes)
    hashed = body.select("id", "body", print_.alias("fp"))
    rows = scratch.put("rows", hashed.select(
        "id", F.col("fp.n").alias("n_bytes"), "fp.h1", "fp.h2", F.sha2("body", 256).alias("text_sha256")))

    key = ["n_bytes", "h1", "h2"]
    sizes = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id"))
    pieces = (hashed.select(F.col("fp.n").alias("n_bytes"), "fp.h1", "fp.h2", "body",
                            F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.greatest(F.col("fp.n") - 1, F.lit(0)) / F.lit(chunk)))).alias("no"))
              .select(*key, "no", F.substring(F.col("body"), (F.col("no") * chunk + 1).cast("int"), F.lit(chunk)).alias("piece")))
    same = (pieces.groupBy(*key, "no").agg(F.min("piece").alias("a"), F.max("piece").alias("b"))
            .groupBy(*key).agg(F.bool_and(F.col("a") == F.col("b")).alias("same")))
    groups = scratch.put("groups", sizes.join(same, key))
    good = rows.join(groups.filter("same").drop("same"), key)
    out = [good.select("id", "keep_id", "group_size", *key, "text_sha256")]
    collided = groups.filter(~F.col("same")).select(*key)
    if collided.head(1):
        odd = hashed.select("id", "body", F.col("fp.n").alias("n_bytes"), "fp.h1", "fp.h2").join(collided, key, "left_semi")
        by_text = odd.groupBy("body").agg(F.count(F.lit(1)).alias("group_size"), F.max("id").alias("keep_id"))
        out.append(odd.join(by_text, "body").select("id", "keep_id", "group_size", *key, F.sha2("body", 256).alias("text_sha256")))
    res = out[0] if len(out) == 1 else out[0].unionByName(out[1])
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return res.select(F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long"), kept.alias("kept"), "text_sha256", *key)

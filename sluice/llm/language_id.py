"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is lower-cased (A-Z), its ASCII non-letters become spaces, and every byte n-gram of length
3 and 4 that is not all spaces is hashed to a row of an embedding table.  The text's vector is the
average of those rows; a linear layer and softmax give the languages.  Table and layer are trained
together by stochastic gradient descent in numpy on a bounded, documented sample of labelled rows.
For prediction the linear layer is multiplied into the table, so a text costs one table row of
class scores per n-gram.  A temperature and a rejection threshold are calibrated on a part of the
sample that the training does not see.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.words import encode, slices

BUCKETS, DIM = 1 << 15, 16
SAMPLE_PER_LANGUAGE = 400      # expected labelled rows collected per language ...
SAMPLE_BYTES = 4000            # ... at a window of so many characters of each, wherever it lies
MAX_LANGUAGES = 200            # more labels than this are refused, not dropped
REJECT_QUANTILE = 0.001        # share of right calibration answers that the threshold may cost
PIECE = 1 << 20                # bytes of a text that are hashed at a time

_A, _B = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


def _letters() -> np.ndarray:
    """Byte map: letters and bytes above ASCII stay, A-Z lower-cased, all else is a space."""
    t = np.full(256, 32, np.uint8)
    t[128:] = np.arange(128, 256)
    t[97:123] = t[65:91] = np.arange(97, 123)
    return t


def _grams(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, table row) of every n-gram of the normalised bytes; 0 bytes separate texts."""
    x = b.astype(np.uint32)
    if len(b) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    three = x[:-2] | (x[1:-1] << np.uint32(8)) | (x[2:] << np.uint32(16))
    end = b == 0
    ok3 = ~(end[:-2] | end[1:-1] | end[2:]) & (three != np.uint32(0x202020))
    four = three[:-1] | (x[3:] << np.uint32(24))
    ok4 = ok3[:-1] & ~end[3:]
    s3, s4 = np.flatnonzero(ok3), np.flatnonzero(ok4)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    rows = np.concatenate([((three[s3] * _A) ^ (three[s3] >> np.uint32(7))) * _A >> shift,
                           ((four[s4] * _B) ^ (four[s4] >> np.uint32(9))) * _B >> shift])
    return np.concatenate([s3, s4]), rows.astype(np.int64)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    table: np.ndarray           # BUCKETS x languages, the embedding table times the linear layer
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities (texts x languages) and number of n-grams of each text."""
        letters, out = _letters(), np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        for a, b in slices(texts, PIECE):
            if b == a + 1 and len(texts[a] or b"") > PIECE:  # a very long text goes piece by piece
                for at in range(0, len(texts[a]), PIECE):
                    # n-grams that start in this piece; three bytes more complete the last ones.
                    part = np.concatenate(([32], letters[np.frombuffer(texts[a][max(0, at):at + PIECE + 3], np.uint8)]))
                    start, rows = _grams(part)
                    rows = rows[(start < PIECE + 1) & ((start > 0) | (at == 0))]
                    out[a] += self.table[rows].sum(0)
                    count[a] += len(rows)
                continue
            lens = np.array([len(t or b"") for t in texts[a:b]])
            flat = np.frombuffer(b"".join(b"\x00 " + (t or b"").replace(b"\x00", b" ") + b" " for t in texts[a:b]), np.uint8)
            norm = letters[flat]
            norm[flat == 0] = 0
            owner = np.repeat(np.arange(a, b), lens + 3)
            start, rows = _grams(norm)
            who = owner[start]
            count += np.bincount(who, minlength=len(texts))
            for k in range(len(self.languages)):
                out[:, k] += np.bincount(who, weights=self.table[rows, k], minlength=len(texts))
        z = (out / np.maximum(count, 1)[:, None] + self.bias) / self.temperature
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True), count


def train(texts: list[bytes], labels: list[str], seed: int = 7, epochs: int = 12, rate: float = 3.0) -> Model:
    """Model of the labels' languages.  Rows are used in the order given; a fifth calibrates."""
    languages = tuple(sorted(set(labels)))
    y = np.array([languages.index(x) for x in labels])
    rng = np.random.default_rng(seed)
    letters = _letters()
    features = []
    for t in texts:
        _, rows = _grams(np.concatenate(([32], letters[np.frombuffer(t, np.uint8)], [32])).astype(np.uint8))
        features.append(np.unique(rows, return_counts=True))
    usable = np.array([len(r) > 0 for r, _ in features])
    order = rng.permutation(np.flatnonzero(usable))
    # Each language has at least one row to learn from; a fifth of the others calibrates.
    first = {y[i]: i for i in order[::-1]}
    hold = [i for i in order[: len(order) // 5] if first[y[i]] != i]
    learn = np.setdiff1d(order, hold)
    emb = rng.normal(0, 0.1, (BUCKETS, DIM))
    lin = rng.normal(0, 0.1, (DIM, len(languages)))
    bias = np.zeros(len(languages))
    weight = np.zeros(len(languages))
    np.add.at(weight, y[learn], 1)
    weight = weight.sum() / np.maximum(weight, 1) / len(languages)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for i in rng.permutation(learn):
            rows, n = features[i]
            share = (n / n.sum())[:, None]
            v = (emb[rows] * share).sum(0)
            z = v @ lin + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            g = p.copy()
            g[y[i]] -= 1
            g *= min(weight[y[i]], 5.0)
            back = lin @ g
            lin -= step * 0.1 * np.outer(v, g)
            bias -= step * 0.01 * g
            emb[rows] -= step * share * back
    table = emb @ lin

    def logits(ids) -> np.ndarray:
        return np.array([(table[r] * (n / n.sum())[:, None]).sum(0) + bias for r, n in (features[i] for i in ids)]).reshape(-1, len(languages))

    check = hold or list(learn)
    z, goal = logits(check), y[check]

    def loss(t: float) -> float:
        s = z / t
        s = s - s.max(1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(1)) - s[np.arange(len(goal)), goal]))

    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 5.0), key=loss) if len(languages) > 1 else 1.0
    p = np.exp((z - z.max(1, keepdims=True)) / temperature)
    p /= p.sum(1, keepdims=True)
    right = p.max(1)[p.argmax(1) == goal]
    threshold = 0.9 * float(np.quantile(right, REJECT_QUANTILE)) if len(right) else 0.0
    return Model(languages, table.astype(np.float32), bias, temperature, min(threshold, 0.5))


def learn_fold(doc_id: Column) -> Column:
    """True for rows that may be learned from: crc32 of the id as text, mod 4, is not 2."""
    return ~held_out(doc_id)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, window: int = SAMPLE_BYTES) -> tuple[list[bytes], list[str]]:
    """About ``per_language`` labelled rows of each language (all of them if there are fewer), chosen
    by a hash of the text, as a window of ``window`` characters at a place the hash names too."""
    rows = docs.filter(learn_fold(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy("lang").limit(MAX_LANGUAGES + 1).collect()}
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return [], []
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.coalesce(*[F.when(F.col("lang") == k, F.lit(min(1.0, per_language / n))) for k, n in counts.items()])
    start = F.pmod(F.xxhash64("text", F.lit(1)), F.greatest(F.length("text") - window + 1, F.lit(1))) + 1
    picked = (rows.select("lang", "text", draw.alias("draw"), share.alias("share")).filter("draw < share")
              .select("lang", F.substring("text", start.cast("int"), F.lit(window)).alias("text"), F.xxhash64("text").alias("h"))
              .orderBy("h", "lang").limit(2 * per_language * len(counts)).collect())
    return [r["text"].encode("utf-8", "surrogatepass") for r in picked], [r["lang"] for r in picked]


def fit(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Model learned from the labelled rows of ``docs`` outside the held-out fold; None without any."""
    texts, labels = labelled_sample(docs, per_language)
    return train(texts, labels) if texts else None


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """All rows and columns of ``docs`` plus lang_pred, score, rejected (replacing such columns).

    Only the text enters.  Null texts and texts without a letter, and all texts if there was
    nothing to learn from, are ``und`` with score 0 and rejected.  Others get the most likely
    language and its calibrated probability, and are rejected below the model's threshold.  An
    empty table gives an empty result.
    """
    base = docs.drop("lang_pred", "score", "rejected", "__p")
    letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    if model is None:
        return base.withColumns({"lang_pred": F.lit("und"), "score": F.lit(0.0), "rejected": F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats, whatever the input

    @F.arrow_udf("struct<lang:string,score:double>")
    def best(column: pa.Array) -> pa.Array:
        m = shared.value
        p, _ = m.scores(encode(column))
        k = p.argmax(1)
        return pa.StructArray.from_arrays([pa.array([m.languages[i] for i in k], pa.string()), pa.array(p.max(1), pa.float64())], names=["lang", "score"])

    rows = base.withColumn("__p", best(F.col("text")))
    return rows.select(*base.columns, F.when(letter, F.col("__p.lang")).otherwise("und").alias("lang_pred"),
                       F.when(letter, F.least(F.col("__p.score"), F.lit(1.0))).otherwise(0.0).alias("score"),
                       (~letter | (F.col("__p.score") < model.threshold)).alias("rejected"))

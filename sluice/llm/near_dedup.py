"""Near-duplicate documents by SetSketch.

Sketch.  A document's set is its distinct five-word shingles.  Each element produces, from its hash
alone, the points of a Poisson process that are dealt to ``M`` registers; a register keeps the
smallest point of any element, on an exponentially spaced scale (base ``BASE``, truncated to 16
bits).  So a sketch is mergeable (registerwise) and two registers agree with a probability that
follows the Jaccard similarity.  Points beyond a horizon that every register reaches first are
never generated, which makes the work per document independent of its length.

Links.  Texts with the same word sequence form a class with one representative.  Bands of
``ROWS`` register values put representatives into buckets.  Within a bucket every member is paired
with the smallest one only; pairs are estimated by the joint likelihood of the registers' orderings
and dropped if any similarity of ``percent`` or more is e^-12 times less likely than the best one;
the rest is verified on the full sets.  Where members of a bucket end up in different components,
the members outside its largest component are then paired with all others in the bucket, so no
candidate pair that could join two components stays unverified.  Before that, members are peeled
off that provably have no link there: two sets of sizes a and b at the threshold share at least
percent * (a + b) / (100 + percent) elements, so a member needs that many elements which other open
members hold too; peeling is repeated, as elements lose their other holders.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch
from sluice.llm.components import components
from sluice.llm.words import Words, encode, mix64, slices, white_table

SHINGLE = 5
PERCENT = 75
M, ROWS = 128, 4        # registers; registers per band: P(no shared band) at 0.75 is 5e-6
BASE = 1.001
LEVEL_0 = 8000          # level of a minimum of 1; levels span e^8 .. e^-57
MARGIN = 12.0           # log-likelihood ratio below which an estimate rejects a pair
PEELS = 2               # rounds of peeling; each is sound, more of them only prune more
FEW = 8                 # members that hold an element at most, for it to pair them

_MUL = np.uint64(0x9E3779B97F4A7C15)


def sketch(hashes: np.ndarray, owner: np.ndarray, sizes: np.ndarray, m: int = M) -> np.ndarray:
    """Registers (sets x m, uint16) of sets given as element hashes with the set each belongs to."""
    n_sets = len(sizes)
    low = np.full((n_sets, m), np.inf)
    horizon = (np.log(m) + 12.0) / np.maximum(sizes, 1)
    todo = np.flatnonzero(sizes > 0)
    while len(todo):
        mine = np.isin(owner, todo) if len(todo) < n_sets else slice(None)
        e, d = hashes[mine], owner[mine]
        x, j, block = np.zeros(len(e)), 0, 4
        while len(e):
            r = mix64(e[:, None] + (np.arange(j + 1, j + block + 1, dtype=np.uint64) * _MUL)[None, :])
            u = ((r >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53
            at = x[:, None] + np.cumsum(-np.log(u) / m, axis=1)
            reg = (mix64(r + _MUL) % np.uint64(m)).astype(np.int64) + d[:, None] * m
            inside = at <= horizon[d][:, None]
            np.minimum.at(low.reshape(-1), reg[inside], at[inside])
            go = inside[:, -1]
            e, d, x, j, block = e[go], d[go], at[go, -1], j + block, min(block * 4, 256)
        todo = todo[np.isinf(low[todo]).any(axis=1)]
        low[todo] = np.inf
        horizon[todo] *= 4
    with np.errstate(divide="ignore", invalid="ignore"):
        level = np.floor(LEVEL_0 - np.log(low) / np.log(BASE))
    return np.clip(np.nan_to_num(level, neginf=0, posinf=65535), 0, 65535).astype(np.uint16)


def shingle_sets(texts: list[bytes | None], k: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    w = Words(texts, white_table())
    at, h = w.shingles(k)
    cuts = np.searchsorted(w.text[at], np.arange(1, len(texts))) if w.n else []
    return [np.unique(x) for x in np.split(h, cuts)] if w.n else [h] * len(texts)


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _sketch_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = encode(batch.column("text"))
        for a, b in slices(texts):
            sets = shingle_sets(texts[a:b])
            sizes = np.array([len(s) for s in sets], np.int64)
            regs = sketch(np.concatenate(sets), np.repeat(np.arange(b - a), sizes), sizes).view(np.uint64).view(np.int64)
            same = [hashlib.blake2b(b" ".join((t or b"").translate(_LOWER).split()), digest_size=16).digest() for t in texts[a:b]]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id").slice(a, b - a), pa.array(sizes), pa.array(same, pa.binary()),
                pa.ListArray.from_arrays(pa.array(np.arange(b - a + 1) * regs.shape[1], pa.int32()), pa.array(regs.reshape(-1)))],
                names=["doc_id", "n", "words", "regs"])


_GRID = np.arange(1, 64) / 64.0


def _p(x: np.ndarray) -> np.ndarray:
    return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)


def similar(n_u, n_v, more, less, equal, percent: int = PERCENT, margin: float = MARGIN) -> np.ndarray:
    """Whether a Jaccard similarity of at least ``percent`` is credible, by the joint likelihood of
    the numbers of registers where u's level is above, below and equal to v's, given the set sizes."""
    u, v = n_u / (n_u + n_v), n_v / (n_u + n_v)
    top = np.minimum(u / v, v / u)
    goal = percent / 100.0
    best, best_goal = np.full(len(u), -np.inf), np.full(len(u), -np.inf)
    for j in np.concatenate([_GRID, [goal, 1 - 1e-9]]):
        x = np.minimum(j, top)
        p, q = np.maximum(_p(np.maximum(u - v * x, 0)), 1e-12), np.maximum(_p(np.maximum(v - u * x, 0)), 1e-12)
        ll = more * np.log(p) + less * np.log(q) + equal * np.log(np.maximum(1 - p - q, 1e-12))
        best = np.maximum(best, ll)
        if j >= goal:
            best_goal = np.maximum(best_goal, ll)
    return (top >= goal - 1e-12) & (best - best_goal <= margin)


def _estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.asarray(batch.column(c).flatten()).view(np.uint16).reshape(batch.num_rows, -1).astype(np.int32) for c in ("regs_u", "regs_v"))
        more, less, equal = (a > b).sum(1), (a < b).sum(1), (a == b).sum(1)
        ok = similar(np.asarray(batch.column("n_u")).astype(float), np.asarray(batch.column("n_v")).astype(float), more, less, equal)
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v"), pa.array(equal.astype(np.int32))], names=["u", "v", "equal"]).filter(pa.array(ok))


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = encode(batch.column("text"))
        for a, b in slices(texts):
            sets = shingle_sets(texts[a:b])
            rows = pa.array(np.repeat(np.arange(a, b), [len(x) for x in sets]))
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), pa.array(np.concatenate(sets).view(np.int64))], names=["id", "h"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right = encode(batch.column("text_u")), encode(batch.column("text_v"))
        ok = np.zeros(batch.num_rows, bool)
        for a, b in slices([x + y if x and y else None for x, y in zip(left, right)]):
            su, sv = shingle_sets(left[a:b]), shingle_sets(right[a:b])
            for i, (x, y) in enumerate(zip(su, sv)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[a + i] = both > 0 and 100 * both >= PERCENT * (len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(ok))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are runs of anything but ASCII white space, A-Z lower-cased.  Null, empty and white texts
    have an empty set and are linked with nothing.  A component's id is its smallest doc_id, and
    rows of that id are kept.  Rows that share a doc_id are one document for the links, so their
    components are joined.  Rows with a null doc_id are linked with nothing: component_id is null
    and they are kept.  An empty table gives an empty result; other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "near")
    sketches = scratch.put("sketches", docs.select("doc_id", "text").mapInArrow(
        _sketch_batches, "doc_id bigint, n bigint, words binary, regs array<bigint>"))
    numbered = sketches.filter("doc_id IS NOT NULL AND n > 0")
    members = numbered.select("words", "doc_id", "n")
    reps = numbered.groupBy("words").agg(F.min("doc_id").alias("id"))
    # A representative's row is the one with the class's words and smallest id.
    heads = scratch.put("heads", numbered.join(reps.withColumnRenamed("words", "w"), (F.col("words") == F.col("w")) & (F.col("doc_id") == F.col("id")))
                        .select("id", "n", "words", "regs").dropDuplicates(["id", "words"]))

    band = heads.select("id", "n", F.posexplode("regs").alias("no", "value")).select(F.xxhash64("no", "value").alias("key"), "id", "n")
    firsts = scratch.put("firsts", band.groupBy("key").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1"))
    buckets = scratch.put("buckets", band.join(firsts, "key"))

    def credible(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda s: heads.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("regs").alias(f"regs_{s}"))
        joined = pairs.join(side("u"), "u").join(side("v"), "v").select("u", "v", "n_u", "n_v", "regs_u", "regs_v")
        return scratch.put(name, joined.mapInArrow(_estimate, "u bigint, v bigint, equal int"))

    # Texts of all bucket members, once; every later check reads this table.
    texts = scratch.put("texts", docs.select(F.col("doc_id").alias("id"), "text").join(buckets.select("id").distinct(), "id", "left_semi"))
    several = scratch.put("several", texts.groupBy("id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("id"))

    def verified(pairs: DataFrame, name: str) -> DataFrame:
        side = lambda s: texts.select(F.col("id").alias(s), F.col("text").alias(f"text_{s}"))
        joined = pairs.select("u", "v").join(side("u"), "u").join(side("v"), "v").select("u", "v", "text_u", "text_v")
        return scratch.put(name, joined.mapInArrow(_verify, "u bigint, v bigint").distinct())

    enough = lambda a, b: (F.lit(100) * F.least(a, b) >= F.lit(PERCENT) * F.greatest(a, b))
    stars = credible(buckets.filter("id <> first").select(F.col("first").alias("u"), F.col("id").alias("v")).distinct(), "stars")

    # First the most alike smaller document of each; then only pairs that could join two components.
    best = stars.groupBy("v").agg(F.max_by("u", "equal").alias("u")).select("u", "v")
    links = verified(best, "links1")
    label = components(links, scratch, "a")

    def across(pairs: DataFrame, of: DataFrame) -> DataFrame:
        named = lambda s: of.select(F.col("id").alias(s), F.col("component").alias(f"c_{s}"))
        return (pairs.join(named("u"), "u", "left").join(named("v"), "v", "left")
                .filter(~F.coalesce("c_u", "u").eqNullSafe(F.coalesce("c_v", "v"))).select("u", "v"))

    more = across(stars.select("u", "v").join(best, ["u", "v"], "left_anti"), label)
    links = links.unionByName(verified(more, "links2"))
    label = scratch.put("labels", components(links, scratch, "b"))

    # Buckets whose members are still in several components: all pairs that cross.
    placed = (buckets.filter("size > 2").join(label, "id", "left")
              .select("key", "id", "n", F.coalesce("component", "id").alias("component")))
    parts = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("size"))
    split = parts.groupBy("key").agg(F.max_by("component", "size").alias("big"), F.count(F.lit(1)).alias("parts")).filter("parts > 1").select("key", "big")
    open_ = scratch.put("open", placed.join(split, "key"))

    def elements(of: DataFrame) -> tuple[DataFrame, DataFrame]:
        """(id, h) of the members with one text, and of those with several."""
        texts_of = texts.join(of.select("id").distinct(), "id")
        return (texts_of.join(several, "id", "left_anti").mapInArrow(_elements, "id bigint, h bigint"),
                texts_of.join(several, "id", "left_semi").mapInArrow(_elements, "id bigint, h bigint").distinct())

    for k in range(PEELS):
        one, more = elements(open_)
        # An id with several texts is not peeled: what is alone in one of them says nothing of the others.
        held = one.unionByName(more.withColumn("id", F.lit(None).cast("long")))
        alone = (held.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.min("id").alias("id")).filter("k = 1 AND id IS NOT NULL")
                 .groupBy("id").agg(F.count(F.lit(1)).alias("alone")))
        # The smallest partner that a member can have in a bucket asks for the least overlap.
        least = open_.groupBy("key").agg(F.min("n").alias("least"))
        partner = F.greatest("least", F.ceil(F.col("n") * PERCENT / 100))
        able = (open_.drop("shared").join(alone, "id", "left").join(least, "key")
                .withColumn("shared", F.col("n") - F.coalesce("alone", F.lit(0)))
                .filter(F.col("shared") * (100 + PERCENT) >= (F.col("n") + partner) * PERCENT).drop("alone", "least"))
        # Buckets in which one component is left are settled, and support no one any more.
        still = (able.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .filter("lo <> hi").select("key"))
        open_ = scratch.put(f"open{k}", able.join(still, "key"))
    # Pairs that share an element few members hold are found by it.  All others share only elements that
    # many hold, so that a member's number of those bounds what it can share with any of them.
    one, more = elements(open_)
    held = scratch.put("elements", one.unionByName(more))
    counts = scratch.put("elements_held", held.groupBy("h").agg(F.count(F.lit(1)).alias("k")).filter("k > 1"))
    few = held.join(counts.filter(F.col("k") <= FEW), "h").groupBy("h").agg(F.collect_set("id").alias("ids"))  # at most FEW
    by_few = (few.select(F.explode("ids").alias("u"), "ids").select("u", F.explode(F.filter("ids", lambda x: x > F.col("u"))).alias("v")).distinct())
    member = open_.select("id", "n", "component").distinct()
    side = lambda s: member.select(F.col("id").alias(s), F.col("n").alias(f"n_{s}"), F.col("component").alias(f"c_{s}"))
    by_few = by_few.join(side("u"), "u").join(side("v"), "v").filter((F.col("c_u") != F.col("c_v")) & enough(F.col("n_u"), F.col("n_v"))).select("u", "v")
    many = (held.join(counts.filter(F.col("k") > FEW), "h").join(several, "id", "left_anti").groupBy("id").agg(F.count(F.lit(1)).alias("many")))
    # A pair meets in every bucket that both are in; it is taken from the first of them.
    keys = open_.groupBy("id", "n").agg(F.collect_set("key").alias("keys"))  # at most one a band and text
    open_ = scratch.put("crossable", open_.join(keys, ["id", "n"]).join(several.select("id", F.lit(True).alias("more")), "id", "left")
                        .join(many, "id", "left").withColumn("many", F.when(F.col("more"), F.col("n")).otherwise(F.coalesce("many", F.lit(0)))))
    a, b = open_.filter("component <> big").alias("a"), open_.alias("b")
    once = F.array_min(F.array_intersect("a.keys", "b.keys")) == F.col("a.key")
    possible = F.least("a.many", "b.many") * (100 + PERCENT) >= (F.col("a.n") + F.col("b.n")) * PERCENT
    by_bucket = (a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.component") != F.col("b.component"))
                        & ((F.col("b.component") == F.col("b.big")) | (F.col("a.id") < F.col("b.id"))) & enough(F.col("a.n"), F.col("b.n")) & possible & once)
                 .select(F.least("a.id", "b.id").alias("u"), F.greatest("a.id", "b.id").alias("v")))
    crossing = by_bucket.unionByName(by_few).distinct().join(stars.select("u", "v"), ["u", "v"], "left_anti")
    rest = credible(crossing, "crossing")
    if rest.head(1):
        links = links.unionByName(verified(rest, "links3"))
        label = components(links, scratch, "c")

    # Rows of one doc_id with several texts tie their classes together.
    classes = members.groupBy("words").agg(F.min("doc_id").alias("id"))
    ties = (members.select("doc_id", "words").distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
            .join(members, "doc_id").join(classes, "words").select(F.col("doc_id").alias("u"), F.col("id").alias("v")).filter("u <> v").distinct())
    if ties.head(1):
        label = components(links.unionByName(ties), scratch, "d")
    final = classes.join(label, "id", "left").select("words", F.coalesce("component", "id").alias("component_id"))
    rows = sketches.select("doc_id", "n", "words").join(final, "words", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).cast("long")
    return (rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))

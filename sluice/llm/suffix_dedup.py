"""Removal of repeated byte strings of ``LENGTH`` bytes by a common-prefix interval tree.

Suffixes.  Not every suffix can be sorted at corpus scale, and need not be: of the ``GRAM``-byte
strings in any window of LENGTH bytes the one with the smallest hash (the first of equals) is the
window's anchor.  Equal windows have equal anchors at equal offsets, so windows are compared among
the occurrences of one anchor string only.  An occurrence stands for the run of window starts that
chose it; its context is the bytes these windows span.

Full repeats.  Occurrences whose whole contexts are equal repeat each other entirely; a hash of
the context tells, counted map-side, so copies in any number cost no comparison.

Partial repeats.  One occurrence of each distinct context goes on.  Those of one anchor string are
sorted by their right context into a suffix array with longest common prefixes; a stack scan yields
the intervals of suffixes with a common prefix of length l.  In an interval the left contexts,
sorted from right to left, tell how far each occurrence extends to the left together with another
one; where they do not all extend alike the interval is a maximal repeat, and left + l >= LENGTH
bytes around the occurrence are repeated.  Anchor strings with more than ``TREE_LIMIT`` distinct
contexts (a very common line) are not scanned in one task: their windows are hashed and counted one
by one with a map-side aggregation, which gives the same answer.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import Scratch
from sluice.llm.words import encode, mix64, slices

LENGTH = 200
GRAM = 64
TREE_LIMIT = 2000
_POSITION_BITS = np.uint64(30)
_T1 = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_T2 = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25))
_R1, _R2 = 0x5851F42D4C957F2D, 0xD1342543DE82EF95


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, np.uint64(base & (2**64 - 1)))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def gram_hashes(b: np.ndarray, k: int, table: np.ndarray = _T1, base: int = _R1) -> np.ndarray:
    """Hash of the k bytes from each position, by doubling (positions near the end are not valid)."""
    n = len(b)
    out, done, part, size, power = np.zeros(n, np.uint64), 0, table[b], 1, base
    rest = k
    while rest:
        if rest & 1:  # append the strings of ``size`` bytes that follow
            nxt = np.zeros(n, np.uint64)
            nxt[: max(0, n - done)] = part[done:]
            out = out * np.uint64(power) + nxt
            done += size
        rest >>= 1
        if rest:
            nxt = np.zeros(n, np.uint64)
            nxt[: max(0, n - size)] = part[size:]
            part = part * np.uint64(power) + nxt
            size, power = size * 2, power * power % 2**64
    return mix64(out)


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i:i + w] for each i (shorter at the end)."""
    out, size = x.copy(), 1
    while size < w:
        step = min(size, w - size)
        n = max(0, len(x) - step)
        out[:n] = np.minimum(out[:n], out[step:])
        size += step
    return out


class Anchors:
    """Anchors of some texts: text, position p, and the window starts p - a .. p - b that chose it."""

    def __init__(self, texts: list[bytes | None], length: int = LENGTH, gram: int = GRAM):
        lens = np.array([len(t or b"") for t in texts], np.int64)
        self.buf = np.frombuffer(b"".join(t or b"" for t in texts), np.uint8)
        self.base = np.cumsum(lens) - lens
        n = len(self.buf)
        if n >= 1 << int(_POSITION_BITS):
            raise ValueError("a text of a gigabyte or more must be split first")
        starts = np.maximum(lens - length + 1, 0)
        if not starts.sum():
            self.text = self.p = self.a = self.b = np.zeros(0, np.int64)
            self.gram = self.context = np.zeros(0, np.uint64)
            return
        h = gram_hashes(self.buf, gram)
        packed = (h >> _POSITION_BITS << _POSITION_BITS) | np.arange(n, dtype=np.uint64)
        low = _sliding_min(packed, length - gram + 1)
        text = np.repeat(np.arange(len(texts)), starts)
        s = np.arange(starts.sum()) - np.repeat(np.cumsum(starts) - starts, starts) + self.base[text]
        p = (low[s] & ((np.uint64(1) << _POSITION_BITS) - np.uint64(1))).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (p[1:] != p[:-1]) | (text[1:] != text[:-1]))))
        last = np.concatenate((new[1:] - 1, [len(s) - 1]))
        self.text, at = text[new], p[new]
        first, final = s[new], s[last]
        self.gram = h[at]
        # Context bytes first .. final + length, by a prefix polynomial that is divided by R^first.
        powers = _powers(_R2, n)
        total = np.concatenate(([np.uint64(0)], np.cumsum(_T2[self.buf] * powers[:n], dtype=np.uint64)))
        inverse = _powers(pow(_R2, -1, 2**64), n)
        self.p, self.a, self.b = at - self.base[self.text], at - first, at - final
        whole = (total[final + length] - total[first]) * inverse[first]
        self.context = mix64(whole + self.a.astype(np.uint64) * np.uint64(_R1) + self.b.astype(np.uint64))


def _anchor_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = encode(batch.column("text"))
        for x, y in slices(texts):
            k = Anchors(texts[x:y])
            rows = pa.array(k.text + x)
            yield pa.RecordBatch.from_arrays(
                [batch.column("ua").take(rows), batch.column("ub").take(rows), pa.array(k.gram.view(np.int64)), pa.array(k.context.view(np.int64)),
                 pa.array(k.p << 16 | k.a << 8 | k.b)], names=["ua", "ub", "gram", "context", "place"])


_ANCHOR = "ua bigint, ub bigint, gram bigint, context bigint, place bigint"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bytes left and right of the asked-for anchors, by anchor string."""
    for batch in batches:
        texts, asked = batch.column("text"), batch.column("asked")
        flat, owner = asked.flatten(), np.repeat(np.arange(batch.num_rows), np.diff(np.asarray(asked.offsets)))
        place, left, right = np.asarray(flat.field("place")), [], []
        last, body = -1, b""
        for i, x in zip(owner.tolist(), place.tolist()):
            if i != last:
                last, body = i, texts[i].as_py().encode("utf-8", "surrogatepass")
            p, a, b = x >> 16, x >> 8 & 255, x & 255
            left.append(body[p - a:p])
            right.append(body[p:p - b + LENGTH])
        rows = pa.array(owner)
        yield pa.RecordBatch.from_arrays(
            [flat.field("gram"), flat.field("single"), flat.field("kinds"), batch.column("ua").take(rows), batch.column("ub").take(rows), pa.array(place >> 16),
             pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["gram", "single", "kinds", "ua", "ub", "p", "left_", "right_"])


_CONTEXT = "gram bigint, single boolean, kinds bigint, ua bigint, ub bigint, p bigint, left_ binary, right_ binary"


def common_prefix(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    if x[:n] == y[:n]:
        return n
    lo, hi = 0, n  # x[:lo] == y[:lo], x[:hi] != y[:hi]
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if x[lo:mid] == y[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def prefix_intervals(lcp: list[int]) -> Iterator[tuple[int, int, int]]:
    """(prefix length, first, last) of the intervals of sorted suffixes 0 .. len(lcp) whose common
    prefix is longer than that of any wider interval; lcp[i] is that of suffixes i and i + 1."""
    stack: list[tuple[int, int]] = []
    for i, x in enumerate([*lcp, -1]):
        first = i
        while stack and stack[-1][0] > x:
            depth, first = stack.pop()
            yield depth, first, i
        if x >= 0 and (not stack or stack[-1][0] < x):
            stack.append((x, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], length: int) -> Iterator[tuple[int, int, list[int]]]:
    """Maximal repeats of at least ``length`` bytes around the occurrences of an anchor string, as
    (bytes to the left, bytes to the right, all occurrences).

    Every interval of the suffix array is a set of occurrences with a common right context that no
    longer context keeps together.  Within it, the left contexts sorted from right to left form
    intervals too; such a group has differing bytes (or a text's start) before its common left
    context - the left-extension diversity that makes a repeat maximal.  Groups that share more to
    the right than the interval does belong to a deeper interval and are left to it."""
    order = sorted(range(len(rights)), key=rights.__getitem__)
    rank = {x: k for k, x in enumerate(order)}
    back = [x[::-1] for x in lefts]
    lcp = [common_prefix(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    longest = max(map(len, lefts), default=0)
    for depth, first, last in prefix_intervals(lcp):
        if depth + longest < length:
            continue
        by_left = sorted(order[first:last + 1], key=back.__getitem__)
        shared = [common_prefix(back[a], back[b]) for a, b in zip(by_left, by_left[1:])]
        for reach, i, j in prefix_intervals(shared):
            if reach + depth >= length:
                group = by_left[i:j + 1]
                ranks = [rank[x] for x in group]
                if min(lcp[min(ranks):max(ranks)]) == depth:
                    yield reach, depth, group


def _tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repeated span around each occurrence of each anchor string; rows come sorted by it."""
    names = ["ua", "ub", "start", "end"]
    rows: list[tuple] = []
    out: list[list] = [[], [], [], []]

    def scan() -> None:
        # All spans of an occurrence hold its anchor, so that their union is one: the farthest to both sides.
        far: dict[int, tuple[int, int]] = {}
        for reach, depth, group in maximal_repeats([r[4] for r in rows], [r[5] for r in rows], LENGTH):
            for i in group:
                if rows[i][0]:
                    a, b = far.get(i, (0, 0))
                    far[i] = (max(a, reach), max(b, depth))
        for i, (reach, depth) in sorted(far.items()):
            _, ua, ub, p, _, _ = rows[i]
            for column, value in zip(out, (ua, ub, p - reach, p + depth)):
                column.append(value)

    last = None
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("gram", "single", "ua", "ub", "p", "left_", "right_"))):
            if r[0] != last:
                if rows:
                    scan()
                rows, last = [], r[0]
            rows.append(r[1:])
        if len(out[0]) > 20000:
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=names)
            out = [[], [], [], []]
    if rows:
        scan()
    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], names=names)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of every window of each context."""
    for batch in batches:
        left, right = batch.column("left_").to_pylist(), batch.column("right_").to_pylist()
        texts = [x + y for x, y in zip(left, right)]
        for x, y in slices(texts, 1 << 18):
            lens = np.array([len(t) for t in texts[x:y]])
            b = np.frombuffer(b"".join(texts[x:y]), np.uint8)
            n = lens - LENGTH + 1
            owner = np.repeat(np.arange(x, y), n)
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            s = inside + (np.cumsum(lens) - lens)[owner - x]
            rows = pa.array(owner)
            start = np.asarray(batch.column("p"))[owner] - np.array([len(v) for v in left])[owner] + inside
            yield pa.RecordBatch.from_arrays(
                [batch.column("single").take(rows), batch.column("ua").take(rows), batch.column("ub").take(rows), pa.array(start),
                 pa.array(gram_hashes(b, LENGTH)[s].view(np.int64)), pa.array(gram_hashes(b, LENGTH, _T2, _R2)[s].view(np.int64))],
                names=["single", "ua", "ub", "start", "w1", "w2"])


def _row_key(doc_id: Column, text: Column) -> list[Column]:
    return [F.coalesce(doc_id, F.lit(-(1 << 62))).alias("ua"), F.xxhash64(text, doc_id.isNull()).alias("ub")]


def repeated_spans(docs: DataFrame, tree_limit: int = TREE_LIMIT) -> tuple[DataFrame, DataFrame]:
    """(rows with keys ua, ub; spans ua, ub, start, end): byte ranges of each text, possibly
    overlapping, whose union is every byte of a string of LENGTH bytes that starts elsewhere too."""
    scratch = Scratch(docs.sparkSession, "suffix")
    rows = docs.select(*_row_key(F.col("doc_id"), F.col("text")), "doc_id", "text")
    anchors = rows.select("ua", "ub", "text").mapInArrow(_anchor_batches, _ANCHOR)
    # A table of its own: the join with it is then one that Spark can split at a hot anchor string.
    repeated = scratch.put("repeated", anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"))
    found = scratch.put("anchors", anchors.join(repeated, "gram"))

    kinds = found.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ua", "ub", "place")).alias("one"))
    mixed = (kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"))
             .filter("kinds > 1 AND least = 1").select("gram", "kinds"))
    place = lambda: (F.shiftright("place", 16), F.shiftright("place", 8).bitwiseAND(F.lit(255)), F.col("place").bitwiseAND(F.lit(255)))
    p, a, b = place()
    full = (found.join(kinds.filter("n > 1").select("gram", "context"), ["gram", "context"])
            .select("ua", "ub", (p - a).alias("start"), (p - b + LENGTH).alias("end")))
    asked = scratch.put("asked", kinds.join(mixed, "gram").select(
        "one.ua", "one.ub", F.struct("gram", "one.place", (F.col("n") == 1).alias("single"), "kinds").alias("x"))
        .groupBy("ua", "ub").agg(F.collect_list("x").alias("asked")))
    contexts = rows.join(asked, ["ua", "ub"]).select("ua", "ub", "doc_id", "text", "asked").mapInArrow(_contexts, _CONTEXT)
    contexts = scratch.put("contexts", contexts)
    tree = (contexts.filter(F.col("kinds") <= tree_limit).repartition("gram").sortWithinPartitions("gram")
            .mapInArrow(_tree, "ua bigint, ub bigint, start bigint, end bigint"))
    windows = contexts.filter(F.col("kinds") > tree_limit).mapInArrow(
        _windows, "single boolean, ua bigint, ub bigint, start bigint, w1 bigint, w2 bigint")
    twice = windows.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("w1", "w2")
    common = (windows.filter("single").join(twice, ["w1", "w2"])
              .select("ua", "ub", "start", (F.col("start") + LENGTH).alias("end")))
    return rows, full.unionByName(tree).unionByName(common)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for text, spans in zip(batch.column("text"), batch.column("spans").to_pylist()):
            body = (text.as_py() or "").encode("utf-8", "surrogatepass")
            runs = merge([(s["start"], s["end"]) for s in spans or ()])
            digest, at = hashlib.sha256(), 0
            for s, e in runs:
                digest.update(body[at:s])
                at = e
            digest.update(body[at:])
            rows.append((len(body), sum(e - s for s, e in runs), len(runs), [{"start": s, "end": e} for s, e in runs], digest.hexdigest()))
        n, removed, count, runs, sha = zip(*rows) if rows else ([],) * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()),
             pa.array(runs, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(sha, pa.string())],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256"])


def remove_repeats(docs: DataFrame, tree_limit: int = TREE_LIMIT) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, spans (the maximal removed byte
    runs), kept_sha256.

    Texts are UTF-8 bytes; null counts as empty.  Texts shorter than LENGTH lose nothing.  Rows with
    null or repeated doc_ids are rows of their own: a repeated row is a copy of the other.  An empty
    table gives an empty result; other columns are ignored.
    """
    rows, spans = repeated_spans(docs, tree_limit)
    by_row = spans.distinct().groupBy("ua", "ub").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = rows.join(by_row, ["ua", "ub"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(_cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                                   "spans array<struct<start:bigint,end:bigint>>, kept_sha256 string")

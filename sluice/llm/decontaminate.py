"""Benchmark decontamination by CGK embedding and bit-sampling LSH over item-sized windows.

Embedding.  A random walk reads a word sequence: at step t it emits the current word and advances
or not by a random bit of (t, word).  Sequences at a small edit distance fall out of step for a few
emissions and then, with good probability, meet again, so edit distance becomes Hamming distance
(Chakraborty, Goldenberg, Koucky 2016).

Search.  Windows start at anchors: word pairs whose hash is the smallest of ``ANCHOR`` consecutive
pairs, which a passage has at the same places wherever it stands.  Every item of L words has
windows of sizes up to L - 6 and down to a quarter of L.  Each of ``REPEATS`` independent walks
samples ``SAMPLED`` emissions per window size; a document window whose samples equal an item's is a
candidate.  Candidates are verified by the exact semi-global word edit distance between the item
and the document around the place it should stand at.

Items of fewer than ``MIN_WORDS`` words are searched too, by the hash of their whole run of words
and without edits.  Characters of scripts written without blanks are words of their own.

Unedited passages are always found (equal windows have equal anchors and walks); the repeats are
chosen so that at the full allowance of edits the measured recall is above 0.9 (see the tests).

The benchmark is a query set: it is processed in blocks of at most ``BLOCK_WORDS`` words, each of
which is broadcast to one scan over all documents.  Documents are not shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.words import Words, encode, mix64, punctuation_table, slices

MIN_WORDS = 10              # items of fewer words are searched without edits
EDITS_PERCENT = 15          # edits allowed, as a share of the item's words
REPEATS, SAMPLED = 4, 4
SIZES = (4, 6, 9, 13, 19, 28, 42, 63, 95, 142, 213, 320, 480, 720, 1080)
ANCHOR = 7
BLOCK_WORDS = 500_000
BLOOM_BITS = 22
WALK_BYTES = 1 << 18        # bytes of text walked at a time: the walk's arrays stay in the cache

MATCH = "struct<item_id:bigint,item_words:bigint,edits:bigint,start_word:bigint,end_word:bigint>"


class Layout:
    """Word hashes of texts with a zero after each text, and the anchors."""

    def __init__(self, texts: list[bytes | None]):
        w = Words(texts, punctuation_table(), True)
        self.count, self.first = w.count, w.first + np.arange(len(texts))
        self.hash = np.zeros(w.n + len(texts), np.uint64)
        place = np.arange(w.n) + w.text
        self.hash[place] = w.hash | np.uint64(1)
        self.end = self.first + self.count  # where each text's zero stands
        n = len(self.hash)
        text = np.repeat(np.arange(len(texts)), w.count + 1)
        pair = np.full(n, np.iinfo(np.uint64).max, np.uint64)
        has = place[(place + 1) < self.end[w.text]]
        pair[has] = mix64(self.hash[has] * np.uint64(0x9E3779B97F4A7C15) + self.hash[has + 1])
        low = pair.copy()
        for k in range(1, min(ANCHOR, n)):
            low[: n - k] = np.minimum(low[: n - k], pair[k:])
        whole = np.arange(n) + ANCHOR < self.end[text]  # ANCHOR pairs from here lie in the text
        chosen = np.zeros(n, bool)
        for k in range(min(ANCHOR, n)):
            chosen[k:] |= (low[: n - k] == pair[k:]) & whole[: n - k]
        short = (w.count <= ANCHOR)[text] & (np.arange(n) < self.end[text])
        self.at = np.flatnonzero(chosen | short)
        self.text = text[self.at]

    def words(self, text: int, start: int, end: int) -> np.ndarray:
        a = self.first[text]
        return self.hash[a + max(0, start):min(a + end, self.end[text])]


def run_keys(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n words."""
    k = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        k = mix64(k + hashes[j:len(k) + j])
    return k


def _plan(sizes: list[int]):
    """For each repeat: multipliers of its steps, and which sizes sample which step."""
    out = []
    for r in range(REPEATS):
        rng = np.random.default_rng(1000 + r)
        odd = rng.integers(0, 2**63, 2048, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        sampled: dict[int, list[int]] = {}
        for s in SIZES:
            steps = np.random.default_rng([r, s]).choice(np.arange(int(1.6 * s)), SAMPLED, replace=False)
            if s in sizes:
                for t in steps:
                    sampled.setdefault(int(t), []).append(s)
        out.append((odd, sampled))
    return out


def window_keys(lay: Layout, sizes: list[int]):
    """Yield (size, key of every anchor's window) for each repeat."""
    step = np.empty(len(lay.at), np.uint64)
    for r, (odd, sampled) in enumerate(_plan(sizes)):
        cur = lay.at.copy()
        keys = {s: np.full(len(cur), np.uint64(s * 1000 + r)) for s in sizes}
        for t in range(max(sampled) + 1):
            # The zero after a text has a bit of 0 in every step: no walk leaves its text.
            np.take(lay.hash, cur, out=step, mode="clip")
            for s in sampled.get(t, ()):
                k = keys[s]
                k ^= step
                k *= np.uint64(0xBF58476D1CE4E5B9)
                k ^= k >> np.uint64(31)
            step *= odd[t]
            step >>= np.uint64(63)
            cur += step.view(np.int64)
        for s in sizes:
            yield s, mix64(keys[s])


def item_sizes(n: int) -> list[int]:
    fit = [s for s in SIZES if s <= n - 6]
    return [s for s in fit if 4 * s >= n or s == fit[-1]]


class Index:
    """Window keys and words of a block of benchmark items."""

    def __init__(self, ids: list[int], texts: list[bytes | None]):
        lay = Layout(texts)
        self.words = [lay.words(i, 0, int(lay.count[i])) for i in range(len(texts))]
        use = [i for i in range(len(texts)) if lay.count[i] >= MIN_WORDS]
        self.ids = ids
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by number of words: run hashes and items
        for n in sorted({len(w) for w in self.words if 0 < len(w) < MIN_WORDS}):
            items = np.array([i for i, w in enumerate(self.words) if len(w) == n])
            runs = np.array([run_keys(self.words[i], n)[0] for i in items], np.uint64)
            order = np.argsort(runs, kind="stable")
            self.short[n] = runs[order], items[order]
        per_item = {i: set(item_sizes(int(lay.count[i]))) for i in use}
        self.sizes = sorted(set().union(*per_item.values())) if per_item else []
        keys, items, offsets = [], [], []
        offset = lay.at - lay.first[lay.text]
        for s, k in window_keys(lay, self.sizes) if self.sizes else ():
            fits = np.array([i in per_item and s in per_item[i] for i in range(len(texts))])
            ok = fits[lay.text] & (offset + s <= lay.count[lay.text])
            keys.append(k[ok]), items.append(lay.text[ok]), offsets.append(offset[ok])
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(self.keys, kind="stable")
        self.keys = self.keys[order]
        self.item = np.concatenate(items)[order] if keys else np.zeros(0, np.int64)
        self.offset = np.concatenate(offsets)[order] if keys else np.zeros(0, np.int64)
        self.bloom = np.zeros(1 << BLOOM_BITS, bool)
        self.bloom[(self.keys >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)] = True

    def candidates(self, lay: Layout) -> set[tuple[int, int, int]]:
        """(text, item, word where the item would start) of windows that share a key."""
        found: set[tuple[int, int, int]] = set()
        offset = lay.at - lay.first[lay.text]
        for _, k in window_keys(lay, self.sizes) if self.sizes and len(lay.at) else ():
            near = np.flatnonzero(self.bloom[(k >> np.uint64(64 - BLOOM_BITS)).astype(np.int64)])
            lo, hi = np.searchsorted(self.keys, k[near], "left"), np.searchsorted(self.keys, k[near], "right")
            hit = hi > lo
            near, lo, n = near[hit], lo[hit], (hi - lo)[hit]
            if len(near):
                who = np.repeat(near, n)
                which = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found.update(zip(lay.text[who].tolist(), self.item[which].tolist(), (offset[who] - self.offset[which]).tolist()))
        return found

    def exact(self, lay: Layout) -> dict[tuple[int, int], tuple[int, int, int]]:
        """First place of each short item in each text."""
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n, (runs, items) in self.short.items():
            k = run_keys(lay.hash, n)
            lo, hi = np.searchsorted(runs, k, "left"), np.searchsorted(runs, k, "right")
            at = np.flatnonzero(hi > lo)
            text = np.searchsorted(lay.first, at, "right") - 1
            _, once = np.unique(np.stack([text, lo[at]]), axis=1, return_index=True)
            for p, t in zip(at[once].tolist(), text[once].tolist()):
                for i in items[lo[p]:hi[p]].tolist():
                    if np.array_equal(lay.hash[p:p + n], self.words[i]):
                        best[t, i] = (0, p - int(lay.first[t]), p - int(lay.first[t]) + n)
        return best

    def possible(self, lay: Layout, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        """Candidates that the words leave possible: each item word that is absent from the words
        looked at is an edit.  All candidates are counted together."""
        if not found:
            return found
        text, item, start = np.array(found, np.int64).T
        size = np.array([len(w) for w in self.words], np.int64)[item]
        allowed = size * EDITS_PERCENT // 100
        slack = allowed + allowed // 2 + 1
        low = lay.first[text] + np.maximum(0, start - slack)
        high = np.minimum(lay.first[text] + np.maximum(0, start + size + slack), lay.end[text])
        seen = np.maximum(high - low, 0)
        k = np.arange(len(found))
        tag = mix64(k.astype(np.uint64) + np.uint64(1))
        at = np.repeat(low - (np.cumsum(seen) - seen), seen) + np.arange(seen.sum())
        have = np.sort(lay.hash[at] ^ np.repeat(tag, seen))
        want = np.concatenate([self.words[i] for i in item.tolist()]) ^ np.repeat(tag, size)
        spot = np.minimum(np.searchsorted(have, want), max(len(have) - 1, 0))
        absent = np.bincount(np.repeat(k, size), weights=have[spot] != want if len(have) else np.ones(len(want)), minlength=len(found))
        return [c for c, ok in zip(found, (absent <= allowed).tolist()) if ok]

    def matches(self, texts: list[bytes | None]) -> list[list[dict]]:
        lay = Layout(texts)
        best = self.exact(lay)
        tried: set[tuple[int, int, int]] = set()
        found = sorted(self.candidates(lay))
        for text, item, start in (c for k in range(0, len(found), 1 << 13) for c in self.possible(lay, found[k:k + (1 << 13)])):
            goal = self.words[item]
            allowed = len(goal) * EDITS_PERCENT // 100
            # Starts that differ by no more than the allowance look at nearly the same words.
            if (text, item) in best and best[text, item][0] == 0:
                continue
            if any((text, item, start - k) in tried for k in range(allowed // 2 + 1)):
                continue
            tried.add((text, item, start))
            slack = allowed + allowed // 2 + 1
            a = max(0, start - slack)
            got = edit_match(goal, lay.words(text, a, start + len(goal) + slack), allowed)
            if got is not None:
                best[text, item] = min(best.get((text, item), (allowed + 1, 0, 0)), (got[0], a + got[1], a + got[2]))
        out: list[list[dict]] = [[] for _ in texts]
        for (text, item), (edits, start, end) in sorted(best.items()):
            out[text].append({"item_id": self.ids[item], "item_words": len(self.words[item]), "edits": edits, "start_word": start, "end_word": end})
        return out


def edit_match(goal: np.ndarray, words: np.ndarray, allowed: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the run of ``words`` nearest to ``goal`` in word edits, if at most
    ``allowed``; of equally near runs the one that ends first, and of these the shortest."""
    if np.count_nonzero(~np.isin(goal, words)) > allowed:  # each absent word is an edit
        return None
    n = len(words)
    index = np.arange(n + 1)
    # Edits and start travel in one number: fewer edits first, then the later start.
    scale = np.int64(n + 2)
    row = n - index
    for i, g in enumerate(goal):
        new = np.minimum(np.concatenate(([np.int64(1) << 50], row[:-1] + np.where(words == g, 0, scale))), row + scale)
        row = np.minimum.accumulate(new - index * scale) + index * scale
    end = int(np.argmin(row // scale))
    edits = int(row[end] // scale)
    return (edits, int(n - row[end] % scale), end) if edits <= allowed else None


# All but the characters that are words of their own.
_SPACED = r"[^\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3000-\u9FFF\uF900-\uFAFF\uFF00-\uFFFF\x{20000}-\x{3FFFF}]"


def benchmark_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> list[Index]:
    """Indexes of the benchmark's items, each of at most about ``block_words`` words."""
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", "text").distinct()
    characters = F.length(F.regexp_replace("text", _SPACED, ""))
    size = items.agg(F.sum(F.size(F.split("text", r"\s+")) + characters)).first()[0] or 0
    n = -(-size // block_words)
    blocks = []
    for k in range(n):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text").collect()
        blocks.append(Index([r["item_id"] for r in rows], [r["text"].encode("utf-8", "surrogatepass") for r in rows]))
    return blocks


def with_matches(docs: DataFrame, benchmark: DataFrame, column: str = "matches") -> DataFrame:
    """All rows and columns of ``docs`` plus an array of the benchmark items found in the text: item_id,
    item_words, edits, and the matching run of words (start_word, end_word).

    Words are runs of ASCII letters and digits and of characters above ASCII, A-Z lower-cased; each
    character of Thai, Lao, Myanmar, Khmer, Kana and Han is a word.  An
    item is reported once per row, with its best match (fewest edits, then first).  Items that are
    null, have a null id or no word are not searched, those of fewer than ``MIN_WORDS`` words are
    found unedited only; items that share an id
    are searched each.  Null and empty texts have no matches.  Rows are judged one by one, so null
    and repeated doc_ids change nothing.  An empty benchmark gives empty arrays, an empty table an
    empty result.  A column that is already called ``column`` is replaced.
    """
    found: Column = F.array().cast(f"array<{MATCH}>")
    for index in benchmark_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # at most BLOCK_WORDS words
        found = F.concat(found, _remote(shared)(F.col("text")))
    return docs.withColumn(column, found)


def _remote(shared):
    @F.arrow_udf(f"array<{MATCH}>")
    def run(column: pa.Array) -> pa.Array:
        index, texts, out = shared.value, encode(column), []
        for a, b in slices(texts, WALK_BYTES):
            out += index.matches(texts[a:b])
        return pa.array(out, pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "item_words", "edits", "start_word", "end_word")])))

    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item."""
    return with_matches(docs, benchmark, "_matches").filter(F.size("_matches") == 0).drop("_matches")

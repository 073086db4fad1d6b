"""Vectorised word and hash work on a batch of texts, for use inside tasks.

A batch of texts is laid out as one byte buffer; words, word hashes and shingle hashes of all its
texts come from a fixed number of numpy passes.  ``slices`` bounds the bytes laid out at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

SLICE_BYTES = 1 << 20

_MUL = np.uint64(0x9E3779B97F4A7C15)
_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def white_table() -> np.ndarray:
    """True for bytes that separate words: space and 0x09-0x0D."""
    t = np.zeros(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = True
    return t


def punctuation_table() -> np.ndarray:
    """True for all ASCII bytes that are neither letters nor digits."""
    t = np.zeros(256, bool)
    t[:128] = True
    for a, b in ((48, 58), (65, 91), (97, 123)):
        t[a:b] = False
    return t


def character_edges(b: np.ndarray) -> np.ndarray | None:
    """Places in UTF-8 bytes where a character of a script written without blanks (Thai, Lao, Myanmar,
    Khmer, Kana, Han and their punctuation) starts or has just ended; None if there are none."""
    lead = np.flatnonzero(b >= 0xE0)
    lead = lead[lead + 2 < len(b)]
    x, y, z = b[lead], b[lead + 1], b[lead + 2]
    four = (x == 0xF0) & (y >= 0xA0)
    ok = (((x == 0xE0) & (y >= 0xB8) & (y <= 0xBB)) | ((x == 0xE1) & ((y < 0x82) | ((y == 0x82) & (z < 0xA0)) | (y == 0x9E) | (y == 0x9F)))
          | ((x >= 0xE3) & (x <= 0xE9)) | ((x == 0xEF) & (((y >= 0xA4) & (y <= 0xAB)) | (y >= 0xBC))) | four)
    if not ok.any():
        return None
    edge = np.zeros(len(b) + 4, bool)
    edge[lead[ok]] = True
    edge[lead[ok] + 3 + four[ok]] = True
    return edge[:len(b)]


def lower_bytes(b: np.ndarray) -> np.ndarray:
    return b + ((b >= 65) & (b <= 90)).astype(np.uint8) * np.uint8(32)


def slices(texts: list[bytes | None], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts with at most ``limit`` bytes together; a larger text is alone."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if start < len(texts):
        yield start, len(texts)


_T = mix64(np.arange(1, 257, dtype=np.uint64) * _MUL) | np.uint64(1)
_POW = np.cumprod(np.full(64, 0xD6E8FEB86659FD93, np.uint64), dtype=np.uint64)


class Words:
    """Words of some texts: byte range, text and 64-bit hash of each, in order."""

    def __init__(self, texts: list[bytes | None], separators: np.ndarray, characters: bool = False):
        """With ``characters`` each character of a script written without blanks is a word."""
        lens = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
        # A separator stands between texts, so that no word crosses.
        self.buf = b = lower_bytes(np.frombuffer(b" ".join([t or b"" for t in texts]) + b" ", np.uint8))
        self.base = np.concatenate(([0], np.cumsum(lens + 1)))[:-1]
        sep = separators[b]
        edge = np.flatnonzero(np.diff(np.concatenate(([True], sep, [True])).astype(np.int8)))
        self.start, self.end = edge[0::2], edge[1::2]
        cut = character_edges(b) if characters else None
        if cut is not None:
            within = np.flatnonzero(cut[1:] & ~sep[1:] & ~sep[:-1]) + 1
            self.start, self.end = np.sort(np.concatenate((self.start, within))), np.sort(np.concatenate((self.end, within)))
        self.text = np.searchsorted(self.base, self.start, "right") - 1
        self.n = len(self.start)
        self.count = np.bincount(self.text, minlength=len(texts)) if self.n else np.zeros(len(texts), np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.count)))[:-1]
        if self.n:
            inside = ~sep
            size = self.end - self.start
            run = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            terms = _T[b[inside]] * _POW[run & 63]
            far = run >= 64
            if far.any():  # very long words: the block number enters the term
                terms[far] = mix64(terms[far] + (run[far] >> 6).astype(np.uint64) * _MUL)
            self.hash = mix64(np.add.reduceat(terms, np.cumsum(size) - size) + size.astype(np.uint64))
        else:
            self.hash = np.zeros(0, np.uint64)

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of each run of k words inside a text; a text with fewer
        words, but at least one, has its whole sequence as the only run."""
        if not self.n:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        h = np.zeros(self.n, np.uint64)
        left = self.count[self.text] - (np.arange(self.n) - self.first[self.text])
        for j in range(k):
            w = np.zeros(self.n, np.uint64)
            w[: max(0, self.n - j)] = self.hash[j:]
            h = (h + np.where(left > j, w, np.uint64(0))) * _M1
            h ^= h >> np.uint64(29)
        keep = np.flatnonzero((left >= k) | ((self.count[self.text] < k) & (left == self.count[self.text])))
        return keep, mix64(h[keep] + np.minimum(left[keep], k).astype(np.uint64) * _MUL)


def encode(column) -> list[bytes | None]:
    """Texts of an Arrow string column as bytes."""
    return [None if t is None else t.encode("utf-8", "surrogatepass") for t in column.to_pylist()]

"""Alignment of two tokenizers over the same texts, by pointer jumping.

The tokens of both sides are byte ranges.  Every token points to the token that reaches farthest right
among those it overlaps; successor doubling over all tokens of a batch at once leads each to the last
token of its group, which labels the group.  Groups are what lies between the places where both
sides end a token.

The first pass tokenises whole texts and writes, per document, its counts and its distinct links (pairs
of an A id and a B id that overlap).  How many documents hold a pair is counted from that table.  The
second pass looks the counts up: the most frequent pairs, at most ``HEAD`` of them, are broadcast as
sorted arrays, and only links beyond those are shuffled to a join, whose keys are rare by construction.

A single blank between two word characters is a place where both sides end a token, so what lies
between such blanks aligns by itself and gives what the whole text would.  Words are therefore aligned
once for all their places, and long texts go piece by piece.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import Scratch

TOKENIZERS = "/opt/tokenizers"
# Characters after which a text is cut at the next place that allows it; bytes aligned at a time.
PIECE = 1 << 18
SLICE_BYTES = 1 << 20
# Pairs that are broadcast (17 bytes each); bytes of a vocabulary file that may be.
HEAD = 1 << 20
MODEL_BYTES = 64 << 20
_CUT = re.compile(r"\w (?=\w)")
_BETWEEN = re.compile(r"(?<=\w) (?=\w)")
# Words whose alignment a task keeps, and their characters.
WORDS = 1 << 19
WORD_CHARS = 1 << 24


def byte_level_alphabet() -> dict[str, int]:
    """Character -> byte of byte-level vocabularies: printable Latin-1 stands for itself, the other
    bytes, in order, for the characters from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {**{chr(b): b for b in own}, **{chr(256 + k): b for k, b in enumerate(rest)}}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, a_json: bytes, b_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(a_json.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        alphabet = byte_level_alphabet()
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = token.encode() if token in added else bytes(alphabet[c] for c in token)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a_len, self.b_len = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # A blank inside a piece would tie the words on its sides together.
        self.cuts = not any("▁" in p.lstrip("▁") for p in pieces)
        texts_a, texts_b = ([str(i) for i in range(len(t))] for t in (self.a_bytes, self.b_bytes))
        self.parts = [s + c for texts, c in ((texts_a, ","), (texts_a, "|"), (texts_b, ","), (texts_b, ";")) for s in texts]

    def pieces(self, text: str, most: int) -> Iterator[str]:
        at = 0
        while self.cuts and len(text) - at > most:
            m = _CUT.search(text, at + most)
            if not m:
                break
            yield text[at:m.start() + 1]
            at = m.end()
        yield text[at:]

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Ids of both sides, and whether both give the piece, with a blank before it, byte for byte."""
        full = [" " + p for p in pieces]
        a = [e.ids for e in self.a.encode_batch_fast(full, add_special_tokens=False)]
        b = self.b.encode(pieces, num_threads=1)
        ok = [b"".join(map(self.a_bytes.__getitem__, x)) == (want := t.encode()) and b"".join(map(self.b_bytes.__getitem__, y)) == want
              for t, x, y in zip(full, a, b)]
        return a, b, ok


def terminals(a_end: np.ndarray, b_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Last token of each token's group, for A tokens and for B tokens, as indexes of B tokens; the
    ends of both sides ascend and the last ones are equal.

    A token points to the farthest-right token it overlaps: the other side's token over its last
    byte.  Of two that end together the B token is the terminal, which points to itself."""
    n = len(a_end)
    over_a = np.searchsorted(b_end, a_end, "left")
    over_b = np.searchsorted(a_end, b_end, "left")
    together = a_end[over_b] == b_end if n else np.zeros(0, bool)
    to = np.concatenate((n + over_a, np.where(together, n + np.arange(len(b_end)), over_b)))
    while True:
        far = to[to]
        if np.array_equal(far, to):
            return to[:n] - n, to[n:] - n
        to = far


class _Document:
    """Sums over the pieces of a document."""

    __slots__ = ("ok", "n", "pairs", "times", "hash", "text", "some")

    def __init__(self, keep: bool):
        self.ok, self.n, self.some = True, np.zeros(4, np.int64), False
        self.pairs, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.hash, self.text = hashlib.sha256(), [] if keep else None

    def add(self, n: np.ndarray, pairs: np.ndarray, times: np.ndarray, groups: str) -> None:
        self.n += n
        if len(self.pairs):
            both, where = np.unique(np.concatenate((self.pairs, pairs)), return_inverse=True)
            self.pairs, self.times = both, np.bincount(where, np.concatenate((self.times, times)), len(both)).astype(np.int64)
        else:
            self.pairs, self.times = pairs, times
        groups = ";" + groups if self.some else groups
        self.some = True
        self.hash.update(groups.encode())
        if self.text is not None:
            self.text.append(groups)


class Aligner:
    """Alignment of pieces of text, word by word: between two words (see ``_CUT``) both sides end a
    token, so a word's groups and links are the same wherever it stands.  What was found of the words
    seen is kept for the next pieces, up to ``WORDS`` of them and ``WORD_CHARS`` characters."""

    def __init__(self, tok: Tokenizers):
        self.tok = tok
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.ok, self.counts, self.groups = np.zeros(0, bool), np.zeros((0, 4), np.int64), []
        self.codes, self.edge = np.zeros(0, np.int64), np.zeros(1, np.int64)

    def learn(self, words: list[str]) -> None:
        """Aligns words not seen before, all of them together."""
        tok, n = self.tok, len(words)
        ids_a, ids_b, ok = tok.encode(words)
        use = np.flatnonzero(ok)
        n_a, n_b = (np.zeros(n, np.int64) for _ in range(2))
        n_a[use], n_b[use] = [len(ids_a[k]) for k in use], [len(ids_b[k]) for k in use]
        a, b = (np.array([i for k in use for i in ids[k]], np.int64) for ids in (ids_a, ids_b))
        # Words abut here, and both sides have the same bytes, so that a word's end is an end on both sides.
        a_end, b_end = np.cumsum(tok.a_len[a]), np.cumsum(tok.b_len[b])
        of_a, of_b = terminals(a_end, b_end)
        word_a, word_b = np.repeat(np.arange(n), n_a), np.repeat(np.arange(n), n_b)
        n_groups = np.bincount(word_b[of_b == np.arange(len(b))], minlength=n)

        first = np.searchsorted(b_end, a_end - tok.a_len[a], "right")
        span = np.searchsorted(b_end, a_end, "left") - first + 1
        n_links = np.bincount(word_a, span, n).astype(np.int64)
        at = np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span) + np.repeat(first, span)
        codes = np.repeat(a, span) * len(tok.b_bytes) + b[at]

        # A's ids of a group, then B's, each with the mark that follows it.
        part_a = a + np.where(of_a != np.append(of_a[1:], -1), len(tok.a_bytes), 0)
        part_b = 2 * len(tok.a_bytes) + b + np.where(of_b != np.append(of_b[1:], -1), len(tok.b_bytes), 0)
        order = np.argsort(np.concatenate((of_a * 2, of_b * 2 + 1)), kind="stable")
        text = list(map(tok.parts.__getitem__, np.concatenate((part_a, part_b))[order].tolist()))
        begin = np.concatenate(([0], np.cumsum(n_a + n_b))).tolist()
        self.groups += ["".join(text[s:e])[:-1] for s, e in zip(begin, begin[1:])]
        self.ok = np.concatenate((self.ok, ok))
        self.counts = np.concatenate((self.counts, np.stack((n_a, n_b, n_groups, n_links), 1)))
        self.codes = np.concatenate((self.codes, codes))
        self.edge = np.concatenate((self.edge, self.edge[-1] + np.cumsum(n_links)))

    def add(self, units: list[tuple[int, str]], docs: dict[int, _Document]) -> None:
        """Aligns (document, piece) units and adds the results to their documents."""
        if not units:
            return
        if len(self.known) > WORDS or self.chars > WORD_CHARS:
            self.forget()
        known, fresh, words, n = self.known, [], [], []
        for _, piece in units:
            mine = _BETWEEN.split(piece) if self.tok.cuts else [piece]
            n.append(len(mine))
            for w in mine:
                k = known.get(w)
                if k is None:
                    known[w] = k = len(known)
                    fresh.append(w)
                words.append(k)
        if fresh:
            self.chars += sum(map(len, fresh))
            self.learn(fresh)
        words, n = np.array(words), np.array(n)
        unit = np.repeat(np.arange(len(n)), n)
        edge = np.concatenate(([0], np.cumsum(n)))
        good = np.bincount(unit, ~self.ok[words], len(n)) == 0
        counts = np.stack([np.bincount(unit, self.counts[words, k], len(n)).astype(np.int64) for k in range(4)], 1)
        span = self.edge[words + 1] - self.edge[words]
        at = np.arange(int(span.sum())) - np.repeat(np.cumsum(span) - span, span) + np.repeat(self.edge[words], span)
        size = len(self.tok.a_bytes) * len(self.tok.b_bytes)
        code, times = np.unique(np.repeat(unit, span) * size + self.codes[at], return_counts=True)
        cut = np.searchsorted(code, np.arange(len(n) + 1) * size)
        words = words.tolist()
        for u, (d, _) in enumerate(units):
            docs[d].ok &= bool(good[u])
            if docs[d].ok:
                s, e = cut[u], cut[u + 1]
                docs[d].add(counts[u], code[s:e] - u * size, times[s:e], ";".join(map(self.groups.__getitem__, words[edge[u]:edge[u + 1]])))


def _align(models, keep: bool, piece: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = aligner = None
        for batch in batches:
            if tok is None:
                tok = Tokenizers(*models.value)
                aligner = Aligner(tok)
            docs: dict[int, _Document] = {}
            units, volume = [], 0
            texts = batch.column("text")
            for d in range(len(texts)):
                docs[d] = _Document(keep)
                text = texts[d].as_py()
                for p in tok.pieces(text, piece) if text else ():
                    units.append((d, p))
                    volume += len(p)
                    if volume >= SLICE_BYTES:
                        aligner.add(units, docs)
                        units, volume = [], 0
            aligner.add(units, docs)
            none = _Document(keep)
            out = [x if x.ok and x.some else none for x in docs.values()]
            edge = pa.array(np.concatenate(([0], np.cumsum([len(x.pairs) for x in out]))), pa.int32())
            flat = lambda f: np.concatenate([getattr(x, f) for x in out]) if out else np.zeros(0, np.int64)
            cols = {"row": batch.column("row"), "id": batch.column("id")}
            cols |= {c: pa.array([int(x.n[k]) for x in out], pa.int64()) for k, c in enumerate(("n_a", "n_b", "n_groups", "n_links"))}
            cols["groups_sha256"] = pa.array([x.hash.hexdigest() if x.some else "" for x in out], pa.string())
            if keep:
                cols["groups"] = pa.array(["".join(x.text) for x in out], pa.string())
            cols["pairs"] = pa.ListArray.from_arrays(edge, pa.array(flat("pairs"), pa.int64()))
            cols["times"] = pa.ListArray.from_arrays(edge, pa.array(flat("times"), pa.int64()))
            yield pa.RecordBatch.from_pydict(cols)

    return run


def align(docs: DataFrame, path: str = TOKENIZERS, a_file: str = "byte_bpe_50k.json", b_file: str = "piece_bpe_32k.model", id_col: str = "doc_id",
          text_col: str = "text", keep_groups: bool = True, piece: int = PIECE) -> DataFrame:
    """One row per input row: row (a number of its own), id, n_a, n_b, n_groups, n_links, groups (with
    ``keep_groups``: ids as ``a1,a2|b1;a3|b2,b3``), groups_sha256 (of that text), pairs (A id times B's
    vocabulary size plus B id, of each distinct link, ascending) and times (its links in the text).

    Both sides read a blank and the text, without special tokens.  A text that is null or empty, or that
    either side does not give back byte for byte, has no tokens: zeros, empty lists and empty texts.
    Repeated rows each count.  An empty table gives an empty result; other columns are ignored.  Long
    texts are cut where that changes nothing; a text without a single blank between two word
    characters stays whole.
    """
    files = []
    for name in (a_file, b_file):
        with open(os.path.join(path, name), "rb") as f:
            files.append(f.read(MODEL_BYTES + 1))
        if len(files[-1]) > MODEL_BYTES:
            raise ValueError(f"{name} has more than {MODEL_BYTES} bytes")
    models = docs.sparkSession.sparkContext.broadcast(tuple(files))
    given = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = given.schema["id"].dataType.simpleString()
    schema = (f"row long, id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
              f"{', groups string' if keep_groups else ''}, pairs array<long>, times array<long>")
    return given.mapInArrow(_align(models, keep_groups, piece), schema)


def _look_up(head):
    """Sums over the links whose pair is in ``head`` (pair, count, best: sorted arrays); the others stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, count, best = head.value
        for batch in batches:
            lists = batch.column("pairs")
            edge = lists.offsets.to_numpy().astype(np.int64)
            own = lists.values.to_numpy()[edge[0]:edge[-1]]
            times = batch.column("times").values.to_numpy()[edge[0]:edge[-1]]
            row = np.repeat(np.arange(len(lists)), np.diff(edge))
            at = np.minimum(np.searchsorted(pair, own), max(len(pair) - 1, 0))
            hit = pair[at] == own if len(pair) else np.zeros(len(own), bool)
            at, n = at[hit], len(lists)
            sums = [np.zeros(n, np.int64) for _ in range(2)]
            if len(at):
                np.add.at(sums[0], row[hit], times[hit] * best[at])
                np.add.at(sums[1], row[hit], times[hit] * count[at])
            rest = pa.array(np.concatenate(([0], np.cumsum(np.bincount(row[~hit], minlength=n)))), pa.int32())
            kept = [c for c in batch.schema.names if c not in ("pairs", "times")]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(s) for s in sums]
                + [pa.ListArray.from_arrays(rest, pa.array(x[~hit])) for x in (own, times)],
                names=[*kept, "best_head", "sum_head", "pairs", "times"])

    return run


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of its A id has more.
    An A id meets at most ``width`` B ids, which bounds the window."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    most = F.max("n").over(Window.partitionBy(F.floor(F.col("pair") / width)))
    return counts.select("pair", "n", (F.col("n") == most).alias("best"))


def with_counts(aligned: DataFrame, width: int, scratch: Scratch, head: int = HEAD) -> DataFrame:
    """``aligned`` (a written table) with n_best and count_sum in place of pairs and times."""
    spark = aligned.sparkSession
    counts = scratch.put("counts", pair_counts(aligned, width))
    # Pairs by size, in steps of a quarter power of two: the largest steps that fit are broadcast.
    sizes = counts.groupBy(F.floor(F.log2("n") * 4).alias("step")).agg(F.count(F.lit(1)).alias("k"), F.min("n").alias("least")).collect()
    least, total = None, 0
    for s in sorted(sizes, key=lambda s: -s["step"]):
        total += s["k"]
        if total > head:
            break
        least = s["least"]
    top = counts.filter(F.col("n") >= least if least is not None else F.lit(False)).orderBy("pair").toArrow()
    shared = spark.sparkContext.broadcast(tuple(top.column(c).to_numpy() for c in ("pair", "n", "best")))
    kept = [f for f in aligned.schema.fields if f.name not in ("pairs", "times")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    seen = scratch.put("seen", aligned.mapInArrow(_look_up(shared), f"{schema}, best_head long, sum_head long, pairs array<long>, times array<long>"))
    rare = counts if least is None else counts.filter(F.col("n") < least)
    links = seen.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("l")).select("row", F.col("l.pairs").alias("pair"), F.col("l.times").alias("times"))
    tail = (links.join(rare, "pair").groupBy("row")
            .agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("best_tail"), F.sum(F.col("times") * F.col("n")).alias("sum_tail")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long"))
    return seen.drop("pairs", "times").join(tail, "row", "left").select(
        *[f.name for f in kept], (F.col("best_head") + zero("best_tail")).alias("n_best"), (F.col("sum_head") + zero("sum_tail")).alias("count_sum"))


def alignment(docs: DataFrame, path: str = TOKENIZERS, a_file: str = "byte_bpe_50k.json", b_file: str = "piece_bpe_32k.model",
              id_col: str = "doc_id", text_col: str = "text", keep_groups: bool = True, piece: int = PIECE, head: int = HEAD) -> DataFrame:
    """``align`` with n_best and count_sum: of a document's links, those whose pair is held by as many
    documents as any pair of the same A id, and the sum of the documents that hold each."""
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_file=os.path.join(path, b_file)).get_piece_size()
    scratch = Scratch(docs.sparkSession, "align")
    return with_counts(scratch.put("aligned", align(docs, path, a_file, b_file, id_col, text_col, keep_groups, piece)), width, scratch, head)

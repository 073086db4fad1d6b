"""Cross-tokenizer alignment against a plain version."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sluice.llm import queries as Q
from sluice.llm.align import TOKENIZERS, alignment, byte_level_alphabet, terminals
from tests_llm_helpers import docs, empty, messy, messy_rows, sentences

A = Tokenizer.from_file(f"{TOKENIZERS}/byte_bpe_50k.json")
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=f"{TOKENIZERS}/piece_bpe_32k.model")


def spans(ids, size):
    at, out = 0, []
    for i in ids:
        out.append((at, at + size(i)))
        at = out[-1][1]
    return out


def plain(text):
    """(groups, links) of one text, token by token."""
    if not text:
        return [], []
    alphabet = byte_level_alphabet()
    a_bytes = lambda i: bytes(alphabet[c] for c in A.id_to_token(i))
    b_bytes = lambda i: bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    want = (" " + text).encode()
    if b"".join(map(a_bytes, a)) != want or b"".join(map(b_bytes, b)) != want:
        return [], []
    sa, sb = spans(a, lambda i: len(a_bytes(i))), spans(b, lambda i: len(b_bytes(i)))
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, low = [], 0
    for c in cuts:
        groups.append(([i for i, (s, e) in zip(a, sa) if low <= s < c], [i for i, (s, e) in zip(b, sb) if low <= s < c]))
        low = c
    links, k = [], 0
    for i, (s, e) in zip(a, sa):
        while sb[k][1] <= s:
            k += 1
        j = k
        while j < len(sb) and sb[j][0] < e:
            links.append((i, b[j]))
            j += 1
    return groups, links


def brute(rows):
    done = [(i, *plain(t)) for i, t in rows]
    n = Counter(p for _, _, links in done for p in set(links))
    most = {}
    for (a, _), c in n.items():
        most[a] = max(most.get(a, 0), c)
    out = []
    for i, groups, links in done:
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                    sum(n[p] == most[p[0]] for p in links), sum(n[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if text else "", text))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted([(r.id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256, r.groups) for r in df.collect()], key=repr)


TEXTS = ["a", " ", "  two  blanks", "tab\tand\nlines\r\n\n", "<|endoftext|> <s></s><unk> <0x41>", "naïve café – “quotes”", "日本語のテキスト", "👩‍👩‍👧‍👦 emoji", "x" * 300,
         "don't we'll I've 1234567890 3.14", "\x00\x01\x7f", "▁under", "﻿bom", "é ﬁ ½ Å", "trailing ", " nbsp sep", "אבג דהו", "the the the"]


@pytest.mark.parametrize("piece,head", [(1 << 18, 1 << 20), (20, 0), (7, 12)])
def test_matches_brute_force(spark, piece, head):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [r[:2] for r in messy_rows() if r[0] != 8] + [(8, sentences(8, 4000)), (8, sentences(4, 90))]
    df = docs(spark, rows).withColumn("row", F.lit("clash")).withColumn("id", F.lit("clash")).repartition(3)
    assert rows_of(alignment(df, piece=piece, head=head)) == brute(rows)


def test_pieces_of_random_texts_are_the_whole(spark):
    r = random.Random(5)
    parts = ["word", "It's", "12", "x_y", "é", "ß", "語", ",", ".", "'", "-", "\n", "  ", " ", " ", " ", " ", "\t", "A"]
    rows = [(k, "".join(r.choice(parts) for _ in range(300))) for k in range(40)]
    assert rows_of(alignment(docs(spark, rows), piece=5)) == brute(rows)


def test_terminals_label_the_groups():
    r = random.Random(1)
    for _ in range(200):
        n = r.randint(1, 60)
        ends = [np.array(sorted({n, *(r.randint(1, n) for _ in range(r.randint(0, n)))})) for _ in range(2)]
        a, b = terminals(*ends)
        cuts = np.array(sorted(set(ends[0].tolist()) & set(ends[1].tolist())))
        for side, to in zip(ends, (a, b)):
            assert (ends[1][to] == cuts[np.searchsorted(cuts, side)]).all()


def test_empty_and_messy_tables(spark):
    assert alignment(empty(spark)).collect() == []
    assert alignment(messy(spark)).count() == len(messy_rows())


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = sorted([tuple(r) for r in Q.queries()["op13_tokenizer_alignment"](spark, sf).collect()], key=repr)
    assert got == sorted([x[:8] for x in brute(rows)], key=repr)

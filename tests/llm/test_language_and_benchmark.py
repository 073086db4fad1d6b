"""Language ID on held-out rows; decontamination against brute force and planted edits."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluice.llm import decontaminate as D
from sluice.llm import language_id as L
from sluice.llm import queries as Q
from tests_llm_helpers import docs, empty, messy, messy_rows, sentences

SF = "/root/testdata/sf0.001"


def test_held_out_accuracy_and_contract(spark):
    got = Q.queries()["op8_language_id"](spark, SF).toPandas().merge(spark.read.parquet(f"{SF}/documents.parquet").toPandas(), on="doc_id")
    assert len(got) == 200 and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert len(held) > 20 and (held.lang_pred == held.lang).mean() >= 0.95
    import zlib
    assert (got.held_out == got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()


def test_prediction_uses_the_text_only(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    model = L.fit(base)
    other = base.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string"), "doc_id": F.col("doc_id") + 7})
    a = L.predict(base, model).select("lang_pred", "score").collect()
    assert a == L.predict(other, model).select("lang_pred", "score").collect()


def test_rows_without_letters_and_messy_rows(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    out = L.predict(messy(spark), L.fit(base)).collect()
    assert len(out) == len(messy_rows())
    for r in out:
        letter = r.text is not None and any(c.isalpha() for c in r.text)
        assert (r.lang_pred == "und") == (not letter)
        assert r.rejected or letter
    assert L.predict(empty(spark), L.fit(base)).collect() == []
    assert L.fit(empty(spark)) is None
    assert {r.lang_pred for r in L.predict(messy(spark), None).collect()} == {"und"}


def test_nothing_is_learned_from_the_held_out_fold(spark):
    rows = [(i, sentences(i, 30, "abcd" if i % 2 else "wxyz"), "one" if i % 2 else "two", "s") for i in range(200)]
    df = docs(spark, rows).withColumn("lang", F.when(L.held_out(F.col("doc_id")), F.lit("leak")).otherwise(F.col("lang")))
    model = L.fit(df)
    assert set(model.languages) == {"one", "two"}
    out = L.predict(df, model).collect()
    assert all(r.lang_pred == ("one" if r.doc_id % 2 else "two") for r in out)


def test_a_long_text_scores_as_its_parts_do(spark):
    model = L.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    text = sentences(3, 400).encode()
    long = text * (L.PIECE // len(text) + 2)
    (p, q), n = model.scores([text, long])
    assert np.allclose(p, q, atol=0.02) and n[1] > 300 * n[0]


# --- decontamination ----------------------------------------------------------------------------

def distance(goal, words):
    """Plain semi-global edit distance."""
    row = [0] * (len(words) + 1)
    for i, g in enumerate(goal, 1):
        new = [i]
        for j, w in enumerate(words, 1):
            new.append(min(row[j - 1] + (g != w), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_edit_match_equals_plain_distance():
    r = random.Random(5)
    for _ in range(200):
        goal, words = [[r.randint(1, 4) for _ in range(r.randint(1, 12))] for _ in range(2)]
        want = distance(goal, words)
        got = D.edit_match(np.array(goal, np.uint64), np.array(words, np.uint64), 100)
        assert got[0] == want
        assert distance(goal, words[got[1]:got[2]]) == want


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def edit(words, n, r):
    w = list(words)
    for _ in range(n):
        k, op = r.randrange(len(w)), r.randrange(3)
        if op == 0:
            w[k] = "zq%d" % r.randrange(999)
        elif op == 1:
            w.insert(k, "zq%d" % r.randrange(999))
        else:
            del w[k]
    return w


def test_recall_at_the_full_allowance_and_no_false_alarm(spark):
    r = random.Random(2)
    items = [(k, sentences(300 + k, r.randint(12, 60))) for k in range(120)]
    rows, want = [], {}
    for k, text in items:
        w = text.split()
        rows.append((k, " ".join([sentences(k + 9000, 60), *edit(w, len(w) * D.EDITS_PERCENT // 100, r), sentences(k + 5000, 60)])))
        rows.append((1000 + k, " ".join([sentences(k + 100, 40), text.upper().replace(" ", ", "), sentences(k + 7000, 5)])))
        rows.append((2000 + k, sentences(k + 20000, 150)))
    out = D.with_matches(docs(spark, rows), bench(spark, items)).collect()
    found = {r.doc_id: [m.item_id for m in r.matches] for r in out}
    assert all(found[1000 + k] == [k] for k, _ in items)
    assert not any(found[2000 + k] for k, _ in items)
    assert np.mean([k in found[k] for k, _ in items]) >= 0.95
    words = dict(items)
    for x in out:
        for m in x.matches:
            assert m.edits <= m.item_words * D.EDITS_PERCENT // 100 and m.item_words == len(words[m.item_id].split())


def test_matches_equal_brute_force_on_documents(spark):
    base, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    got = {(r.doc_id, m.item_id): m.edits for r in D.with_matches(base, items).collect() for m in r.matches}
    import re
    split = lambda t: re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
    goals = {r.item_id: split(r.text) for r in items.collect()}
    pieces = {k: {tuple(g[i:i + 4]) for i in range(len(g) - 3)} for k, g in goals.items()}  # 15% of edits leave four words in a row
    want = {}
    for r in base.collect():
        w = split(r.text)
        have = {tuple(w[i:i + 4]) for i in range(len(w) - 3)}
        for k, g in goals.items():
            if have & pieces[k] and len(g) >= D.MIN_WORDS:
                d = distance(g, w)
                if d <= len(g) * D.EDITS_PERCENT // 100:
                    want[r.doc_id, k] = d
    assert got == want and want


def test_messy_rows_and_blocks(spark):
    text = sentences(1, 120)
    items = bench(spark, [(1, " ".join(text.split()[10:40])), (2, None), (None, text), (3, ""), (4, "too short to count"), (5, sentences(77, 30)), (5, " ".join(text.split()[50:80]))])
    out = D.with_matches(messy(spark), items).collect()
    assert len(out) == len(messy_rows())
    for r in out:
        same = r.text is not None and r.text.lower() == text
        assert sorted(m.item_id for m in r.matches) == ([1, 5] if same else [])
    assert D.with_matches(empty(spark), items).collect() == []
    assert D.decontaminate(messy(spark), items).count() == sum(1 for r in messy_rows() if (r[1] or "").lower() != text)
    assert D.decontaminate(messy(spark), items.limit(0)).count() == len(messy_rows())
    assert len(D.benchmark_blocks(items, 60)) > 1


@pytest.mark.parametrize("block", [40, 10**6])
def test_blocks_give_the_same(spark, block, monkeypatch):
    monkeypatch.setattr(D.benchmark_blocks, "__defaults__", (block,))
    items = [(k, sentences(40 + k, 30)) for k in range(6)]
    rows = [(k, sentences(k, 20) + " " + t) for k, t in items]
    out = D.with_matches(docs(spark, rows), bench(spark, items)).collect()
    assert all([m.item_id for m in r.matches] == [r.doc_id] for r in out)


def test_short_items_and_scripts_without_blanks(spark):
    han = "".join(chr(0x4E00 + 37 * k % 5000) for k in range(1, 41))
    thai = "".join(chr(0x0E01 + 7 * k % 45) for k in range(1, 31))
    items = bench(spark, [(1, "Who wrote it?"), (2, "who wrote it"), (3, han), (4, "東京はどこ"), (5, thai), (6, "...")])
    edited = han[:20] + chr(0x9F00) + han[21:]
    rows = [(1, "x y z who WROTE, it today"), (2, "who wrote that"), (3, "前" * 30 + edited + "後" * 30), (4, "我说東京はどこで"),
            (5, "กข " * 20 + thai + "ฃ" * 9), (6, "who wrote"), (7, "it was who wrote"), (8, ""), (9, "... it")]
    out = {r.doc_id: [(m.item_id, m.edits, m.start_word, m.end_word) for m in r.matches] for r in D.with_matches(docs(spark, rows), items).collect()}
    assert out[1] == [(1, 0, 3, 6), (2, 0, 3, 6)]
    assert [m[:2] for m in out[3]] == [(3, 1)] and out[4] == [(4, 0, 2, 7)] and [m[:2] for m in out[5]] == [(5, 0)]
    assert not any(out[k] for k in (2, 6, 7, 8, 9))

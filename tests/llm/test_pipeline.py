"""The corpus pipeline against a plain version, stage by stage, and on messy rows."""

import hashlib
import math

import corpus_pipeline as C
from sluice.llm import decontaminate as D
from sluice.llm import language_id as L
from test_language_and_benchmark import distance
from test_near import brute_components
from tests_llm_helpers import docs, empty, messy, sentences

SF = "/root/testdata/sf0.001"


def plain_lines(rows):
    """rows of (doc_id, text): text without repeated chunks, and whether all of it went."""
    first, out = {}, []
    for i, text in sorted(rows):
        lines = text.split("\n")
        h = [int(hashlib.md5(x.encode()).hexdigest()[:15], 16) for x in lines]
        kept, chunk, gone = [], [], 0
        for k, line in enumerate(lines):
            chunk.append(line)
            before = h[k - 1] if k else h[k]
            if ((before << 1) ^ h[k]) & 3 == 0 or k == len(lines) - 1:
                key = "\n".join(chunk)
                if len(chunk) >= 2 and first.setdefault(key, (i, k)) != (i, k):
                    gone += len(chunk)
                else:
                    kept += chunk
                chunk = []
        if gone < len(lines):
            out.append((i, "\n".join(kept)))
    return out


def plain_mix(rows):
    """rows of (doc_id, text, source) -> {(doc_id, epoch): (position, words)}"""
    size = {i: len([w for w in _split(t)]) for i, t, _ in rows}
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    slope = {s: (0.5, 0.0, -0.5)[k % 3] for k, s in enumerate(names)}
    total = {s: sum(size[i] for i, _, x in rows if x == s) for s in names}
    budget, target, free = 1.5 * sum(total.values()), {}, set(names)
    while free:  # share by weight; who is above the cap stops there, the rest is shared again
        rest = budget - sum(target.values())
        w = sum(weight[s] for s in free)
        over = {s for s in free if rest * weight[s] / w > 2 * total[s]}
        if not over:
            target |= {s: rest * weight[s] / w for s in free}
            break
        target |= {s: 2.0 * total[s] for s in over}
        free -= over
    out = {}
    for s in names:
        at, wanted = 0, math.floor(target[s] + 1e-9)
        mine = sorted((hashlib.md5(str(i).encode()).hexdigest(), i) for i, _, x in rows if x == s)
        for epoch in range(2):
            for _, i in mine:
                words = max(0, min(size[i], wanted - at))
                if words:
                    y, a = at / target[s], slope[s]
                    out[i, epoch] = (2 * y / ((1 - a) + math.sqrt((1 - a) ** 2 + 4 * a * y)), words)
                at += size[i]
    return out


def _split(text):
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_words(text):
    import re
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def test_run_equals_the_plain_version(spark):
    base = spark.read.parquet(f"{SF}/documents.parquet")
    source = {r.doc_id: r.source for r in base.collect()}
    rows = [(r.doc_id, r.text) for r in L.predict(base, L.fit(base)).collect() if not r.rejected]
    rows = plain_lines(rows)
    keep = {i for i, _, c in brute_components(rows) if i == c}
    rows = [r for r in rows if r[0] in keep]
    goals = [plain_words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    pieces = [{tuple(g[i:i + 4]) for i in range(len(g) - 3)} for g in goals]
    clean = []
    for i, t in rows:
        w = plain_words(t)
        have = {tuple(w[k:k + 4]) for k in range(len(w) - 3)}
        if not any(have & p and len(g) >= D.MIN_WORDS and distance(g, w) <= len(g) * D.EDITS_PERCENT // 100 for g, p in zip(goals, pieces)):
            clean.append((i, t, source[i]))
    want = plain_mix(clean)
    text = {i: t for i, t, _ in clean}
    got = C.run(spark, SF).collect()
    assert len(got) == len(want) and len(clean) < len(source)
    for r in got:
        position, words = want[r.doc_id, r.epoch]
        assert r.words == words and math.isclose(r.position, position, rel_tol=1e-9, abs_tol=1e-12)
        assert r.text == text[r.doc_id] and r.n_chars == len(r.text)
    assert [r.position for r in got] == sorted(r.position for r in got)


def test_stages_on_messy_and_empty_tables(spark, tmp_path):
    english = [(1000 + k, sentences(k, 60), "en", "s") for k in range(40)]
    table = messy(spark).select(*C.COLUMNS).unionByName(docs(spark, english))
    now = messy(spark).unionByName(docs(spark, english), allowMissingColumns=True)
    none = empty(spark)
    counts = []
    for k, (_, stage) in enumerate(C.STAGES):
        now = stage(spark, now, SF)
        none = stage(spark, none, SF)
        assert none.collect() == []
        if k < len(C.STAGES) - 1:
            assert now.columns == C.COLUMNS == none.columns
            path = str(tmp_path / str(k))
            now.write.parquet(path)
            now = spark.read.parquet(path)
            counts.append(now.count())
    assert {1000 + k for k in range(40)} <= {r.doc_id for r in now.collect()} | {r.doc_id for r in spark.read.parquet(path).collect()}
    assert counts == sorted(counts, reverse=True) and table.count() >= counts[0] >= 40

import hashlib

from sluice.llm.exact_dedup import BASES, PRIMES, chunk_hashes, combine, exact_groups
from tests_llm_helpers import docs, empty, messy, messy_rows, sentences

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    norm = [(i, (t or "").translate(LOWER)) for i, t in rows]
    out = []
    for i, t in norm:
        ids = [j for j, u in norm if u == t]
        keep = max([j for j in ids if j is not None], default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=repr)


def test_messy_rows_match_brute_force(spark):
    want = brute([r[:2] for r in messy_rows()])
    assert rows_of(exact_groups(messy(spark))) == want
    assert rows_of(exact_groups(messy(spark), chunk=7)) == want


def test_collisions_are_resolved_by_bytes(spark):
    rows = [(k, sentences(k % 30, 4)) for k in range(90)] + [(90, "ab"), (91, "ba"), (92, None)]
    assert rows_of(exact_groups(docs(spark, rows), primes=(3, 5), bases=(2, 2))) == brute(rows)


def test_empty_table(spark):
    assert exact_groups(empty(spark)).collect() == []


def test_fingerprint_is_the_polynomial_whatever_the_chunks(spark):
    text = sentences(3, 200).encode()
    df = spark.createDataFrame([(bytearray(text),)], "b binary")
    want = [0, 0]
    for x in text:
        want = [(h * b + x) % p for h, b, p in zip(want, BASES, PRIMES)]
    for chunk in (1, 10, 64, 1 << 16):
        fp = df.select(combine(chunk_hashes(chunk)("b")).alias("f")).first().f
        assert (fp.n, fp.h1, fp.h2) == (len(text), *want)

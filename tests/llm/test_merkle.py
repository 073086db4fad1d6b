"""Merkle manifest: against a plain tree, against SQL, on messy rows."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from sluice.llm import queries as Q
from sluice.llm.merkle import fold, leaf_digest, positions, prove
from tests_llm_helpers import docs, empty, messy, messy_rows

SF = "/root/testdata/sf0.001"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def climb(nodes, fanout):
    """Root of some digests, and each one's proof as (before, after) pairs."""
    proofs, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, i in enumerate(at):
            run = i - i % fanout
            proofs[k].append(("".join(nodes[run:i]), "".join(nodes[i + 1:run + fanout])))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [i // fanout for i in at]
    return nodes[0], proofs


def brute(rows, fanout):
    """rows of (part, order, leaf) -> {(part, order, leaf, position): (subroot, root, proof)}, a list each."""
    parts = sorted({r[0] for r in rows}, key=lambda p: (p is not None, (p or "").encode()))
    trees = []
    for p in parts:
        mine = sorted([r for r in rows if r[0] == p], key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        trees.append((mine, *climb([r[2] for r in mine], fanout)))
    root, tops = climb([t[1] for t in trees], fanout)
    return sorted([(*r, i, sub, root, proofs[i] + tops[k]) for k, (mine, sub, proofs) in enumerate(trees) for i, r in enumerate(mine)], key=repr)


def proved(df, **kw):
    out = prove(df, "part", "k", carry=["part", "k", "leaf"], **kw).collect()
    return sorted([(r.part, r.k, r.leaf, r.position, r.subroot, r.root, [(p.before, p.after) for p in r.proof]) for r in out], key=repr)


@pytest.mark.parametrize("fanout,height", [(8, 4), (8, 1), (2, 1), (3, 2)])
def test_trees_of_many_sizes(spark, fanout, height):
    sizes = {None: 9, "": 1, "a": 2, "b": 8, "z": 65, "é": 64, "zz": 700, "hot": 513}
    rows = [(p, k * 7 % n if k % 5 else None, sha(f"{p}{k % 40}")) for p, n in sizes.items() for k in range(n)]
    df = spark.createDataFrame(rows, "part string, k long, leaf string").repartition(5)
    assert proved(df, fanout=fanout, height=height) == brute(rows, fanout)


def test_more_parts_than_a_run_and_a_single_leaf(spark):
    rows = [(f"p{k:03d}", k, sha(str(k))) for k in range(90)]
    assert proved(spark.createDataFrame(rows, "part string, k long, leaf string"), fanout=8, height=1) == brute(rows, 8)
    one = [("x", 1, sha("1"))]
    assert proved(spark.createDataFrame(one, "part string, k long, leaf string")) == [("x", 1, sha("1"), 0, sha("1"), sha("1"), [])]


def test_empty_table(spark):
    assert prove(empty(spark).withColumn("leaf", F.lit("00")), "lang", "doc_id", carry=["doc_id"]).collect() == []


def test_leaf_and_fold_on_messy_rows(spark):
    rows = messy(spark).withColumn("leaf", leaf_digest([F.col(c) for c in ("doc_id", "lang", "text")]))
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    given = [(r[0], r[2] if len(r) > 2 else "en", r[1]) for r in messy_rows()]
    out = prove(rows, "lang", "doc_id", carry=["doc_id", "leaf", "n"], height=1)
    got = out.select("doc_id", "leaf", (fold(F.col("leaf"), F.col("proof")) == F.col("root")).alias("ok"),
                     (fold(F.sha2("leaf", 256), F.col("proof")) == F.col("root")).alias("bad"), "n").collect()
    assert sorted((r.doc_id or -1, r.leaf) for r in got) == sorted((i or -1, sha(field(i) + field(lang) + field(t))) for i, lang, t in given)
    assert all(r.ok and not r.bad and r.n == "clash" for r in got)


def test_positions_split_equal_rows(spark, request):
    df = spark.createDataFrame([("a", 1)] * 4000 + [("b", k) for k in range(100)], "part string, k long").repartition(4)
    from sluice.llm.common import Scratch

    scratch = Scratch(spark, "t")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    request.addfinalizer(lambda: spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true"))
    out = positions(df, ["part"], ["k"], scratch, "p")
    assert [r.position for r in out.filter("part = 'a'").orderBy("position").collect()] == list(range(4000))
    assert [r.k for r in out.filter("part = 'b'").orderBy("position").collect()] == list(range(100))
    sizes = [r["count"] for r in spark.read.parquet(f"{scratch.root}/p").groupBy("slice").count().collect()]
    assert max(sizes) < 2000


def test_query_equals_its_sql_and_finds_tampering(spark):
    from oracle_harness import digest, duck as connect

    got = Q.queries()["op11_merkle_manifest"](spark, SF).toPandas()
    want = connect(SF).execute(Q.oracle_sql()["op11_merkle_manifest"]).df()
    assert digest(got) == digest(want) and len(got)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    changed = {i for i, t in texts.items() if zlib.crc32(str(i).encode()) % 3 == 0 and t and t != t.translate({c: c + 32 for c in range(65, 91)})}
    assert set(got[~got.verified].doc_id) == changed and changed


def test_query_of_the_contract_on_nulls(spark, tmp_path):
    rows = docs(spark, [(1, "A", None, None), (2, None, None, "s"), (None, "B", "en", "s"), (3, "C", "en", None), (3, "C", "en", None), (9, "", "fr", "s")])
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    got = Q.queries()["op11_merkle_manifest"](spark, str(tmp_path)).toPandas()
    from tests_llm_helpers import duck

    con = duck({"documents": rows.toPandas().astype({"doc_id": "Int64", "n_chars": "Int64"})})
    want = con.execute(Q.oracle_sql()["op11_merkle_manifest"]).df()
    cols = ["leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got[cols].values)) == sorted(map(tuple, want[cols].values)) and len(got) == 6

"""Operators built of DataFrame functions: against their SQL, and on messy rows."""

import pytest
from pyspark.sql import functions as F

from sluice.llm import queries as Q
from sluice.llm.chat import preference_pairs, render, trained_spans
from sluice.llm.licenses import scan
from sluice.llm.line_dedup import dedup_lines
from sluice.llm.mixing import demand_time, mix, training_order
from tests_llm_helpers import docs, empty, messy, messy_rows, sentences

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op2_line_dedup", "op3_near_dedup", "op4_mix_sources", "op6_exact_dedup", "op9_license_scan", "op10_preference_format"])
def test_query_equals_its_sql(spark, name):
    from oracle_harness import digest, duck as connect

    got = Q.queries()[name](spark, SF).toPandas()
    want = connect(SF).execute(Q.oracle_sql()[name]).df()
    assert digest(got) == digest(want) and len(got)


def test_native_plans_have_no_python(spark):
    for name in ("op2_line_dedup", "op4_mix_sources", "op9_license_scan", "op10_preference_format"):
        plan = Q.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow")), name


# --- mixing ---------------------------------------------------------------------------------

def test_mix_of_messy_rows(spark):
    out = mix(messy(spark)).toPandas()
    assert len(out) == len(messy_rows())
    sizes = [len((r[1] or "").split()) for r in messy_rows()]
    assert sorted(out["size"]) == sorted(sizes)
    assert (out.taken <= 2 * out["size"]).all() and (out.taken[out["size"] == 0] == 0).all()
    assert out.drop_duplicates("source_size").target.sum() == pytest.approx(1.5 * sum(sizes))
    order = training_order(mix(messy(spark), carry=["doc_id", "text"])).toPandas()
    assert list(order.position) == sorted(order.position) and order["words"].sum() == out.taken.sum()


def test_mix_sources_get_their_targets(spark):
    rows = [(i, sentences(i, 5 + i % 17), "en", [None, "a", "b", "hot", "hot", "hot"][i % 6]) for i in range(400)]
    out = mix(docs(spark, rows), carry=["doc_id", "source"]).toPandas()
    for _, g in out.groupby("source", dropna=False):
        assert g.taken.sum() == int(g.target.iloc[0])
    assert mix(empty(spark)).collect() == [] and training_order(mix(empty(spark))).collect() == []


def test_mix_of_a_source_without_words(spark):
    rows = [(1, None, "en", "void"), (2, "", "en", "void"), (3, " \n", "en", "void"), (4, sentences(4, 30), "en", "full")]
    out = {r.doc_id: r for r in mix(docs(spark, rows)).collect()}
    assert [(out[k].taken, out[k].target, out[k].copies) for k in (1, 2, 3)] == [(0, 0.0, [])] * 3 and out[4].taken == 45
    assert [(r.doc_id, r.epoch, r.words) for r in training_order(mix(docs(spark, rows))).collect()] == [(4, 0, 30), (4, 1, 15)]


def test_demand_time_inverts_the_integral(spark):
    for a in (0.5, 0.0, -0.5):
        for t in (0.0, 0.1, 0.7, 1.0):
            share = t + a * (t * t - t)
            assert spark.range(1).select(demand_time(F.lit(share), F.lit(a))).first()[0] == pytest.approx(t)


def test_heavier_slope_trains_later(spark):
    rows = [(i, sentences(i, 20), "en", "abc"[i % 3]) for i in range(600)]
    order = training_order(mix(docs(spark, rows), carry=["doc_id", "source"])).toPandas()
    assert order[order.source == "a"].position.mean() > order[order.source == "c"].position.mean()


# --- line dedup -----------------------------------------------------------------------------

def test_line_dedup_messy_rows(spark):
    out = dedup_lines(messy(spark))
    assert out.columns == [c for c in messy(spark).columns if c not in ("n_lines", "n_removed")] + ["n_lines", "n_removed"]
    rows = out.collect()
    assert len(rows) == len(messy_rows())
    assert all(r.text is None and r.n_lines == 0 for r in rows if r.doc_id == 3)
    # Row 6 comes first and keeps its lines; row 7 and the null id repeat them.
    full = next(t for i, t in messy_rows() if i == 6)
    assert next(r.text for r in rows if r.doc_id == 6) == full
    assert next(r.n_removed for r in rows if r.doc_id == 7) > 0
    assert next(r.n_removed for r in rows if r.doc_id is None and r.text is not None and r.n_lines == 12) == \
        next(r.n_lines for r in rows if r.doc_id == 6) - max(0, 12 - next(r.n_removed for r in rows if r.doc_id is None and r.n_lines == 12))
    same = [r.text for r in rows if r.doc_id == 9]
    assert same[0] == same[1]
    assert dedup_lines(empty(spark)).collect() == []


def test_line_dedup_boundaries_resist_shifts(spark):
    block = [sentences(k, 10) for k in range(40)]
    rows = [(1, "\n".join(block)), (2, "\n".join(["new line", *block])), (3, "\n".join(block[3:]))]
    out = {r.doc_id: r.n_removed for r in dedup_lines(docs(spark, rows)).collect()}
    assert out[1] == 0 and out[2] >= 20 and out[3] >= 20


# --- licences -------------------------------------------------------------------------------

def test_licences_found_by_dice(spark):
    rows = [(1, sentences(2, 40) + "\nReleased  under the MIT license!"), (2, "Licensed under the Apache License, Version 2.0."), (3, None), (4, ""), (5, "MIT"),
            (6, "this work is licensed under the gnu general public license version 3 or later"), (None, "Licensed under CC BY-NC 4.0."),
            (7, sentences(1, 50000)), (8, "Released under the MIT License."), (8, "Released under the MIT License.")]
    got = sorted((r.doc_id, r.line_no, r.license) for r in scan(docs(spark, rows).withColumn("grams", F.lit(1)).withColumn("n", F.lit(1))).collect() if r.doc_id is not None)
    assert got == [(1, 2, "MIT"), (2, 1, "Apache-2.0"), (6, 1, "GPL-3.0"), (8, 1, "MIT"), (8, 1, "MIT")]
    assert [r.license for r in scan(docs(spark, rows)).collect() if r.doc_id is None] == ["CC-BY-NC-4.0"]
    assert scan(empty(spark)).collect() == [] and scan(messy(spark)).collect() == []


# --- chat -----------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, size string, p string, a string"


def turns(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], TURNS)


def test_preference_pairs(spark):
    conv = turns(spark, [
        (1, 0, "user", "hi"), (1, 1, "assistant", "hello"), (1, 2, "user", "bye"), (1, 3, "assistant", "see you"),
        (2, 0, "user", "hi"), (2, 1, "assistant", "hello"), (2, 2, "user", "bye"), (2, 3, "assistant", "no"),
        (3, 0, "user", None), (3, None, None, "late"), (4, 0, "user", None), (4, 1, "assistant", ""), (None, 0, "user", "lost"),
        (5, 0, "user", "x"), (5, 0, "user", "x"), (6, 0, "user", "x"), (6, 0, "user", "x")])
    pairs = spark.createDataFrame([(1, 1, 2), (2, 3, 4), (3, 5, 6), (4, 7, None), (5, 1, None), (6, 1, 1)], "pair_id bigint, chosen_id bigint, rejected_id bigint")
    out = {r.pair_id: r for r in preference_pairs(conv, pairs).collect()}
    assert len(out) == 6
    one = out[1]
    assert one.prompt_turns == 3 and one.prompt.count("<|im_start|>") == 3 and one.usable
    assert one.chosen == "<|im_start|>assistant\nsee you<|im_end|>\n"
    s = one.chosen_spans[0]
    assert one.chosen[s.start:s.end] == "see you<|im_end|>\n"
    assert out[2].prompt_turns == 1 and not out[2].usable
    assert out[3].prompt_turns == 2 and out[3].chosen == out[3].rejected == ""
    assert (out[4].prompt, out[4].chosen, out[4].usable) == ("", "", False)
    assert out[5].prompt_turns == 0 and out[5].rejected == "" and len(out[5].chosen_spans) == 2
    assert out[6].prompt_turns == 4 and out[6].chosen == ""
    assert preference_pairs(conv.limit(0), pairs.limit(0)).collect() == []


def test_spans_cover_what_is_rendered(spark):
    rows = [("user", "ü" * 5), ("assistant", "añb"), (None, None), ("assistant", None)]
    df = spark.createDataFrame([(rows,)], "t array<struct<role:string,text:string>>")
    r = df.select(render(F.col("t")).alias("r"), trained_spans(F.col("t")).alias("s")).first()
    assert [r.r[s.start:s.end] for s in r.s] == ["añb<|im_end|>\n", "<|im_end|>\n"]

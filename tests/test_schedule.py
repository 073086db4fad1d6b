"""Schedule importers (FIXTURES §7), replace-by-source, panels and the CSV tokenizer."""

import datetime as dt

import pytest

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluice.functions.tokenize import split_csv
from sluice.operators import schedule as sc
from sluice.sinks.tables import IngestTables, replace_schedule_files
from sluice.sources import schedule_csv as csv


def _lines(spark, files):
    rows = []
    for name, text in files.items():
        rows.append((name, text))
    df = spark.createDataFrame(rows, "source_file string, text string")
    return csv.text_to_lines(df)


def test_lead_copper_readme_example(spark):
    lines = _lines(spark, {"lc.csv": "analyte_name,next_due_date\nLEAD,09-30-2027\nCOPPER,09-30-2027\n"})
    rows = csv.parse_lead_copper(lines).collect()
    assert len(rows) == 2
    assert {r.next_due_date for r in rows} == {dt.date(2027, 9, 30)}
    assert {(r.ps_code, r.group_name) for r in rows} == {("DST_LCR", "LEAD_COPPER")}


def test_schedule_title_row_first(spark):
    text = ("LAST AND NEXT SAMPLE REPORT\n"
            "PS Codes,Group Name,Analyte Number,Analyte Name,Last Sampled,Frequency,Next Due,Notes\n"
            "P1,GA,1,IRON,03-15-2024,36,2028/12,\n"
            "P2,GA,2,ZINC,,,none,\n"
            "P3,GA,3,LEAD,,,2028/13,\n"
            "P4,GA,4,TIN,,,,\n"
            ",GA,5,SKIPPED,,,,\n")
    rows = {r.ps_code: r for r in csv.parse_schedule(_lines(spark, {"﻿s.csv": "﻿" + text})).collect()}
    assert set(rows) == {"P1", "P2", "P3", "P4"}
    p1 = rows["P1"]
    assert p1.next_due_date == dt.date(2028, 12, 31) and p1.last_sampled == dt.date(2024, 3, 15)
    assert p1.frequency_months == 36 and p1.notes is None
    assert rows["P2"].next_due_date is None and rows["P2"].next_due_raw == "none"
    assert rows["P3"].next_due_date is None and rows["P3"].next_due_raw == "2028/13"
    assert rows["P4"].next_due_raw is None


def test_lead_copper_text_due(spark):
    text = "Metal,Site,Next Sampling Due\nLEAD,a,Past Due\nCOPPER,b,due now\nIRON,c,call lab\n,d,01-01-2030\n"
    rows = {r.analyte_name: r for r in csv.parse_lead_copper(_lines(spark, {"x.csv": text})).collect()}
    assert set(rows) == {"LEAD", "COPPER", "IRON"}
    assert rows["LEAD"].notes == "Past Due" and rows["COPPER"].notes == "DUE NOW" and rows["IRON"].notes == "call lab"
    assert all(r.next_due_date is None for r in rows.values())


def test_reimport_replaces_only_that_file(spark, tmp_path):
    t = IngestTables(spark, str(tmp_path / "tables"))
    hdr = "PS Codes,Group Name,Analyte Number,Analyte Name,Last Sampled,Frequency,Next Due,Notes\n"
    first = csv.parse_schedule(_lines(spark, {"active.csv": hdr + "A1,G,1,X,,,2030/1,\nA2,G,2,Y,,,2030/2,\n",
                                             "standby.csv": hdr + "S1,G,1,X,,,2030/1,\n"})).drop("_bad_frequency")
    replace_schedule_files(t, first, ["active.csv", "standby.csv"], dt.datetime(2024, 1, 1))
    assert t.schedule.read().count() == 3
    again = csv.parse_schedule(_lines(spark, {"active.csv": hdr + "A9,G,1,X,,,2031/1,\n"})).drop("_bad_frequency")
    replace_schedule_files(t, again, ["active.csv"], dt.datetime(2024, 2, 1))
    got = sorted((r.source_file, r.ps_code) for r in t.schedule.read().collect())
    assert got == [("active.csv", "A9"), ("standby.csv", "S1")]
    empty = csv.parse_schedule(_lines(spark, {"standby.csv": hdr})).drop("_bad_frequency")
    replace_schedule_files(t, empty, ["standby.csv"], dt.datetime(2024, 3, 1))
    assert sorted(r.ps_code for r in t.schedule.read().collect()) == ["A9"]


def test_panels(spark):
    rows = spark.createDataFrame([
        ("P1", "GA", None, dt.date(2024, 1, 1), "active_1.csv", None),
        ("P2", "", "LEAD", dt.date(2024, 1, 10), "STANDBY.csv", "Due now please"),
        ("P3", None, None, None, "x.csv", None),
    ], "ps_code string, group_name string, analyte_name string, next_due_date date, source_file string, notes string")
    today = "2024-01-05"
    out = {r.ps_code: r for r in rows.select(
        "ps_code", sc.well_label().alias("w"), sc.how_soon("next_due_date", today).alias("h"),
        sc.what_to_sample(style="to_order").alias("what"), sc.notes_flagged().alias("f")).collect()}
    assert out["P1"].w == "Active well" and out["P1"].h == "OVERDUE" and out["P1"].what == "GA"
    assert out["P2"].w == "Standby well" and out["P2"].h == "Due within 2 weeks" and out["P2"].what == "LEAD"
    assert out["P3"].w.startswith("Well (rename") and out["P3"].h == "No due date in file"
    assert out["P3"].what == "(see PS code — analyte missing in export)"
    assert out["P2"].f and not out["P1"].f
    c = sc.due_counts(rows, today).first()
    assert (c.overdue, c.due_45, c.notes_flagged, c.alert_window) == (1, 1, 1, 2)


def _js_split(line: str) -> list[str]:
    """The quote-toggling CSV reader being reproduced (for the equivalence test)."""
    out, cur, inq, i = [], "", False, 0
    while i < len(line):
        ch = line[i]
        if ch == '"':
            if inq and i + 1 < len(line) and line[i + 1] == '"':
                cur += '"'
                i += 1
            else:
                inq = not inq
        elif ch == "," and not inq:
            out.append(cur.strip())
            cur = ""
        else:
            cur += ch
        i += 1
    out.append(cur.strip())
    return out


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet='ab ,"', min_size=0, max_size=14), min_size=300, max_size=300))
def test_split_csv_matches_quote_toggle_reader(spark, lines):
    df = spark.createDataFrame([(i, l) for i, l in enumerate(lines)], "i int, l string")
    got = {r.i: list(r.c) for r in df.select("i", split_csv("l").alias("c")).collect()}
    for i, l in enumerate(lines):
        assert got[i] == _js_split(l), l


HEADER = "PS Codes,Group Name,Analyte Number,Analyte Name,Last Sampled,Frequency,Next Due,Notes"


def _stored(t):
    return sorted((r.source_file, r.ps_code, r.frequency_months, r.next_due_raw) for r in t.schedule.read().collect())


def test_schedule_import_job(spark, tmp_path):
    from sluice.plans.schedule_job import ImportRejected, import_schedule

    root = str(tmp_path / "t")
    t = IngestTables(spark, root)
    good = tmp_path / "active.csv"
    good.write_text("\ufefftitle,,\n\n" + HEADER + '\nP1,G,1,Iron,1-2-2024,12,Jan 2025,"a ""b"", c"\nP2,G,2,Lead,,,none,\n,skipped,,,,,,\n', encoding="utf-8")
    assert import_schedule(spark, str(good), root).first()["count"] == 2
    want = [("active.csv", "P1", 12, "Jan 2025"), ("active.csv", "P2", None, "none")]
    assert _stored(t) == want
    for bad in ("no header here\nP9,G,1,Iron,,1,,\n", HEADER + "\nP9,G,1,Iron,,1.5,,\n"):
        good.write_text(bad)
        with pytest.raises(ImportRejected):
            import_schedule(spark, str(good), root)
        assert _stored(t) == want
    good.write_text(HEADER + "\nP3,G,1,Iron,,3,,\n")
    other = tmp_path / "standby.csv"
    other.write_text(HEADER + "\n")
    import_schedule(spark, [str(good), str(other)], root)
    assert _stored(t) == [("active.csv", "P3", 3, None)]
    lead = tmp_path / "lead.csv"
    lead.write_text("Metal,Sample Site,Next Sampling Due\nLead,x,01-31-2025\n")
    import_schedule(spark, str(lead), root, kind="lead_copper")
    assert len(_stored(t)) == 2
    lead.write_text("nothing,useful\n")
    with pytest.raises(ImportRejected):
        import_schedule(spark, str(lead), root, kind="lead_copper")
    assert len(_stored(t)) == 2


def test_files_and_lines_give_the_same_rows(spark, tmp_path):
    from sluice.sources import schedule_csv as R

    f = tmp_path / "a.csv"
    f.write_text("x\n" + HEADER + "\nP1,G,1,Iron,1-2-2024,12,Jan 2025,n\n" + HEADER + "\nP2,,,Lead,,bi,none,\n")
    files = R.parse_schedule_files(R.read_files(spark, str(f))).drop("_no_header")
    lines = R.parse_schedule(R.read_lines(spark, str(f)))
    assert sorted(map(repr, files.collect())) == sorted(map(repr, lines.select(files.columns).collect()))


def test_an_import_is_one_step_for_readers(spark, tmp_path):
    t = IngestTables(spark, str(tmp_path))
    row = lambda f, n: (None, None, str(n), None, None, None, None, None, None, f, None)
    rows = lambda *x: spark.createDataFrame([row(*y) for y in x], t.schedule.schema)
    replace_schedule_files(t, rows(("a", 1), ("b", 1), ("c", 1)), ["a", "b", "c"], "2026-01-01 00:00:00")
    reader, before = t.schedule.read(), t.schedule.versions()
    replace_schedule_files(t, rows(("a", 2), ("c", 2), ("c", 3)), ["a", "b", "c"], "2026-01-02 00:00:00")
    # Who opened the table before the import still sees all of the old rows.
    assert sorted((x.source_file, x.analyte_number) for x in reader.collect()) == [("a", "1"), ("b", "1"), ("c", "1")]
    assert sorted((x.source_file, x.analyte_number) for x in t.schedule.read().collect()) == [("a", "2"), ("c", "2"), ("c", "3")]
    assert len(t.schedule.versions()) == len(before) + 1

    def fails(x):
        raise OSError("lost")
    broken = spark.createDataFrame([row("a", 9)], t.schedule.schema).withColumn("analyte_number", F.udf(fails)("analyte_number"))
    with pytest.raises(Exception):
        replace_schedule_files(t, broken, ["a"], "2026-01-03 00:00:00")
    assert t.schedule.read().count() == 3

"""Schedule queries (E5 and the water-compliance panels)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sluice.operators import schedule as sc
from sluice.plans.catalog import register
from sluice.plans.sqlparts import AS_OF_DATE, with_views
from sluice.sources import driver_tables as dt
from sluice.sources import schedule_csv as csv

_TODAY = f"DATE '{AS_OF_DATE}'"


# The expectations below are written from the data model's description, independently of the
# operators: bands and words are rows of small value tables, the sample text is one concatenation.

# Display texts of the well label by style (word in the file name → text).
_WELL_TEXT = {
    "panel": ("Standby well", "Active well"),
    "full_list": ("Standby well", "Active well"),
    "readme": ("standby", "active"),
}
# Display texts of the due bands, in days from today.
_BANDS = [(-1_000_000, -1, "OVERDUE"), (0, 14, "Due within 2 weeks"), (15, 45, "Due within 45 days"),
          (46, 120, "Due within 120 days"), (121, 1_000_000, "OK")]
_DAYS = f"date_diff('day', {_TODAY}, next_due_date)"


def _well(style="panel"):
    standby, active = _WELL_TEXT[style]
    return (f"COALESCE((SELECT arg_min(label, rank) FROM (VALUES (1, 'standby', '{standby}'), (2, 'active', '{active}')) w(rank, word, label) "
            f"WHERE contains(lower(source_file), word)), '{sc.WELL_FALLBACK[style]}')")


def _what(style):
    parts = "concat_ws(' — ', NULLIF(TRIM(group_name), ''), NULLIF(TRIM(analyte_name), ''))"
    return f"COALESCE(NULLIF({parts}, ''), '{sc.SAMPLE_PLACEHOLDER[style]}')"


_HOW_SOON = ("COALESCE((SELECT any_value(label) FROM (VALUES "
             + ", ".join(f"({lo}, {hi}, '{label}')" for lo, hi, label in _BANDS)
             + f") b(lo, hi, label) WHERE {_DAYS} BETWEEN lo AND hi), 'No due date in file')")

_FLAGGED = "regexp_matches(upper(coalesce(notes, '')), 'DUE NOW|PAST DUE')"


@register("schedule_due_counts", sql=with_views("schedule") + f"""
SELECT count(*) FILTER (WHERE {_DAYS} < 0) AS overdue, count(*) FILTER (WHERE {_DAYS} BETWEEN 0 AND 45) AS due_45,
       count(*) FILTER (WHERE {_FLAGGED}) AS notes_flagged, count(*) FILTER (WHERE {_DAYS} BETWEEN -30 AND 45) AS alert_window
FROM schedule""")
def schedule_due_counts(spark, sf_dir):
    """Overdue, due-45, notes-flagged and alert-window counts in one pass."""
    return sc.due_counts(dt.schedule(spark, sf_dir), AS_OF_DATE)


@register("schedule_tests_to_order", sql=with_views("schedule") + f"""
SELECT {_well()} AS well, {_HOW_SOON} AS how_soon, {_what('to_order')} AS what, next_due_date AS due_date,
       last_sampled, ps_code, COALESCE(notes, '') AS notes, source_file
FROM schedule
WHERE {_DAYS} <= 120""", text_cols=("due_date", "last_sampled"))
def schedule_tests_to_order(spark, sf_dir):
    """F11 + S31/S32/S33: tests to order or schedule in the next 120 days."""
    return sc.tests_to_order(dt.schedule(spark, sf_dir), AS_OF_DATE)


@register("schedule_lead_copper", sql=with_views("schedule") + f"""
SELECT {_well()} AS well, TRIM(analyte_name) AS what, next_due_date AS due_date, COALESCE(notes, '') AS notes,
       ps_code, source_file
FROM schedule WHERE group_name = 'LEAD_COPPER'""", text_cols=("due_date",))
def schedule_lead_copper(spark, sf_dir):
    """lead and copper rows."""
    return sc.lead_copper(dt.schedule(spark, sf_dir))


@register("schedule_urgent_notes", sql=with_views("schedule") + f"""
SELECT {_well()} AS well, {_what('urgent')} AS what, COALESCE(notes, '') AS notes, next_due_date AS due_date,
       ps_code, source_file
FROM schedule WHERE {_FLAGGED}""", text_cols=("due_date",))
def schedule_urgent_notes(spark, sf_dir):
    """notes say DUE NOW or PAST DUE."""
    return sc.urgent_notes(dt.schedule(spark, sf_dir))


@register("schedule_full_list", sql=with_views("schedule") + f"""
SELECT {_well('full_list')} AS well, {_what('full_list')} AS what, next_due_date AS due_date, last_sampled,
       ps_code, COALESCE(group_name, '') AS "group", source_file
FROM schedule""", text_cols=("due_date", "last_sampled"))
def schedule_full_list(spark, sf_dir):
    """the full labelled list."""
    return sc.full_list(dt.schedule(spark, sf_dir))


@register("schedule_import_status", sql=with_views("schedule") + """
SELECT source_file, CAST(count(*) AS BIGINT) AS "rows", max(imported_at) AS last_import
FROM schedule GROUP BY source_file""")
def schedule_import_status(spark, sf_dir):
    """Rows and latest import per file."""
    return sc.import_status(dt.schedule(spark, sf_dir))


@register("schedule_well_readme", sql=with_views("schedule") + f"""
SELECT {_well('readme')} AS well, CAST(count(*) AS BIGINT) AS n FROM schedule GROUP BY 1""")
def schedule_well_readme(spark, sf_dir):
    """S31 (README variant): standby / active / unclassified counts."""
    return dt.schedule(spark, sf_dir).groupBy(sc.well_label(style="readme").alias("well")) \
        .agg(F.count("*").alias("n"))


# --- importers: schedule rows rendered to CSV lines, then parsed back ---------------------

def _schedule_lines(spark, sf_dir):
    """One CSV line per schedule row plus a title and a header line per file (no aggregation)."""
    s = dt.schedule(spark, sf_dir, with_key=True)
    quoted_notes = F.when(F.col("notes").isNull(), F.lit("")) \
        .otherwise(F.concat(F.lit('"'), F.regexp_replace("notes", '"', '""'), F.lit('"')))
    data = s.select(
        "source_file", (F.col("row_key") + 3).alias("line_no"),
        F.concat_ws(",", "ps_code", "group_name", "analyte_number", F.coalesce("analyte_name", F.lit("")),
                    F.date_format("last_sampled", "M-d-yyyy"), F.col("frequency_months").cast("string"),
                    "next_due_raw", quoted_notes).alias("line"))
    files = s.select("source_file").distinct()
    head = files.select("source_file", F.posexplode(F.array(
        F.lit("LAST AND NEXT SAMPLE REPORT,,,,,,,"),
        F.lit(" PS Codes ,Group  Name,Analyte Number,Analyte Name,Last Sampled,Frequency,Next Due,Notes"),
    )).alias("i", "line")).select("source_file", (F.col("i") + 1).alias("line_no"), "line")
    return head.unionByName(data)


@register("schedule_import", sql=with_views("schedule") + """
SELECT ps_code, NULLIF(TRIM(group_name), '') AS group_name, analyte_number, analyte_name, last_sampled,
       frequency_months, next_due_date, next_due_raw, notes, source_file
FROM schedule""", text_cols=("last_sampled", "next_due_date"))
def schedule_import(spark, sf_dir):
    """R9 + P5 + S20: parse schedule CSV lines (title row first, quoted notes) back into rows."""
    return csv.parse_schedule(_schedule_lines(spark, sf_dir),
                              spread=spark.sparkContext.defaultParallelism * 2).drop("_bad_frequency")


def _lead_copper_lines(spark, sf_dir):
    s = dt.schedule(spark, sf_dir, with_key=True).where(F.col("group_name") == "LEAD_COPPER")
    due = (F.when(F.col("notes") == "DUE NOW", "due now").when(F.col("notes").like("past due%"), "Past Due")
           .when(F.col("next_due_date").isNull(), "call lab")
           .otherwise(F.date_format("next_due_date", "MM-dd-yyyy")))
    fname = F.concat(F.lit("lead_copper_"), F.col("source_file"))
    data = s.select(fname.alias("source_file"), (F.col("row_key") + 2).alias("line_no"),
                    F.concat_ws(",", F.coalesce("analyte_name", F.lit("")), "ps_code", due).alias("line"))
    head = s.select(fname.alias("source_file")).distinct().select(
        "source_file", F.lit(1).cast("long").alias("line_no"), F.lit("Metal,Sample Site,Next Sampling Due").alias("line"))
    return head.unionByName(data)


@register("schedule_import_lead_copper", sql=with_views("schedule") + """
, r AS (SELECT 'lead_copper_' || source_file AS source_file, TRIM(analyte_name) AS analyte_name,
               CASE WHEN notes = 'DUE NOW' THEN 'due now' WHEN notes LIKE 'past due%' THEN 'Past Due'
                    WHEN next_due_date IS NULL THEN 'call lab' ELSE strftime(next_due_date, '%m-%d-%Y') END AS due,
               next_due_date
        FROM schedule WHERE group_name = 'LEAD_COPPER' AND COALESCE(TRIM(analyte_name), '') <> '')
SELECT 'DST_LCR' AS ps_code, 'LEAD_COPPER' AS group_name, CAST(NULL AS VARCHAR) AS analyte_number, analyte_name,
       CAST(NULL AS DATE) AS last_sampled, CAST(NULL AS INTEGER) AS frequency_months,
       CASE WHEN due IN ('due now', 'Past Due', 'call lab') THEN NULL ELSE next_due_date END AS next_due_date,
       due AS next_due_raw,
       CASE WHEN due = 'due now' THEN 'DUE NOW' WHEN due = 'Past Due' THEN 'Past Due'
            WHEN due = 'call lab' THEN 'call lab' END AS notes,
       source_file
FROM r""", text_cols=("last_sampled", "next_due_date"))
def schedule_import_lead_copper(spark, sf_dir):
    """R10 + S21 + S22: lead/copper list (``Metal`` / ``Next Sampling Due`` headers) parsed back."""
    return csv.parse_lead_copper(_lead_copper_lines(spark, sf_dir), spread=spark.sparkContext.defaultParallelism * 2)

"""Water-sampling schedule analytics.

``as_of`` is the explicit "current date"; all windows are computed from it.  Every panel is
a filter + projection (no shuffle) and the counters are one partial aggregate.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions.text import col_of

# Fallback texts of the well label and the "what to sample" placeholder.
WELL_FALLBACK = {
    "panel": "Well (rename file to include active or standby)",
    "full_list": "Well (rename file)",
    "readme": "unclassified",
}
SAMPLE_PLACEHOLDER = {
    "to_order": "(see PS code — analyte missing in export)",
    "urgent": "(see PS code)",
    "full_list": "(unspecified)",
}


def _date(as_of) -> Column:
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of[:10])
    return F.lit(as_of)


def well_label(source_file="source_file", style: str = "panel") -> Column:
    """Standby / Active well from the file name, else a fallback text."""
    f = F.lower(col_of(source_file))
    if style == "readme":
        return F.when(f.like("%standby%"), "standby").when(f.like("%active%"), "active").otherwise("unclassified")
    return (F.when(f.like("%standby%"), "Standby well").when(f.like("%active%"), "Active well")
            .otherwise(WELL_FALLBACK[style]))


def how_soon(next_due="next_due_date", as_of=None) -> Column:
    """No date / OVERDUE / within 2 weeks / 45 days / 120 days / OK."""
    d, today = col_of(next_due), _date(as_of)
    return (F.when(d.isNull(), "No due date in file")
            .when(d < today, "OVERDUE")
            .when(d <= F.date_add(today, 14), "Due within 2 weeks")
            .when(d <= F.date_add(today, 45), "Due within 45 days")
            .when(d <= F.date_add(today, 120), "Due within 120 days")
            .otherwise("OK"))


def what_to_sample(group="group_name", analyte="analyte_name", style: str = "to_order") -> Column:
    """``group — analyte``; one blank → the other; both blank → placeholder."""
    g = F.trim(col_of(group))
    a = F.trim(col_of(analyte))
    g_blank = F.coalesce(g, F.lit("")) == ""
    a_blank = F.coalesce(a, F.lit("")) == ""
    return (F.when(a_blank & g_blank, SAMPLE_PLACEHOLDER[style])
            .when(g_blank, a).when(a_blank, g)
            .otherwise(F.concat(g, F.lit(" — "), a)))


def notes_flagged(notes="notes") -> Column:
    """notes mention DUE NOW or PAST DUE (case-insensitive)."""
    n = F.upper(col_of(notes))
    return col_of(notes).isNotNull() & (n.like("%DUE NOW%") | n.like("%PAST DUE%"))


def due_counts(schedule: DataFrame, as_of) -> DataFrame:
    """G2 (+A6 count): overdue, due in 45 days, notes flagged, alert window [-30d, +45d]; one pass."""
    d, today = F.col("next_due_date"), _date(as_of)
    return schedule.agg(
        F.count_if(d.isNotNull() & (d < today)).alias("overdue"),
        F.count_if(d.isNotNull() & (d >= today) & (d <= F.date_add(today, 45))).alias("due_45"),
        F.count_if(notes_flagged()).alias("notes_flagged"),
        F.count_if(d.isNotNull() & (d <= F.date_add(today, 45)) & (d >= F.date_sub(today, 30))).alias("alert_window"),
    )


def tests_to_order(schedule: DataFrame, as_of, days: int = 120) -> DataFrame:
    """F11 panel: rows due within ``days`` (or overdue) with well, urgency and what to sample."""
    today = _date(as_of)
    return schedule.where(F.col("next_due_date").isNotNull()
                          & (F.col("next_due_date") <= F.date_add(today, days))).select(
        well_label().alias("well"), how_soon("next_due_date", today).alias("how_soon"),
        what_to_sample(style="to_order").alias("what"), F.col("next_due_date").alias("due_date"),
        "last_sampled", "ps_code", F.coalesce("notes", F.lit("")).alias("notes"), "source_file",
    ).orderBy(F.col("due_date").asc_nulls_last(), "well", "ps_code")


def lead_copper(schedule: DataFrame) -> DataFrame:
    """F13 panel: lead/copper rows."""
    return schedule.where(F.col("group_name") == "LEAD_COPPER").select(
        well_label().alias("well"), F.trim("analyte_name").alias("what"), F.col("next_due_date").alias("due_date"),
        F.coalesce("notes", F.lit("")).alias("notes"), "ps_code", "source_file",
    ).orderBy("well", F.col("what").asc_nulls_last())


def urgent_notes(schedule: DataFrame) -> DataFrame:
    """F12 panel: rows whose notes say DUE NOW / PAST DUE."""
    return schedule.where(notes_flagged()).select(
        well_label().alias("well"), what_to_sample(style="urgent").alias("what"),
        F.coalesce("notes", F.lit("")).alias("notes"), F.col("next_due_date").alias("due_date"), "ps_code",
        "source_file",
    ).orderBy("well", F.col("ps_code").asc_nulls_last())


def full_list(schedule: DataFrame) -> DataFrame:
    """F14 panel: every row, labelled (Postgres ASC = NULLS LAST)."""
    return schedule.select(
        well_label(style="full_list").alias("well"), what_to_sample(style="full_list").alias("what"),
        F.col("next_due_date").alias("due_date"), "last_sampled", "ps_code",
        F.coalesce("group_name", F.lit("")).alias("group"), "source_file",
    ).orderBy("well", F.col("due_date").asc_nulls_last(), F.col("ps_code").asc_nulls_last())


def import_status(schedule: DataFrame) -> DataFrame:
    """Rows and latest import time per source file."""
    return (schedule.groupBy("source_file")
            .agg(F.count("*").alias("rows"), F.max("imported_at").alias("last_import"))
            .orderBy("source_file"))

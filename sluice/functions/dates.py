"""Time-zone, report-window, date-cell and rounding expressions.

All instants are TIMESTAMP in a UTC session; wall-clock conversions go through
``from_utc_timestamp`` / ``to_utc_timestamp`` with an explicit IANA zone.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import col_of, js_trim

US_GALLONS_PER_ACRE_FOOT = 325851.0


def as_instant(c) -> Column:
    """Normalise TIMESTAMP_NTZ input (driver tables) to an instant (TIMESTAMP, UTC session)."""
    return col_of(c).cast("timestamp")


def epoch_ms(c) -> Column:
    """Millisecond instant (floor), the precision all reference arithmetic works at."""
    return F.unix_millis(col_of(c))


def local_date(ts, tz: str) -> Column:
    """S23 date part: ``yyyy-MM-dd`` wall-clock date of an instant in ``tz``."""
    return F.date_format(F.from_utc_timestamp(col_of(ts), tz), "yyyy-MM-dd")


def local_time(ts, tz: str) -> Column:
    """S23 time part: 24-hour ``HH:mm:ss`` (midnight is 00)."""
    return F.date_format(F.from_utc_timestamp(col_of(ts), tz), "HH:mm:ss")


def year_month_in_tz(ts, tz: str) -> Column:
    """``yyyy-MM`` calendar month of an instant in ``tz``."""
    return F.date_format(F.from_utc_timestamp(col_of(ts), tz), "yyyy-MM")


def yesterday(as_of, tz: str) -> Column:
    """The day before ``as_of``'s local date (default report end)."""
    return F.date_sub(F.to_date(F.from_utc_timestamp(col_of(as_of), tz)), 1)


def local_midnight_instant(day, tz: str) -> Column:
    """Instant of 00:00 local time on ``day`` (DATE column or literal)."""
    return F.to_utc_timestamp(col_of(day).cast("timestamp"), tz)


def report_window(year: int, end_inclusive: str | _dt.date, tz: str) -> tuple[Column, Column]:
    """``[year-01-01 00:00 local, end+1d 00:00 local)`` as two foldable instants."""
    end = end_inclusive if isinstance(end_inclusive, _dt.date) else _dt.date.fromisoformat(str(end_inclusive))
    start = local_midnight_instant(F.lit(_dt.date(int(year), 1, 1)), tz)
    stop = local_midnight_instant(F.lit(end + _dt.timedelta(days=1)), tz)
    return start, stop


def round_half_up(c, digits: int) -> Column:
    """``Math.round(x * 10^d) / 10^d`` (ties toward +infinity)."""
    f = float(10 ** digits)
    return F.floor(col_of(c) * f + 0.5) / f


def finite(c) -> Column:
    x = col_of(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def check_flow_scale(scale) -> float:
    """The scale must be a positive finite number (1 = identity)."""
    try:
        v = float(scale)
    except (TypeError, ValueError):
        raise ValueError(f"invalid flow scale: {scale!r} (expected positive number)")
    if not (v > 0 and v != float("inf")):
        raise ValueError(f"invalid flow scale: {scale!r} (expected positive number)")
    return v


# --- schedule cells ---------------------------------------------------------------------

def _civil_date(y: Column, mo: Column, d: Column) -> Column:
    """``Date.UTC(y, mo-1, d)`` with JavaScript roll-over of month and day overflow."""
    first = F.make_date(y + F.floor((mo - 1) / 12), F.pmod(mo - 1, F.lit(12)) + 1, F.lit(1))
    return F.date_add(first, (d - 1).cast("int"))


def us_date(c) -> Column:
    """``M-D-YYYY`` only (fields roll over), else NULL."""
    t = js_trim(c)
    pat = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
    ok = t.rlike(pat)
    mo = F.regexp_extract(t, pat, 1).try_cast("int")
    d = F.regexp_extract(t, pat, 2).try_cast("int")
    y = F.regexp_extract(t, pat, 3).try_cast("int")
    return F.when(ok, _civil_date(y, mo, d))


def next_due_date(c) -> Column:
    """S20b date: ``YYYY/M`` → last day of that month; month outside 1-12 or text → NULL."""
    t = js_trim(c)
    pat = r"^(\d{4})/(\d{1,2})$"
    y = F.regexp_extract(t, pat, 1).try_cast("int")
    mo = F.regexp_extract(t, pat, 2).try_cast("int")
    ok = t.rlike(pat) & (mo >= 1) & (mo <= 12)
    return F.when(ok, F.last_day(F.make_date(y, mo, F.lit(1))))


def next_due_raw(c) -> Column:
    """S20b raw text: trimmed cell, NULL when blank (``none`` is kept as text)."""
    t = js_trim(c)
    return F.when(t != "", t)


def frequency_months(c) -> Column:
    """Numeric cell → INTEGER months; blank or text → NULL (fractions fail the import)."""
    t = js_trim(c)
    num = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
    return F.when(num == F.floor(num), num.cast("int"))


def frequency_is_invalid(c) -> Column:
    """Cells that the reference's INTEGER column would reject (fractional numbers)."""
    t = js_trim(c)
    num = F.when(t.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), t.try_cast("double"))
    return F.coalesce(num != F.floor(num), F.lit(False))


def due_cell(c) -> Column:
    """lead/copper due cell → struct(date, note).

    "past due" → note ``Past Due``; "due now" → ``DUE NOW``; ``M-D-YYYY``, ``YYYY-MM-DD``,
    ``M/D/YYYY`` → date; other ISO-like dates → date part; anything else → note = text.
    """
    s = js_trim(c)
    q = js_trim(F.regexp_replace(s, r"""^['"]|['"]$""", ""))
    p_mdy = r"^(\d{1,2})-(\d{1,2})-(\d{4})$"
    p_ymd = r"^(\d{4})-(\d{2})-(\d{2})$"
    p_slash = r"^(\d{1,2})/(\d{1,2})/(\d{4})$"
    generic = F.to_date(F.try_to_timestamp(q))
    date = (
        F.when(s == "", F.lit(None).cast("date"))
        .when(q.rlike(r"(?i)past\s*due"), F.lit(None).cast("date"))
        .when(q.rlike(r"(?i)due\s*now"), F.lit(None).cast("date"))
        .when(q.rlike(p_mdy), _civil_date(F.regexp_extract(q, p_mdy, 3).try_cast("int"),
                                          F.regexp_extract(q, p_mdy, 1).try_cast("int"),
                                          F.regexp_extract(q, p_mdy, 2).try_cast("int")))
        .when(q.rlike(p_ymd), _civil_date(F.regexp_extract(q, p_ymd, 1).try_cast("int"),
                                          F.regexp_extract(q, p_ymd, 2).try_cast("int"),
                                          F.regexp_extract(q, p_ymd, 3).try_cast("int")))
        .when(q.rlike(p_slash), _civil_date(F.regexp_extract(q, p_slash, 3).try_cast("int"),
                                            F.regexp_extract(q, p_slash, 1).try_cast("int"),
                                            F.regexp_extract(q, p_slash, 2).try_cast("int")))
        .otherwise(generic)
    )
    note = (
        F.when(s == "", F.lit(None).cast("string"))
        .when(q.rlike(r"(?i)past\s*due"), F.lit("Past Due"))
        .when(q.rlike(r"(?i)due\s*now"), F.lit("DUE NOW"))
        .when(date.isNull(), q)
    )
    return F.struct(date.alias("date"), note.alias("notes"))

"""Object keys, file names and device codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import col_of


def serial_from_key(key) -> Column:
    """Second path segment of the object key, else ``unknown_serial``."""
    parts = F.split(col_of(key), "/", -1)
    return F.when(F.size(parts) >= 2, F.element_at(parts, 2)).otherwise("unknown_serial")


def file_name(key) -> Column:
    """Base name of the object key."""
    return F.element_at(F.split(col_of(key), "/", -1), -1)


def label_code(name) -> Column:
    """``mb[-_]?ddd`` (any case), else ``[_-]ddd`` followed by a non-digit or the end,
    else the first three digits, else ``unknown``."""
    n = F.coalesce(col_of(name), F.lit(""))
    a = F.regexp_extract(n, r"(?i)mb[-_]?(\d{3})", 1)
    b = F.regexp_extract(n, r"[_-](\d{3})(?:\D|$)", 1)
    c = F.regexp_extract(n, r"(\d{3})", 1)
    return F.when(a != "", a).when(b != "", b).when(c != "", c).otherwise("unknown")


def header_code(name, default: str | None = None) -> Column:
    """``mb[-_]?d{1,3}`` followed by a non-digit or the end, zero-padded to three digits;
    else a configured default (only when it is 1-3 digits)."""
    n = F.coalesce(col_of(name), F.lit(""))
    m = F.regexp_extract(n, r"(?i)mb[-_]?(\d{1,3})(?:\D|$)", 1)
    dflt = None
    if default is not None and str(default).strip().isdigit() and 1 <= len(str(default).strip()) <= 3:
        dflt = str(default).strip().zfill(3)
    out = F.when(m != "", F.lpad(m, 3, "0"))
    return out.otherwise(F.lit(dflt)) if dflt else out


def physical_group(parsed_system, label_group) -> Column:
    """Parsed system when known, else the label's group, else ``unknown``."""
    s = col_of(parsed_system)
    known = s.isNotNull() & (s != "") & (s != "unknown")
    return F.when(known, s).otherwise(F.coalesce(F.nullif(col_of(label_group), F.lit("")), F.lit("unknown")))

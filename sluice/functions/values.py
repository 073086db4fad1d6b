"""Cell-value parsing: timestamps (S1), numbers (S2), flags.

All branches are built-in expressions; ``try_*`` variants keep ANSI mode from failing a task
on malformed input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import col_of, js_trim, let, strip_cell_quotes

NUMBER_RE = r"^-?\d+(\.\d+)?([eE][+-]?\d+)?$"

_ZONE_RE = r"[zZ]$|[+-]\d{2}:?\d{2}$"
_YMD_HMS = r"^(\d{4})-(\d{1,2})-(\d{1,2})[ T](\d{1,2}):(\d{2}):(\d{2})(\.\d+)?$"
_YMD = r"^(\d{4})-(\d{2})-(\d{2})$"
_YMD_HM = r"^(\d{4})-(\d{2})-(\d{2})[ T](\d{2}):(\d{2})$"
_MDY_HMS = r"^(\d{1,2})/(\d{1,2})/(\d{4})\s+(\d{1,2}):(\d{2}):(\d{2})"
_EPOCH = r"^\d{10,13}$"


def _int(s: Column, pat: str, i: int) -> Column:
    return F.regexp_extract(s, pat, i).try_cast("long")


def civil_millis(y, mo, d, h, mi, sec, ms=None) -> Column:
    """``Date.UTC(y, mo-1, d, h, mi, sec, ms)``: fields out of range roll over (month 13 →
    January of the next year, day 32 → next month, hour 24 → next day)."""
    first = F.make_date(y + F.floor((mo - 1) / 12), F.pmod(mo - 1, F.lit(12)) + 1, F.lit(1))
    days = F.unix_date(first).cast("long") + (d - 1)
    total = days * 86_400_000 + h * 3_600_000 + mi * 60_000 + sec * 1000
    return total + ms if ms is not None else total


def parse_utc_time(value) -> Column:
    """Device time cell → TIMESTAMP (UTC, millisecond precision) or NULL.

    Order: zone-suffixed ISO text (absolute); ``Y-M-D[ T]H:mm:ss[.f]`` as UTC with roll-over
    and the fraction truncated to ms; ISO date / date-time without seconds as UTC;
    ``M/D/YYYY H:mm:ss`` as UTC; 10-13 digit epochs (≤ 10 digits = seconds).
    """
    return F.timestamp_millis(let(strip_cell_quotes(value), _utc_millis))


def _utc_millis(s: Column) -> Column:
    ymd = civil_millis(_int(s, _YMD, 1), _int(s, _YMD, 2), _int(s, _YMD, 3), F.lit(0), F.lit(0), F.lit(0))
    ymd_hm = civil_millis(_int(s, _YMD_HM, 1), _int(s, _YMD_HM, 2), _int(s, _YMD_HM, 3),
                          _int(s, _YMD_HM, 4), _int(s, _YMD_HM, 5), F.lit(0))
    mdy = civil_millis(_int(s, _MDY_HMS, 3), _int(s, _MDY_HMS, 1), _int(s, _MDY_HMS, 2),
                       _int(s, _MDY_HMS, 4), _int(s, _MDY_HMS, 5), _int(s, _MDY_HMS, 6))
    epoch = F.when(F.length(s) <= 10, s.try_cast("long") * 1000).otherwise(s.try_cast("long"))
    zoned = F.when(s.rlike(_ZONE_RE), F.unix_millis(F.try_to_timestamp(s)))
    # The usual form is taken apart by one match: its fields, and the fraction as 0.fff.
    parts = F.split(F.regexp_replace(s, _YMD_HMS, "$1,$2,$3,$4,$5,$6,0$7"), ",")
    ymd_hms = let(parts, lambda p: civil_millis(*[p[i].try_cast("long") for i in range(6)],
                                                F.floor(p[6].try_cast("double") * 1000).cast("long")))
    rest = (F.when(s == "", F.lit(None).cast("long"))
            .when(s.rlike(_YMD_HMS), ymd_hms)
            .when(s.rlike(_YMD), ymd)
            .when(s.rlike(_YMD_HM), ymd_hm)
            .when(s.rlike(_MDY_HMS), mdy)
            .when(s.rlike(_EPOCH), epoch))
    return F.coalesce(zoned, rest)


def coerce_number(value) -> Column:
    """S2 numeric side: quote-stripped cell matching ``-?d+(.d+)?(e±d+)?`` → DOUBLE, else NULL.

    No ``+1``, ``.5``, ``1.``, ``1,000`` or NaN.  ``1e999`` becomes +inf (callers keep finite
    values only, as the reference does).  The cell is referenced once (cheap inside lambdas).
    """
    return F.regexp_extract(strip_cell_quotes(value), r"^(-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)$", 1) \
        .try_cast("double")


def coerce_text(value) -> Column:
    """S2 text side: the quote-stripped cell ('' for missing)."""
    return F.coalesce(strip_cell_quotes(value), F.lit(""))


def is_finite(c) -> Column:
    x = col_of(c)
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


_DECIMAL = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
_RADIX = r"^0([xX][0-9a-fA-F]+|[oO][0-7]+|[bB][01]+)$"


def parse_flag(value) -> Column:
    """A finite number other than 0 → true; empty, text and quoted cells → false.  Numbers are
    decimals and 0x / 0o / 0b integers; a type suffix (``1d``) makes a text."""
    def flag(v: Column) -> Column:
        n = F.when(v.rlike(_DECIMAL), v.try_cast("double"))
        whole = v.rlike(_RADIX) & ~v.rlike(r"^0[xXoObB]0+$")
        return F.coalesce((is_finite(n) & (n != 0)) | whole, F.lit(False))

    c = col_of(value)
    return F.when(c == "0", F.lit(False)).when(c == "1", F.lit(True)).otherwise(let(js_trim(c), flag))

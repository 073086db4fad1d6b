"""String helpers shared by the parsers (S3, S18, S19, JS-compatible trim)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The whitespace set of JavaScript's String.prototype.trim and regex \s.
JS_WS_CHARS = r"\t\n\x0B\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
JS_WS = f"[{JS_WS_CHARS}]"
# The same set as the characters themselves.
JS_WS_TEXT = "\t\n\x0b\f\r \xa0\u1680" + "".join(map(chr, range(0x2000, 0x200b))) + "\u2028\u2029\u202f\u205f\u3000\ufeff"


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def js_trim(c) -> Column:
    """Trim every Unicode whitespace character (SQL ``trim`` only removes spaces)."""
    return F.btrim(col_of(c), F.lit(JS_WS_TEXT))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` names it: branches of a CASE
    share no common subexpressions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse_ws(c) -> Column:
    return F.regexp_replace(col_of(c), f"{JS_WS}+", " ")


def strip_bom(c) -> Column:
    return F.regexp_replace(col_of(c), r"^\ufeff", "")


def strip_cell_quotes(c) -> Column:
    """S3: trim, drop one matching pair of '…' or "…" quotes, trim again (input used once)."""
    return let(js_trim(c), lambda t: F.when(t.startswith("'") | t.startswith('"'), js_trim(F.regexp_replace(t, r"""(?s)^(['"])(.*)\1$""", "$2")))
               .otherwise(t))


def safe_name(c) -> Column:
    """Trim, every char outside [A-Za-z0-9._-] → '_', at most 180 chars."""
    return F.substring(F.regexp_replace(js_trim(c), r"[^a-zA-Z0-9._-]", "_"), 1, 180)


def norm_header_line(c) -> Column:
    """BOM strip, trim the line, trim each tab-separated cell."""
    t = js_trim(strip_bom(c))
    return F.when(t == "", F.lit("")).otherwise(
        F.array_join(F.transform(F.split(t, "\t", -1), lambda x: js_trim(x)), "\t")
    )


def pg_concat(*cols) -> Column:
    """Postgres CONCAT skips NULL arguments (Spark's concat returns NULL)."""
    return F.concat(*[F.coalesce(col_of(c), F.lit("")) for c in cols])

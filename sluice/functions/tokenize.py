"""Line tokenizers as Column expressions.

``split_csv`` reproduces a quote-toggling CSV reader: a quote toggles quoting anywhere in a
cell, ``""`` inside quotes is a literal quote, cells are trimmed, an unterminated quote runs
to the end of the line, and one physical line is one row.  ``from_csv`` is not used: it
treats quotes in the middle of a cell differently.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import col_of, js_trim

# A comma is a separator when an even number of quotes follows it on the line.
_CSV_SEP = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
_QUOTED = r'"((?:[^"]|"")*)"'


def _balance_quotes(line: Column) -> Column:
    n_quotes = F.length(line) - F.length(F.regexp_replace(line, '"', ""))
    return F.when(n_quotes % 2 == 1, F.concat(line, F.lit('"'))).otherwise(line)


def unquote_cell(cell) -> Column:
    c = col_of(cell)
    return js_trim(F.regexp_replace(F.regexp_replace(c, _QUOTED, "$1"), '""', '"'))


def split_csv(line) -> Column:
    """P5: quoted CSV line → ARRAY<STRING> of trimmed cells.

    Lines without a double quote (the common case) take a plain comma split; only quoted lines
    pay for the quote-aware split and per-cell unquoting."""
    ln = col_of(line)
    balanced = _balance_quotes(ln)
    quoted = F.transform(F.split(balanced, _CSV_SEP, -1), unquote_cell)
    plain = F.transform(F.split(ln, ",", -1), lambda c: js_trim(c))
    return F.when(ln.contains('"'), quoted).otherwise(plain)


def split_plain(line, sep: str) -> Column:
    """Split on a literal tab or semicolon and trim, no quoting."""
    return F.transform(F.split(col_of(line), sep, -1), lambda c: js_trim(c))


def split_tab(line) -> Column:
    return split_plain(line, "\t")


def split_semicolon(line) -> Column:
    return split_plain(line, ";")


def split_lines(text) -> Column:
    """``\\r?\\n`` line split of a whole text."""
    return F.split(col_of(text), r"\r?\n", -1)

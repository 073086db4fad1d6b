"""Device log → records and readings.

Input: one row per file with its decoded ``text``, plus the label/schema columns attached by
``sources.config.resolve_label`` (schema_id, has_data, column_order, header_aliases,
expected_headers).

Input may also be blocks of lines (``sources.blocks``), several rows per file: each carries the file's
first lines and the number of lines before it, so a block is parsed by itself.

Per block (inside its own row — no shuffle): find the header among the file's first 8 lines with
the delimiter that exposes a time column (P1-P3), or fall back to the schema's column order (P9)
or to loose ``key=value`` lines (P10/P11).  The header → metric specs (S13) are computed there too.

Per line (after ``posexplode``, still no shuffle): split with the file's delimiter, re-detect
for one-cell rows (P4), pad/truncate (P7), build the row map (P8), parse the time and flags
(S1, P14), and melt numeric cells into readings (F1/F2).

The only shuffle is the first-wins de-duplication of readings on
(file, serial, record_ts, metric) (W3): partial aggregation already removes duplicates
within a task, and the key spreads a hot file over all reducers.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.functions import metrics as M
from sluice.functions.text import JS_WS_CHARS, js_trim, strip_bom
from sluice.functions.tokenize import split_csv, split_semicolon, split_tab
from sluice.functions.values import coerce_number, coerce_text, is_finite, parse_flag, parse_utc_time
from sluice.sources.blocks import HEAD_LINES, text_blocks

HEADER_SCAN_MAX_LINES = HEAD_LINES
TAB, CSV, SEMI = 1, 2, 3


def split_by(line, delim) -> Column:
    return F.when(delim == TAB, split_tab(line)).when(delim == SEMI, split_semicolon(line)) \
        .otherwise(split_csv(line))


def data_delimiter(line) -> Column:
    """Delimiter of a data row from the characters it contains (tab, ``;`` without ``,``, CSV)."""
    return (F.when(line.contains("\t"), F.lit(TAB))
            .when(line.contains(";") & ~line.contains(","), F.lit(SEMI))
            .otherwise(F.lit(CSV)))


def norm_csv_header(h) -> Column:
    """Header cell: trim, strip a BOM, drop one leading and one trailing double quote."""
    return F.regexp_replace(strip_bom(js_trim(h)), r'^"|"$', "")


def time_column(headers) -> Column:
    """Exact ``time(UTC)``; else ``time(utc)`` / ``time (utc)`` in any case; else the
    first header containing both ``time`` and ``utc``."""
    exact = F.try_element_at(F.filter(headers, lambda h: h == "time(UTC)"), F.lit(1))
    lower = F.try_element_at(F.filter(headers, lambda h: F.lower(h).isin("time(utc)", "time (utc)")), F.lit(1))
    loose = F.try_element_at(F.filter(headers, lambda h: F.lower(h).contains("time") & F.lower(h).contains("utc")),
                             F.lit(1))
    return F.coalesce(exact, lower, loose)


@functools.lru_cache(maxsize=None)
def _layout_stages() -> tuple[dict[str, Column], ...]:
    """File-level stages up to (mode, headers, delim, start); built once per process."""
    head = F.col("_head")
    # The three splits of each of the first 8 lines are computed once, as arrays; the
    # choice below only indexes into them.
    # A header needs a cell containing both "time" and "utc", so only such lines are split;
    # the tab / semicolon splits only run when the line has those characters.
    def cand(l):
        low = F.lower(l)
        return low.contains("time") & low.contains("utc")
    none = F.array().cast("array<string>")
    s2 = {"_tab": F.transform(head, lambda l: F.when(cand(l) & l.contains("\t"),
                                                     F.transform(split_tab(l), norm_csv_header)).otherwise(none)),
          "_csv": F.transform(head, lambda l: F.when(cand(l), F.transform(split_csv(l), norm_csv_header))
                              .otherwise(none)),
          "_semi": F.transform(head, lambda l: F.when(cand(l) & l.contains(";") & ~l.contains(","),
                                                      F.transform(split_semicolon(l), norm_csv_header))
                               .otherwise(none))}
    s3 = {"_tt": F.transform("_tab", lambda h: time_column(h).isNotNull()),
          "_ct": F.transform("_csv", lambda h: time_column(h).isNotNull()),
          "_st": F.transform("_semi", lambda h: time_column(h).isNotNull())}

    def choose(i):
        line = F.col("_head")[i]
        return F.when(line.contains("\t") & F.col("_tt")[i], F.lit(TAB)) \
            .when(F.col("_ct")[i], F.lit(CSV)) \
            .when(line.contains(";") & ~line.contains(",") & F.col("_st")[i], F.lit(SEMI))

    # An empty file has no line to choose; sequence(0, -1) would count down.
    places = F.when(F.size("_csv") > 0, F.sequence(F.lit(0), F.size("_csv") - 1)).otherwise(F.array().cast("array<int>"))
    s4 = {"_cand": F.transform(places, lambda i: F.struct(i.alias("i"), choose(i).alias("delim")))}
    # a header line: the chosen split exposes a time column and has at least 4 cells
    with_headers = F.transform("_cand", lambda c: F.struct(
        c["i"].alias("i"), c["delim"].alias("delim"),
        F.when(c["delim"] == TAB, F.col("_tab")[c["i"]]).when(c["delim"] == SEMI, F.col("_semi")[c["i"]])
        .otherwise(F.col("_csv")[c["i"]]).alias("headers")))
    s5 = {"_hit": F.try_element_at(F.filter(with_headers, lambda c: c["delim"].isNotNull()
                                            & (F.size(c["headers"]) >= 4)), F.lit(1)),
          "_order_h": order_headers(F.col("column_order"))}
    headerless = (F.size("_order_h") > 0) & time_column(F.col("_order_h")).isNotNull()
    first_line = F.try_element_at(F.col("_head"), F.lit(1))
    mode = (F.when(F.size("_head") == 0, F.lit("empty")).when(F.col("_hit").isNotNull(), F.lit("structured"))
            .when(headerless, F.lit("headerless")).otherwise(F.lit("loose")))
    s6 = {"mode": mode}
    s7 = {"headers": F.when(F.col("mode") == "structured", F.col("_hit.headers"))
          .when(F.col("mode") == "headerless", F.col("_order_h")),
          "delim": F.when(F.col("mode") == "structured", F.col("_hit.delim"))
          .when(F.col("mode") == "headerless", data_delimiter(F.coalesce(first_line, F.lit("")))),
          "start": F.when(F.col("mode") == "structured", F.col("_hit.i") + 1).otherwise(F.lit(0))}
    # Q4: a loose file whose ts/timestamp value is not a valid timestamp fails as a whole.
    raw_maps = F.transform("_lines", lambda l: F.map_from_entries(_loose_entries(l)))
    bad = F.exists(F.transform(raw_maps, _loose_ts_raw), lambda t: t.isNotNull() & F.try_to_timestamp(t).isNull())
    s8 = {"parse_error": F.when(F.col("mode") == "loose", F.when(
        bad, F.lit("invalid timestamp value in key=value line")))}
    return (s2, s3, s4, s5, s6, s7, s8)


@functools.lru_cache(maxsize=None)
def _header_stages(strict: bool) -> tuple[dict[str, Column], ...]:
    """Header-level stages: keys, specs and column indexes (evaluated per file)."""
    h = F.col("headers")
    aliases = F.col("header_aliases") if strict else None
    expected = F.col("expected_headers") if strict else None
    s1 = {"keys": F.transform(h, lambda v, i: F.when(
              F.array_position(F.slice(h, 1, i), v) > 0, F.concat(v, F.lit("__"), i.cast("string"))).otherwise(v)),
          "specs": F.when(F.col("mode") == "headerless", F.col("order_specs")).otherwise(M.column_specs(h, aliases, expected, strict)),
          "time_idx": (F.array_position(h, time_column(h)) - 1).cast("int"),
          "err_idx": (F.array_position(h, "error") - 1).cast("int"),
          "low_idx": (F.array_position(h, "lowalarm") - 1).cast("int"),
          "high_idx": (F.array_position(h, "highalarm") - 1).cast("int")}
    measurable = F.filter(F.sequence(F.lit(0), F.size(h) - 1),
                          lambda i: F.col("specs")[i].isNotNull() & M.is_measurable(h[i]))
    s2 = {"measurable_headers": F.when(h.isNotNull(), F.transform(measurable, lambda i: h[i]))
          .otherwise(F.array().cast("array<string>")),
          # The columns that give readings, so that a line's other cells are not looked at.
          "mapped": F.filter(F.transform("specs", lambda s, i: F.struct(i.alias("col_idx"), s.alias("spec"))), lambda m: m["spec"].isNotNull())}
    return (s1, s2)


def order_headers(column_order) -> Column:
    """The headers of files without a header line."""
    return F.transform(F.coalesce(column_order, F.array().cast("array<string>")), norm_csv_header)


def order_specs(schemas: DataFrame, strict: bool = False) -> DataFrame:
    """``schemas`` with the specs of their column orders, which all their headerless files share."""
    specs = M.column_specs(F.col("_order"), F.col("header_aliases") if strict else None, F.col("expected_headers") if strict else None, strict)
    return schemas.withColumn("_order", order_headers(F.col("column_order"))).withColumn("order_specs", specs).drop("_order")


def file_layout(files: DataFrame, strict: bool = False) -> DataFrame:
    """Per-block parse plan: lines, mode, delimiter, headers, keys, specs and column indexes.  ``files``
    are blocks, or files with their ``text``, which are a block each, with the columns of their schema
    (``order_specs``).
    """
    x = files if "lines" in files.columns else text_blocks(files)
    x = x.withColumnsRenamed({"lines": "_lines", "head": "_head", "first_line": "_first"})
    for stage in _layout_stages() + _header_stages(strict):
        x = x.withColumns(stage)
    return x.drop("_tab", "_csv", "_semi", "_tt", "_ct", "_st", "_cand", "_hit", "_order_h", "order_specs")


def failed_files(layout: DataFrame) -> DataFrame:
    """(file_id, file_error) of files of several blocks of which one failed: as a whole they fail."""
    error = F.coalesce("read_error", "parse_error") if "read_error" in layout.columns else F.col("parse_error")
    return (layout.where(~F.col("whole") & error.isNotNull()).groupBy("file_id")
            .agg(F.min(F.struct(F.col("block"), error.alias("e"))).alias("_f")).select("file_id", F.col("_f.e").alias("file_error")))


def mark_failed(layout: DataFrame, failed: DataFrame, small: bool = False) -> DataFrame:
    """``layout`` with the errors of ``failed`` on every block of their files.  ``small``: the caller has
    counted ``failed`` and it may be broadcast, which keeps the lines where they are."""
    return (layout.join(F.broadcast(failed) if small else failed, "file_id", "left")
            .withColumn("parse_error", F.coalesce("file_error", "parse_error")).drop("file_error"))


def files_of(layout: DataFrame) -> DataFrame:
    """One row per file: its first block, or the row that says why it could not be read."""
    if "read_error" not in layout.columns:
        return layout.where(F.col("block") == 0)
    unread = layout.where(F.col("block") < 0).select("file_id").distinct()
    return (layout.where(F.col("block") == 0).join(unread, "file_id", "left_anti")
            .unionByName(layout.where(F.col("block") < 0).withColumn("parse_error", F.col("read_error"))))


# --- loose lines ----------------------------------------------------------------------

def _loose_entries(line) -> Column:
    """ARRAY<STRUCT<k, v>> of raw (uncoerced) values in line order."""
    pieces = F.filter(F.transform(F.split(line, f"[,{JS_WS_CHARS}]+", -1), lambda p: js_trim(p)),
                      lambda p: (p != "") & p.contains("="))
    kv = F.filter(F.transform(pieces, lambda p: F.struct(
        js_trim(F.substring_index(p, "=", 1)).alias("k"),
        js_trim(F.regexp_extract(p, r"(?s)^[^=]*=(.*)$", 1)).alias("v"))), lambda e: e["k"] != "")
    positional = F.transform(F.split(line, ",", -1), lambda v, i: F.struct(
        F.concat(F.lit("col_"), (i + 1).cast("string")).alias("k"), js_trim(v).alias("v")))
    return F.when(F.size(pieces) > 0, kv).otherwise(positional)


def _loose_ts_raw(raw_map: Column) -> Column:
    """``ts || timestamp`` on coerced values: '' and numeric 0 are falsy."""
    def truthy(k):
        v = coerce_text(F.try_element_at(raw_map, F.lit(k)))
        return F.when((v != "") & ~v.rlike(r"^-?0+(\.0+)?([eE][+-]?\d+)?$"), v)
    return F.coalesce(truthy("ts"), truthy("timestamp"))


# --- per line -------------------------------------------------------------------------

@functools.lru_cache(maxsize=None)
def _line_stages() -> tuple[dict[str, Column], ...]:
    line = F.col("raw_text")
    n = F.size("headers")
    s1 = {"line_no": (F.col("_i") + 1).cast("int"),
          "_c0": F.when(F.col("mode") != "loose", split_by(line, F.col("delim")))}
    # P4 re-detection only for rows that split into a single cell under a multi-column header.
    s1b = {"_alt": F.when((F.size("_c0") <= 1) & (n > 1), split_by(line, data_delimiter(line)))}
    s2 = {"cells": F.when(F.col("mode") != "loose", F.slice(F.concat(
              F.when((F.size("_c0") <= 1) & (n > 1) & (F.size("_alt") > F.size("_c0")), F.col("_alt"))
              .otherwise(F.col("_c0")), F.array_repeat(F.lit(""), n)), 1, n)),
          "_raw_map": F.when(F.col("mode") == "loose", F.map_from_entries(_loose_entries(line)))}

    def at(idx_col: str) -> Column:
        return F.when(F.col(idx_col) >= 0, F.try_element_at(F.col("cells"), F.col(idx_col) + 1))

    s3 = {"_tcell": F.when(F.col("mode") == "loose", coerce_text(F.try_element_at(F.col("_raw_map"), F.lit("col_1"))))
          .otherwise(at("time_idx")),
          "_lts": _loose_ts_raw(F.col("_raw_map"))}
    s4 = {"record_ts": F.when((F.col("mode") == "loose") & F.col("_lts").isNotNull(), F.try_to_timestamp("_lts"))
          .otherwise(parse_utc_time(F.col("_tcell"))),
          "error_flag": F.coalesce(parse_flag(at("err_idx")), F.lit(False)),
          "low_alarm": F.coalesce(parse_flag(at("low_idx")), F.lit(False)),
          "high_alarm": F.coalesce(parse_flag(at("high_idx")), F.lit(False)),
          "parsed": F.when(F.col("mode") == "loose", F.transform_values("_raw_map", lambda k, v: coerce_text(v)))
          .otherwise(F.map_from_arrays("keys", "cells"))}
    return (s1, s1b, s2, s3, s4)


def structure_lines(layout: DataFrame) -> DataFrame:
    """Explode a file layout into one row per record (structured, headerless or loose).

    Files that failed (``parse_error``) explode to nothing, and the data lines are sliced
    from the header onwards before exploding, so no Filter sits above the parse projections:
    Catalyst would push such a filter down and inline the expensive parse expressions into
    it, evaluating them twice."""
    keep = [c for c in layout.columns if c not in ("text", "_lines", "_head")]
    # Lines before the data that fall into this block.
    skip = F.greatest(F.col("start") - F.col("_first"), F.lit(0)).cast("int")
    data = F.when(F.col("parse_error").isNull() & (skip <= F.size("_lines")), F.slice("_lines", skip + 1, F.size("_lines")))
    # posexplode_outer + a filter on the generated column: a plain explode makes Catalyst infer
    # size(array) > 0 and push it (with the array expression inlined) below the projections.
    x = layout.select(*keep, F.posexplode_outer(data).alias("_i", "raw_text")) \
        .where(F.col("_i").isNotNull()).withColumn("_i", F.col("_i") + F.greatest(F.col("start").cast("long"), F.col("_first")))
    for stage in _line_stages():
        x = x.withColumns(stage)
    return x.drop("_i", "_first", "_c0", "_alt", "_tcell", "_lts")


def candidate_readings(lines: DataFrame, gate: Column | None = None) -> DataFrame:
    """one row per numeric, finite, mapped cell (before de-duplication).

    ``gate``: rows for which the melt is skipped entirely (applied inside the exploded array
    rather than as a Filter, for the reason given in ``structure_lines``)."""
    n = F.size("headers")
    structured = F.transform("mapped", lambda m: F.struct(
        m["col_idx"].alias("col_idx"), m["spec"]["metric"].alias("metric_key"),
        coerce_number(F.col("cells")[m["col_idx"]]).alias("metric_value"),
        m["spec"]["unit"].alias("unit"), m["spec"]["source"].alias("source_system"), F.lit(True).alias("_ok")))
    loose = F.transform(F.map_entries(F.coalesce("_raw_map", F.create_map().cast("map<string,string>"))),
                        lambda e, i: F.struct(
                            i.alias("col_idx"), e["key"].alias("metric_key"),
                            coerce_number(e["value"]).alias("metric_value"),
                            F.lit(None).cast("string").alias("unit"), F.lit("unknown").alias("source_system"),
                            (~e["key"].rlike(r"(?i)^col_\d+$")).alias("_ok")))
    cand = F.when(F.col("mode") == "loose", loose).when(n > 0, structured)
    kept = F.filter(cand, lambda c: c["_ok"] & is_finite(c["metric_value"]))
    x = lines.withColumn("_cand", kept if gate is None else F.when(gate, kept))
    x = x.select(*[c for c in x.columns if c not in ("_cand",)], F.explode_outer("_cand").alias("_r")) \
        .where(F.col("_r").isNotNull()).select(
        *[c for c in x.columns if c != "_cand"], "_r.col_idx", "_r.metric_key", "_r.metric_value", "_r.unit",
        "_r.source_system")
    is_loose = F.col("mode") == "loose"
    return (x.withColumn("error_flag", F.when(is_loose, F.lit(False)).otherwise(F.col("error_flag")))
            .withColumn("low_alarm", F.when(is_loose, F.lit(False)).otherwise(F.col("low_alarm")))
            .withColumn("high_alarm", F.when(is_loose, F.lit(False)).otherwise(F.col("high_alarm"))))


def first_wins(readings: DataFrame, key=("source_file_id", "serial", "record_ts", "metric_key"),
               order=("line_no", "col_idx")) -> DataFrame:
    """Keep the first reading per key in (line, column) order (insert-if-absent)."""
    payload = [c for c in readings.columns if c not in key]
    best = F.min_by(F.struct(*payload), F.struct(*order)).alias("_b")
    return readings.groupBy(*key).agg(best).select(*key, "_b.*")

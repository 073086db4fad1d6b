"""Sampling-schedule CSV importers.

Input is a lines DataFrame ``(source_file, line_no, line)`` — produced by ``read_lines`` from
whole files, or by any other job — so the parse itself is a distributed plan:

1. tokenize every line (P5) and flag header candidates;
2. per file, pick the first header line (``min_by`` — a partial aggregate, one row per file);
3. join the header back to the file's lines and map cells by normalised column name.

Zero-length lines are dropped (blank-looking lines with spaces are kept, as the reference's
importers do); a BOM at the start of a file is removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.functions import dates as D
from sluice.functions.text import collapse_ws, js_trim, strip_bom
from sluice.functions.tokenize import split_csv, split_lines

SCHEDULE_COLUMNS = ["ps_code", "group_name", "analyte_number", "analyte_name", "last_sampled",
                    "frequency_months", "next_due_date", "next_due_raw", "notes", "source_file"]


def read_files(spark: SparkSession, paths) -> DataFrame:
    """Whole text files → ``(source_file, text)``; ``source_file`` is the base name (imports
    are keyed by file name)."""
    return spark.read.text(paths, wholetext=True).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("source_file"), F.col("value").alias("text"))


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """Whole text files → ``(source_file, line_no, line)``; 1-based over non-empty lines."""
    return text_to_lines(read_files(spark, paths))


def text_to_lines(files: DataFrame, key: str = "source_file", keep=lambda line: F.length(line) > 0) -> DataFrame:
    """Explode whole texts into kept lines, numbered 1.. over kept lines only.

    The filter runs on the line array inside the row (no shuffle, no window): line numbers
    come straight from ``posexplode``.
    """
    lines = F.filter(split_lines(strip_bom(F.col("text"))), keep)
    return files.select(key, F.posexplode(lines).alias("_i", "line")) \
        .select(key, (F.col("_i") + 1).alias("line_no"), "line")


def norm_header(c) -> Column:
    """S22 normalisation: trim, lower-case, collapse whitespace."""
    return collapse_ws(F.lower(js_trim(c)))


JOIN_SALTS = 32


def _spread(lines: DataFrame, spread: int | None) -> DataFrame:
    # Tokenizing is CPU-bound and a whole file arrives in one task: optionally re-distribute
    # the lines (an explicit partition count, which AQE keeps).
    return lines.repartition(int(spread)) if spread else lines


def join_header(body: DataFrame, heads: DataFrame, salts: int = JOIN_SALTS) -> DataFrame:
    """Attach each file's header row to its lines.

    A single file can hold most of an import's lines, so the join is salted: the header row
    (one per file) is replicated ``salts`` times and every line picks one copy by a hash of its
    line number — a hot file spreads over ``salts`` reducers instead of one (AQE still turns
    the join into a broadcast when the header table is small)."""
    h = heads.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    b = body.withColumn("_salt", F.pmod(F.xxhash64("line_no"), F.lit(salts)).cast("int"))
    return b.join(h, ["source_file", "_salt"]).drop("_salt")


def _first_header(lines: DataFrame, is_header: Column, extra: dict[str, Column] | None = None) -> DataFrame:
    """First header line per file: ``min_by`` over a line number that is NULL for non-header
    lines (such rows are skipped).  No Filter node is used: Catalyst would push it upstream,
    into whatever produced the lines, and evaluate the header test there per line."""
    payload = F.struct(F.col("line_no").alias("h_line"), F.col("cells").alias("h_cells"),
                       *[v.alias(k) for k, v in (extra or {}).items()])
    agg = lines.groupBy("source_file").agg(
        F.min_by(F.when(is_header, payload), F.when(is_header, F.col("line_no"))).alias("h"))
    return agg.where(F.col("h").isNotNull()).select("source_file", "h.*")


def parse_schedule(lines: DataFrame, spread: int | None = None) -> DataFrame:
    """R9: "last and next sample report" rows.

    Header = first line whose normalised cells include ``ps codes`` and ``next due``; files
    without one produce no rows (the import job rejects them).  Only lines
    that mention both words are tokenized for the header search.
    """
    lines = _spread(lines, spread)
    low = F.lower(F.col("line"))
    maybe = low.rlike(r"ps\s+codes") & low.rlike(r"next\s+due")
    cand = lines.withColumn("cells", F.when(maybe, split_csv("line")))
    norm = F.transform("cells", norm_header)
    heads = _first_header(cand, F.coalesce(F.array_contains(norm, "ps codes") & F.array_contains(norm, "next due"),
                                           F.lit(False)))
    tok = lines.withColumn("cells", split_csv("line"))
    # name → index; a repeated name keeps the last index (LAST_WIN map-key policy).
    heads = heads.withColumn(
        "h_idx", F.map_from_arrays(F.transform("h_cells", norm_header),
                                   F.sequence(F.lit(0), F.size("h_cells") - 1)))
    return _schedule_rows(join_header(tok, heads).where(F.col("line_no") > F.col("h_line")))


def parse_schedule_files(files: DataFrame) -> DataFrame:
    """R9 over whole files ``(source_file, text)``: the header is looked up in the file's own array of
    lines, so there is neither an aggregate nor a join.  A file without header gives one row with a
    null ``ps_code`` and ``_no_header`` true."""
    lines = F.filter(split_lines(strip_bom(F.col("text"))), lambda line: F.length(line) > 0)

    def header(line: Column) -> Column:
        low = F.lower(line)
        names = F.transform(split_csv(line), norm_header)
        return (F.when(low.rlike(r"ps\s+codes") & low.rlike(r"next\s+due"),
                       F.array_contains(names, "ps codes") & F.array_contains(names, "next due")).otherwise(F.lit(False)))

    f = files.select("source_file", lines.alias("_lines"))
    f = f.withColumn("_at", F.array_position(F.transform("_lines", header), F.lit(True)).cast("int"))
    names = F.transform(split_csv(F.try_element_at("_lines", F.col("_at"))), norm_header)
    f = f.withColumn("h_idx", F.when(F.col("_at") > 0, F.map_from_arrays(names, F.sequence(F.lit(0), F.size(names) - 1))))
    body = f.select("source_file", "h_idx", F.explode(F.slice("_lines", F.col("_at") + 1, F.size("_lines"))).alias("line"))
    rows = _schedule_rows(body.where(F.col("h_idx").isNotNull()).withColumn("cells", split_csv("line")))
    missing = f.where(F.col("_at") == 0).select("source_file").withColumn("_no_header", F.lit(True))
    return rows.withColumn("_no_header", F.lit(False)).unionByName(missing, allowMissingColumns=True)


def _schedule_rows(body: DataFrame) -> DataFrame:
    """Schedule rows of lines that carry their cells and their file's name → position map."""
    fields = {"ps": "ps codes", "grp": "group name", "anum": "analyte number", "aname": "analyte name",
              "last": "last sampled", "freq": "frequency", "due": "next due", "notes": "notes"}

    def cell(name: str) -> Column:
        i = F.try_element_at(F.col("h_idx"), F.lit(name))
        return F.when(i.isNotNull(), F.try_element_at(F.col("cells"), i + 1))

    # Stage 1: pull each field out once; stage 2: trim once; stage 3: derive.  Named stages
    # keep the expression trees small (planning cost) and evaluate each regex once per row.
    raw = body.select("source_file", *[cell(v).alias(k) for k, v in fields.items()])
    trimmed = raw.select("source_file", *[js_trim(F.col(k)).alias(k) for k in fields])

    def text(k: str) -> Column:
        return F.when(F.col(k) != "", F.col(k))

    rows = trimmed.where(F.col("ps").isNotNull() & (F.col("ps") != ""))
    return rows.select(
        F.col("ps").alias("ps_code"),
        text("grp").alias("group_name"),
        text("anum").alias("analyte_number"),
        text("aname").alias("analyte_name"),
        D.us_date("last").alias("last_sampled"),
        D.frequency_months(F.coalesce("freq", F.lit(""))).alias("frequency_months"),
        D.next_due_date("due").alias("next_due_date"),
        D.next_due_raw("due").alias("next_due_raw"),
        text("notes").alias("notes"),
        "source_file",
        D.frequency_is_invalid(F.coalesce("freq", F.lit(""))).alias("_bad_frequency"),
    )


def is_analyte_header(c) -> Column:
    """Analyte column names."""
    n = norm_header(c)
    return (n == "analyte_name") | (n == "analyte name") | (n == "analyte") | n.contains("analyte") | (n == "metal")


def is_due_header(c) -> Column:
    """Next-due column names."""
    n = norm_header(c)
    return ((n == "next_due_date") | (n == "next due date") | n.contains("next sampling due")
            | (n.contains("due") & (n.contains("next") | n.contains("sampling"))))


def parse_lead_copper(lines: DataFrame, ps_code: str = "DST_LCR", spread: int | None = None) -> DataFrame:
    """lead/copper due list.

    Header = first line (≥ 2 cells) with an analyte column ``a`` and a different due column
    ``b``; the smallest such ``a`` wins, then the smallest ``b``.
    """
    tok, heads = _lead_copper_heads(_spread(lines, spread))
    body = join_header(tok.drop("_ca", "_cd"), heads).where(F.col("line_no") > F.col("h_line"))
    name = js_trim(F.try_element_at(F.col("cells"), F.col("col_a") + 1))
    due_raw = F.coalesce(F.try_element_at(F.col("cells"), F.col("col_d") + 1), F.lit(""))
    parsed = D.due_cell(due_raw)
    return body.where(name.isNotNull() & (name != "")).select(
        F.lit(ps_code).alias("ps_code"),
        F.lit("LEAD_COPPER").alias("group_name"),
        F.lit(None).cast("string").alias("analyte_number"),
        name.alias("analyte_name"),
        F.lit(None).cast("date").alias("last_sampled"),
        F.lit(None).cast("int").alias("frequency_months"),
        parsed["date"].alias("next_due_date"),
        D.next_due_raw(due_raw).alias("next_due_raw"),
        parsed["notes"].alias("notes"),
        "source_file",
    )


def lead_copper_headers(lines: DataFrame) -> DataFrame:
    """Header row per file of R10; files without one have no row."""
    return _lead_copper_heads(lines)[1]


def _lead_copper_heads(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(tokenized lines, header row per file) of R10."""
    tok = lines.withColumn("cells", split_csv("line"))
    flags = F.transform("cells", lambda c: F.struct(is_analyte_header(c).alias("a"), is_due_header(c).alias("d")))
    idx = F.sequence(F.lit(0), F.size("cells") - 1)
    # analyte candidates that have a due column at another position
    due_pos = F.filter(idx, lambda j: flags[j]["d"])
    a_pos = F.filter(idx, lambda i: flags[i]["a"]
                     & (F.size(F.filter(due_pos, lambda j: j != i)) > 0))
    col_a = F.array_min(a_pos)
    col_d = F.array_min(F.filter(due_pos, lambda j: j != col_a))
    tok = tok.withColumn("_ca", F.when(F.size("cells") >= 2, col_a)).withColumn("_cd", col_d)
    heads = _first_header(tok, F.col("_ca").isNotNull(), {"col_a": F.col("_ca"), "col_d": F.col("_cd")})
    return tok, heads

"""Device column header → metric spec.

``column_spec`` maps a header such as ``"F2 - Wyman Creek Flow Ave (Gpm)"`` to
``struct(source, metric, unit)`` (here ``hydro_plant``, ``flow_wyman_avg``, ``Gpm``).  It is
evaluated per file (once per header), never per data row.  The rule tables below are the
reference's own vocabulary and order; the order matters (first match wins), including its
quirks — unanchored phase hints make "Solar Array" end in ``_A`` and "Flow Ave" in
``flow_avg_A``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from sluice.functions.text import JS_WS, col_of, js_trim, let

# ---- Fixed values (must equal the reference's tables, in their order) -------------------

RESERVED_HEADERS = ["time(UTC)", "error", "lowalarm", "highalarm"]

# Export typos → corrected token (applied in this order, every occurrence).
TYPO_CORRECTIONS = [
    ("pwer", "power"),
    ("curent", "current"),
    ("voltge", "voltage"),
    ("frequncy", "frequency"),
    ("enrgy", "energy"),
    ("dmand", "demand"),
    ("aparant", "apparent"),
    ("reactve", "reactive"),
    ("postive", "positive"),
    ("negtive", "negative"),
    ("sumation", "sum"),
    ("avrage", "average"),
    ("instntaneous", "instantaneous"),
    ("facotr", "factor"),
    ("hydo", "hydro"),
]

# End-anchored suffix patterns on the normalised source → metric tail.  Each pattern holds its tail's last
# word, without which it is not tried.
METRIC_SUFFIX_RULES = [
    (r"\bave\s*rate\b$", "avg_rate"),
    (r"\bavg\s*rate\b$", "avg_rate"),
    (r"\brate\b$", "rate"),
    (r"\binstantaneous\b$", "instantaneous"),
    (r"\bdemand\b$", "demand"),
    (r"\bave\b$", "avg"),
    (r"\bavg\b$", "avg"),
    (r"\baverage\b$", "avg"),
    (r"\bmin\b$", "min"),
    (r"\bmax\b$", "max"),
    (r"\btotal\b$", "total"),
    (r"\bcount\b$", "count"),
    (r"\blevel\b$", "level"),
    (r"\bstatus\b$", "status"),
]

AGG_LABELS = ["avg", "min", "max", "rate", "avg_rate", "instantaneous", "demand"]

# Substring → phase suffix (first contained substring wins).
PHASE_HINTS = [
    (" a-b", "AB"),
    (" b-c", "BC"),
    (" a-c", "AC"),
    ("-a", "A"),
    ("-b", "B"),
    ("-c", "C"),
    (" a", "A"),
    (" b", "B"),
    (" c", "C"),
    (" sum", "sum"),
    (" total", "sum"),
    (" ave", "avg"),
    (" average", "avg"),
]

# Substring → source system (first contained substring wins).
SOURCE_SYSTEM_HINTS = [
    ("flow rate c", "hydro_plant"),
    ("flow-rate-c", "hydro_plant"),
    ("flow rate a", "booster_pump"),
    ("flow-rate-a", "booster_pump"),
    ("wyman creek", "hydro_plant"),
    ("reservoir by-pass", "hydro_plant"),
    ("bypass", "hydro_plant"),
    ("deep well pump", "deep_well"),
    ("booster pump", "booster_pump"),
    ("sce", "electrical_grid"),
    ("net meter", "electrical_grid"),
    ("hydro", "hydro_plant"),
    ("solar", "solar_field"),
    ("modhopper", "modhopper_status"),
]

MEASURABLE_WORDS = ["pulse", "power", "flow", "pressure", "energy"]

# ---------------------------------------------------------------------------------------

_UNIT_RE = rf"\(([^()]*)\){JS_WS}*$"


def _replace_first(c: Column, old: str, new: str) -> Column:
    # JavaScript String.replace with a string pattern replaces the first occurrence only.
    return let(c, lambda x: F.when(x.contains(old), F.regexp_replace(x, "(?s)^(.*?)" + _quote(old), "$1" + new.replace("$", r"\$")))
               .otherwise(x))


def _quote(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\/" else ch for ch in s)


def split_unit(header) -> tuple[Column, Column]:
    """``(base, unit)`` — unit from a trailing ``(…)`` without nested parentheses."""
    clean = js_trim(header)
    has = clean.rlike(_UNIT_RE)
    unit = js_trim(F.regexp_extract(clean, _UNIT_RE, 1))
    unit = _replace_first(_replace_first(unit, "per minute", "/min"), "per hour", "/hr")
    base = js_trim(F.regexp_replace(clean, _UNIT_RE, ""))
    return F.when(has, base).otherwise(clean), F.when(has, unit)


def canonicalize(base, aliases: Column | None = None) -> Column:
    """Alias lookup by lower-cased base (``aliases``: MAP<STRING,STRING>)."""
    b = js_trim(base)
    if aliases is None:
        return b
    mapped = F.try_element_at(aliases, F.lower(b))
    return F.when(mapped.isNotNull() & (mapped != ""), mapped).otherwise(b)


def normalize_source(c) -> Column:
    """Lower-case, trim, collapse whitespace, then the typo corrections in order."""
    s = F.regexp_replace(js_trim(F.lower(col_of(c))), f"{JS_WS}+", " ")
    for wrong, right in TYPO_CORRECTIONS:
        s = F.replace(s, F.lit(wrong), F.lit(right))
    return s


def _first_rule(s: Column):
    """Index-free view of the suffix rules: (matches?, label) of the first matching rule."""
    label = None
    for pat, lab in METRIC_SUFFIX_RULES:
        hit = s.contains(re.findall("[a-z]+", re.sub(r"\\[bs]", " ", pat))[-1]) & s.rlike(pat)
        label = F.when(hit, lab) if label is None else label.when(hit, lab)
    return label


def infer_quantity(source, unit) -> Column:
    """Pressure | flow | power | energy | pulse (first match), else NULL."""
    s = F.lower(F.coalesce(col_of(source), F.lit("")))
    u = F.lower(F.coalesce(col_of(unit), F.lit("")))
    return (F.when(s.contains("pressure") | u.contains("psi"), "pressure")
            .when(s.contains("flow") | u.contains("gpm"), "flow")
            .when(s.contains("power") | (u == "kw"), "power")
            .when(s.contains("energy") | (u == "kwh"), "energy")
            .when(s.contains("pulse"), "pulse"))


def detect_phase(source) -> Column:
    """First phase hint contained in the source."""
    s = col_of(source)
    out = None
    for hint, ph in PHASE_HINTS:
        out = F.when(s.contains(hint), ph) if out is None else out.when(s.contains(hint), ph)
    return out


def infer_system(source) -> Column:
    """First system hint contained in the source, else ``unknown``."""
    s = col_of(source)
    out = None
    for hint, sysname in SOURCE_SYSTEM_HINTS:
        out = F.when(s.contains(hint), sysname) if out is None else out.when(s.contains(hint), sysname)
    return out.otherwise("unknown")


def _is_gpm(unit) -> Column:
    return F.lower(F.coalesce(col_of(unit), F.lit(""))).contains("gpm")


def is_measurable(header) -> Column:
    """Header mentions pulse / power / flow / pressure / energy."""
    h = F.lower(F.coalesce(col_of(header), F.lit("")))
    cond = F.lit(False)
    for w in MEASURABLE_WORDS:
        cond = cond | h.contains(w)
    return cond


def column_specs(headers, aliases: Column | None = None, expected: Column | None = None,
                 strict: bool = False) -> Column:
    """S13 over an ARRAY of headers → ARRAY<STRUCT<source, metric, unit>> (NULL entries for
    empty, ``-``, reserved or not-allowed headers).

    Evaluated in successive ``transform`` stages so that every intermediate (trimmed header,
    unit, base, canonical name, normalised source, suffix label, quantity) is computed once
    and later stages only read struct fields: lambdas get no common-subexpression elimination,
    so re-deriving an intermediate in each rule would multiply the work.
    """
    st = F.transform(headers, lambda h: F.struct(js_trim(h).alias("clean")))
    # Empty, "-" and reserved headers never get a spec: they skip every rule below.
    st = F.transform(st, lambda x: F.struct(
        x["clean"].alias("clean"),
        (x["clean"].isNull() | (x["clean"] == "") | (x["clean"] == "-") | x["clean"].isin(RESERVED_HEADERS))
        .alias("skip")))
    st = F.transform(st, lambda x: F.when(~x["skip"], F.struct(
        x["clean"].alias("clean"), x["clean"].rlike(_UNIT_RE).alias("has_unit"),
        F.regexp_extract(x["clean"], _UNIT_RE, 1).alias("u0"),
        js_trim(F.regexp_replace(x["clean"], _UNIT_RE, "")).alias("b0"))))
    st = F.transform(st, lambda x: F.when(x.isNotNull(), F.struct(
        x["clean"].alias("clean"),
        F.when(x["has_unit"], _replace_first(_replace_first(js_trim(x["u0"]), "per minute", "/min"),
                                             "per hour", "/hr")).alias("unit"),
        F.when(x["has_unit"], x["b0"]).otherwise(x["clean"]).alias("base"))))
    if aliases is not None:
        st = F.transform(st, lambda x: F.when(x.isNotNull(), F.struct(
            x["clean"].alias("clean"), x["unit"].alias("unit"),
            F.try_element_at(aliases, F.lower(x["base"])).alias("mapped"), x["base"].alias("base"))))
        st = F.transform(st, lambda x: F.when(x.isNotNull(), F.struct(
            x["clean"].alias("clean"), x["unit"].alias("unit"),
            F.when(x["mapped"].isNotNull() & (x["mapped"] != ""), x["mapped"]).otherwise(x["base"])
            .alias("canonical"))))
    else:
        st = F.transform(st, lambda x: F.when(x.isNotNull(), F.struct(
            x["clean"].alias("clean"), x["unit"].alias("unit"), x["base"].alias("canonical"))))
    st = F.transform(st, lambda x: F.when(x.isNotNull(), F.struct(
        x["clean"].alias("clean"), x["unit"].alias("unit"), x["canonical"].alias("canonical"),
        normalize_source(x["canonical"]).alias("source"))))
    st = F.transform(st, lambda x: F.when(x.isNotNull(), F.struct(
        x["clean"].alias("clean"), x["unit"].alias("unit"), x["canonical"].alias("canonical"),
        x["source"].alias("source"), _first_rule(x["source"]).alias("label"),
        infer_quantity(x["source"], x["unit"]).alias("q"), _is_gpm(x["unit"]).alias("gpm"),
        detect_phase(x["source"]).alias("phase"), infer_system(x["source"]).alias("system"))))

    def spec(x):
        s, label, q, gpm, phase = x["source"], x["label"], x["q"], x["gpm"], x["phase"]
        agg = F.when(label.isin(AGG_LABELS), label)
        wyman = s.contains("wyman") & s.contains("creek")
        bypass_word = s.contains("by-pass") | s.contains("bypass")
        bypass = (s.contains("f-1") & bypass_word) | (s.contains("reservoir") & bypass_word)
        named = (F.when(wyman & agg.isNotNull(), F.concat(F.lit("flow_wyman_"), agg))
                 .when(wyman & gpm, F.lit("flow_wyman"))
                 .when(wyman, F.lit(None))
                 .when(bypass & agg.isNotNull(), F.concat(F.lit("flow_bypass_"), agg))
                 .when(bypass & gpm, F.lit("flow_bypass")))
        stream = F.when(s.contains("flow") | gpm, named)
        with_label = F.when(q.isNotNull() & label.isin(AGG_LABELS), F.concat(q, F.lit("_"), label)).otherwise(label)
        no_label = F.when(q == "pulse", "pulse_total").otherwise(F.coalesce(q, F.lit("value")))
        metric = F.when(label.isNotNull(), with_label).otherwise(no_label)
        metric = F.when(phase.isNotNull(), F.concat(metric, F.lit("_"), phase)).otherwise(metric)
        out = F.struct(x["system"].alias("source"), F.coalesce(stream, metric).alias("metric"),
                       x["unit"].alias("unit"))
        skip = x.isNull()
        if strict and expected is not None:
            # A schema without an allow-list, or that is not in the schema table, allows every header.
            listed = F.coalesce(expected, F.array().cast("array<string>"))
            skip = skip | ((F.size(listed) > 0) & ~F.array_contains(listed, x["canonical"]))
        return F.when(~skip, out)

    return F.transform(st, spec)


def column_spec(header, aliases: Column | None = None, expected: Column | None = None,
                strict: bool = False) -> Column:
    """S13 for one header: ``struct(source, metric, unit)`` or NULL."""
    return F.element_at(column_specs(F.array(col_of(header)), aliases, expected, strict), 1)

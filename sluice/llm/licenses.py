"""Licence scan: Dice coefficient over word bigrams against licence templates (DataFrame functions only).

Every line of a text, and the text as a whole, is normalised (lower-cased, ASCII punctuation to
spaces) and turned into its set of word bigrams.  With sizes a and b, Dice = 2|A n B| / (a + b) can
reach t only if a lies between b*t/(2-t) and b*(2-t)/t, so only templates of a fitting size are
compared.  The scan is one pass over the rows without any shuffle; templates are a fixed, small list
that travels in the plan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.75

# Wording of well-known public licence notices.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
            "following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted "
                     "provided that the following conditions are met:"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work."),
]

# After lower-casing: every ASCII character that is neither a letter nor a digit separates words.
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), _SEPARATORS), lambda w: w != "")


def bigrams(w: Column) -> Column:
    """Distinct bigrams of an array of words, joined by a space."""
    n = F.greatest(F.size(w) - 1, F.lit(0))
    return F.array_distinct(F.zip_with(F.slice(w, F.lit(1), n), F.slice(w, F.lit(2), n), lambda a, b: F.concat(a, F.lit(" "), b)))


def _template_bigrams(text: str) -> list[str]:
    words = [w for w in re.split(_SEPARATORS, text.translate({c: c + 32 for c in range(65, 91)})) if w]
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:])})


def scan(docs: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """One row per licence found: doc_id, line_no (0: the text as a whole, for texts of several
    lines), license, dice (the best of that licence's templates) and n_bigrams.

    Null and empty texts and units of fewer than two words give no rows.  Rows with a null or
    repeated doc_id are scanned like any other, one by one.  Ties between licences give a row each.
    An empty table gives an empty result; other columns are ignored.
    """
    grams = [(name, g) for name, text in templates if (g := _template_bigrams(text))]
    sizes = [len(g) for _, g in grams]
    low, high = min(sizes) * threshold / (2 - threshold), max(sizes) * (2 - threshold) / threshold
    lines = F.split("text", "\n")
    by_line = F.transform(lines, lambda x, i: F.struct((i + 1).alias("line_no"), words(x).alias("w")))
    # The text as a whole has its lines' words in a row; a lambda names the lines, so they are split once.
    whole = lambda us: F.array(F.struct(F.lit(0).alias("line_no"), F.flatten(F.transform(us, lambda u: u["w"])).alias("w")))
    units = F.element_at(F.transform(F.array(by_line), lambda us: F.concat(us, F.when(F.size(us) > 1, whole(us)).otherwise(F.array()))), 1)
    # All in one generator, so that no filter is pushed below it and no step is computed twice.  A set
    # of bigrams is no larger than the number of words less one, and no smaller than that of distinct words.
    units = F.filter(units, lambda u: (F.size(u["w"]) > F.lit(low)) & ((F.size(u["w"]) - 1 <= F.lit(high)) | (F.size(F.array_distinct(u["w"])) - 1 <= F.lit(high))))
    units = F.transform(units, lambda u: F.struct(u["line_no"].alias("line_no"), bigrams(u["w"]).alias("grams")))
    units = F.filter(units, lambda u: F.size(u["grams"]).between(F.lit(low), F.lit(high)))
    sets = (docs.filter(F.col("text").isNotNull()).select("doc_id", F.explode(units).alias("u"))
            .select("doc_id", "u.line_no", "u.grams", F.size("u.grams").alias("n")))
    by_name: dict[str, list[list[str]]] = {}
    for name, g in grams:
        by_name.setdefault(name, []).append(g)

    def dice(g: list[str]) -> Column:
        lo, hi = len(g) * threshold / (2 - threshold), len(g) * (2 - threshold) / threshold
        shared = F.size(F.array_intersect("grams", F.array(*[F.lit(x) for x in g])))
        return F.when((F.col("n") >= F.lit(lo)) & (F.col("n") <= F.lit(hi)), shared * F.lit(2.0) / (F.col("n") + F.lit(len(g)))).otherwise(F.lit(0.0))

    scores = F.array(*[F.struct(F.lit(name).alias("license"), (F.greatest(*map(dice, gs)) if len(gs) > 1 else dice(gs[0])).alias("dice"))
                       for name, gs in by_name.items()])
    return (sets.select("doc_id", "line_no", "n", F.explode(F.filter(scores, lambda s: s["dice"] >= threshold)).alias("s"))
            .select("doc_id", F.col("line_no").cast("long"), "s.license", "s.dice", F.col("n").cast("long").alias("n_bigrams")))

"""Licence scan by TF-IDF cosine, with inheritance along directories.

Templates and lines of text are sparse vectors of damped word counts (1 + ln) times inverse document
frequency over the templates; a word of no template has the highest weight.  A line
whose cosine with a template reaches ``THRESHOLD`` carries that licence.  Only lines
with an anchor word can: for every template the heaviest words are anchors until the
rest of its vector is too short to reach the threshold, so the filter loses nothing.
Before words are exploded a line is also dropped where the known words cannot make up
enough of its length, a bound from above that loses nothing either.
Equal lines are scored once, however many files hold them, each within its own row: its
words are put in order, so that equal ones stand together, and no row is made of a word.

A licence line that speaks for its directory (in a licence file, or as the caller says)
is inherited by files without one of their own from the nearest directory above.
Directories, not files, meet their ancestors, so a file joins only its own directory.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cloakwork.llm.common import guarded, register, table
from cloakwork.session import materialize

THRESHOLD = 0.6
WORD = "[a-z0-9]+"

# fixed values: public licence notices, one line each, by SPDX identifier
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version"),
    ("LGPL-3.0", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License version 3"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
]
# fixed values: function words of several languages and digits, poor anchors
COMMON = frozenset(
    "a all and any are as at be by can for from in is it its no not of on only or such that the then there this to under use was were with without you mit des 0 1 2 3 4".split()
)
LICENCE_FILE = r"(?i)(^|/)(licen[cs]e|copying|notice|unlicense)(\.[a-z]+)?$"


def model(templates: list[tuple[str, str]]) -> tuple[dict[str, float], float, list[dict[str, float]]]:
    """Inverse document frequencies, the weight of an unknown word, and the unit vectors of the templates."""
    bags = [Counter(re.findall(WORD, t.lower())) for _, t in templates]
    df = Counter(w for b in bags for w in b)
    idf = {w: math.log((1 + len(bags)) / (1 + n)) + 1 for w, n in df.items()}
    vectors = []
    for b in bags:
        raw = {w: (1 + math.log(n)) * idf[w] for w, n in b.items()}
        norm = math.sqrt(sum(v * v for v in raw.values()))
        vectors.append({w: v / norm for w, v in raw.items()})
    return idf, math.log(1 + len(bags)) + 1, vectors


def anchors(vectors: list[dict[str, float]], threshold: float) -> list[str]:
    """Words of which every line that can reach the threshold has one; common words only where the others do not do."""
    out: set[str] = set()
    for v in vectors:
        rest = sum(x * x for w, x in v.items() if w not in out)
        for w, x in sorted(v.items(), key=lambda p: (p[0] in COMMON, -p[1], p[0])):
            if rest < (threshold * 0.999) ** 2:
                break
            if w not in out:
                out.add(w)
                rest -= x * x
    return sorted(out)


def reachable(line: str, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> Column:
    """False only for lines below the threshold: their words of no template alone leave too little for the others.

    The words of the templates have few different weights, so how many of each weight a
    line has is a handful of set intersections, whatever its length.  No word comes
    more often than all repetitions of the line together, which bounds its damped count.
    """
    idf, unknown, _ = model(templates)
    levels = [(v, F.array(*[F.lit(w) for w, x in sorted(idf.items()) if x == v])) for v in sorted(set(idf.values()))]

    def bound(words, kinds):
        held = [(v, F.size(F.array_intersect(kinds, listed))) for v, listed in levels]
        squares = sum((n * F.lit(v * v) for v, n in held), F.lit(0.0))
        inside = squares * F.pow(1 + F.ln(F.size(words) - F.size(kinds) + 1), F.lit(2.0))
        outside = (F.size(kinds) - sum((n for _, n in held), F.lit(0))) * F.lit(unknown**2)  # a word that comes more than once weighs more
        return inside >= (threshold * 0.999) ** 2 * (inside + outside)

    # one-element arrays name the words and their set, so neither is worked out again for every weight
    words = F.array(F.regexp_extract_all(F.lower(line), F.lit(WORD), F.lit(0)))
    return F.get(F.transform(words, lambda w: F.get(F.transform(F.array(F.array_distinct(w)), lambda d: bound(w, d)), F.lit(0))), F.lit(0))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often an expression inside names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def score(lines: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """(line, licence, cosine) of the distinct lines that reach the threshold; ties go to the earlier template."""
    idf, unknown, vectors = model(templates)
    vocabulary = sorted(idf)
    listed = lambda rows: F.expr("map(" + ", ".join(f"'{w}', {v}" for w, v in rows) + ")")
    weigh = listed((w, f"{idf[w]!r}D") for w in vocabulary)
    # a word's unit weights in all templates
    weights = listed((w, "array(" + ", ".join(f"{v.get(w, 0.0)!r}D" for v in vectors) + ")") for w in vocabulary)
    words = F.sort_array(F.regexp_extract_all(F.lower("line"), F.lit(WORD), F.lit(0)))

    # equal words stand together: a word begins where it differs from the one before and ends where the next begins
    def bag(w):
        return _bound(F.filter(F.sequence(F.lit(0), F.greatest(F.size(w) - 1, F.lit(0))), lambda i: (i == 0) | (F.get(w, i) != F.get(w, i - 1))), lambda first: runs(w, first))

    def runs(w, first):
        ends = F.concat(F.slice(first, F.lit(2), F.size(first)), F.array(F.size(w)))
        return F.zip_with(first, ends, lambda a, b: F.struct(F.get(w, a).alias("word"), (1 + F.ln(b - a)).alias("tf")))

    # everything about a line is worked out in its row
    each = lines.select("line", _bound(words, bag).alias("bag"))
    known = F.filter("bag", lambda r: r["word"].isin(vocabulary))
    known = F.transform(known, lambda r: F.struct(r["word"].alias("word"), (r["tf"] * F.element_at(weigh, r["word"])).alias("y")))
    strange = F.filter("bag", lambda r: ~r["word"].isin(vocabulary))
    squares = F.aggregate(strange, F.lit(0.0), lambda a, r: a + r["tf"] * F.lit(unknown) * r["tf"] * F.lit(unknown))
    each = each.select("line", known.alias("known"), squares.alias("strange"))
    norm = F.sqrt(F.aggregate("known", F.col("strange"), lambda a, r: a + r["y"] * r["y"]))
    zeros = F.array(*[F.lit(0.0)] * len(vectors))
    dots = F.aggregate("known", zeros, lambda a, r: F.zip_with(a, F.element_at(weights, r["word"]), lambda d, x: d + x * r["y"]))
    near = each.select("line", norm.alias("norm"), F.posexplode(dots).alias("k", "dot"))
    near = near.withColumn("cosine", F.round(F.col("dot") / F.col("norm"), 9)).filter(F.col("cosine") >= threshold)
    best = near.groupBy("line").agg(F.max(F.struct("cosine", (-F.col("k")).alias("k"))).alias("b"))
    names = F.expr("array(" + ",".join(f"'{n}'" for n, _ in templates) + ")")
    return best.select("line", F.element_at(names, (1 - F.col("b.k")).cast("int")).alias("licence"), F.col("b.cosine").alias("cosine"))


def parent(path: Column) -> Column:
    """The directory of a path; '' for one without a slash."""
    return F.regexp_extract(path, r"(?s)^(.*)/", 1)


def scan(files: DataFrame, path: str = "path", text: str = "text", speaks: Column | None = None) -> DataFrame:
    """(path, licence, cosine, origin, directory), one row per distinct path.

    ``origin`` is 'own', 'inherited' or null.  ``speaks`` says on the columns path and
    number (of the line, from 0) whether a licence line stands for its directory; by
    default in files named like a licence.  Of several licences the highest cosine
    wins, in a directory the most frequent one, then the first by name.  A null path is
    ''; null and empty texts carry no licence; rows of equal path are one file.
    """
    _, _, vectors = model(TEMPLATES)
    words = "|".join(anchors(vectors, THRESHOLD))
    may = rf"(?i)(^|[^a-z0-9])({words})([^a-z0-9]|$)"
    speaks = F.regexp_like("path", F.lit(LICENCE_FILE)) if speaks is None else speaks
    rows = files.select(F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.col(text).alias("text"))
    cand = rows.filter(F.regexp_like("text", F.lit(may))).select("path", F.posexplode(F.split("text", "\n")).alias("number", "line"))
    cand = materialize(cand.filter(F.regexp_like("line", F.lit(may))).filter(reachable("line")))
    scored = materialize(score(cand.select("line").distinct()))
    held = materialize(cand.join(guarded(scored, scored.count()), "line"))
    own = held.groupBy("path").agg(F.max(F.struct("cosine", "licence")).alias("o"))
    said = held.filter(speaks).groupBy(parent(F.col("path")).alias("ancestor"), "licence").agg(F.count(F.lit(1)).alias("n"))
    said = said.groupBy("ancestor").agg(F.min(F.struct((-F.col("n")).alias("n"), "licence")).alias("d"))
    paths = rows.select("path").distinct().withColumn("directory", parent(F.col("path")))
    directories = paths.select("directory").distinct()
    steps = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(steps)), lambda i: F.array_join(F.slice(steps, F.lit(1), i), "/"))
    above = F.array_distinct(F.concat(F.array(F.lit("")), above))
    met = directories.withColumn("ancestor", F.explode(above)).join(said, "ancestor")
    near = met.groupBy("directory").agg(F.max(F.struct(F.length("ancestor").alias("depth"), "ancestor", F.col("d.licence").alias("licence"))).alias("i"))
    df = paths.join(own, "path", "left").join(near, "directory", "left")
    return df.select(
        "path",
        F.coalesce("o.licence", "i.licence").alias("licence"),
        F.col("o.cosine").alias("cosine"),
        F.when(F.col("o").isNotNull(), "own").when(F.col("i").isNotNull(), "inherited").alias("origin"),
        F.when(F.col("o").isNull(), F.col("i.ancestor")).alias("directory"),
    )


@register("op8_licence_cosine")
def query(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as files of a tree source/language/thousand/hundred; one that opens with a licence speaks for its directory."""
    return tree_scan(table(spark, folder, "documents"))


def tree_scan(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, lang, source), as files of a tree named after these.

    The name of a file has its text's hash beside the key, so rows of one key and other
    texts are files of their own; a null key is the name 'null', other nulls are empty
    names.  An empty table gives no rows.
    """
    steps = [F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")), F.floor(F.col("doc_id") / 1000), F.floor(F.col("doc_id") / 100)]
    name = F.concat_ws("~", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(F.xxhash64(F.coalesce("text", F.lit("")))))
    path = F.concat_ws("/", *[F.coalesce(s.cast("string"), F.lit("null")) for s in steps], name)
    files = docs.select("doc_id", path.alias("path"), "text")
    found = scan(files, speaks=F.col("number") == 0)
    return files.select("doc_id", "path").join(found, "path").select("doc_id", "path", "licence", "cosine", "origin", "directory")

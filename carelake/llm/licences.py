"""Licence scan: lines, paragraphs, whole texts and word windows against licence templates.

The measure is Dice's coefficient over bags of word bigrams, 2 * shared / (own + template).
A coefficient of at least t needs own >= template * t / (2 - t) and own <= template * (2 - t) / t;
units whose number of words fits no template are dropped before any bigram is made.  Such a
match lacks at most a share (2 - 2t) / (2 - t) of the template's bigrams, so of one bigram more
than that it holds one: texts without a word of these anchors are dropped first.

A window has as many bigrams as the template.  An occurrence of a template's bigram counts in the windows
that hold it but not the occurrence so many places earlier as the template has of that bigram,
which is an interval of starts; a running sum over the ends of the intervals is what the
windows share with the template, all starts included.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from carelake.llm.common import materialize, text_or_empty

#: Words that make poor anchors; any choice of anchors gives the same rows.
_COMMON = set("a an and any are as at be but by for from has have if in is it its may must no not of on or other shall such that the their them they this to under was which will with work you your".split())

#: Short public licence notices and grants, by SPDX name.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
]

#: Notices of siblings and other versions, which ``known_templates`` adds.
NOTICES = [
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at"),
    ("MPL-2.0", "Licensed under the Mozilla Public License, Version 2.0."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("ISC", "Licensed under the ISC License."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
]


def known_templates() -> list[tuple[str, str]]:
    """TEMPLATES, NOTICES and the whole texts beside this module, by SPDX name; read on the driver."""
    texts = sorted((Path(__file__).parent / "licence_texts").glob("*.txt"))
    # both BSD licences begin with the same words
    notices = [("BSD-2-Clause OR BSD-3-Clause" if t.startswith("Redistribution and use") else n, t) for n, t in TEMPLATES + NOTICES]
    return notices + [(p.stem, p.read_text()) for p in texts]


_BLANK = r"\n[ \n]*\n"


def _bigrams(words):
    rest = F.size(words) - 1
    return F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.concat_ws(" ", a, b))


def _cleaned(text):
    """Lower case; anything but letters, digits and line ends becomes one space."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def _words(clean):
    return F.split(F.trim(F.regexp_replace(clean, r"\s+", " ")), " ")


def _anchors(counts: list, dice: float) -> list[str]:
    """Words of which every unit or window that matches a template holds one; from (template, n, bigram) rows."""
    rarity = lambda w: (w in _COMMON, -len(w), w)
    of: dict[int, list] = {}
    for r in counts:
        of.setdefault(r.template, []).append((min(r.bigram.split(" "), key=rarity), r.n))
    words = set()
    for own in of.values():
        missing = own[0][1] * (2 - 2 * dice) / (2 - dice)
        words |= {w for w, _ in sorted(own, key=lambda x: rarity(x[0]))[: int(missing + 1e-9) + 1]}
    return sorted(words)


def _windows(texts: DataFrame, counts: DataFrame, dice: float) -> DataFrame:
    """(row, key, licence, unit, n, dice) of windows of a template's size; of overlapping ones that which shares most."""
    words = texts.withColumn("words", _words(F.col("clean"))).withColumn("own", F.size("words") - 1).filter("own > 0")
    hits = words.select("row", "key", "own", F.posexplode(_bigrams(F.col("words"))).alias("p", "bigram"))
    hits = hits.join(F.broadcast(counts), "bigram").filter("own >= n")  # templates: a given list
    by = ["row", "key", "own", "template", "licence", "n"]
    hits = hits.groupBy(*by, "there", "bigram").agg(F.sort_array(F.collect_list("p")).alias("ps"))
    need = F.ceil(F.col("n") * dice - 1e-9)
    pair = Window.partitionBy("row", "template")
    hits = hits.withColumn("most", F.sum(F.least(F.size("ps"), F.col("there").cast("int"))).over(pair)).filter(F.col("most") >= need)

    def starts(p, i):
        earlier = F.when(i >= F.col("there"), F.get("ps", (i - F.col("there")).cast("int")) + 1).otherwise(0)
        return F.struct(F.greatest(earlier, p - F.col("n") + 1, F.lit(0)).alias("lo"), F.least(p, F.col("own") - F.col("n")).alias("hi"))

    spans = hits.select(*by, F.explode(F.transform("ps", starts)).alias("x")).filter("x.lo <= x.hi")
    ends = F.array(F.struct(F.col("x.lo").alias("start"), F.lit(1).alias("d")), F.struct((F.col("x.hi") + 1).alias("start"), F.lit(-1).alias("d")))
    steps = spans.select(*by, F.explode(ends).alias("e")).groupBy(*by, "e.start").agg(F.sum("e.d").alias("d"))
    steps = steps.withColumn("shared", F.sum("d").over(pair.orderBy("start").rowsBetween(Window.unboundedPreceding, 0))).filter(F.col("shared") >= need)
    along = F.sort_array(F.collect_list(F.struct("start", "shared")))
    one = "named_struct('start', x.start, 'shared', x.shared)"
    # along the text: a better window replaces the last one it overlaps, one behind it is another
    chosen = F.expr(
        f"""aggregate(along, slice(along, 1, 1), (a, x) -> CASE
          WHEN x.start > element_at(a, -1).start + n THEN concat(a, array({one}))
          WHEN x.shared > element_at(a, -1).shared THEN concat(slice(a, 1, size(a) - 1), array({one})) ELSE a END)"""
    )
    found = steps.groupBy(*by).agg(along.alias("along")).withColumn("x", F.explode(chosen))
    found = found.select("row", "key", F.struct((-F.col("x.shared")).alias("fewer"), F.col("n").cast("int").alias("n"), F.col("x.start").cast("int").alias("start"), "licence").alias("w"))
    # of several templates: the one that shares most first, each window that overlaps none before it
    of_row = found.groupBy("row", "key").agg(F.sort_array(F.collect_list("w")).alias("ws"))
    kept = F.expr(
        """aggregate(ws, slice(ws, 1, 0), (a, x) ->
          IF(exists(a, y -> x.start <= y.start + y.n AND y.start <= x.start + x.n), a, concat(a, array(x))))"""
    )
    return of_row.select("row", "key", F.explode(kept).alias("w")).select(
        "row", "key", "w.licence", F.col("w.start").alias("unit"), "w.n", (-F.col("w.fewer") / F.col("w.n")).alias("dice")
    )


def _beside(windows: DataFrame, units: DataFrame, texts: DataFrame, same: list[str]) -> DataFrame:
    """The windows in no unit's words that matched as long a template; units have row, scope, unit, n and the columns ``same``."""

    def ends(parts):
        sizes = F.transform(parts, lambda x: F.size(F.filter(F.split(x, r"\s+"), lambda w: w != "")))
        return F.aggregate(sizes, F.array().cast("array<int>"), lambda a, x: F.concat(a, F.array(x + F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(0)))))

    rows = texts.join(windows.select("row").distinct(), "row", "left_semi")
    rows = rows.select("row", ends(F.split("clean", "\n")).alias("line"), ends(F.split("clean", _BLANK)).alias("paragraph"))
    at = lambda scope, word: F.size(F.filter(F.col(scope), lambda e: e <= word))
    last = F.col("unit") + F.col("n")
    placed = windows.join(rows, "row")
    for scope in ("line", "paragraph"):
        placed = placed.withColumn(f"{scope}_0", at(scope, F.col("unit"))).withColumn(f"{scope}_1", at(scope, last))
    w, u = placed.drop("line", "paragraph").alias("w"), units.alias("u")
    within = F.col("u.scope") == "document"
    for scope in ("line", "paragraph"):
        within |= (F.col("u.scope") == scope) & F.col("u.unit").between(F.col(f"w.{scope}_0"), F.col(f"w.{scope}_1"))
    cond = within & (F.col("u.n") >= F.col("w.n"))
    for c in ["row", *same]:
        cond = (F.col(f"w.{c}") == F.col(f"u.{c}")) & cond
    return w.join(u, cond, "left_anti")


def scan_licences(
    docs: DataFrame, templates: list[tuple[str, str]] | None = None, dice: float = 0.8, key: str = "doc_id", text: str = "text",
    best_only: bool = False,
) -> DataFrame:
    """One row per unit of a text and licence it matches: key, scope, unit, licence, dice.

    scope is line, paragraph (of several lines, ended by an empty line), document (of several
    paragraphs) or window; unit counts the units of that scope in the text from 0, and is the
    number of the first word of a window.  Of several templates of a licence the best counts.
    Windows have a template's number of words and lie anywhere in the text; of overlapping
    ones that which shares most bigrams counts, and those in a unit found for their licence by
    as long a template are left out.  With ``best_only`` a unit has the one licence whose template
    fits best, of equals the longest, and windows in it are left out whatever their licence.  Texts need two words to match; null and empty
    texts give no rows, repeated rows of ``docs`` each give theirs.  Work is done by
    Spark's own functions; only bigrams that occur in a template reach the shuffle.
    """
    spark = docs.sparkSession
    listed = spark.createDataFrame(list(enumerate(templates or TEMPLATES)), "template int, t struct<licence string, text string>")
    words = _words(_cleaned(F.col("t.text")))
    listed = listed.select("template", "t.licence", _bigrams(words).alias("b")).filter("size(b) > 0")
    sizes = [(r.template, r.n) for r in listed.select("template", F.size("b").alias("n")).collect()]  # one number a template
    low = min(-(-n * dice // (2 - dice)) for _, n in sizes)
    high = max(n * (2 - dice) // dice for _, n in sizes)
    counts = listed.select("template", "licence", F.size("b").alias("n"), F.explode("b").alias("bigram"))
    counts = counts.groupBy("template", "licence", "n", "bigram").agg(F.count("*").alias("there"))
    anchors = _anchors(counts.select("template", "n", "bigram").collect(), dice)  # words of the given list

    clean = _cleaned(text_or_empty(text))
    lines = F.split(F.col("clean"), "\n")
    paragraphs = F.split(F.col("clean"), _BLANK)
    given = docs.select(F.col(key).alias("key"), clean.alias("clean")).withColumn("row", F.monotonically_increasing_id())
    hopeful = F.arrays_overlap(F.split("clean", r"[ \n]+"), F.split(F.lit(" ".join(anchors)), " "))
    given = materialize(given.filter(hopeful), "licence-texts")

    def units(scope, array, wanted):
        with_no = F.transform(array, lambda x, i: F.struct(F.lit(scope).alias("scope"), i.alias("unit"), x.alias("x")))
        return F.filter(with_no, lambda u: wanted(u["x"]) & (F.length(u["x"]) >= int(low)))

    several = lambda x: F.instr(F.trim(F.translate(x, "\n", "\x01")), "\x01") > 0
    all_units = F.concat(
        units("line", lines, lambda x: F.lit(True)),
        units("paragraph", paragraphs, several),
        units("document", F.array("clean"), lambda x: x.rlike(r"[^\s][ ]*\n[ \n]*\n[ \n]*[^\s]")),
    )
    found = given.select("row", "key", F.explode(all_units).alias("u")).select("row", "key", "u.scope", "u.unit", "u.x")
    found = found.withColumn("words", _words(F.col("x"))).withColumn("own", F.size("words") - 1)
    found = found.filter(F.col("own").between(int(low), int(high)))
    found = found.select("row", "key", "scope", "unit", "own", F.explode(_bigrams(F.col("words"))).alias("bigram"))
    pruned = found.join(F.broadcast(counts), "bigram").filter(  # templates: a given list
        (F.col("own") * (2 - dice) >= F.col("n") * dice) & (F.col("own") * dice <= F.col("n") * (2 - dice))
    )
    shared = pruned.groupBy("row", "key", "scope", "unit", "own", "template", "licence", "n", "bigram").agg(
        F.least(F.count("*"), F.first("there")).alias("shared")
    )
    measured = shared.groupBy("row", "key", "scope", "unit", "licence", "template", "own", "n").agg(F.sum("shared").alias("shared"))
    measured = measured.withColumn("dice", 2.0 * F.col("shared") / (F.col("own") + F.col("n"))).filter(F.col("dice") >= dice - 1e-12)
    rank = Window.partitionBy("row", "scope", "unit", *([] if best_only else ["licence"])).orderBy(F.desc("dice"), F.desc("n"), "licence", "template")
    best = measured.withColumn("r", F.row_number().over(rank)).filter("r = 1").select("row", "key", "scope", "unit", "licence", "n", "dice")
    best = materialize(best, "licence-units")
    windows = materialize(_windows(given, counts, dice), "licence-windows")
    windows = _beside(windows, best, given, [] if best_only else ["licence"]).withColumn("scope", F.lit("window"))
    out = best.unionByName(windows.select(best.columns))
    return out.select(F.col("key").alias(key), "scope", "unit", "licence", F.round("dice", 6).alias("dice"))

"""Licence notices found by the Dice coefficient of word bigrams.

A unit is a line of a text, and a whole text if it has no more words than the size bound of the
longest template allows. Units and templates are normalised alike (lower case, every run of other
characters than letters and digits to a blank) and become sets of word bigrams. A unit matches a
template when 2 |A and B| / (|A| + |B|) reaches the threshold t. That is impossible unless
t |A| <= (2 - t) |B| and t |B| <= (2 - t) |A|: units outside the bounds of all templates are dropped
before their bigrams are spread out, and templates outside a unit's bounds are not counted for it.
Texts are read once, for the bigrams that are in a template (a set of the templates' size); only these are
written to the shared folder, and meet the templates in a hash join. All of it is DataFrame expressions.

Notices that are wrapped over lines or share their line with other words are found as spans: runs of
consecutive words of the text, lines joined, of at most (2 - t) |B| / t word pairs for a template B. The
best span starts and ends with a pair of the template, so only places of such pairs are compared, and
only where enough of them lie within that length. In a span a pair of the template counts once and any
other pair each time. Of spans that overlap, the one that shares most pairs stays; spans over a line
or in a whole text that matched the same template are not told again.

Defined results: null and empty texts and units of fewer than two words match nothing; of several
templates a unit gets the one with the largest coefficient, ties to the smaller name; repeated rows
give their matches each; no rows give no matches; extra columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeferry.session import staged

# Notices in the wording their authors recommend.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file"
        " except in compliance with the License. You may obtain a copy of the License at"
        " http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the"
        " LICENSE file."
    ),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0 Universal.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of"
        " the GNU General Public License as published by the Free Software Foundation, either"
        " version 3 of the License, or (at your option) any later version."
    ),
    "MIT": "Released under the MIT License.",
    "MIT-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this"
        " software and associated documentation files (the Software), to deal in the Software"
        " without restriction, including without limitation the rights to use, copy, modify, merge,"
        " publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons"
        " to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
        " copy of the MPL was not distributed with this file, You can obtain one at"
        " https://mozilla.org/MPL/2.0/."
    ),
}


def _words(text: Column) -> Column:
    return F.filter(
        F.split(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != ""
    )


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<string>"))


def templates(spark: SparkSession, texts: dict[str, str]) -> DataFrame:
    """license, bigram, b (number of the template's bigrams)."""
    rows = F.array(*[F.struct(F.lit(k).alias("license"), F.lit(v).alias("t")) for k, v in sorted(texts.items())])
    return (
        spark.range(1)
        .select(F.inline(rows))
        .select("license", _bigrams(_words(F.col("t"))).alias("g"))
        .select("license", F.size("g").alias("b"), F.explode("g").alias("bigram"))
    )


def _pair(words: Column, at: Column) -> Column:
    return F.concat(F.get(words, at), F.lit(" "), F.get(words, at + 1))


def _places(words: Column, grams: list[str]) -> Column:
    """Places (from 0) of the word pairs that are in a template."""
    places = F.when(F.size(words) > 1, F.sequence(F.lit(0), F.size(words) - 2)).otherwise(F.array().cast("array<int>"))
    return F.filter(places, lambda i: _pair(words, i).isin(grams))


def hits(docs: DataFrame, grams: list[str], least: int, low: float, high: float) -> DataFrame:
    """_doc (one number a row of docs), doc_id, at, line, last, a, bigram: the pairs of templates in texts.

    Pairs of the joined text have their place ``at`` and the lines of their words; distinct pairs of a unit
    have at -1, its line and the number ``a`` of its distinct pairs. Texts are cut and normalised once; a
    text, or a unit, with fewer than ``least`` pairs of templates cannot match and goes at once.
    """
    words = docs.select(
        F.col("doc_id").cast("long"), F.transform(F.split("text", "\n", -1), _words).alias("_w")
    ).where("_w is not null")
    near = (
        words.select("doc_id", "_w", F.flatten("_w").alias("_all"))
        # the number, as no filter is pushed below it, also keeps the places from being looked up twice
        .select(
            F.monotonically_increasing_id().alias("_doc"), "doc_id", "_w", "_all",
            _places(F.col("_all"), grams).alias("_at"),
        )
        .where(F.size("_at") >= least)
    )
    whole = F.when((F.size("_w") > 1) & (F.size("_all") - 1 <= high), F.col("_all"))
    marked = near.select(
        "_doc",
        "doc_id",
        "_all",
        "_at",
        F.expr("flatten(transform(_w, (x, i) -> array_repeat(i, size(x))))").alias("_line"),
        F.filter(
            F.transform(
                F.concat(F.array(whole), "_w"), lambda x, i: F.struct((i - 1).alias("line"), x.alias("words"))
            ),
            lambda u: F.size(_places(u["words"], grams)) >= least,
        ).alias("_units"),
    ).withColumn(
        "_units",
        F.transform("_units", lambda u: F.struct(u["line"].alias("line"), _bigrams(u["words"]).alias("g"))),
    )
    units = F.transform(
        F.filter("_units", lambda u: (F.size(u["g"]) >= low) & (F.size(u["g"]) <= high)),
        lambda u: F.transform(
            F.filter(u["g"], lambda g: g.isin(grams)),
            lambda g: F.struct(
                F.lit(-1).alias("at"), u["line"].alias("line"), u["line"].alias("last"),
                F.size(u["g"]).alias("a"), g.alias("bigram"),
            ),
        ),
    )
    marks = F.transform(
        "_at",
        lambda i: F.struct(
            i.alias("at"), F.get("_line", i).alias("line"), F.get("_line", i + 1).alias("last"),
            F.lit(0).alias("a"), _pair(F.col("_all"), i).alias("bigram"),
        ),
    )
    return marked.select("_doc", "doc_id", F.inline(F.concat(F.flatten(units), marks)))


def scan(
    docs: DataFrame, texts: dict[str, str] | None = None, *, threshold: float = 0.8
) -> DataFrame:
    """doc_id, line (from 0; -1 for the whole text; the first of a span), license, dice for every unit
    that matches."""
    spark = docs.sparkSession
    table = templates(spark, TEMPLATES if texts is None else texts)
    # a row whose size is that of the templates
    sizes = table.agg(
        F.min("b").alias("low"), F.max("b").alias("high"), F.sort_array(F.collect_set("bigram")).alias("grams")
    ).first()
    if sizes["low"] is None:
        return spark.sql("SELECT 0L AS doc_id, 0 AS line, '' AS license, 0D AS dice WHERE false")
    low = sizes["low"] * threshold / (2 - threshold)
    high = sizes["high"] * (2 - threshold) / threshold
    # 2 c >= t (a + b) and t b <= (2 - t) a make the c shared pairs at least t b / (2 - t)
    least = max(1, math.ceil(low - 1e-9))
    found_pairs = staged(hits(docs, sizes["grams"], least, low, high), "licence-pairs")
    t = F.lit(threshold)
    shared = (
        found_pairs.where("at < 0")
        .join(F.broadcast(table), "bigram")
        .where((t * F.col("a") <= (2 - t) * F.col("b")) & (t * F.col("b") <= (2 - t) * F.col("a")))
        .groupBy("_doc", "doc_id", "line", "a", "license", "b")
        .agg(F.count("*").alias("_c"))
        .withColumn("dice", 2.0 * F.col("_c") / (F.col("a") + F.col("b")))
        .where(F.col("dice") >= t)
    )
    best = Window.partitionBy("_doc", "line").orderBy(F.desc("dice"), "license")
    found = (
        shared.withColumn("_nth", F.row_number().over(best))
        .where("_nth = 1")
        .select("_doc", "doc_id", "line", "license", "dice")
    )
    told = found.select(
        F.col("_doc").alias("_of"), F.col("license").alias("_as"), F.col("line").alias("_on")
    )
    more = spans(found_pairs.where("at >= 0"), table, threshold).join(
        told,
        F.expr("_doc = _of AND license = _as AND (_on = -1 OR _on BETWEEN line AND last)"),
        "left_anti",
    )
    return found.unionByName(more.drop("last")).drop("_doc")


def spans(pairs: DataFrame, table: DataFrame, threshold: float) -> DataFrame:
    """_doc, doc_id, line, last (the lines of a span), license, dice for the spans that stay, from the
    pairs of templates in joined texts."""
    marks = (
        pairs.join(F.broadcast(table), "bigram")
        .groupBy("_doc", "doc_id", "license", "b")
        .agg(F.sort_array(F.collect_list(F.struct("at", "bigram", "line", "last"))).alias("m"))
        .withColumn("need", F.ceil(F.lit(threshold / (2 - threshold)) * F.col("b") - 1e-9).cast("int"))
        .withColumn("reach", F.floor(F.lit((2 - threshold) / threshold) * F.col("b") + 1e-9).cast("int"))
        .where("size(m) >= need")
    )
    starts = (
        # each start carries the pairs within its reach, never the whole list
        marks.select(
            "_doc",
            "doc_id",
            "license",
            "b",
            F.explode(
                F.expr(
                    "transform(filter(sequence(0, size(m) - need), i -> m[i + need - 1].at - m[i].at < reach),"
                    " i -> filter(slice(m, i + 1, reach), x -> x.at - m[i].at < reach))"
                )
            ).alias("own"),
        )
        .withColumn("grams", F.expr("transform(own, x -> x.bigram)"))
        # places of pairs that are new in the span, each with the places of template pairs up to it
        .withColumn(
            "fresh",
            F.expr(
                "filter(transform(own, (x, j) -> struct(x as x, j + 1 as upto)), y -> array_position(grams, y.x.bigram) = y.upto)"
            ),
        )
        .withColumn(
            "best",
            F.expr(
                "array_max(transform(fresh, (y, k) -> struct("
                "2D * (k + 1) / (y.x.at - own[0].at + 1 - y.upto + k + 1 + b) as dice, k + 1 as c, y.x.at as end, y.x.last as last)))"
            ),
        )
        .where(F.col("best.dice") >= F.lit(threshold))
    )
    clear = "NOT exists(kept, k -> k.start <= x.end + 1 AND x.start <= k.end + 1)"
    return (
        starts.groupBy("_doc", "doc_id")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.expr(
                        "struct(-best.c as c, -best.dice as dice, license, own[0].at as start, best.end as end,"
                        " own[0].line as line, best.last as last)"
                    )
                )
            ).alias("found")
        )
        .select(
            "_doc",
            "doc_id",
            F.expr(
                "inline(aggregate(found, slice(found, 1, 0),"
                f" (kept, x) -> if({clear}, concat(kept, array(x)), kept)))"
            ),
        )
        .select("_doc", "doc_id", "line", "last", "license", (-F.col("dice")).alias("dice"))
    )


def sql(texts: dict[str, str] | None = None, threshold: float = 0.8) -> str:
    rows = ", ".join(f"('{k}', '{v}')" for k, v in sorted((texts or TEMPLATES).items()))
    words = "list_filter(string_split(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"
    grams = (
        "CASE WHEN len({0}) > 1 THEN list_distinct(list_transform(range(1, len({0})),"
        " lambda i: {0}[i] || ' ' || {0}[i + 1])) ELSE [] END"
    )
    return f"""
WITH tw AS (SELECT license, {words.format("t")} AS w FROM (VALUES {rows}) v(license, t)),
tg AS (SELECT license, {grams.format("w")} AS g FROM tw),
templates AS (SELECT license, len(g) AS b, unnest(g) AS bigram FROM tg),
lines AS (
  SELECT doc_id, list_transform(string_split(text, chr(10)), lambda l: {words.format("l")}) AS w
  FROM documents WHERE text IS NOT NULL
), cut AS (
  SELECT doc_id, unnest(range(len(w))) AS line, unnest(w) AS w FROM lines
  UNION ALL
  SELECT doc_id, -1, flatten(w) FROM lines
  WHERE len(w) > 1 AND len(flatten(w)) - 1 <= (SELECT max(b) FROM templates) * (2 - {threshold}) / {threshold}
), units AS (
  SELECT row_number() OVER () AS unit, doc_id, line, g, len(g) AS a
  FROM (SELECT doc_id, line, {grams.format("w")} AS g FROM cut)
), shared AS (
  SELECT u.unit, u.doc_id, u.line, t.license, CAST(2.0 AS DOUBLE) * count(*) / (min(u.a) + min(t.b)) AS dice
  FROM (SELECT unit, doc_id, line, a, unnest(g) AS bigram FROM units) u JOIN templates t USING (bigram)
  GROUP BY u.unit, u.doc_id, u.line, t.license
), best AS (
  SELECT *, row_number() OVER (PARTITION BY unit ORDER BY dice DESC, license) AS nth FROM shared WHERE dice >= {threshold}
)
SELECT doc_id, CAST(line AS INTEGER) AS line, license, dice FROM best WHERE nth = 1
"""

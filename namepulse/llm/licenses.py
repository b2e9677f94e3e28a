"""License scans: Dice coefficient over word bigrams, in DataFrame functions only.

Every line of a text and the text as a whole are compared with templates.
Normal form: A-Z in lower case, everything but letters a-z and digits as one
space. The coefficient of two sets of bigrams is twice what they share over the
sum of their sizes. A coefficient of ``least`` bounds the ratio of the sizes, so
lines and texts outside every template's bounds go before bigrams are made, and
a pair outside its own bounds before they are counted. Bounds and threshold are
compared in whole numbers: a coefficient of exactly ``least`` is a match.

Null and empty texts, and lines of fewer than two words, match nothing. Equal
templates of one name count once. Repeated rows are reported once per document;
documents with a null id are reported together. Empty tables give no rows.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LEAST = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Usual licence notices and short licence texts.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
)


def share(least: float) -> tuple[int, int]:
    """``(p, q)`` with ``least = p / q``: what two sets share reaches it if ``2 * q * shared >= p * (size + other size)``."""
    return Fraction(str(least)).as_integer_ratio()


def normal(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(text, UPPER, LOWER), "[^a-z0-9]+", " "))


def n_words(normalised: Column) -> Column:
    """Words of a normal form, from its spaces."""
    return F.when(normalised == "", 0).otherwise(F.length(normalised) - F.length(F.replace(normalised, F.lit(" "), F.lit(""))) + 1)


def bigrams(normalised: Column) -> Column:
    words = F.split(normalised, " ")
    first, second = F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1)
    return F.array_distinct(F.zip_with(first, second, lambda a, b: F.concat(a, F.lit(" "), b)))


def templates(spark: SparkSession, given: tuple = TEMPLATES) -> DataFrame:
    rows = spark.createDataFrame(sorted(set(given)), "license string, template string").where("license IS NOT NULL AND template IS NOT NULL")
    rows = rows.select("license", bigrams(normal(F.col("template"))).alias("bigrams"))
    return rows.withColumn("size", F.size("bigrams")).where("size > 0")


def _once(made: Column) -> Column:
    """A generated column: filters on it stay above it, so that it is made once."""
    return F.explode(F.array(made))


def _units(docs: DataFrame, least_words: int) -> DataFrame:
    """Lines, numbered from 1, and whole texts, numbered 0, that have so many words at least."""
    # Line feeds stay apart through the normal form of the whole text.
    clean = F.regexp_replace(F.translate("text", UPPER, LOWER), "[^a-z0-9\\n]+", " ")
    whole = F.regexp_replace(F.translate("clean", "\n", " "), " +", " ")
    numbered = F.posexplode(F.concat(F.array(whole), F.split("clean", "\n"))).alias("line_no", "line")
    units = docs.select("doc_id", _once(clean).alias("clean")).select("doc_id", numbered)
    units = units.select("doc_id", "line_no", F.trim("line").alias("unit"))
    return units.where(n_words(F.col("unit")) >= least_words)


def _texts(words: list[str]) -> Column:
    return F.array(*(F.lit(w) for w in words)) if words else F.array().cast("array<string>")


def scan(docs: DataFrame, *, doc: str = "doc_id", text: str = "text", given: tuple = TEMPLATES, least: float = LEAST) -> DataFrame:
    """The best template of each line and text that reaches ``least``: ``line_no``, ``license``, ``dice``.

    The templates are a list in the program, so their bigrams are constants of
    the plan, and nothing is shuffled but the matches. What a unit shares with
    all templates together bounds what it shares with each.
    """
    table = templates(docs.sparkSession, given).orderBy("size", "license").collect()
    p, q = share(least)
    # What is shared is no more than the smaller set: that one is at least p / (2q - p) of the other.
    rest = 2 * q - p
    low, high = -(-p * min((t["size"] for t in table), default=0) // rest), rest * max((t["size"] for t in table), default=0) // p
    named = docs.select(F.col(doc).alias("doc_id"), F.col(text).cast("string").alias("text"))
    units = _units(named, max(2, low)).select("doc_id", "line_no", _once(bigrams(F.col("unit"))).alias("bigrams"))
    units = units.withColumn("size", F.size("bigrams")).where((F.col("size") >= low) & (F.col("size") <= high))
    known = _texts(sorted({b for t in table for b in t["bigrams"]}))
    parts = units.select("doc_id", "line_no", "size", _once(F.array_intersect("bigrams", known)).alias("known"))
    parts = parts.where(rest * F.size("known") >= p * F.col("size"))

    def dice(t) -> Column:
        near = (rest * F.col("size") >= p * t["size"]) & (rest * t["size"] >= p * F.col("size"))
        both = F.col("size") + t["size"]
        shared = F.size(F.array_intersect("known", _texts(t["bigrams"])))
        score = F.when(2 * q * shared >= p * both, -2 * shared / both)
        return F.when(near, F.struct(score.alias("d"), F.lit(t["license"]).alias("license")))

    none = F.lit(None).cast("struct<d:double,license:string>")
    best = F.array_min(F.filter(F.array(none, *(dice(t) for t in table)), lambda x: x["d"].isNotNull()))
    found = parts.select("doc_id", "line_no", _once(best).alias("best")).where("best IS NOT NULL")
    found = found.select("doc_id", F.col("line_no").cast("long"), F.col("best.license").alias("license"), F.round(-F.col("best.d"), 6).alias("dice"))
    return found.distinct().withColumnRenamed("doc_id", doc)

"""Licence scans: lines and paragraphs compared with licence templates by word bigrams.

A unit is a line, or a paragraph of several lines.  Its text is normalised (letters and digits, lower case)
and its set of word bigrams compared with that of each template by the Dice coefficient,
``2 * common / (own + template)``.  A template can only reach the threshold ``t`` if the sizes of the two sets
differ by a factor of at most ``(2 - t) / t``, so others are left out before any comparison.  The
templates are a fixed short list and travel as literals; only built-in functions are used, and no rows move.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.arrays import let

# The wording of common licence notices.
LICENCES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    (
        "CC-BY-NC-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met:",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
]

MIN_DICE = 0.8


def normalised_words(text: str) -> list[str]:
    return re.sub("[^a-zA-Z0-9]+", " ", text).lower().split()


def template_bigrams(text: str) -> list[str]:
    words = normalised_words(text)
    return sorted({f"{a} {b}" for a, b in zip(words, words[1:], strict=False)})


def units(text: Column) -> Column:
    """Lines, then the paragraphs (parted by empty lines) that have several."""
    paragraphs = F.filter(F.split(text, "\n\n"), lambda p: F.contains(p, F.lit("\n")))
    return F.concat(F.split(text, "\n"), paragraphs)


def scan_licences(
    docs: DataFrame, licences: Sequence[tuple[str, str]] = LICENCES, min_dice: float = MIN_DICE
) -> DataFrame:
    """``doc_id, unit, template, licence, dice`` of every unit and template of at least ``min_dice``.

    ``unit`` numbers the lines from 0, then the paragraphs; ``template`` numbers the templates from 0.  Null and
    empty texts and units of one word have no bigrams and match nothing.  Repeated rows give repeated matches.
    """
    ratio = (2 - min_dice) / min_dice
    sets = [(i, name, template_bigrams(text)) for i, (name, text) in enumerate(licences)]
    least = min(len(b) for _, _, b in sets) / ratio
    templates = F.array(
        *[
            F.struct(F.lit(i).alias("template"), F.lit(name).alias("licence"), F.array(*[F.lit(b) for b in bigrams]).alias("b"))
            for i, name, bigrams in sets
        ]
    )

    def dice_of(own: Column, template: Column) -> Column:
        common = F.size(F.array_intersect(own, template["b"]))
        dice = (2.0 * common) / (F.size(own) + F.size(template["b"]))
        return F.struct(template["template"].alias("template"), template["licence"].alias("licence"), dice.alias("dice"))

    def compared(own: Column) -> Column:
        near = F.filter(templates, lambda t: F.size(t["b"]).between(F.size(own) / ratio, F.size(own) * ratio))
        return F.filter(F.transform(near, lambda t: dice_of(own, t)), lambda m: m["dice"] >= min_dice)

    def bigrams_of(words: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(words) - 2)
        return F.array_distinct(F.transform(starts, lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))))

    none = F.array().cast("array<struct<template: int, licence: string, dice: double>>")
    plain = F.trim(F.lower(F.regexp_replace("own", "[^a-zA-Z0-9]+", " ")))
    # each part is bound to a name once; a unit of w words has at most w - 1 bigrams
    matches = let(
        F.split(plain, " "),
        lambda w: F.when((F.size(w) > 1) & (F.size(w) - 1 >= least), let(bigrams_of(w), compared)).otherwise(none),
    )
    rows = docs.select("doc_id", F.posexplode(units(F.col("text"))).alias("unit", "own"))
    return rows.select("doc_id", "unit", F.explode(matches).alias("m")).select("doc_id", "unit", "m.*")


def _templates_sql() -> str:
    rows = []
    for i, (name, text) in enumerate(LICENCES):
        bigrams = ", ".join(f"'{b}'" for b in template_bigrams(text))
        rows.append(f"({i}, '{name}', [{bigrams}])")
    return ",\n".join(rows)


LICENCE_SQL = f"""
WITH templates(template, licence, b) AS (VALUES {_templates_sql()}),
parts AS (
  SELECT doc_id, list_concat(string_split(text, chr(10)),
    list_filter(string_split(text, chr(10) || chr(10)), lambda p: contains(p, chr(10)))) AS all_units
  FROM documents),
each AS (SELECT doc_id, unnest(all_units) AS own, generate_subscripts(all_units, 1) - 1 AS unit FROM parts),
worded AS (
  SELECT doc_id, unit,
    string_split(trim(lower(regexp_replace(own, '[^a-zA-Z0-9]+', ' ', 'g'))), ' ') AS w FROM each),
grams AS (
  SELECT doc_id, unit, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS own
  FROM worded WHERE len(w) BETWEEN 2 AND 1000),
compared AS (
  SELECT doc_id, CAST(unit AS INTEGER) AS unit, template, licence,
    2.0::DOUBLE * len(list_intersect(own, b)) / (len(own) + len(b)) AS dice
  FROM grams, templates)
SELECT * FROM compared WHERE dice >= 0.8
"""

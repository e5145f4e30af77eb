"""Licence notices in documents by Dice coefficient (DataFrame functions only).

Units of a document (the whole text, its paragraphs, its lines) are normalised
to lower-case words and compared with licence templates by the Dice coefficient
over the multisets of their word bigrams, 2 |A and B| / (|A| + |B|). A unit of n
words has n - 1 bigrams, so the words are counted before any bigram is made, and
a template of b bigrams can reach the threshold t only for sizes from
b t / (2 - t) to b (2 - t) / t. The templates are literals of the plan: there is
no join and no shuffle.

A notice may also stand amid other words or be wrapped in a comment. So a template
that no unit matches is compared with the word windows of the whole text, across
lines, that its size bounds allow. Only windows from one of the template's bigrams to
another are tried, as any other has a better one inside, and only in texts that hold
enough of its bigrams. The best window counts as one matched unit.

Defined results: null, blank and one-word units match nothing; equal units of a
document count once; ties go to the template that comes first by name; repeated
rows are judged alike; an empty table gives an empty result; other input columns
are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.8
#: Size bounds are whole numbers of bigrams that a double may miss by its last bit.
ROUNDING = 1e-9

#: Notices of public licences, by SPDX identifier (variants end in -2, -3).
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-2": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "BSD-3-Clause-2": "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-4.0-2": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "CC-BY-NC-4.0-2": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "CC-BY-SA-4.0-2": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "GPL-2.0": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "GPL-2.0-2": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "GPL-3.0-2": "This work is licensed under the GNU General Public License, version 3.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "MIT-2": "Released under the MIT License.",
    "MIT-3": "This project is licensed under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
}


def normalised(text: Column) -> Column:
    """Lower-case words of letters, digits and dots inside them, one space between."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


def template_bigrams(text: str) -> Counter:
    w = re.sub(r"[\W_]+", " ", text.lower()).split()
    return Counter(f"{a} {b}" for a, b in zip(w, w[1:], strict=False))


def dice_scores(units: Column, templates: Mapping[str, str], threshold: float) -> Column:
    """For an array of units ``(bigrams)``: array of ``(licence, dice)`` of each unit's matches."""
    def score(unit: Column, name: str, grams: Counter) -> Column:
        size, lo, hi = sum(grams.values()), threshold / (2 - threshold), (2 - threshold) / threshold
        distinct = F.array(*[F.lit(g) for g in grams])
        shared = F.array_intersect(unit, distinct)
        twice = [g for g, c in grams.items() if c > 1]  # in both more than once, perhaps
        both = F.size(shared)
        for g in twice:
            both = both + F.greatest(F.lit(0), F.least(F.lit(grams[g]), F.size(unit) - F.size(F.array_remove(unit, g))) - 1)
        dice = 2.0 * both / (F.size(unit) + size)
        fits = (F.size(unit) >= lo * size - ROUNDING) & (F.size(unit) <= hi * size + ROUNDING)
        return F.when(fits & F.arrays_overlap(unit, distinct),
                      F.when(dice >= threshold, F.struct(dice.alias("dice"), F.lit(name).alias("licence"))))

    grams = {n: template_bigrams(t) for n, t in sorted(templates.items())}
    return F.flatten(F.transform(units, lambda u: F.filter(F.array(*[score(u, n, g) for n, g in grams.items()]), lambda x: x.isNotNull())))


def bigrams(words: Column) -> Column:
    """Pairs of neighbouring words of an array of words."""
    pairs = F.zip_with(words, F.slice(words, 2, F.greatest(F.size(words), F.lit(1))), lambda a, b: F.concat_ws(" ", a, b))
    return F.slice(pairs, 1, F.greatest(F.size(words) - 1, F.lit(0)))


def window_hits(grams: Column, held: Column, found: Column, templates: Mapping[str, str], threshold: float) -> Column:
    """``(dice, licence)`` of the best window in ``grams`` for each template that is not in ``found``.

    ``held`` are the distinct bigrams of the text that stand in some template.
    """
    def best(name: str, text: str) -> Column:
        own = template_bigrams(text)
        size, distinct = sum(own.values()), F.array(*[F.lit(g) for g in own])
        least, most = math.ceil(size * threshold / (2 - threshold) - ROUNDING), math.floor(size * (2 - threshold) / threshold + ROUNDING)
        counts = F.create_map(*[F.lit(x) for pair in own.items() for x in pair])
        enough = F.aggregate(F.array_intersect(held, distinct), F.lit(0), lambda n, g: n + counts[g]) >= least  # a match shares at least that many
        places = F.filter(F.transform(grams, lambda g, i: F.when(F.array_contains(distinct, g), i)), lambda i: i.isNotNull())

        def from_place(at: Column, a: Column, i: Column) -> Column:
            ends = F.filter(F.slice(at, i + 1, F.lit(most)), lambda b: (b - a + 1).between(least, most))
            return F.array_max(dice_scores(F.transform(ends, lambda b: F.slice(grams, a + 1, b - a + 1)), {name: text}, threshold))

        top = F.transform(F.array(places), lambda at: F.array_max(F.transform(at, lambda a, i: from_place(at, a, i))))[0]  # places are found once
        return F.when(enough & ~F.array_contains(found, name), top)

    each = [best(n, t) for n, t in sorted(templates.items()) if template_bigrams(t)]
    return F.filter(F.array(*each), lambda x: x.isNotNull())


def scan(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, threshold: float = THRESHOLD,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_units`` (matched), ``licences`` (all, sorted), ``licence, dice`` (best) per document."""
    sizes = [sum(template_bigrams(t).values()) for t in templates.values()]
    least, most = min(sizes) * threshold / (2 - threshold) - ROUNDING, max(sizes) * (2 - threshold) / threshold + ROUNDING
    text = F.coalesce(F.col(text_col), F.lit(""))
    known = F.array(*[F.lit(g) for g in sorted(set().union(*map(template_bigrams, templates.values())))])
    df = docs.select(F.col(id_col).alias("doc_id"), bigrams(F.split(normalised(text), " ")).alias("grams"), F.array_distinct(F.concat(F.array(text), F.split(text, r"\n[\x20\t\r]*\n"), F.split(text, "\n"))).alias("units"))
    df = df.select("doc_id", "grams", F.array_distinct(F.transform("units", normalised)).alias("units"))
    n_grams = lambda u: F.length(u) - F.length(F.replace(u, F.lit(" "), F.lit("")))
    df = df.select("doc_id", "grams", F.filter("units", lambda u: (n_grams(u) >= least) & (n_grams(u) <= most) & (u != "")).alias("units"))
    grams = lambda u: F.zip_with(F.split(u, " "), F.slice(F.split(u, " "), 2, F.length(u)), lambda a, b: F.concat_ws(" ", a, b))
    df = df.select("doc_id", "grams", F.transform("units", lambda u: F.slice(grams(u), 1, F.greatest(n_grams(u), F.lit(1)))).alias("units"))
    df = df.select("doc_id", "grams", F.array_intersect("grams", known).alias("held"), dice_scores(F.col("units"), templates, threshold).alias("hits"))
    found = F.transform("hits", lambda h: h["licence"])
    df = df.select("doc_id", F.concat("hits", window_hits(F.col("grams"), F.col("held"), found, templates, threshold)).alias("hits"))
    best = F.array_max(F.transform("hits", lambda h: h["dice"]))
    df = df.withColumn("dice", best).withColumn("licence", F.array_min(F.transform(F.filter("hits", lambda h: h["dice"] == F.col("dice")), lambda h: h["licence"])))
    return df.select("doc_id", F.size("hits").cast("long").alias("n_units"),
                     F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["licence"]))).alias("licences"), "licence", "dice")

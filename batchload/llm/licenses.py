"""License scans: MinHash bands retrieve templates for windows of text, exact containment verifies.

A template is a set of word shingles (of five words, or of all its words where it has fewer).
Templates of similar size form a class; texts are cut into overlapping windows of the class's size, so
that a copy of a template always lies in one window as a whole. A window's MinHash signature is cut
into bands that are looked up among those of the templates; the number of bands follows from the
lowest Jaccard similarity that a match can have with its window, so that a match is missed with a
probability of at most MISS. A retrieved template matches where its shingles are contained in the
window to a share of at least the threshold, counted exactly.

A few anchor words are in so many shingles of each template that every match holds one of them, so
texts and windows without any anchor are left out beforehand without losing a match.

Only DataFrame operations: no Python runs on the executors.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SHINGLE = 5
CONTAINED = 0.8
MISS = 1e-5
WORDS = r"[\p{L}\p{N}]+"

# Notices as they are commonly printed.
TEMPLATES = {
    "reserved": "All rights reserved.",
    "mit-line": "Released under the MIT License.",
    "apache-line": "Licensed under the Apache License, Version 2.0.",
    "gpl-line": "This work is licensed under the GNU General Public License, version 3.",
    "cc-by-nc-line": "Licensed under CC BY-NC 4.0.",
    "cc-by-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    'software and associated documentation files (the "Software"), to deal in the Software without '
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the "
    "Software.",
    "apache": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this '
    "file except in compliance with the License. You may obtain a copy of the License at "
    "http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in "
    'writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT '
    "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl": "This program is free software: you can redistribute it and/or modify it under the terms "
    "of the GNU General Public License as published by the Free Software Foundation, either version 3 "
    "of the License, or (at your option) any later version.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are "
    "permitted provided that the following conditions are met: Redistributions of source code must "
    "retain the above copyright notice, this list of conditions and the following disclaimer.",
    "mpl": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
    "copy of the MPL was not distributed with this file, You can obtain one at "
    "https://mozilla.org/MPL/2.0/.",
    "isc": "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
    "without fee is hereby granted, provided that the above copyright notice and this permission "
    "notice appear in all copies.",
    "lgpl": "This library is free software; you can redistribute it and/or modify it under the terms "
    "of the GNU Lesser General Public License as published by the Free Software Foundation; either "
    "version 2.1 of the License, or (at your option) any later version.",
    "agpl": "This program is free software: you can redistribute it and/or modify it under the terms "
    "of the GNU Affero General Public License as published by the Free Software Foundation, either "
    "version 3 of the License, or (at your option) any later version.",
    "epl": "This program and the accompanying materials are made available under the terms of the "
    "Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "unlicense": "This is free and unencumbered software released into the public domain. Anyone is "
    "free to copy, modify, publish, use, compile, sell, or distribute this software, either in source "
    "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any "
    "means.",
    "cc0": "The person who associated a work with this deed has dedicated the work to the public "
    "domain by waiving all of his or her rights to the work worldwide under copyright law, including "
    "all related and neighboring rights, to the extent allowed by law.",
    "cc-by-sa-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
    "International License.",
    "cc-by-nc": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
    "International License.",
    "zlib": "This software is provided 'as-is', without any express or implied warranty. In no event "
    "will the authors be held liable for any damages arising from the use of this software. "
    "Permission is granted to anyone to use this software for any purpose, including commercial "
    "applications, and to alter it and redistribute it freely, subject to the following restrictions",
    "boost-line": "Distributed under the Boost Software License, Version 1.0.",
    "warranty": 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, '
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
}


@dataclass(frozen=True)
class SizeClass:
    """Templates of `k`-word shingles with more than `most` / 2 and up to `most` of them."""

    k: int
    most: int
    bands: int
    rows: int

    @property
    def window(self) -> int:
        """Shingles of a window: twice the largest template."""
        return 2 * self.most

    @property
    def step(self) -> int:
        """Windows overlap so that 1.5 times the largest template always lies in one of them."""
        return max(1, self.most // 2)


def words_of(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def bands_for(similarity: float, rows: int, miss: float) -> int:
    """How many bands of `rows` rows let a pair of this similarity collide with odds of 1 - miss."""
    p = similarity**rows
    return 1 if p >= 1 else math.ceil(math.log(miss) / math.log1p(-p))


def classes(templates: dict[str, str], contained: float, rows: int = 1) -> dict[str, SizeClass]:
    """The class of every template; templates without words have none."""
    sizes = {}
    for name, text in templates.items():
        words = words_of(text)
        if words:
            k = min(SHINGLE, len(words))
            n = len({tuple(words[i : i + k]) for i in range(len(words) - k + 1)})
            sizes[name] = (k, n, 1 << (n - 1).bit_length())
    out = {}
    for name, (k, _, most) in sizes.items():
        least = min(n for other_k, n, other in sizes.values() if (other_k, other) == (k, most))
        lowest = contained * least / (2 * most + (1 - contained) * least)
        out[name] = SizeClass(k, most, bands_for(lowest, rows, MISS), rows)
    return out


def anchors(templates: dict[str, str], contained: float) -> list[str]:
    """Few words, the longer the better, of which every match of a template holds one.

    A match may lack a share of the template's shingles; the anchors are in more of them than that.
    """
    open_, needs = {}, {}
    for name, text in templates.items():
        words = words_of(text)
        k = min(SHINGLE, len(words))
        if words:
            open_[name] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)}
            n = len(open_[name])
            needs[name] = n - math.ceil(contained * n - 1e-9) + 1
    chosen = []
    while any(need > 0 for need in needs.values()):
        gains: dict[str, float] = {}
        for name, need in needs.items():
            counts: dict[str, int] = {}
            for shingle in open_[name] if need > 0 else ():
                for word in set(shingle):
                    counts[word] = counts.get(word, 0) + 1
            for word, n in counts.items():
                gains[word] = gains.get(word, 0.0) + min(n, need) / need
        # Long words are rarer in other texts.
        best = max(gains, key=lambda word: (gains[word] * len(word) ** 3, word))
        chosen.append(best)
        for name, left in open_.items():
            held = {shingle for shingle in left if best in shingle}
            needs[name] -= len(held)
            open_[name] = left - held
    return chosen


def shingles(words: Column, k: Column) -> Column:
    """Hashes of all runs of k words."""
    return F.transform(
        F.sequence(F.lit(1), F.size(words) - k + 1),
        lambda i: F.xxhash64(F.array_join(F.slice(words, i, k), " ")),
    )


def signature(hashes: Column, bands: Column, rows: Column) -> Column:
    """One hash per band, of the minima of its rows."""
    return F.transform(
        F.sequence(F.lit(0), bands - 1),
        lambda band: F.xxhash64(
            F.array_join(
                F.transform(
                    F.sequence(band * rows, band * rows + rows - 1),
                    lambda row: F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, row))),
                ),
                " ",
            )
        ),
    )


def scan(
    docs: DataFrame,
    templates: dict[str, str] | None = None,
    contained: float = CONTAINED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, license, containment, first_word, last_word): the templates found in whole texts.

    One row per id and template, with the highest containment and, among windows that have it, the
    words (from 0) from the first to the last matching shingle of the first such window. Words are
    runs of letters and digits in lower case. Null and empty texts have no rows, nor do texts without
    a match; repeated rows of one id give one row. Other columns play no part. Templates that share
    most of their wording (`gpl`, `agpl`) are found together, the right one with the higher containment.
    """
    spark: SparkSession = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    by_name = classes(templates, contained)
    rows = [
        (name, c.k, c.most, c.window, c.step, c.bands, c.rows, words_of(templates[name]))
        for name, c in by_name.items()
    ]
    known = spark.createDataFrame(
        rows,
        "license string, k int, most int, width int, step int, bands int, rows int, words array<string>",
    )
    wanted = known.select(
        "license", "k", "most", F.array_distinct(shingles(F.col("words"), F.col("k"))).alias("wanted"),
        "bands", "rows",
    )
    wanted = wanted.select(
        "license", "k", "most", "wanted",
        F.posexplode(signature(F.col("wanted"), F.col("bands"), F.col("rows"))).alias("band", "value"),
    )
    sized = sorted({(c.k, c.most, c.window, c.step, c.bands, c.rows) for c in by_name.values()})
    if not sized:
        return docs.select(
            F.col(id_col).alias("doc_id"), F.lit("").alias("license"), F.lit(0.0).alias("containment"),
            F.lit(0).cast("long").alias("first_word"), F.lit(0).cast("long").alias("last_word"),
        ).where("false")
    kinds = F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("k", "most", "width", "step", "bands", "rows"), c, strict=True)])
        for c in sized
    ])
    found_anchors = anchors(templates, contained)
    lowered = F.lower(F.col(text_col))
    anchored = F.lit(False)
    for word in found_anchors:
        anchored = anchored | lowered.contains(word)
    texts = docs.where(F.coalesce(anchored, F.lit(False))).select(
        F.col(id_col).alias("doc_id"),
        F.regexp_extract_all(lowered, F.lit(WORDS), F.lit(0)).alias("words"),
    )
    cut = texts.select("doc_id", "words", F.explode(kinds).alias("c")).where("size(words) >= c.k")
    cut = cut.select(
        "doc_id",
        "c.*",
        F.explode(
            F.transform(
                F.sequence(F.lit(0), F.size("words") - F.col("c.k"), F.col("c.step")),
                lambda at: F.struct(
                    at.alias("at"),
                    F.slice("words", at + 1, F.col("c.width") + F.col("c.k") - 1).alias("words"),
                ),
            )
        ).alias("w"),
    )
    cut = cut.where(F.arrays_overlap("w.words", F.array(*[F.lit(a) for a in found_anchors])))
    windows = cut.select(
        "doc_id", "k", "most", "bands", "rows", "w.at", shingles(F.col("w.words"), F.col("k")).alias("hashes")
    )
    banded = windows.select(
        "doc_id", "k", "most", "at", "hashes",
        F.posexplode(signature(F.col("hashes"), F.col("bands"), F.col("rows"))).alias("band", "value"),
    )
    # The templates are a parameter: their bands are as many as the code says.
    retrieved = banded.join(F.broadcast(wanted), ["k", "most", "band", "value"])
    shared = F.size(F.array_intersect("wanted", "hashes")) / F.size("wanted")
    places = F.filter(
        F.transform("hashes", lambda h, i: F.when(F.array_contains("wanted", h), i)),
        lambda i: i.isNotNull(),
    )
    verified = retrieved.withColumn("containment", shared).where(F.col("containment") >= contained)
    spans = verified.select(
        "doc_id", "license", "containment",
        (F.col("at") + F.array_min(places)).cast("long").alias("first_word"),
        (F.col("at") + F.array_max(places) + F.col("k") - 1).cast("long").alias("last_word"),
    )
    best = F.min_by(
        F.struct("containment", "first_word", "last_word"),
        F.struct(-F.col("containment"), F.col("first_word"), F.col("last_word")),
    )
    return spans.groupBy("doc_id", "license").agg(best.alias("b")).select("doc_id", "license", "b.*")

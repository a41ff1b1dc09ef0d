"""License scans: MinHash bands over overlapping windows, with DataFrame operations only.

1. Templates and texts become shingles of words. Texts that hold no shingle of any
   template are set aside: they contain no part of one.
2. Windows of one and a half times a template's length (in steps of half its length,
   lengths rounded up to powers of the root of two) overlap so that every passage as long
   as the template lies whole in one of them. Templates have any length. Only windows with as many template shingles as the
   shortest template of the class needs are kept.
3. Each window and template gets the minimum of several hash orders over its shingles,
   in bands. A window that holds the share `containment` of a template is at least
   containment / 1.5 similar to it in the Jaccard sense, up to rounding of the length
   class, so with BANDS bands of ROWS minima it shares a band with probability over
   1 - (1 - s^ROWS)^BANDS; see `collision_probability`.
4. Exact containment of the template's shingles in the window verifies each match.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import col, computed, text_or_empty, written
from .shingles import with_shingles

SHINGLE_WORDS = 5
CONTAINMENT = 0.8
ROWS = 1
BANDS = 16
# Shingles and band keys of templates are sent to every task up to this number of rows
# (16 bytes each); beyond it the same joins shuffle.
BROADCAST_ROWS = 1_000_000

# Notices that mark a text's license, as published with the licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
        file except in compliance with the License. You may obtain a copy of the License at""",
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
        and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions""",
    "MIT-name": "Released under the MIT License.",
    "BSD": """Redistribution and use in source and binary forms, with or without modification, are permitted
        provided that the following conditions are met""",
    "GPL-3.0": "licensed under the GNU General Public License, version 3.",
    "GPL-3.0-terms": "under the terms of the GNU General Public License, version 3.",
    "GPL": """This program is free software: you can redistribute it and/or modify it under the terms of the
        GNU General Public License as published by the Free Software Foundation""",
    "LGPL": """under the terms of the GNU Lesser General Public License as published by the Free Software
        Foundation""",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-SA": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice""",
    "MIT-text": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software
        and associated documentation files (the "Software"), to deal in the Software without restriction,
        including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense,
        and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so,
        subject to the following conditions: The above copyright notice and this permission notice shall be
        included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT
        WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
        FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
        LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    # The place where the third clause would stand.
    "BSD-2-Clause": "materials provided with the distribution. THIS SOFTWARE IS PROVIDED",
    "BSD-3-Clause": """Neither the name of the copyright holder nor the names of its contributors may be used to
        endorse or promote products derived from this software without specific prior written permission""",
    "ISC-text": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without
        fee is hereby granted, provided that the above copyright notice and this permission notice appear in all
        copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS
        SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE
        LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
        LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
        ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "Unlicense": "This is free and unencumbered software released into the public domain.",
    "reserved": "All rights reserved. No part of this publication may be reproduced",
}


def collision_probability(similarity: float) -> float:
    """Chance that two sets of this Jaccard similarity share a band."""
    return 1 - (1 - similarity**ROWS) ** BANDS


def templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(TEMPLATES.items()), "license string, text string")


def read_templates(spark: SparkSession, folder: str) -> DataFrame:
    """``license, text`` from a folder of license texts, one a file; the file's name is the license."""
    files = spark.read.option("wholetext", True).text(folder)
    name = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.txt)?$", 1)
    return files.select(F.url_decode(name).alias("license"), F.col("value").alias("text"))


def length_class(n: int) -> int:
    """The smallest rounded power of the root of two, from 2 on, that is at least n."""
    k = 2
    while round(2 ** (k / 2)) < n:
        k += 1
    return round(2 ** (k / 2))


def _bands(hashes: str) -> Column:
    """Keys of all bands of the shingles in an array column."""

    def minimum(i: int) -> Column:
        return F.array_min(F.transform(hashes, lambda h: F.xxhash64(h, F.lit(i))))

    keys = [
        F.xxhash64(F.lit(band), *[minimum(band * ROWS + row) for row in range(ROWS)]) for band in range(BANDS)
    ]
    return F.array(*keys)


def _shingled(df: DataFrame, text: str) -> DataFrame:
    return with_shingles(df, F.col(text), SHINGLE_WORDS)


def license_matches(
    docs: DataFrame,
    known: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    containment: float = CONTAINMENT,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """(id, license, containment, start_word, n_words): the best window of each document for
    each license notice it holds.

    `known` has columns license and text, a stated list of notices or whole license texts of
    any length. Texts are compared as lower-case words without punctuation; NULL counts as
    empty. Notices of fewer than five words match nothing. Rows of `known` that share a license
    are searched apart; the best window of any of them is given. Repeated rows of a document
    give one row; rows with NULL ids are kept apart by text. Of equal windows the first is given.
    """
    marks = written(
        _shingled(known.select("license", F.coalesce("text", F.lit("")).alias("text")), "text")
        .select("license", F.array_distinct("hashes").alias("hashes"))
        .filter((F.size("hashes") > 0) & F.col("license").isNotNull())
        .withColumn("template", F.xxhash64("license", "hashes"))
        .dropDuplicates(["license", "template"])
    )
    sizes = marks.groupBy(F.size("hashes").alias("n")).agg(F.count("*").alias("templates")).collect()  # one row a length
    rows = sum(r.templates * max(r.n, BANDS) for r in sizes)
    least: dict[int, int] = {}
    for r in sizes:
        least[length_class(r.n)] = min(r.n, least.get(length_class(r.n), r.n))

    def sent(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if rows <= broadcast_rows else df

    # For each class: span, step, and the shingles of templates that a match holds at least.
    kinds = [
        F.struct(
            F.lit(n).alias("n"),
            F.lit(max(1, n // 2)).alias("step"),
            F.lit(max(1, math.ceil(size * containment - 1e-6))).alias("least"),
        )
        for n, size in sorted(least.items())
    ] or [F.struct(F.lit(2).alias("n"), F.lit(1).alias("step"), F.lit(1).alias("least"))]
    listed = marks.select(F.explode("hashes").alias("h")).distinct()

    text = text_or_empty(text_col)
    named = docs.select(
        F.xxhash64(col(id_col).cast("string")).alias("k1"), F.xxhash64(text).alias("k2"), col(id_col).alias("id"), text.alias("text")
    )
    positions = _shingled(named, "text").select("k1", "k2", F.posexplode("hashes").alias("pos", "h"))
    hits = positions.join(sent(listed), "h").groupBy("k1", "k2").agg(F.array_sort(F.collect_set("pos")).alias("hits"))
    suspects = _shingled(named.join(hits, ["k1", "k2"]).dropDuplicates(["k1", "k2"]), "text")

    # Window w of class n starts at w * step and spans n + step shingles; hit p lies in the
    # windows from (p - span) / step on to p / step.
    placed = suspects.select("k1", "k2", "id", "hashes", "hits", F.explode(F.array(*kinds)).alias("kind")).select(
        "k1", "k2", "id", "hashes", "hits", "kind.*"
    )
    covering = F.flatten(
        F.transform(
            "hits",
            lambda p: F.sequence(
                F.greatest(F.lit(0), F.ceil((p - F.col("n") - F.col("step") + 1) / F.col("step")).cast("int")),
                F.floor(p / F.col("step")).cast("int"),
            ),
        )
    )
    # Each hit names its windows, so one with `least` hits is named that often: in sorted
    # order its name stands again `least` - 1 places on.
    listing = computed(placed, covering=F.array_sort(covering))
    full = F.filter("covering", lambda w, i: w == F.get("covering", i + F.col("least") - 1))
    windows = written(
        listing.select("*", F.explode(F.array_distinct(full)).alias("w"))
        .withColumn("start", F.col("w") * F.col("step"))
        .select("k1", "k2", "id", "n", "start", F.slice("hashes", F.col("start") + 1, F.col("n") + F.col("step")).alias("hashes"))
    )
    class_of = F.create_map(*[F.lit(v) for r in sizes for v in (r.n, length_class(r.n))]) if sizes else None
    in_class = class_of[F.size("hashes")] if sizes else F.lit(2)
    probes = windows.select("k1", "k2", "n", "start", F.explode(_bands("hashes")).alias("key"))
    shelves = marks.select("license", "template", in_class.alias("n"), F.explode(_bands("hashes")).alias("key"))
    pairs = probes.join(sent(shelves), ["n", "key"]).select("k1", "k2", "n", "start", "license", "template").distinct()
    whole = marks.select("license", "template", F.col("hashes").alias("known"))
    checked = pairs.join(windows, ["k1", "k2", "n", "start"]).join(sent(whole), ["license", "template"])
    share = F.size(F.array_intersect("known", "hashes")) / F.size("known")
    best = F.max(F.struct("containment", (-F.col("start")).alias("s"), F.size("hashes").alias("held"))).alias("best")
    return (
        checked.withColumn("containment", share)
        .filter(F.col("containment") >= containment - 1e-9)
        .groupBy("k1", "k2", "license")
        .agg(F.first("id").alias("id"), best)
        .select(
            "id",
            "license",
            "best.containment",
            (-F.col("best.s")).cast("long").alias("start_word"),
            (F.col("best.held") + SHINGLE_WORDS - 1).cast("long").alias("n_words"),
        )
    )

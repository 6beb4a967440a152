"""License scan: MinHash bands over overlapping text windows retrieve templates, exact containment verifies.

Words are runs of letters and digits, lower-cased.  Windows of eight words start every four words; their
shingles (five words; a template of fewer words is one shingle) get ``BANDS`` minima, one a band.  A
window retrieves a template when a band's minimum equals that of a window of the template; template
windows start at every word, so a window inside a copy has an equal one.  A window with Jaccard ``j`` to
a template window is retrieved with probability ``1 - (1 - j) ** BANDS``: 0.999999 with one of the four
shingles of a window in common, 0.9998 for a template of three words (one of six).  A retrieved template is verified around the window: the
share of its shingles found there must reach ``CONTAINED``.

A band's minimum is the hash of a shingle, so a window that has none of the shingles that are a minimum
of some template window cannot be retrieved: texts without such a shingle are dropped before any window
is made.  DataFrame and SQL functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attestra.functions.binding import evaluated_once
from attestra.llm.common import own_columns, prepared, written

SHINGLE = 5
WINDOW = 8
STRIDE = 4
BANDS = 48
CONTAINED = 0.8
SEPARATOR = r"[^\p{L}\p{N}]+"

# Published license notices and the opening sentences of license texts.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
    ),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version"),
    (
        "GPL",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
    ),
    (
        "LGPL",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation",
    ),
    ("AGPL", "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    (
        "BSD",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("proprietary", "All rights reserved."),
)


def words_of(text: Column) -> Column:
    return F.split(F.lower(text), SEPARATOR)


def _shingles(words: Column, size: int) -> Column:
    """Hashes of ``size`` neighbouring words, in order; empty if there are fewer words."""
    places = F.sequence(F.lit(1), F.size(words) - size + 1)
    made = F.transform(places, lambda k: F.xxhash64(*[F.element_at(words, k + d) for d in range(size)]))
    return F.when(F.size(words) >= size, made).otherwise(F.array().cast("array<bigint>"))


def _minima(shingles: Column) -> Column:
    """For each band its number, the least hash of the window's shingles and the shingle that has it."""
    bands = F.sequence(F.lit(0), F.lit(BANDS - 1))
    return F.transform(
        bands,
        lambda b: F.struct(
            b.alias("band"),
            F.array_min(F.transform(shingles, lambda s: F.struct(F.xxhash64(s, b).alias("least"), s.alias("shingle")))).alias("m"),
        ),
    )


def _templates(spark: SparkSession, templates: tuple[tuple[str, str], ...]) -> DataFrame:
    """``template, license, size, shingles``: a few rows, whatever the input."""
    rows = spark.createDataFrame([(k, n, t) for k, (n, t) in enumerate(templates)], "template int, license string, text string")
    rows = rows.withColumn("words", F.filter(words_of(F.col("text")), lambda w: w != ""))
    short = F.size("words") < SHINGLE
    size = F.when(short, F.size("words")).otherwise(F.lit(SHINGLE))
    options = {n: _shingles(F.col("words"), n) for n in range(1, SHINGLE + 1)}
    made = options[SHINGLE]
    for n in range(1, SHINGLE):
        made = F.when(size == n, options[n]).otherwise(made)
    return rows.select("template", "license", size.alias("size"), made.alias("shingles"))


def _template_bands(templates: DataFrame) -> DataFrame:
    """``template, size, band, least, shingle`` of all windows of the templates."""
    wide = WINDOW + 1 - F.col("size")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("shingles") - wide + 1))
    windows = templates.select("template", "size", F.explode(F.transform(starts, lambda k: F.slice("shingles", k, wide))).alias("w"))
    bands = windows.select("template", "size", F.explode(_minima(F.col("w"))).alias("b"))
    return bands.select("template", "size", "b.band", "b.m.least", "b.m.shingle").distinct()


def scan(docs: DataFrame, templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """``doc_id, row_key, template, license, n_shingles, n_found, place``: one row for each text and template it holds.

    ``template`` numbers the ``templates``; ``n_found`` is how many of its distinct shingles the
    text holds, ``place`` the word (from 0) at which the first window starts that shares a band with it.  Null and empty texts hold
    none; repeated rows have rows each; an empty table gives none.
    """
    spark = prepared(docs.sparkSession)
    known = written(_templates(spark, templates).withColumn("shingles", F.array_distinct("shingles")), "templates")
    bands = written(_template_bands(_templates(spark, templates)), "bands")
    sizes = sorted(r.size for r in known.select("size").distinct().collect())  # five at most

    rows = own_columns(docs, "doc_id", "text").where("text is not null")
    rows = evaluated_once(rows.select("doc_id", F.xxhash64("text").alias("row_key"), words_of(F.col("text")).alias("words")))
    rows = evaluated_once(rows.select("doc_id", "row_key", *[_shingles(F.col("words"), n).alias(f"s{n}") for n in sizes]))
    candidate = F.lit(False)
    for n in sizes:
        least = [r.shingle for r in bands.where(F.col("size") == n).select("shingle").distinct().collect()]
        candidate = candidate | F.arrays_overlap(f"s{n}", F.array(*[F.lit(s) for s in least]))
    held = written(rows.where(candidate).withColumn("row", F.monotonically_increasing_id()), "license_texts")

    found: DataFrame | None = None
    for n in sizes:
        wide = WINDOW + 1 - n
        mine = F.broadcast(bands.where(F.col("size") == n).select("template", "band", "least"))  # fixed rows
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(f"s{n}")), F.lit(STRIDE))
        windows = held.where(F.size(f"s{n}") > 0).select(
            "row", F.posexplode(F.transform(starts, lambda k: F.slice(f"s{n}", k, wide))).alias("window", "w")  # noqa: B023
        )
        windows = windows.where(F.size("w") > 0).select("row", "window", F.explode(_minima(F.col("w"))).alias("b"))
        windows = windows.select("row", "window", "b.band", F.col("b.m.least").alias("least"))
        retrieved = windows.join(mine, ["band", "least"]).groupBy("row", "template").agg(F.min("window").alias("window"))
        around = retrieved.join(held.select("row", "doc_id", "row_key", F.col(f"s{n}").alias("s")), "row").join(F.broadcast(known), "template")
        reach = F.size("shingles")
        # A window retrieves; what counts is the whole text, however its parts are spread.
        hits = around.withColumn("n_found", F.size(F.array_intersect("shingles", "s")))
        hits = hits.where(F.col("n_found") >= CONTAINED * reach)
        hits = hits.select("row", "doc_id", "row_key", "template", "license", reach.alias("n_shingles"), "n_found", (STRIDE * F.col("window")).alias("place"))
        found = hits if found is None else found.union(hits)
    best = F.max(F.struct("n_found", (-F.col("place")).alias("back"))).alias("best")
    one = found.groupBy("row", "doc_id", "row_key", "template", "license", "n_shingles").agg(best)
    return one.select("doc_id", "row_key", "template", "license", "n_shingles", "best.n_found", (-F.col("best.back")).alias("place"))

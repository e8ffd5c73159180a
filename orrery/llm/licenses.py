"""License scan: MinHash bands over overlapping text windows, then exact
shingle containment (DataFrame functions only).

Texts are lower-cased runs of letters and digits; shingles are three words (a
license line often has five, too few for longer shingles). Windows of WINDOW
shingles begin at every STEP-th shingle of a document and at every shingle of
a license template; a template's windows also hold only its first or its last
shingles, as a window around a short notice does. Each window has one MinHash
per seed; bands are single MinHashes, so a window whose shingles overlap a
template window's by the share J meets it in some band with probability
1 - (1 - J)^SEEDS: 0.9998 at J = 3/4, which a notice of three shingles has in
its best window, and 1 for a window inside the template.

The bands of all templates are a literal in the plan, bounded by MAX_KEYS.
Only documents with a common band go on; for them the share of the template's
shingles found in the document (containment) is computed exactly, and
THRESHOLD decides. No shuffle: matches are found where the text is.

Defined results: a null or empty text, or one under three words, has no
match; repeated rows match each by themselves; texts are scanned whole.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm.common import let

#: License notices, by identifier.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "Apache-2.0 (long)":
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
        "to in writing, software distributed under the License is distributed on an \"AS IS\" "
        "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "MIT (long)":
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software",
    "GPL-3.0 (long)":
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    "BSD":
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met",
    "CC-BY-4.0":
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-SA-4.0":
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License.",
    "MPL-2.0":
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
}
SHINGLE = 3
WINDOW = 4
STEP = 2
SEEDS = 6
THRESHOLD = 0.8
MAX_KEYS = 50_000
_GAP = "[^a-z0-9]+"


def _shingles(text: Column) -> Column:
    """64-bit hashes of all runs of SHINGLE words, in order."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), _GAP), lambda w: w != "")
    return let(words, lambda ws: F.when(F.size(ws) < SHINGLE, F.array().cast("array<bigint>"))
               .otherwise(F.transform(
                   F.sequence(F.lit(0), F.size(ws) - SHINGLE),
                   lambda i: F.xxhash64(*[F.get(ws, i + k) for k in range(SHINGLE)]))))


def _bands(shingles: Column, step: int, seeds: int) -> Column:
    """MinHashes of all windows under all seeds. A seed's hash of a shingle
    hash depends on the seed, so bands of different seeds do not meet."""
    def of_seed(seed: int) -> Column:
        hashed = F.transform(shingles, lambda h: F.xxhash64(h, F.lit(seed)))
        return let(hashed, lambda hs: F.when(
            F.size(hs) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
                F.sequence(F.lit(1), F.size(hs), F.lit(step)),
                lambda i: F.array_min(F.slice(hs, i, WINDOW)))))

    return F.array_distinct(F.concat(*[of_seed(s) for s in range(seeds)]))


def template_keys(spark: SparkSession, templates: dict[str, str], seeds: int = SEEDS) -> list:
    """(license, template: distinct shingle hashes, keys: bands of its windows
    and of those that hold only its first or last shingles) per template."""
    short = [name for name, text in templates.items()
             if len(re.findall(r"[a-z0-9]+", text.lower())) < SHINGLE]
    if short:
        raise ValueError(f"templates of fewer than {SHINGLE} words: {short}")
    frame = spark.createDataFrame(list(templates.items()), "license string, text string")
    s = F.col("s")
    heads = [_bands(F.slice(s, 1, k), WINDOW, seeds) for k in range(1, WINDOW)]
    return frame.select("license", _shingles(F.col("text")).alias("s")).select(
        "license", F.array_distinct(s).alias("template"),
        F.array_distinct(F.concat(_bands(s, 1, seeds), *heads)).alias("keys")).collect()


def scan(docs: DataFrame, text: str = "text", templates: dict[str, str] | None = None,
         threshold: float = THRESHOLD, seeds: int = SEEDS) -> DataFrame:
    """(row: the input row, license, n_shingles, n_found, containment): one
    row per document and matching license."""
    known = template_keys(docs.sparkSession, TEMPLATES if templates is None else templates, seeds)
    keys = sorted({k for r in known for k in r["keys"]})
    if len(keys) > MAX_KEYS:
        raise ValueError(f"more than {MAX_KEYS} band keys: scan in several runs")
    met = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        let(_shingles(F.col(f"`{text}`")), lambda s: F.struct(
            s.alias("shingles"),
            F.array_intersect(_bands(s, STEP, seeds), F.lit(keys)).alias("keys"))).alias("w")) \
        .filter(F.size("w.keys") > 0).select("row", "w.shingles", "w.keys")
    checks = [F.when(
        F.arrays_overlap(F.col("keys"), F.lit(sorted(r["keys"]))),
        F.struct(F.lit(r.license).alias("license"),
                 F.lit(len(r.template)).cast("long").alias("n_shingles"),
                 F.size(F.array_intersect(F.lit(r.template), F.col("shingles"))).cast("long")
                 .alias("n_found"))) for r in known]
    hits = F.filter(F.array(*checks), lambda c: c.isNotNull()
                    & (c["n_found"] >= threshold * c["n_shingles"]))
    return met.select("row", F.inline(hits)).withColumn(
        "containment", F.col("n_found") / F.col("n_shingles"))

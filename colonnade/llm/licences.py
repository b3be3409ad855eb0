"""Operator 10 [native]: paragraph classifier for licence families.

Paragraphs are text between blank lines; their wrapped lines are joined and reduced to lower-case words.  A paragraph is
judged in overlapping tiles of ``TILE`` words, so that a notice inside a long paragraph is not thinned out; neighbours
share half their words.  Sparse hashed word uni- and bigrams feed one logistic regression per family, fitted on the
licence templates, alone and inside ``INSIDE`` tiles of the corpus, against ``background`` tiles of the corpus that match
no template: half of them near misses, which hold words of a template in sequence, half any.  Every second background
tile is kept out of the fit and calibrates the unknown class: a prediction must reach ``threshold`` and the ``CALM``
quantile of the family's probability on them.  The predicted family is confirmed by comparison with its templates: the
tile must hold ``CONTAINED`` of the three-word sequences of one of them.  Else it is unknown.

Tiles without any three-word sequence of a template cannot be confirmed, so only the others meet the classifier; this
changes no result.  The background is a bounded sample (at most ``background`` tiles, smallest hashes, one tile a
text); every paragraph of every text is judged, very long ones tile by tile.

Null and empty texts have no paragraphs and no licence.  Ties between families go to the smaller name.  Repeated rows
are judged alike; empty tables give no rows (and the background is empty); only the key and text columns are read.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 2048
TILE = 40
INSIDE = 12  # background tiles in which each template stands once more for the fit
CONTAINED = 0.5
CALM = 0.99
# Opening words and notices by which the families are commonly applied.
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "Licensed under the Apache License, Version 2.0.", "This file is distributed under the Apache License 2.0."),
    "bsd": ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.", "Released under the BSD 3-Clause License."),
    "cc": ("This work is licensed under a Creative Commons Attribution 4.0 International License.",
           "Available under the Creative Commons Attribution-ShareAlike license, CC BY-SA 4.0.", "Licensed under CC BY 4.0.", "Licensed under CC BY-NC-SA 4.0."),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation."),
    "mit": ("Released under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction."),
    "mpl": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
            "Covered by the Mozilla Public License 2.0."),
    "proprietary": ("Copyright. All rights reserved.", "All rights reserved. No part of this work may be reproduced without permission."),
}

def _plain(text: str) -> list[str]:
    return re.sub("[^a-z0-9]+", " ", text.lower()).split()


def _grams(tokens: list[str]) -> list[str]:
    return sorted({" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)})


#: (family, three-word sequences) of each template.
SEQUENCES = [(f, _grams(_plain(t))) for f, ts in TEMPLATES.items() for t in ts]


def _any_sequence() -> str:
    """One expression that finds a three-word sequence of any template, alternatives shared by their first word."""
    by: dict[str, list[str]] = {}
    for _, grams in SEQUENCES:
        for g in grams:
            first, rest = g.split(" ", 1)
            by.setdefault(first, []).append(rest)
    return r"\b(?:" + "|".join(f"{w} (?:{'|'.join(sorted(set(r)))})" for w, r in sorted(by.items())) + r")\b"


def _paragraphs(text: Column) -> Column:
    """Paragraphs in lower-case words with single spaces between them."""
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"\n[ \t\r\f\x0B]*\n", -1)
    return F.transform(parts, lambda p: F.trim(F.regexp_replace(p, "[^a-z0-9]+", " ")))


def _tiles(paragraph: Column) -> Column:
    """Overlapping tiles (arrays of words) of one paragraph; a paragraph of at most TILE words is one tile."""
    def cut(ws: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(ws) - TILE // 2, F.lit(1)), F.lit(TILE // 2))
        return F.transform(starts, lambda i: F.slice(ws, i, TILE))
    return F.get(F.transform(F.array(F.split(paragraph, " ", -1)), cut), F.lit(0))


def _likely(text: Column) -> Column:
    """Tiles that hold a three-word sequence of some template."""
    found = _any_sequence()
    tiles = F.flatten(F.transform(F.filter(_paragraphs(text), lambda p: p.rlike(found)), _tiles))
    return F.filter(tiles, lambda t: F.array_join(t, " ").rlike(found))


def _features(tokens: Column) -> Column:
    grams = F.concat(tokens, F.transform(F.sequence(F.lit(1), F.greatest(F.size(tokens) - 1, F.lit(1))),
                                         lambda i: F.concat_ws(" ", F.slice(tokens, i, 2))))
    return F.array_distinct(F.transform(grams, lambda g: F.pmod(F.xxhash64(g), F.lit(BUCKETS)).cast("int")))


def _contained(tokens: Column, family: str | None = None) -> Column:
    """Greatest share of a template's three-word sequences that the tile holds (of one family, or of all)."""
    held = F.transform(F.sequence(F.lit(1), F.greatest(F.size(tokens) - 2, F.lit(1))), lambda i: F.concat_ws(" ", F.slice(tokens, i, 3)))
    shares = [F.size(F.array_intersect(held, F.lit(grams))) / F.lit(len(grams)) for f, grams in SEQUENCES if family in (None, f)]
    return F.greatest(*shares) if len(shares) > 1 else shares[0]


def train_weights(docs: DataFrame, text: str, background: int, steps: int = 200) -> dict[str, tuple[np.ndarray, float, float]]:
    """Family -> (weights by bucket, intercept, probability that unknown tiles stay below)."""
    spark = docs.sparkSession
    labelled = spark.createDataFrame([(f, _plain(t)) for f, ts in TEMPLATES.items() for t in ts], "family string, p array<string>")

    def smallest(docs: DataFrame, tiles: Column) -> DataFrame:
        """Of each text the tile with the smallest hash."""
        ranked = F.transform(tiles, lambda t: F.struct(F.xxhash64(t).alias("o"), t.alias("p")))
        return docs.select(F.array_min(ranked).alias("x")).where("x is not null").select("x.o", "x.p")

    half = background // 2
    near = smallest(docs, F.filter(_likely(F.col(text)), lambda t: _contained(t) < CONTAINED))
    near = near.groupBy("o").agg(F.min("p").alias("p")).orderBy("o").limit(half).select("p")
    # any tiles: of the different texts with the smallest hashes, which are told without their words
    named = docs.select(F.col(text).alias("t")).withColumn("h", F.xxhash64("t")).where("t is not null")
    first = [r["h"] for r in named.select("h").distinct().orderBy("h").limit(background - half).collect()]
    texts = named.where(F.col("h").isin(first)).groupBy("h").agg(F.min("t").alias("t"))
    found = _any_sequence()
    plain = smallest(texts, F.flatten(F.transform(F.filter(_paragraphs(F.col("t")), lambda p: (F.length(p) > 0) & ~p.rlike(found)), _tiles))).select("p")
    unknown = near.unionByName(plain).select(F.lit(None).cast("string").alias("family"), "p")
    local = labelled.unionByName(unknown).select("family", _features(F.col("p")).alias("f"), F.xxhash64("p").alias("o")).collect()  # templates and background, bounded
    rows = [(r["family"] or "", set(r["f"]), r["family"] is None and r["o"] % 2 == 0) for r in sorted(local, key=lambda r: (r["family"] or "", r["o"]))]
    around = [fs for f, fs, out in rows if not f and not out][:INSIDE]
    rows += [(f, fs | bg, False) for f, fs, _ in rows if f for bg in around]  # a notice rarely fills its tile
    x = np.zeros((len(rows), BUCKETS))
    for line, (_, fs, _) in zip(x, rows):
        line[list(fs)] = 1 / np.sqrt(max(1, len(fs)))
    family, kept_out = np.array([f for f, _, _ in rows]), np.array([out for _, _, out in rows])
    out = {}
    for f in TEMPLATES:
        y = (family == f).astype(float)
        share = np.where(kept_out, 0.0, np.where(y > 0, 1 / max(1, y.sum()), 1 / max(1, (~kept_out & (y == 0)).sum())))
        w, b = np.zeros(BUCKETS), 0.0
        for _ in range(steps):  # full-batch descent, both classes weighted evenly
            err = (y - 1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30)))) * share
            w, b = 0.999 * w + 4 * (err @ x), b + err.sum()
        calm = 1 / (1 + np.exp(-np.clip(x[kept_out] @ w + b, -30, 30)))
        out[f] = w, b, float(np.quantile(calm, CALM)) if len(calm) else 0.0
    return out


def scan_licences(docs: DataFrame, key: str = "doc_id", text: str = "text", background: int = 300, threshold: float = 0.5) -> DataFrame:
    """key, n_licence_tiles, family (of the most probable tile, else null), families, probability."""
    weights = train_weights(docs, text, background)

    def judge(t: Column) -> Column:
        def scored(fs: Column) -> Column:
            probs = []
            for fam, (w, b, calm) in weights.items():
                table = F.lit(w.tolist())
                z = b + F.aggregate(fs, F.lit(0.0), lambda a, i: a + F.get(table, i)) / F.sqrt(F.greatest(F.size(fs), F.lit(1)))
                probs.append(F.struct((-1 / (1 + F.exp(-z))).alias("o"), F.lit(fam).alias("family"), F.lit(max(threshold, calm)).alias("least")))
            return F.array_min(F.array(*probs))  # the prediction: most probable, then smaller name
        best = F.get(F.transform(F.array(_features(t)), scored), F.lit(0))

        def confirmed(c: Column) -> Column:
            share = F.lit(0.0)
            for fam in weights:
                share = F.when(c["family"] == fam, _contained(t, fam)).otherwise(share)
            return F.when((-c["o"] >= c["least"]) & (share >= CONTAINED), c)
        return F.get(F.transform(F.array(best), confirmed), F.lit(0))

    found = F.filter(F.transform(_likely(F.col(text)), judge), lambda c: c.isNotNull())
    rows = docs.select(F.col(key).alias("_key"), found.alias("_found"))
    top = F.array_min("_found")
    return rows.select(F.col("_key").alias(key), F.size("_found").cast("long").alias("n_licence_tiles"), top["family"].alias("family"),
                       F.array_join(F.array_sort(F.array_distinct(F.col("_found.family"))), ",").alias("families"), (-top["o"]).alias("probability"))

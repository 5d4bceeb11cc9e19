"""License scan: MinHash bands over overlapping text windows, confirmed by exact containment.

DataFrame functions only. Words are runs of letters and digits in lower case;
shingles are ``shingle`` consecutive words.

1. *Anchors.* For each template enough words are marked as anchors that any text with
   ``containment`` of the template's shingles must hold one of them. Documents without
   an anchor are left out, and a length's windows are built only over anchors of the
   templates of that length: an exact bound.
2. *Windows.* For a template of L words: windows of L + stride - 1 words every
   ``stride`` = max(1, L / 8) words, so one window holds any passage of L words whole.
3. *MinHash.* Each window's minima under ``bands * rows`` hash functions, ``rows`` to a
   band. The number of bands follows from the lowest Jaccard similarity that a window
   with the wanted containment can have: such a window shares a band with its template
   with probability ``recall`` at least. Bands are joined with the templates' bands.
4. *Check.* The shingles of the template that the window really has are counted. Each *mark*
   of the template (its version, or the word that tells it from the rest of its family)
   must stand in one of them, so version 2 of a license isn't taken for version 3.

Nulls, edges: NULL or empty texts match nothing. Templates with fewer words than a shingle
have their word sequence as one shingle. Rows with equal ids are told apart by their text;
exact repeats give one row. An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Notices by which texts state a license (name, notice, marks: words that tell it from its family).
TEMPLATES = [
    ("MIT", "Released under the MIT License.", ()),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
            "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
            "copies of the Software, and to permit persons to whom the Software is furnished to do so", ()),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0.", ("version 2 0",)),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except "
                   "in compliance with the License. You may obtain a copy of the License at", ("version 2 0",)),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3.", ("gnu general", "version 3")),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation, either version 3 of the License, "
                "or (at your option) any later version.", ("gnu general", "version 3")),
    ("LGPL-3.0", "This library is licensed under the GNU Lesser General Public License, version 3.",
     ("gnu lesser", "version 3")),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met", ()),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", ("v 2 0",)),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
     ("attribution 4 0",)),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", ("nc 4 0",)),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0.", ("sa 4 0",)),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring "
                "rights to this work.", ()),
    ("proprietary", "All rights reserved.", ()),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2.", ("gnu general", "version 2")),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU "
                "General Public License as published by the Free Software Foundation; either version 2 of the License, "
                "or (at your option) any later version.", ("gnu general", "version 2")),
    ("LGPL-2.1", "This library is licensed under the GNU Lesser General Public License, version 2.1.",
     ("gnu lesser", "version 2 1")),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the "
                 "License, or (at your option) any later version.", ("gnu lesser", "version 2 1")),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Lesser General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version.", ("gnu lesser", "version 3")),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3.",
     ("gnu affero", "version 3")),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
                 "Affero General Public License as published by the Free Software Foundation, either version 3 of the "
                 "License, or (at your option) any later version.", ("gnu affero", "version 3")),
    ("BSD-3-Clause", "Neither the name of the copyright holder nor the names of its contributors may be used to endorse "
                     "or promote products derived from this software without specific prior written permission.", ()),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
     ()),
    ("Unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, "
                  "modify, publish, use, compile, sell, or distribute this software, either in source code form or as a "
                  "compiled binary, for any purpose, commercial or non-commercial, and by any means.", ()),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1 (the \"License\"); you "
                "may not use this file except in compliance with the License.", ("version 1 1",)),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
     ("sharealike 4 0",)),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
     ("noncommercial 4 0",)),
    ("CC-BY-4.0", "Licensed under CC BY 4.0.", ("by 4 0",)),
]
# Fixed value: words too common to be anchors while others are left.
COMMON = frozenset("a all and any are as at be by for from in is it of on or the this to under use with work you".split())


SEGMENT = 2000      # words of a text whose windows are built in one row


@dataclass(frozen=True)
class LicenseParams:
    shingle: int = 3
    containment: float = 0.8
    rows: int = 2
    recall: float = 0.999


def words_in(text: str) -> list[str]:
    return re.findall(r"[^\W_]+", text.lower())


def shingles_in(words: list[str], size: int) -> list[str]:
    return sorted({" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))}) if words else []


def mark_shingles(words: list[str], marks: tuple[str, ...], size: int) -> list[list[str]]:
    """For each mark the template's shingles that hold it."""
    found = [[s for s in shingles_in(words, size) if f" {m} " in f" {s} "] for m in marks]
    if not all(found):
        raise ValueError(f"a mark of {marks} stands in no shingle of the notice {' '.join(words)!r}")
    return found


def stride_of(length: int) -> int:
    return max(1, length // 8)


def anchors_of(words: list[str], params: LicenseParams) -> set[str]:
    """Words of which any text with the wanted containment has one: too few shingles do without them."""
    shingles = shingles_in(words, params.shingle)
    needed = math.ceil(params.containment * len(shingles) - 1e-9)
    chosen: set[str] = set()
    free = shingles
    while len(free) >= needed:
        left = {w for s in free for w in s.split()}
        best = max(left, key=lambda w: (w not in COMMON, len(w) > 4, sum(w in s.split() for s in free), len(w), w))
        chosen.add(best)
        free = [s for s in free if best not in s.split()]
    return chosen


def lowest_jaccard(length: int, params: LicenseParams) -> float:
    """Smallest Jaccard similarity of template and window if the window has the wanted containment."""
    shingles = max(1, length - params.shingle + 1)
    window = max(1, length + stride_of(length) - params.shingle)
    shared = math.ceil(params.containment * shingles - 1e-9)
    return shared / (shingles + window - shared)


def bands_needed(jaccard: float, rows: int, recall: float) -> int:
    """Bands with which a pair of that similarity shares one with probability ``recall``."""
    hit = jaccard ** rows
    return 1 if hit >= 1 else math.ceil(math.log(1 - recall) / math.log(1 - hit))


def text_words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))


def word_shingles(words: Column, size: int) -> Column:
    """Distinct shingle hashes of a word array."""
    last = F.greatest(F.size(words) - F.lit(size), F.lit(0))
    return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(
        F.concat_ws(" ", F.slice(words, i + 1, size)))))


def band_hashes(shingles: Column, bands: int, rows: int) -> Column:
    """One hash per band from the shingles' minima under ``bands * rows`` hash functions."""
    def lowest(j: int) -> Column:
        return F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, F.lit(j))))
    return F.array(*[F.xxhash64(F.lit(b), *[lowest(b * rows + r) for r in range(rows)]) for b in range(bands)])


def scan_licenses(docs: DataFrame, templates: list[tuple[str, str, tuple[str, ...]]] = TEMPLATES,
                  params: LicenseParams = LicenseParams()) -> DataFrame:
    """doc_id, template (number), license, containment, first_word: the best window per document and template."""
    spark = docs.sparkSession
    listed = [(n, name, words_in(text), marks) for n, (name, text, marks) in enumerate(templates)]
    listed = [(n, name, w, mark_shingles(w, marks, params.shingle)) for n, name, w, marks in listed if w]
    anchors_by_length: dict[int, set[str]] = {}
    for _, _, w, _ in listed:
        anchors_by_length.setdefault(len(w), set()).update(anchors_of(w, params))
    anchors, lengths = sorted(set().union(*anchors_by_length.values())), sorted(anchors_by_length)
    bands = max((bands_needed(lowest_jaccard(n, params), params.rows, params.recall) for n in lengths), default=1)

    known = spark.createDataFrame(listed, "template int, license string, words array<string>, marks array<array<string>>") \
        .withColumn("length", F.size("words")).withColumn("wanted", word_shingles(F.col("words"), params.shingle)) \
        .withColumn("marks", F.transform("marks", lambda m: F.transform(m, lambda s: F.xxhash64(s))))
    known_bands = known.select("template", "license", "length", "wanted", "marks",
                               F.explode(band_hashes(F.col("wanted"), bands, params.rows)).alias("band"))

    lowered = F.lower("text")
    # long anchors by plain search (a longer word may hold them: the exact test follows), short ones as whole words
    any_anchor, short = F.lit(False), [a for a in anchors if len(a) <= 4]
    for a in anchors:
        if a not in short:
            any_anchor = any_anchor | F.contains(lowered, F.lit(a))
    if short:
        any_anchor = any_anchor | lowered.rlike(
            r"(?<![\p{L}\p{N}])(?:" + "|".join(map(re.escape, short)) + r")(?![\p{L}\p{N}])")
    widest = max(lengths, default=1) + stride_of(max(lengths, default=1))
    # long texts are cut into overlapping segments first, so no row builds more than one segment's windows
    segments = F.transform(F.sequence(F.lit(0), F.greatest(F.size("words") - 1, F.lit(0)), F.lit(SEGMENT)),
                           lambda o: F.struct(o.alias("offset"), F.slice("words", o + 1, SEGMENT + widest).alias("words")))
    held = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64("text").alias("__fp"), "text")
            .where(any_anchor)
            .select("doc_id", "__fp", text_words(F.col("text")).alias("words"))
            .select("doc_id", "__fp", F.explode(segments).alias("s"))
            .select("doc_id", "__fp", "s.offset", "s.words")
            .withColumn("hits", F.transform(
                F.filter(F.sequence(F.lit(0), F.size("words") - 1), lambda i: F.get("words", i).isin(anchors)),
                lambda i: i + F.col("offset")))
            .where(F.size("hits") > 0))

    def windows_of(length: int) -> Column:
        """Windows that start in the segment, at a multiple of the stride, and have an anchor."""
        stride = stride_of(length)
        size = length + stride - 1
        over = F.filter("hits", lambda h: F.get("words", (h - F.col("offset")).cast("int")).isin(
            sorted(anchors_by_length[length])))
        starts = F.array_distinct(F.flatten(F.transform(over, lambda h: F.sequence(
            F.greatest(F.ceil((h - F.lit(size - 1)) / F.lit(stride)).cast("int"), F.lit(0)) * stride,
            F.floor(h / stride).cast("int") * stride, F.lit(stride)))))
        own = F.filter(starts, lambda s: (s >= F.col("offset")) & (s < F.col("offset") + SEGMENT))
        return F.transform(own, lambda s: F.struct(
            F.lit(length).alias("length"), s.alias("start"),
            F.slice(F.col("words"), s - F.col("offset") + 1, F.lit(size)).alias("part")))

    windows = (held.select("doc_id", "__fp", F.explode(F.flatten(F.array(*[windows_of(n) for n in lengths]))).alias("w"))
               .select("doc_id", "__fp", "w.length", "w.start",
                       word_shingles(F.col("w.part"), params.shingle).alias("shingles")))
    retrieved = (windows.withColumn("band", F.explode(band_hashes(F.col("shingles"), bands, params.rows)))
                 .join(F.broadcast(known_bands), ["length", "band"])       # templates x bands rows, given by the caller's list
                 .drop("band").dropDuplicates(["doc_id", "__fp", "length", "start", "template"]))
    share = F.size(F.array_intersect("shingles", "wanted")) / F.size("wanted")
    return (retrieved.withColumn("containment", share).where(F.col("containment") >= params.containment - 1e-9)
            .where(F.forall("marks", lambda m: F.arrays_overlap(m, F.col("shingles"))))
            .groupBy("doc_id", "__fp", "template", "license")
            .agg(F.max(F.struct("containment", (-F.col("start")).alias("s"))).alias("best"))
            .select("doc_id", "template", "license", "best.containment", (-F.col("best.s")).alias("first_word")))

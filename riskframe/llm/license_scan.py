"""Licence scan: sparse TF-IDF cosine to templates, inherited down directories.

Every line of a file, and the file as a whole, is a sparse vector of words
and word pairs (lower case, without punctuation) weighted by count times
inverse frequency over the lines of all files; terms in no template weigh
like a term seen once. A line that is ``HEADER`` or more similar to a
template is a licence header and gives the file its licence. A file is a
licence file if its whole text is ``WHOLE`` or more similar to a template,
or its name says so (LICENSE, COPYING, ...) and it has a header: it speaks
for its directory. A file without header takes the licence of its nearest
ancestor directory that has a licence file.

Lines are discarded before their vector is built only where a bound shows
that no cosine can reach the threshold.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.graph import saved, small_batches
from riskframe.llm.text import U64, mix, slices, words

HEADER = 0.7
WHOLE = 0.7
FILE_NAMES = r"(?i)^(licen[sc]e|copying|copyright|unlicense|notice)([._-].*)?$"

# Statements by which licences are given.
TEMPLATES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("Apache-2.0", "you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0-1.0", "Released under CC0 1.0, dedicated to the public domain."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
)


def _terms(h: np.ndarray) -> np.ndarray:
    """Words and pairs of neighbours."""
    return np.concatenate((h, mix(h[:-1] * U64(3) + h[1:]))) if len(h) > 1 else h


class Templates:
    """The templates' terms; ``df`` (lines that have a term) and ``n`` (lines) weigh them."""

    def __init__(self, templates: tuple[tuple[str, str], ...]) -> None:
        self.names = [name for name, _ in templates]
        counts = [Counter(_terms(words(pa.array([t]), punctuation=False).hash).tolist()) for _, t in templates]
        self.terms = np.array(sorted({t for c in counts for t in c}), U64)
        self.count = np.zeros((len(counts), len(self.terms)))
        for i, c in enumerate(counts):
            for t, k in c.items():
                self.count[i, np.searchsorted(self.terms, U64(t))] = k
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.terms >> U64(48)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> np.ndarray:
        """Index of each term, -1 for those in no template."""
        out = np.full(len(h), -1)
        if not len(self.terms):
            return out
        at = np.flatnonzero(self.seen[(h >> U64(48)).astype(np.int64)])
        k = np.minimum(np.searchsorted(self.terms, h[at]), len(self.terms) - 1)
        real = self.terms[k] == h[at]
        out[at[real]] = k[real]
        return out

    def weigh(self, df: np.ndarray, n: int) -> None:
        self.idf = np.log((1 + n) / (1 + df)) + 1
        self.rare = math.log((1 + n) / 2) + 1
        weighted = self.count * self.idf
        self.unit = weighted / np.maximum(np.sqrt((weighted ** 2).sum(axis=1, keepdims=True)), 1e-300)

    def best(self, h: np.ndarray) -> tuple[int, float]:
        """The template nearest to a unit's words, and the cosine."""
        terms, counts = np.unique(_terms(h), return_counts=True)
        k = self.find(terms)
        hit = k >= 0
        norm = math.sqrt(((counts[hit] * self.idf[k[hit]]) ** 2).sum() + ((counts[~hit] * self.rare) ** 2).sum())
        if not hit.any() or not norm:
            return -1, 0.0
        cosine = self.unit[:, k[hit]] @ (counts[hit] * self.idf[k[hit]]) / norm
        return int(cosine.argmax()), float(cosine.max())


def _units(w, found: np.ndarray, pairs: np.ndarray, t: Templates, edges: np.ndarray, least: float) -> np.ndarray:
    """Units (word ranges between ``edges``) whose cosine may reach ``least``.

    With P the squared sum of the weights of template terms and R the summed
    squares of the others, the cosine is at most sqrt(P / (P + R)): counts
    only raise the true norm outside the templates.
    """
    def per(values: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(values)))
        return total[np.maximum(hi, lo)] - total[lo]

    lo, hi = edges[:-1], edges[1:]
    weight = lambda k: np.where(k >= 0, t.idf[k], 0.0)
    inside = per(weight(found), lo, hi) + per(weight(pairs), lo, np.maximum(hi - 1, lo))
    outside = per((found < 0) * 1.0, lo, hi) + per((pairs < 0) * 1.0, lo, np.maximum(hi - 1, lo))
    p = inside ** 2
    return np.flatnonzero((hi > lo) & (p > 0) & (p >= least ** 2 * (p + outside * t.rare ** 2)))


def _lines(w) -> np.ndarray:
    """Word positions where lines begin, texts included, with the end."""
    newline = np.flatnonzero(w.data == 0x0A)
    cuts = np.concatenate((w.bytes, newline + 1))
    return np.unique(np.searchsorted(w.start, np.unique(cuts)))


def _found(w, t: Templates) -> tuple[np.ndarray, np.ndarray]:
    pairs = mix(w.hash[:-1] * U64(3) + w.hash[1:]) if len(w.hash) > 1 else w.hash[:0]
    return t.find(w.hash), np.concatenate((t.find(pairs), [-1]))[:len(w.hash)]


_ROWS = "id bigint, path string, licence string, score double, line string, whole boolean"


def scan(files: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None,
         templates: tuple[tuple[str, str], ...] = TEMPLATES) -> DataFrame:
    """Per row of ``files``: id, path, licence, origin (header, directory or null), score
    and line of the header, licence_dir (the directory inherited from).

    ``path`` gives a file's path; null paths, and files in no directory with
    a licence file, inherit nothing. Null and empty texts have no header. Of
    several headers the most similar counts, then the first; of several
    licence files in a directory the licence most of them name, then the
    first by name. Very long texts are read whole, line by line. Rows that
    repeat are all returned; an empty table gives no rows. Other columns are
    not looked at.
    """
    spark = files.sparkSession
    t = Templates(templates)
    base = small_batches(files).select(F.col(id_col).cast("bigint").alias("id"), (path if path is not None else F.col("path")).alias("path"),
                        F.col(text_col).alias("text"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(t.terms) + 1, np.int64), 0
        for batch in batches:
            for lo, hi in slices(batch.column(0)):
                w = words(batch.column(0).slice(lo, hi - lo), punctuation=False)
                edges = _lines(w)
                n += len(edges) - 1
                line = np.searchsorted(edges, np.arange(len(w.hash)), "right") - 1
                for k, width in zip(_found(w, t), (1, 2), strict=True):
                    at = np.flatnonzero(k >= 0)
                    if width == 2:  # a pair lies in one line
                        at = at[line[at] == line[np.minimum(at + 1, len(line) - 1)]]
                    df[:len(t.terms)] += np.bincount(np.unique(line[at] * len(t.terms) + k[at]) % max(len(t.terms), 1),
                                                     minlength=len(t.terms))
        df[-1] = n
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(df)), pa.int32()), pa.array(df)], names=["term", "df"])

    counted = (base.select("text").mapInArrow(frequencies, "term int, df bigint").groupBy("term")
               .agg(F.sum("df").alias("df")).collect())  # a row a template term
    df = np.zeros(len(t.terms) + 1, np.int64)
    for r in counted:
        df[r["term"]] = r["df"]
    t.weigh(df[:-1].astype(float), int(df[-1]))
    shared = spark.sparkContext.broadcast(t)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        for batch in batches:
            for lo, hi in slices(batch.column(2)):
                w = words(batch.column(2).slice(lo, hi - lo), punctuation=False)
                found, pairs = _found(w, t)
                names, scores, text, whole = ([None] * (hi - lo) for _ in range(4))
                edges = _lines(w)
                owner = np.searchsorted(w.offsets, edges[:-1], "right") - 1
                for u in _units(w, found, pairs, t, edges, HEADER):
                    b, e, i = edges[u], edges[u + 1], owner[u]
                    k, score = t.best(w.hash[b:e])
                    if score >= HEADER and (scores[i] is None or score > scores[i] + 1e-12):
                        names[i], scores[i] = t.names[k], score
                        text[i] = bytes(w.data[w.start[b]:w.end[e - 1]]).decode()
                for i in _units(w, found, pairs, t, w.offsets, WHOLE):
                    k, score = t.best(w.of(i))
                    whole[i] = score >= WHOLE
                    if whole[i] and scores[i] is None:
                        names[i], scores[i] = t.names[k], score
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(scores, pa.float64()),
                     pa.array(text, pa.string()), pa.array([bool(x) for x in whole], pa.bool_())],
                    names=["id", "path", "licence", "score", "line", "whole"])

    own = saved(base.mapInArrow(match, _ROWS), "headers")
    folder = F.regexp_extract("path", r"(?s)^(.*)/[^/]*$", 1)  # "" for a file at the top
    name = F.regexp_extract("path", r"(?s)([^/]*)$", 1)
    placed = own.withColumn("folder", folder)
    votes = (placed.filter("path is not null and licence is not null").filter(F.col("whole") | name.rlike(FILE_NAMES))
             .groupBy("folder", "licence").agg(F.count("*").alias("n")))
    speaks = votes.groupBy("folder").agg(F.min(F.struct((-F.col("n")).alias("n"), "licence")).alias("x")).select(
        F.col("folder").alias("licence_dir"), F.col("x.licence").alias("given"))
    # Ancestors are looked up once a directory, not once a file.
    parts = F.split("folder", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.array_join(F.slice(parts, F.lit(1), n), "/"))
    folders = placed.filter("path is not null").select("folder").distinct()
    nearest = (folders.withColumn("licence_dir", F.explode(F.array_distinct(up))).join(speaks, "licence_dir")
               .groupBy("folder").agg(F.max(F.struct(F.length("licence_dir").alias("n"), "licence_dir", "given")).alias("x"))
               .select("folder", "x.licence_dir", "x.given"))
    out = placed.join(nearest, "folder", "left")
    header = F.col("licence").isNotNull()
    return out.select(
        F.col("id").alias(id_col), "path", F.coalesce("licence", "given").alias("licence"),
        F.when(header, F.lit("header")).when(F.col("given").isNotNull(), F.lit("directory")).alias("origin"),
        "score", "line", F.when(~header, F.col("licence_dir")).alias("licence_dir"))

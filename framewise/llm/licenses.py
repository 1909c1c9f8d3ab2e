"""License scan: TF-IDF cosine to templates, then inheritance by directory.

Every line and every block of lines of a file (a header's notice) and the file
as a whole (a licence file) is a sparse TF-IDF vector; its cosine to the
vectors of the licence templates names the best template.  Templates are of
two kinds: notices that licences ask to be put into files, and whole licence
texts (``license_texts/``).  Lines and blocks are held against notices, whole
files against both.  A block is a run of lines with words that all begin with
a comment mark or all with none.  Whole texts have a threshold of their own,
since long texts resemble each other by their common words.  Document frequencies of the templates'
words are counted over all files; a word outside the templates weighs like a
word of one file.  A file whose whole text reaches the threshold is known by
that text; a file with a line or block that does has a header.  A directory's
licence file is one of the first kind that resembles a whole licence text, or
a notice in a file with a licence file's name: a short document that is little
but a notice speaks for itself only.  All other files inherit from the nearest
directory above them, their own included, that holds a licence file: the distinct directories are joined with the ancestors
of their paths, the files with their directory's answer.

The template vectors are fixed and small; nothing else is broadcast.  Files of
one directory meet no other file, so a directory with a third of all files
only means a join key that Spark splits.

Defined results.  Null or empty text: no own licence, may inherit.  Null path:
the root directory.  Ties of score: the template named first; licence files of
one directory: the best score, then the first template, then the first path.
Repeated rows: each is answered.  Empty table: empty result.  Columns other
than id, path and text are not carried.
"""

from __future__ import annotations

import functools
import math
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from framewise.llm.common import bounded_batches, byte_codes, flat, mix, utf8, word_hashes, write_scratch

#: Least cosine to a notice, and to a whole licence text.
THRESHOLD, TEXT_THRESHOLD = 0.6, 0.85
#: Whole licence texts by name, without their holders' names.
TEXTS = tuple((f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in sorted(
    (resources.files("framewise.llm") / "license_texts").iterdir(), key=lambda f: f.name) if f.name.endswith(".txt"))
#: Notices that licences ask to be put into files.
NOTICES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                   "file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation, either version "
                "3 of the License, or (at your option) any later version."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
            "and associated documentation files (the \"Software\"), to deal in the Software without "
            "restriction"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of "
                "the GNU General Public License as published by the Free Software Foundation; either version "
                "2 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of "
                 "the GNU Lesser General Public License as published by the Free Software Foundation; either "
                 "version 2.1 of the License, or (at your option) any later version."),
    *(("MIT", part) for part in dict(TEXTS)["MIT"].split("\n\n") if part.startswith("Permission")),
)
TEMPLATES = NOTICES + TEXTS


def _hashed(texts: list[str]):
    data, offsets = utf8(pa.array(texts, pa.string()))
    h, _, _, first = word_hashes(data, offsets, byte_codes("alnum", True))
    return h, first


@functools.lru_cache(maxsize=1)
def vocabulary() -> np.ndarray:
    """Hashes of the templates' words, ascending."""
    return np.unique(_hashed([t for _, t in TEMPLATES])[0])


class Vectors:
    """Template vectors under the document frequencies ``df`` of ``files``."""

    def __init__(self, df: np.ndarray, files: int) -> None:
        self.words = vocabulary()
        self.idf = np.log((1 + files) / (1.0 + df)) + 1
        self.rare = math.log((1 + files) / 2) + 1
        h, first = _hashed([t for _, t in TEMPLATES])
        self.matrix = np.zeros((len(TEMPLATES), len(self.words)))
        at = np.searchsorted(self.words, h)
        np.add.at(self.matrix, (np.repeat(np.arange(len(TEMPLATES)), np.diff(first)), at), 1)
        self.matrix *= self.idf
        self.matrix /= np.linalg.norm(self.matrix, axis=1, keepdims=True)

    def best(self, unit: np.ndarray, h: np.ndarray, units: int) -> tuple[np.ndarray, np.ndarray]:
        """Best cosine and its template for each of ``units`` texts, given the
        ascending text number of every word hash."""
        return self.reached(unit, h, units, [0.0] * len(TEMPLATES))[:2]

    def reached(self, unit: np.ndarray, h: np.ndarray, units: int, least: list[float]):
        """Cosine and template of each text, and whether the cosine reaches the
        template's number in ``least``; the best of those that do, or else the
        best.  Only the first ``len(least)`` templates are compared."""
        if not len(h):
            return np.zeros(units), np.zeros(units, np.int64), np.zeros(units, bool)
        key = mix(unit.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ h)
        _, index, tf = np.unique(key, return_index=True, return_counts=True)
        unit, h = unit[index], h[index]
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        own = self.words[at] == h
        weight = tf * np.where(own, self.idf[at], self.rare)
        norm = np.sqrt(np.bincount(unit, weight * weight, units))
        unit, at, weight = unit[own], at[own], weight[own]
        score, which, held = np.zeros(units), np.zeros(units, np.int64), np.zeros(units, bool)
        for t, enough in enumerate(least):
            dot = np.bincount(unit, weight * self.matrix[t, at], units)
            cosine = np.divide(dot, norm, out=np.zeros(units), where=norm > 0)
            reach = cosine >= enough
            better = reach & ~held | (reach == held) & (cosine > score + 1e-12)
            score[better], which[better], held[better] = cosine[better], t, reach[better]
        return score, which, held


def _frequencies(batches):
    words, total = vocabulary(), None
    files = 0
    for batch in batches:
        h, first = _words(batch)
        at = np.minimum(np.searchsorted(words, h), len(words) - 1)
        own = words[at] == h
        doc = np.repeat(np.arange(batch.num_rows), np.diff(first))[own]
        once = np.unique(doc * len(words) + at[own]) % len(words)
        n = np.bincount(once, minlength=len(words))
        total, files = n if total is None else total + n, files + batch.num_rows
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, len(words))), pa.array(np.append(files, total))], names=["word", "n"])


def _words(batch):
    data, offsets = utf8(flat(batch, "text"))
    h, _, _, first = word_hashes(data, offsets, byte_codes("alnum", True))
    return h, first


# Names of files that speak for their directory.
FILE_NAMES = r"(?i)(^|/)(licen[cs]e|copying|copyright|unlicense|notice)s?([-_.][^/]*)?$"
NOTICE_LEAST = [THRESHOLD] * len(NOTICES)
FILE_LEAST = NOTICE_LEAST + [TEXT_THRESHOLD] * len(TEXTS)


def blocks(data: np.ndarray, doc: np.ndarray, line: np.ndarray, begins: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Ascending block number of every word, given its text, line and start."""
    if not len(s):
        return line
    marks = np.append(0, np.cumsum((data > 32) & (data < 128)))
    opens = np.append(True, line[1:] != line[:-1])  # first word of its line
    marked = (marks[s[opens]] > marks[begins[line[opens]]])[np.cumsum(opens) - 1]
    ends = (np.diff(line) > 1) | (np.diff(doc) > 0) | (marked[1:] != marked[:-1])
    return np.append(0, np.cumsum(ends))


def _scan(batches, vectors):
    v, codes = vectors.value, byte_codes("alnum", True)
    for batch in batches:
        data, offsets = utf8(flat(batch, "text"))
        h, s, _, first = word_hashes(data, offsets, codes)
        doc = np.repeat(np.arange(batch.num_rows), np.diff(first))
        whole, which, held = v.reached(doc, h, batch.num_rows, FILE_LEAST)
        # lines are numbered over the batch: a text begins a line, and so does a line feed
        begins = np.unique(np.concatenate([offsets[:-1], np.flatnonzero(data == 10) + 1]))
        line = np.searchsorted(begins, s, side="right") - 1
        header, named = np.zeros(batch.num_rows), np.zeros(batch.num_rows, np.int64)
        for unit in (line, blocks(data, doc, line, begins, s)):
            units = int(unit[-1]) + 1 if len(unit) else 0
            score, template, reach = v.reached(unit, h, units, NOTICE_LEAST)
            at = np.flatnonzero(reach)
            for i, d in zip(at, doc[np.searchsorted(unit, at)], strict=True):
                if score[i] > header[d] + 1e-12:
                    header[d], named[d] = score[i], template[i]
        names = [n for n, _ in TEMPLATES]
        yield pa.RecordBatch.from_arrays(
            [flat(batch, "id"), flat(batch, "path"), pa.array(whole), pa.array(header),
             pa.array([names[k] if x else None for k, x in zip(which, held, strict=True)], pa.string()),
             pa.array([names[k] if x else None for k, x in zip(named, header, strict=True)], pa.string()),
             pa.array(np.asarray(held, bool) & (which >= len(NOTICES)))],
            names=["id", "path", "file_score", "header_score", "file_license", "header_license", "is_text"])


def directory(path: Column) -> Column:
    """The part before the last slash; the root is the empty string."""
    return F.regexp_replace(F.regexp_replace(F.coalesce(path, F.lit("")), "^/+", ""), "(^|/)[^/]*$", "")


def ancestors(directory: Column) -> Column:
    """(depth, dir) of a directory and all above it, the root included."""
    parts = F.when(directory == "", F.array().cast("array<string>")).otherwise(F.split(directory, "/"))
    return F.transform(F.sequence(F.lit(0), F.size(parts)), lambda n: F.struct(
        n.alias("depth"), F.array_join(F.slice(parts, F.lit(1), n), "/").alias("up")))


def scan(files: DataFrame, id_col: str, path: str, text: str = "text") -> DataFrame:
    """(id, path, file_license, file_score, header_license, header_score,
    license, origin, from_dir): ``license`` is the file's own or inherited one,
    ``origin`` says which ("file", "header", "inherited" or null)."""
    spark = files.sparkSession
    bounded_batches(spark)
    rows = files.select(F.col(id_col).alias("id"), F.col(path).alias("path"), F.col(text).alias("text"))
    counted = rows.select("text").mapInArrow(_frequencies, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    n = {r.word: r.n for r in counted.collect()}  # one row for each template word
    vectors = spark.sparkContext.broadcast(
        Vectors(np.array([n.get(i, 0) for i in range(len(vocabulary()))], float), n.get(-1, 0)))
    id_type = rows.schema["id"].dataType.simpleString()
    own = write_scratch(rows.mapInArrow(
        lambda it: _scan(it, vectors),
        f"id {id_type}, path string, file_score double, header_score double, "
        "file_license string, header_license string, is_text boolean").withColumn("dir", directory(F.col("path"))), "licenses")
    names = F.array(*(F.lit(x) for x in dict.fromkeys(t for t, _ in TEMPLATES)))
    speaks = F.col("is_text") | (F.col("file_license").isNotNull() & F.coalesce(F.col("path"), F.lit("")).rlike(FILE_NAMES))
    held = own.where(speaks).groupBy(F.col("dir").alias("up")).agg(
        F.min(F.struct((-F.round("file_score", 9)).alias("s"), F.array_position(names, F.col("file_license")).alias("k"),
                       "path", "file_license")).alias("best"))
    held = write_scratch(held.select("up", F.col("best.file_license").alias("inherited")), "license-dirs")
    above = own.select("dir").distinct().select("dir", F.explode(ancestors(F.col("dir"))).alias("a")).select(
        "dir", "a.depth", "a.up")
    nearest = above.join(held, "up").groupBy("dir").agg(
        F.max(F.struct("depth", "up", "inherited")).alias("near"))
    nearest = write_scratch(nearest.select("dir", "near.up", "near.inherited"), "license-nearest")
    joined = own.join(nearest, "dir", "left")
    origin = (F.when(F.col("file_license").isNotNull(), "file").when(F.col("header_license").isNotNull(), "header")
              .when(F.col("inherited").isNotNull(), "inherited"))
    return joined.select(
        "id", "path", "file_license", "file_score", "header_license", "header_score",
        F.coalesce("file_license", "header_license", "inherited").alias("license"), origin.alias("origin"),
        F.when(origin == "inherited", F.col("up")).alias("from_dir"))

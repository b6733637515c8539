"""License scans: exact phrases, and templates found by votes of word k-grams on offset diagonals."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from caskline.llm.common import slices, spread, text_bytes, word_hashes

#: Words of a gram, and the share of a template's words that a verified span must hold in order.
GRAM, COVERAGE = 4, 0.8
#: Text bytes handled at a time inside a task.
PIECE = 2 << 20
#: A template table up to this many grams is broadcast; a larger one is joined by shuffle.
BROADCAST_GRAMS = 200_000

# The phrases that the scan must report, and the labels they stand for.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Notices as their publishers word them. A label may have several.
TEMPLATES = (
    ("apache", "Licensed under the Apache License, Version 2.0"),
    (
        "apache",
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software "
        'distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, '
        "either express or implied. See the License for the specific language governing permissions and limitations under "
        "the License.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
        "to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial portions of the "
        "Software.",
    ),
    ("mit", "Released under the MIT License"),
    (
        "gpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
        "License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any "
        "later version.",
    ),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    (
        "lgpl",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
        "Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your "
        "option) any later version.",
    ),
    (
        "agpl",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) "
        "any later version.",
    ),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "mpl",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-nd", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License"),
    ("cc-by-nd", "Licensed under CC BY-ND 4.0"),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work"),
    ("proprietary", "All rights reserved. No part of this publication may be reproduced without prior written permission"),
)

_CODE = np.arange(256)
_IS_WORD = ((_CODE >= 0x30) & (_CODE <= 0x39)) | ((_CODE | 0x20) >= 0x61) & ((_CODE | 0x20) <= 0x7A) | (_CODE >= 0x80)
_LOWER = np.where((_CODE >= 0x41) & (_CODE <= 0x5A), _CODE | 0x20, _CODE).astype(np.uint8)


def _words(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = text_bytes(column)
    return word_hashes(_LOWER[data], bounds, _IS_WORD)


def _grams(words: np.ndarray, k: int) -> np.ndarray:
    """Rolling hashes of k words; those over the end of a text are the caller's to leave out."""
    out = np.zeros(max(0, len(words) - k + 1), np.uint64)
    for j in range(k):
        out = spread(out ^ words[j : len(words) - k + 1 + j])
    return out


def _kept_grams(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Offsets of lists of each text's grams, and a mask of the grams that lie within one text."""
    n = np.diff(first)
    count = np.maximum(n - k + 1, 0)
    total = max(0, int(first[-1]) - k + 1)
    mask = np.zeros(int(first[-1]) + 1, np.int64)
    np.add.at(mask, first[:-1], 1)
    np.add.at(mask, first[:-1] + count, -1)
    return np.concatenate([[0], np.cumsum(count)]), np.cumsum(mask)[:total] > 0


def phrase_places(docs: DataFrame, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """For rows (_id, _print, _t): words, places of the phrases, smallest and largest start, labels."""
    sought = [(_words(pa.array([text]))[0], label) for text, label in phrases]
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_t", PIECE):
            words, first = _words(batch.column("_t"))
            rows = len(first) - 1
            found: dict[int, tuple[list[int], set[str]]] = {}
            for phrase, label in sought:
                m = len(phrase)
                at = np.flatnonzero(words[: max(0, len(words) - m + 1)] == phrase[0])
                for j in range(1, m):
                    at = at[words[at + j] == phrase[j]]
                row = np.searchsorted(first, at, side="right") - 1
                ok = at + m <= first[row + 1]
                for r, place in zip(row[ok].tolist(), (at - first[row])[ok].tolist(), strict=True):
                    places, labels = found.setdefault(r, ([], set()))
                    places.append(place)
                    labels.add(label)
            none: tuple[list[int], set[str]] = ([], set())
            hits = [found.get(r, none) for r in range(rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_id"),
                    batch.column("_print"),
                    pa.array(np.diff(first), pa.int64()),
                    pa.array([len(p) for p, _ in hits], pa.int64()),
                    pa.array([min(p, default=None) for p, _ in hits], pa.int64()),
                    pa.array([max(p, default=None) for p, _ in hits], pa.int64()),
                    pa.array([sorted(x) for _, x in hits], pa.list_(pa.string())),
                ],
                names=["_id", "_print", "n_words", "n_base", "first_word", "last_word", "_base"],
            )

    return docs.mapInArrow(
        run,
        f"_id {kind}, _print bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, _base array<string>",
    )


def template_grams(spark, templates: Sequence[tuple[str, str]] = TEMPLATES, k: int = GRAM) -> DataFrame:
    """(gram, template, label, length, position) of every gram; a template of fewer than k words has none."""
    rows = []
    for number, (label, text) in enumerate(templates):
        words, _ = _words(pa.array([text]))
        rows += [
            (int(g), number, label, len(words), position)
            for position, g in enumerate(_grams(words, k).view(np.int64).tolist())
        ]
    schema = "gram long, template int, label string, length int, place int"
    frame = spark.createDataFrame(rows, schema)
    return F.broadcast(frame) if len(rows) <= BROADCAST_GRAMS else frame


def template_spans(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, k: int = GRAM, coverage: float = COVERAGE) -> DataFrame:
    """Spans of rows (_id, _print, _t) that repeat a template, from votes on diagonals.

    All rolling k-grams of all texts are joined to the templates' grams. A match votes for the diagonal
    (word minus template word). Diagonals of a template that differ by at most a quarter of its length
    (5 words at most) and lie within its length of each other are one span, which allows words put in
    or left out. A span is verified if the matched grams hold ``coverage`` of the template's words and
    it is at most half longer than the template.
    Returns _id, _print, label, first, last (words), score (the coverage).
    """
    kind = docs.schema["_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "_t", PIECE):
            words, first = _words(batch.column("_t"))
            offsets, within = _kept_grams(first, k)
            grams = _grams(words, k)[within].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_print"), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(grams))],
                names=["_id", "_print", "grams"],
            )

    grams = docs.mapInArrow(run, f"_id {kind}, _print bigint, grams array<bigint>").select(
        "_id", "_print", F.posexplode("grams").alias("word", "gram")
    )
    votes = (
        grams.join(template_grams(docs.sparkSession, templates, k), "gram")
        .groupBy("_id", "_print", "template", "label", "length", (F.col("word") - F.col("place")).alias("diagonal"))
        .agg(F.min("word").alias("first"), F.max("word").alias("last"), F.collect_set("place").alias("places"))
    )
    slack = F.least(F.lit(5), F.floor(F.col("length") / 4)).cast("int")
    by = Window.partitionBy("_id", "_print", "template").orderBy("diagonal")
    near = (F.col("diagonal") - F.lag("diagonal").over(by) <= slack) & (
        F.abs(F.col("first") - F.lag("last").over(by)) <= F.col("length")
    )
    spans = (
        votes.withColumn("_new", F.when(near, 0).otherwise(1))
        .withColumn("_span", F.sum("_new").over(by))
        .groupBy("_id", "_print", "template", "label", "length", "_span")
        .agg(
            F.min("first").alias("first"),
            (F.max("last") + (k - 1)).alias("last"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("places")))).alias("places"),
        )
    )
    held = F.aggregate(
        "places",
        F.struct(F.lit(-k).alias("at"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("at"), (a["n"] + F.least(F.lit(k), p - a["at"])).alias("n")),
        lambda a: a["n"],
    )
    return (
        spans.withColumn("score", held / F.col("length"))
        .where((F.col("score") >= coverage) & (F.col("last") - F.col("first") + 1 <= 1.5 * F.col("length")))
        .select("_id", "_print", "label", "first", "last", "score")
    )


def scan_licenses(
    docs: DataFrame,
    phrases: Sequence[tuple[str, str]] = PHRASES,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Label every document with the licenses it names (phrases) or carries (template spans).

    Returns id, n_words, n_base, first_word, last_word, base_labels, labels, score. The score is 1 with
    a phrase, else the best coverage of a verified span, else 0. Null and empty texts have no words and
    no labels (empty strings). Repeated rows are scanned each; rows are told apart by id and text hash.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text_col).alias("_print"), F.coalesce(F.col(text_col), F.lit("")).alias("_t"))
    found = (
        template_spans(rows, templates)
        .groupBy("_id", "_print")
        .agg(F.collect_set("label").alias("_more"), F.max("score").alias("_best"))
    )
    base = phrase_places(rows, phrases)
    joined = base.join(
        found.select(F.col("_id").alias("_fid"), F.col("_print").alias("_fprint"), "_more", "_best"),
        F.col("_id").eqNullSafe(F.col("_fid")) & (F.col("_print") == F.col("_fprint")),
        "left",
    )
    labels = F.array_union("_base", F.coalesce("_more", F.array().cast(T.ArrayType(T.StringType()))))
    return joined.select(
        F.col("_id").alias(id_col),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )

"""License scan: templates retrieved by MinHash bands over text windows, verified by containment.

For a template of m words a text is covered by overlapping windows, placed so that any m words in a
row lie inside one of them. A window that holds enough of the template's five-word shingles has at
least a known Jaccard similarity with it; bands and rows are set so that such a window shares a band
key with a probability of ``CERTAINTY``. Every window that does is verified: the template's shingles
in it are counted exactly.

A band can only agree where the shingle with the template's least hash is in the window, so windows
without any such shingle are passed over before signatures are made. Templates are few and travel
with the task; texts do not move.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
CONTAINMENT = 0.75
CERTAINTY = 0.9999
MOST_SAMPLES = 160

# Wording of common licenses' notices.
TEMPLATES = (
    ("apache-2.0-short", "Licensed under the Apache License, Version 2.0"),
    (
        "apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file "
        "except in compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to "
        "in writing, software distributed under the License is distributed on an AS IS BASIS, "
        "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    (
        "bsd-2-clause",
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met: Redistributions of source code "
        "must retain the above copyright notice, this list of conditions and the following "
        "disclaimer. Redistributions in binary form must reproduce the above copyright notice, this "
        "list of conditions and the following disclaimer in the documentation and/or other "
        "materials provided with the distribution.",
    ),
    ("cc-by-nc-4.0-short", "Licensed under CC BY-NC 4.0"),
    (
        "cc-by-sa-4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International "
        "License",
    ),
    (
        "gpl-3.0-short",
        "This work is licensed under the GNU General Public License, version 3",
    ),
    (
        "gpl-3.0-or-later",
        "This program is free software: you can redistribute it and/or modify it under the terms of "
        "the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this "
        "permission notice appear in all copies.",
    ),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the Software), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions: The above "
        "copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    ("mit-short", "Released under the MIT License"),
    (
        "mpl-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a "
        "copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/.",
    ),
    (
        "unlicense",
        "This is free and unencumbered software released into the public domain. Anyone is free to "
        "copy, modify, publish, use, compile, sell, or distribute this software, either in source "
        "code form or as a compiled binary, for any purpose, commercial or non-commercial, and by "
        "any means.",
    ),
)


class Template(NamedTuple):
    name: str
    shingles: np.ndarray
    window: int
    stride: int
    bands: int
    rows: int
    keys: np.ndarray
    least: np.ndarray


def band_settings(similarity: float, certainty: float = CERTAINTY) -> tuple[int, int]:
    """(bands, rows): as many rows as the samples allow at this certainty."""
    for rows in range(4, 0, -1):
        bands = math.ceil(math.log(1 - certainty) / math.log(1 - similarity**rows))
        if bands * rows <= MOST_SAMPLES:
            return bands, rows
    raise ValueError("the windows are too long for a template so short")


def _letters() -> W.Alphabet:
    return W.alphabet(lower=True, alphanumeric=True)


def _samples(hashes: np.ndarray, n: int) -> np.ndarray:
    return W.mix(hashes[None, :] ^ W.random_words(n, 31)[:, None])


def _keys(samples: np.ndarray, bands: int, rows: int) -> np.ndarray:
    key = np.arange(bands, dtype=np.uint64)
    least = samples.min(axis=1).reshape(bands, rows)
    for i in range(rows):
        key = W.mix(key ^ least[:, i])
    return key


def prepare(name: str, text: str) -> Template:
    words = W.words_of(pa.array([text]), _letters())
    m = len(words.hashes)
    if m < SHINGLE:
        raise ValueError(f"template {name} has fewer than {SHINGLE} words")
    shingles = np.unique(W.windows(words, SHINGLE)[0])
    window = m + max(3, m // 4)
    in_window = window - SHINGLE + 1
    common = math.ceil(CONTAINMENT * len(shingles))
    bands, rows = band_settings(common / (len(shingles) + in_window - common))
    samples = _samples(shingles, bands * rows)
    return Template(
        name,
        shingles,
        window,
        window - m + 1,
        bands,
        rows,
        _keys(samples, bands, rows),
        np.unique(shingles[samples.argmin(axis=1)]),
    )


def scan(
    docs: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(key, license, containment, first_word, last_word): one row for each row of ``docs`` and each
    template found in it, from the window with most of it, the first of equals.

    Words are runs of ASCII letters, digits and other alphabets, without regard to A-Z in capitals,
    counted from 0; ``last_word`` is included. ``containment`` is the share of the template's
    distinct shingles, at least ``CONTAINMENT``. Empty and null texts match nothing; repeated rows
    match each; other columns are ignored; no rows give none.
    """
    prepared = [prepare(name, body) for name, body in templates]
    schema = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            T.StructField("license", T.StringType()),
            T.StructField("containment", T.DoubleType()),
            T.StructField("first_word", T.LongType()),
            T.StructField("last_word", T.LongType()),
        ]
    )

    def matches(template: Template, own: np.ndarray, hits: np.ndarray):
        """Best (containment, first, last) among one text's windows that cover ``hits``."""
        lowest = np.maximum(0, -(-(hits + SHINGLE - template.window) // template.stride))
        highest = hits // template.stride
        best = None
        wanted = np.unique(
            np.concatenate([np.arange(a, b + 1) for a, b in zip(lowest, highest, strict=True)])
        )
        for begin in (wanted * template.stride).tolist():
            inside = own[begin : begin + template.window - SHINGLE + 1]
            if not len(inside):
                continue
            keys = _keys(
                _samples(inside, template.bands * template.rows), template.bands, template.rows
            )
            if not (keys == template.keys).any():
                continue
            found = np.isin(inside, template.shingles)
            share = len(np.unique(inside[found])) / len(template.shingles)
            if share >= CONTAINMENT and (best is None or share > best[0]):
                at = np.flatnonzero(found)
                best = (share, begin + int(at[0]), begin + int(at[-1]) + SHINGLE - 1)
        return best

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = _letters()
        signal = np.unique(np.concatenate([t.least for t in prepared])) if prepared else None
        for batch in batches:
            for block in W.blocks(batch, "text"):
                found = []
                words = W.words_of(block.column("text"), letters)
                hashes, at = W.windows(words, SHINGLE)
                if signal is not None and len(hashes):
                    place = np.searchsorted(signal, hashes)
                    place[place == len(signal)] = 0
                    hits = np.flatnonzero(signal[place] == hashes)
                    rows = words.rows[at[hits]]
                    for row in np.unique(rows).tolist():
                        a = np.searchsorted(at, words.first[row])
                        b = np.searchsorted(at, words.first[row + 1])
                        own = hashes[a:b]
                        places = hits[rows == row] - a
                        for template in prepared:
                            near = places[np.isin(own[places], template.least)]
                            if len(near) and (best := matches(template, own, near)):
                                found.append((row, template.name, *best))
                columns = list(zip(*found, strict=True)) if found else [()] * 5
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("key").take(pa.array(columns[0], pa.int64())),
                        pa.array(columns[1], pa.string()),
                        pa.array(columns[2], pa.float64()),
                        pa.array(columns[3], pa.int64()),
                        pa.array(columns[4], pa.int64()),
                    ],
                    names=schema.names,
                )

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        run, schema
    )

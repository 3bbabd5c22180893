"""Statistics of texts, computed for many texts at once from their bytes."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W
from tillroll.llm.frames import new_name

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATISTICS = (
    "words",
    "word_length",
    "short_words",
    "long_words",
    "distinct_words",
    "top_word",
    "distinct_pairs",
    "repeated_fives",
    "lines",
    "line_words",
    "repeated_lines",
    "ended_lines",
    "sentence_ends",
    "capitals",
    "digits",
    "signs",
    "symbols",
    "exclamations",
    "other_alphabets",
)


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics_of(texts: pa.Array) -> list[np.ndarray]:
    """One array of doubles for each of ``STATISTICS``; shares are 0 where the whole is empty."""
    words = W.words_of(texts, W.alphabet())
    data, offsets = words.data, words.offsets
    n = len(texts)
    n_words = np.diff(words.first)
    size = np.diff(offsets)

    def bytes_in(*values: int) -> np.ndarray:
        mask = np.zeros(256, dtype=bool)
        mask[list(values)] = True
        return W.sums_by_row(mask[data].astype(np.int64), offsets)

    def by_word(mask: np.ndarray) -> np.ndarray:
        return W.sums_by_row(mask.astype(np.int64), words.first)

    def distinct(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct values, the most frequent's count, and values seen again, by text."""
        rows, _, times = W.distinct_by_row(rows, hashes)
        spans = W.row_spans(rows, n)
        most = np.zeros(n, np.int64)
        full = np.flatnonzero(np.diff(spans))
        if len(full):
            most[full] = np.maximum.reduceat(times, spans[:-1][full])
        again = W.sums_by_row(np.where(times > 1, times, 0), spans)
        return np.diff(spans), most, again

    length = words.ends - words.starts
    last = data[words.ends - 1] if len(words.ends) else np.zeros(0, np.uint8)
    ended = (last == 46) | (last == 33) | (last == 63)
    kinds, most, _ = distinct(words.rows, words.hashes)
    pairs, at = W.windows(words, 2)
    pair_kinds, _, _ = distinct(words.rows[at], pairs)
    fives, at = W.windows(words, 5)
    _, _, again = distinct(words.rows[at], fives)

    # A line's hash is the sum over its words of their hashes and places.
    line = np.zeros(len(data) + 1, np.int64)
    np.cumsum(data == 10, out=line[1:])
    own_line = line[words.starts]
    begins = np.ones(len(own_line), dtype=bool)
    begins[1:] = (own_line[1:] != own_line[:-1]) | (words.rows[1:] != words.rows[:-1])
    first = np.flatnonzero(begins)
    lines = np.zeros(n, np.int64)
    line_repeats, line_ends = np.zeros(n, np.int64), np.zeros(n, np.int64)
    if len(first):
        place = np.arange(len(own_line)) - np.repeat(first, np.diff(np.append(first, len(own_line))))
        value = W.mix(words.hashes + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        hashes = np.add.reduceat(value, first)
        rows = words.rows[first]
        spans = W.row_spans(rows, n)
        lines = np.diff(spans)
        different, _, _ = distinct(rows, hashes)
        line_repeats = lines - different
        final = np.append(first[1:], len(own_line)) - 1
        line_ends = W.sums_by_row(ended[final].astype(np.int64), spans)

    letters = bytes_in(*range(65, 91), *range(97, 123))
    return [
        x.astype(np.float64)
        for x in (
            n_words,
            _share(by_word(length) if len(length) else np.zeros(n), n_words),
            _share(by_word(length <= 3), n_words),
            _share(by_word(length >= 15), n_words),
            _share(kinds, n_words),
            _share(most, n_words),
            _share(pair_kinds, n_words - 1),
            _share(again, n_words - 4),
            lines,
            _share(n_words, lines),
            _share(line_repeats, lines),
            _share(line_ends, lines),
            _share(by_word(ended), n_words),
            _share(bytes_in(*range(65, 91)), letters),
            _share(bytes_in(*range(48, 58)), size),
            _share(bytes_in(*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)), size),
            _share(bytes_in(*b"#*$%&|<>"), size),
            _share(bytes_in(33), n_words),
            _share(bytes_in(*range(128, 256)), size),
        )
    ]


def with_statistics(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns in ``keep`` (default: all) and the statistics (doubles), one row for each row.

    A null text is empty. Input columns named like a statistic are replaced.
    """
    names = [c for c in (docs.columns if keep is None else keep) if c.lower() not in STATISTICS]
    schema = T.StructType(
        [
            *[docs.schema[name] for name in names],
            *[T.StructField(name, T.DoubleType()) for name in STATISTICS],
        ]
    )
    body = new_name(docs, "__text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch, body):
                yield pa.RecordBatch.from_arrays(
                    [
                        *[block.column(name) for name in names],
                        *map(pa.array, statistics_of(block.column(body))),
                    ],
                    names=schema.names,
                )

    return docs.select(
        *[F.col(f"`{name}`") for name in names], F.col(text).cast("string").alias(body)
    ).mapInArrow(run, schema)

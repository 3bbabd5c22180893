"""Document fingerprints by consistent weighted sampling (Ioffe, 2010).

A text is a set of words weighted by how often they occur. For each of ``SAMPLES`` samples every word
draws two Gamma(2, 1) variables and a uniform one, all hashed from the word, which say at which steps
of the weight the word's score changes; the word with the least score and its step are the sample.
Two texts agree in a sample with a probability equal to their generalised Jaccard similarity, the sum
of the smaller weights over the sum of the larger ones. A fingerprint keeps 16 bits of each sample.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W
from tillroll.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAMPLES = 128

_SOME = 512  # words that draw at a time, so that their numbers stay in cache
_TERMS = 32768  # different (word, number of times) whose draws are held at a time
_STEP = np.uint64(0xD1342543DE82EF95)


def _steps(terms: np.ndarray, times: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray]:
    """By term and sample: the score, as an integer that orders alike, above the term's place in 32
    bits; and the step of the weight at which the term has that score."""
    order = np.empty((len(terms), samples), np.int64)
    step = np.empty((len(terms), samples), np.float32)
    salt = W.random_words(samples, 51)
    scale, half, tiny = np.float32(2.0**-32), np.float32(0.5), np.float32(1e-9)

    def halves(bits: np.ndarray) -> np.ndarray:
        """Two uniform numbers from each 64 bits, on the last axis."""
        wide = bits.view(np.uint32).reshape(*bits.shape, 2).astype(np.float32)
        wide += half
        wide *= scale
        return wide

    def gamma(bits: np.ndarray) -> np.ndarray:
        """A Gamma(2, 1) number from each 64 bits."""
        pair = halves(bits)
        return np.maximum(-np.log(pair[..., 0] * pair[..., 1]), tiny)

    weight = np.log(times.astype(np.float32))
    for a in range(0, len(terms), _SOME):
        part = slice(a, a + _SOME)
        one = W.mix(terms[part, None] ^ salt[None, :])
        two = W.mix(one + np.uint64(0x9E3779B97F4A7C15))
        r, c, beta = gamma(one), gamma(two), halves(W.mix(two ^ one))[..., 1]
        t = np.floor(weight[part, None] / r + beta)
        step[part] = t
        bits = (np.log(c) - r - r * (t - beta)).view(np.int32).astype(np.int64)
        order[part] = np.where(bits < 0, bits ^ 0x7FFFFFFF, bits) << 32
    order |= np.arange(len(terms))[:, None]
    return order, step


def codes_of(texts: pa.Array, samples: int = SAMPLES) -> np.ndarray:
    """16 bits for each text and sample; 0 throughout for a text without words, else never 0.

    Each different (word, number of times) draws once. They are gone through ``_TERMS`` at a time,
    with each text's least score so far, so what is held does not grow with their number.
    """
    words = W.words_of(texts, W.alphabet())
    _, at, times = np.unique(
        W.mix(words.hashes ^ W.mix(words.rows.astype(np.uint64))), return_index=True, return_counts=True
    )
    by_row = np.argsort(words.rows[at], kind="stable")
    at, times = at[by_row], times[by_row]
    rows, hashes = words.rows[at], words.hashes[at]
    del words
    distinct, example, which = np.unique(
        W.mix(hashes + times.astype(np.uint64) * _STEP), return_index=True, return_inverse=True
    )
    none = np.iinfo(np.int64).max
    least = np.full((len(texts), samples), none >> 32)
    codes = np.zeros((len(texts), samples), np.uint16)
    for first in range(0, len(distinct), _TERMS):
        some = example[first : first + _TERMS]
        order, step = _steps(hashes[some], times[some], samples)
        held = np.flatnonzero((which >= first) & (which < first + _TERMS))
        own, spans = which[held] - first, W.row_spans(rows[held], len(texts)).tolist()
        lowest = np.full((len(texts), samples), none)
        for i, (a, b) in enumerate(zip(spans, spans[1:], strict=False)):
            if a < b:
                order.take(own[a:b], axis=0).min(axis=0, out=lowest[i])
        text, sample = np.nonzero(lowest >> 32 < least)
        best = lowest[text, sample]
        least[text, sample] = best >> 32
        best &= 0xFFFFFFFF
        mark = step[best, sample].astype(np.int64).view(np.uint64)
        codes[text, sample] = W.mix(hashes[some[best]] ^ (mark * _STEP)) % np.uint64(65535) + np.uint64(1)
    return codes


def as_bytes(codes: np.ndarray) -> pa.Array:
    return pa.array([row.astype(">u2").tobytes() for row in codes], pa.binary())


def as_text(column: str) -> Column:
    return F.lower(F.hex(column)).alias(column)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, by row: an estimate of the generalised Jaccard similarity."""
    return (a == b).mean(axis=1)


def fingerprints(
    docs: DataFrame, key: str = "doc_id", text: str = "text", samples: int = SAMPLES
) -> DataFrame:
    """(key, fingerprint) for each row: a string of four hexadecimal digits for each sample.

    Texts with the same words, each as often, have equal fingerprints. A null or empty text, or one
    of white space, has zeros throughout. Other columns are ignored; no rows give none.
    """
    schema = T.StructType(
        [T.StructField(key, docs.schema[key].dataType), T.StructField("fingerprint", T.BinaryType())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch, "text"):
                found = as_bytes(codes_of(block.column("text"), samples))
                yield pa.RecordBatch.from_arrays([block.column("key"), found], names=schema.names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, schema).select(key, as_text("fingerprint"))


def _spliced(own: str, other: str) -> str:
    """``own`` with its last third (rounded down) replaced by as much of the start of ``other``."""
    n = len(own) // 3
    return own[: len(own) - n] + other[:n]


_DONE, _LAST, _FIRST = 0, 1, 2


def edited_fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited versions, and how alike they are.

    In descending key order, after the last comes the first, a text's last third is replaced by the
    beginning of the next text. (key, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next) for each row; lengths count code points. A null text is empty. Rows with
    one key follow each other in an order that their texts fix; null keys come last. A single row is
    its own successor. Other columns are ignored.

    The texts are range-sorted once. Within a task the next text is at hand; each task hands on its
    first and its last row, and those few are matched afterwards.
    """
    kind = docs.schema[key].dataType
    result = [
        T.StructField(key, kind),
        T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.BinaryType()),
        T.StructField("fingerprint", T.BinaryType()),
        T.StructField("edited_fingerprint", T.BinaryType()),
        T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ]
    names = [field.name for field in result]
    ends = [
        T.StructField("task", T.IntegerType()),
        T.StructField("role", T.IntegerType()),
        T.StructField("text", T.StringType()),
    ]

    def compared(keys: pa.Array, own: list[str], following: list[str], next_codes) -> list:
        """The result's columns; ``next_codes`` gets the codes of ``own``."""
        edited = [_spliced(a, b) for a, b in zip(own, following, strict=True)]
        codes = codes_of(pa.array(own + edited, pa.large_string()))
        first, second = codes[: len(own)], codes[len(own) :]
        return [
            keys,
            pa.array([len(x) for x in own], pa.int64()),
            pa.array([hashlib.sha256(x.encode()).digest() for x in edited], pa.binary()),
            as_bytes(first),
            as_bytes(second),
            pa.array(likeness(first, second)),
            pa.array(likeness(first, next_codes(first))),
        ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()

        def row(keys: pa.Array, body: str, role: int) -> pa.RecordBatch:
            none = pa.nulls(1, pa.binary())
            columns = [keys, pa.array([len(body)], pa.int64()), none, none, none]
            columns += [pa.nulls(1, pa.float64())] * 2
            columns += [pa.array([task], pa.int32()), pa.array([role], pa.int32()), pa.array([body])]
            return pa.RecordBatch.from_arrays(columns, names=[*names, "task", "role", "text"])

        held_key, held = None, None
        for batch in batches:
            for block in W.blocks(batch, "text"):
                bodies = [x or "" for x in block.column("text").to_pylist()]
                keys = block.column("key")
                if held is None:
                    yield row(keys[:1], bodies[0], _FIRST)
                else:
                    bodies = [held, *bodies]
                    keys = pa.concat_arrays([held_key, keys])
                n = len(bodies) - 1
                if n:
                    last = codes_of(pa.array(bodies[n:], pa.large_string()))
                    done = compared(
                        keys[:n],
                        bodies[:n],
                        bodies[1:],
                        lambda codes, last=last: np.concatenate([codes[1:], last]),
                    )
                    done += [
                        pa.array(np.full(n, task, np.int32)),
                        pa.array(np.full(n, _DONE, np.int32)),
                        pa.nulls(n, pa.string()),
                    ]
                    yield pa.RecordBatch.from_arrays(done, names=[*names, "task", "role", "text"])
                held_key, held = keys[n:], bodies[n]
        if held is not None:
            yield row(held_key, held, _LAST)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch, "own"):
                own, following = ([x or "" for x in block.column(c).to_pylist()] for c in ("own", "following"))
                codes = codes_of(pa.array(following, pa.large_string()))
                yield pa.RecordBatch.from_arrays(
                    compared(block.column("key"), own, following, lambda _, codes=codes: codes),
                    names=names,
                )

    order = [F.desc_nulls_last("key"), F.xxhash64("text")]
    table = stored(
        docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, T.StructType([*result, *ends])),
        "fingerprints",
    )
    firsts = table.filter(F.col("role") == _FIRST)
    # One row for each task that had rows.
    tasks = firsts.select("task")
    following = tasks.select(
        F.col("task").alias("last_task"),
        F.coalesce(F.lead("task").over(Window.orderBy("task")), tasks.agg(F.min("task").alias("task")).scalar()).alias(
            "task"
        ),
    )
    pairs = (
        table.filter(F.col("role") == _LAST)
        .select(F.col(key).alias("key"), F.col("task").alias("last_task"), F.col("text").alias("own"))
        .join(following, "last_task")
        .join(firsts.select("task", F.col("text").alias("following")), "task")
        .select("key", "own", "following")
    )
    every = (
        table.filter(F.col("role") == _DONE)
        .select(*names)
        .unionByName(pairs.mapInArrow(finish, T.StructType(result)))
    )
    shown = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return every.select(*[as_text(name) if name in shown else F.col(name) for name in names])

"""Exact top-k search by inner product, term at a time.

A vector's places are terms and its components weights, which are whole numbers, so scores are exact.
The vectors are dealt into blocks by a hash of the row. Every block of queries meets every block of
candidates in a task of its own: the candidates' components become one posting list for each term,
and every query, a sparse row of its terms that are not zero, scatters each term's weighted postings
into an array with a score for every candidate of the block. Nothing is pruned. Of each array the best
``k`` are selected by partition, not by sorting, and the blocks' selections are merged by query.

What a task holds is bounded by the block sizes. The work is queries times vectors, as the search is
exhaustive; the number of tasks follows it, and the vectors are sent once for each block of queries.
"""

from __future__ import annotations

import sys
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

K = 10
SCALE = 1024
#: Vectors to a block, and queries to a block.
CANDIDATES = 8_192
QUERIES = 16_384


def usable(vector: Column) -> Column:
    """Whether a vector takes part: it is not null and neither is, nor is infinite or NaN, a component."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & whole, F.lit(False))


def scaled(vector: Column, scale: int = SCALE) -> Column:
    """Components as whole numbers: each times ``scale``, as a double, rounded down. What lies
    beyond a long becomes the nearest long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


class Postings(NamedTuple):
    """``rows`` and ``weights`` of the entries that are not zero, by term; term ``t`` has those from
    ``first[t]`` to ``first[t + 1]``."""

    rows: np.ndarray
    weights: np.ndarray
    first: np.ndarray


def _entries(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and weight of every component that is not zero."""
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    terms = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    used = np.flatnonzero(values)
    return rows[used], terms[used], values[used]


def postings_of(vectors: pa.Array) -> Postings:
    rows, terms, weights = _entries(vectors)
    order = np.argsort(terms, kind="stable")
    n = int(terms.max()) + 1 if len(terms) else 0
    return Postings(rows[order], weights[order], np.searchsorted(terms[order], np.arange(n + 1)))


def accumulated(postings: Postings, terms: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """The scores of ``n`` candidates for one query."""
    scores = np.zeros(n, postings.weights.dtype)
    for term, weight in zip(terms.tolist(), weights.tolist(), strict=True):
        if term + 1 >= len(postings.first):
            continue
        a, b = postings.first[term], postings.first[term + 1]
        # A row occurs once in a posting list, so the scattered sums do not meet.
        if b - a == n:
            scores += postings.weights[a:b] * weight
        else:
            scores[postings.rows[a:b]] += postings.weights[a:b] * weight
    return scores


def selected(scores: np.ndarray, k: int, but: int) -> np.ndarray:
    """The places of the ``k`` highest scores, of equal ones the first, without place ``but``."""
    places = np.arange(len(scores))
    if but >= 0:
        places = np.delete(places, but)
    if len(places) > k:
        own = scores[places]
        least = np.partition(own, len(own) - k)[len(own) - k]
        above = places[own > least]
        level = places[own == least][: k - len(above)]
        places = np.concatenate([above, level])
    return places


def _largest(weights: np.ndarray) -> int:
    return max(abs(int(weights.min())), abs(int(weights.max()))) if len(weights) else 0


_LONG = (1 << 63) - 1


def search(
    vectors: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    scale: int = SCALE,
    candidates_per_block: int = CANDIDATES,
    queries_per_block: int = QUERIES,
) -> DataFrame:
    """(query_id, rank, key, score): for each row that fulfils ``queries``, its ``k`` best others.

    The score is the inner product of the ``scaled`` vectors; places that the shorter vector lacks
    count as zero. Equal scores rank by smaller key, a null key last. Every other
    row is a candidate, also one with the query's key, and a repeated query is answered each time.
    Rows whose vector is null, or has a component that is null or not finite, take no part; empty
    vectors score zero. With fewer than ``k`` candidates all are returned, without any nothing. A
    score beyond a long counts as the nearest long. Columns not named are ignored.
    """
    kind = vectors.schema[key].dataType
    rows = stored(
        vectors.select(F.col(key).alias("id"), F.col(vector).alias("vector"), queries.alias("asked"))
        .filter(usable(F.col("vector")))
        .select("id", scaled(F.col("vector"), scale).alias("vector"), F.coalesce("asked", F.lit(False)).alias("asked"))
        .withColumn("row", F.monotonically_increasing_id()),
        "vectors",
    )
    counts = rows.agg(F.count("*").alias("n"), F.count_if("asked").alias("asked")).first()
    blocks = max(1, -(-int(counts["n"]) // candidates_per_block))
    query_blocks = max(1, -(-int(counts["asked"]) // queries_per_block))

    def dealt(side: DataFrame, own: str, n: int, other: str, others: int) -> DataFrame:
        """``side`` in ``n`` blocks, each sent to every one of the ``others``."""
        hashed = F.pmod(F.xxhash64("row"), F.lit(n)).cast("int").alias(own)
        every = F.explode(F.sequence(F.lit(0), F.lit(others - 1))).alias(other)
        return side.select("id", "vector", "row", hashed, every)

    candidates = dealt(rows, "block", blocks, "query_block", query_blocks)
    asked = dealt(rows.filter("asked"), "query_block", query_blocks, "block", blocks)
    result = T.StructType(
        [
            T.StructField("query", T.LongType()),
            T.StructField("query_id", kind),
            T.StructField("id", kind),
            T.StructField("row", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )

    def meet(candidates: pa.Table, asked: pa.Table) -> pa.Table:
        # In the order that settles ties, so that equal scores are taken from the front.
        order = [("id", "ascending"), ("row", "ascending")]
        candidates = candidates.take(pc.sort_indices(candidates, order, null_placement="at_end"))
        n = candidates.num_rows
        postings = postings_of(candidates.column("vector").combine_chunks())
        rows, terms, weights = _entries(asked.column("vector").combine_chunks())
        first = np.searchsorted(rows, np.arange(asked.num_rows + 1))
        longest = int(np.diff(first).max(initial=1))
        if _largest(weights) * _largest(postings.weights) * longest > _LONG:  # numbers of any size
            postings = postings._replace(weights=postings.weights.astype(object))
            weights = weights.astype(object)
        own = candidates.column("row").to_numpy()
        where = {row: place for place, row in enumerate(own.tolist())}
        places, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, row in enumerate(asked.column("row").to_pylist()):
            part = slice(first[i], first[i + 1])
            every = accumulated(postings, terms[part], weights[part], n)
            every = np.clip(every, -_LONG - 1, _LONG).astype(np.int64)
            places.append(selected(every, k, where.get(row, -1)))
            scores.append(every[places[-1]])
        place = pa.array(np.concatenate(places))
        which = pa.array(np.repeat(np.arange(asked.num_rows), [len(x) for x in places[1:]]))
        return pa.table(
            [
                asked.column("row").take(which),
                asked.column("id").take(which),
                candidates.column("id").take(place),
                candidates.column("row").take(place),
                pa.array(np.concatenate(scores)),
            ],
            names=result.names,
        )

    # So many partitions are asked for, since little data makes much work here.
    pairs = ["block", "query_block"]
    tasks = 2 * blocks * query_blocks
    best = (
        candidates.repartition(tasks, *pairs)
        .groupBy(*pairs)
        .cogroup(asked.repartition(tasks, *pairs).groupBy(*pairs))
        .applyInArrow(meet, result)
    )
    order = [F.desc("score"), F.asc_nulls_last("id"), "row"]
    rank = F.row_number().over(Window.partitionBy("query").orderBy(*order))
    merged = best.withColumn("rank", rank).filter(F.col("rank") <= k)
    return merged.select("query_id", "rank", F.col("id").alias(key), "score")

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import top_k


def whole(x):
    return max(-(2**63), min(2**63 - 1, math.floor(x * 1024)))


def expected(rows, asked, k=10):
    """(query_id, rank, vec_id, score) from plain Python, row by row."""
    rows = [
        (key, [whole(x) for x in vector])
        for key, vector in rows
        if vector is not None and all(x is not None and math.isfinite(x) for x in vector)
    ]
    out = []
    for i, (key, query) in enumerate(rows):
        if key is None or not asked(key):
            continue
        scored = []
        for j, (other, vector) in enumerate(rows):
            if i != j:
                score = sum(a * b for a, b in zip(query, vector, strict=False))
                score = max(-(2**63), min(2**63 - 1, score))
                scored.append((-score, other is None, other or 0, other))
        scored.sort(key=lambda x: x[:3])
        out += [(key, n + 1, x[3], -x[0]) for n, x in enumerate(scored[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect()), key=str)


def every_hundredth(key):
    return key % 100 == 0


@pytest.mark.parametrize(("candidates", "queries"), [(8192, 16384), (37, 2)])
def test_against_brute_force(spark, sf, candidates, queries):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in vectors.collect()]
    found = top_k.search(
        vectors, F.col("vec_id") % 100 == 0, candidates_per_block=candidates, queries_per_block=queries
    )
    assert got(found) == expected(rows, every_hundredth)


AWKWARD = [
    (0, [0.5, -0.25, 0.0]),
    (100, [0.5, -0.25, 0.0]),
    (100, [0.5, -0.25, 0.0]),
    (200, []),
    (300, None),
    (400, [1.0, None]),
    (500, [1.0, float("nan")]),
    (600, [float("-inf")]),
    (700, [0.0, 0.0, 0.0, 0.0, 9.0]),
    (800, [3e30, 1.0]),
    (900, [-3e30, 2.0**52]),
    (None, [0.5, -0.25]),
    (-100, [1e-9, -1e-9]),
    (1, [0.5, -0.25, 0.0]),
    (2, [-1.0, 1.0]),
    (3, [1.0]),
]


@pytest.mark.parametrize("candidates", [1, 5, 100])
def test_awkward_vectors(spark, candidates):
    vectors = spark.createDataFrame(AWKWARD, "vec_id long, embedding array<double>").withColumns(
        {name: F.lit("x") for name in ("id", "row", "score", "rank", "vector", "block", "query")}
    )
    for k in (1, 4, 10, 30):
        found = top_k.search(vectors, F.col("vec_id") % 100 == 0, k=k, candidates_per_block=candidates, queries_per_block=3)
        assert got(found) == expected(AWKWARD, every_hundredth, k)


def test_empty_tables_and_no_queries(spark):
    vectors = spark.createDataFrame(AWKWARD, "vec_id long, embedding array<double>")
    assert top_k.search(vectors.limit(0), F.lit(True)).collect() == []
    assert top_k.search(vectors, F.lit(False)).collect() == []
    assert top_k.search(vectors.limit(1), F.lit(True)).collect() == []


def test_one_vector_many_times(spark):
    """Ties over whole blocks go to the smallest keys."""
    vectors = spark.range(0, 3000).select(
        F.col("id").alias("vec_id"), F.array(F.lit(0.5), F.lit(1.0)).cast("array<float>").alias("embedding")
    )
    rows = top_k.search(vectors, F.col("vec_id") % 1000 == 0, candidates_per_block=64).collect()
    best = {(r.query_id, r["rank"]): r.vec_id for r in rows}
    assert [best[(0, n)] for n in range(1, 11)] == list(range(1, 11))
    assert [best[(2000, n)] for n in range(1, 11)] == list(range(10))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(-3, 3), max_size=40), st.integers(1, 12), st.integers(-1, 45))
def test_selection_is_that_of_a_sort(scores, k, but):
    but = but if but < len(scores) else -1
    best = sorted((-s, i) for i, s in enumerate(scores) if i != but)[:k]
    assert sorted(top_k.selected(np.array(scores, np.int64), k, but).tolist()) == sorted(i for _, i in best)

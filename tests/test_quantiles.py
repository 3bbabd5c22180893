import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.functions import quantiles
from tillroll.functions.quantiles import exact_quantile, exact_quantiles


def frame(spark, values):
    return spark.createDataFrame(pd.DataFrame({"v": np.asarray(values, dtype=float)}))


@pytest.mark.parametrize("q", [0.0, 0.01, 0.5, 0.99, 1.0])
@pytest.mark.parametrize("kind", ["skewed", "ties", "two values", "constant"])
def test_narrowing_finds_the_same_value(spark, q, kind):
    rng = np.random.default_rng(1)
    values = {
        "skewed": rng.lognormal(0, 3, 20_001),
        "ties": np.concatenate([np.full(7_000, 3.25), rng.normal(3.25, 1, 13_001)]),
        "two values": np.repeat([1.0, 2.0], [9_999, 10_002]),
        "constant": np.full(20_001, 5.0),
    }[kind]
    got = exact_quantile(frame(spark, values), "v", q)
    assert got == pytest.approx(np.quantile(values, q), rel=1e-12)


@settings(max_examples=6, deadline=None)
@given(
    values=st.lists(st.integers(-5, 5), min_size=1, max_size=60),
    q=st.sampled_from([0.0, 0.25, 0.5, 0.9, 1.0]),
)
def test_any_small_column(spark, values, q):
    df = frame(spark, values).coalesce(1)
    want = np.quantile(values, q)
    assert exact_quantile(df, "v", q) == pytest.approx(want)


def test_empty_and_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0)], "a double, b double")
    assert exact_quantiles(df, ["a", "b"], 0.5) == {"a": None, "b": 2.0}


def test_infinite_values_rank_at_the_ends(spark):
    inf = float("inf")
    values = [inf, -inf, *range(501), float("nan")]
    df = frame(spark, values)
    assert exact_quantile(df, "v", 0.5) == 250.0
    assert exact_quantile(df, "v", 0.0) == -inf and exact_quantile(df, "v", 1.0) == inf
    assert exact_quantile(frame(spark, [inf, inf]), "v", 0.5) == inf
    assert exact_quantile(frame(spark, [1e308, -1e308, 0.0]), "v", 0.5) == 0.0
    assert exact_quantile(frame(spark, [0.0, 5e-324, 5e-324, 1e-323]), "v", 0.5) == 5e-324


def test_a_tenfold_table_has_nearly_the_same_quantiles(spark):
    values = np.random.default_rng(2).lognormal(0, 2, 2_000)
    once, tenfold = frame(spark, values), frame(spark, np.repeat(values, 10))
    for q in (0.25, 0.5, 0.99):
        assert exact_quantile(once, "v", q) == pytest.approx(np.quantile(values, q), rel=1e-12)
        assert exact_quantile(tenfold, "v", q) == pytest.approx(
            np.quantile(np.repeat(values, 10), q), rel=1e-12
        )


def test_columns_share_the_passes(spark):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({"a": rng.normal(size=3_000), "b": rng.integers(0, 5, 3_000) * 1.0, "c": 7.0})
    got = exact_quantiles(spark.createDataFrame(data), ["a", "b", "c"], 0.9)
    assert got == pytest.approx({name: np.quantile(data[name], 0.9) for name in data})


def heavy(kind, n=30_000):
    rng = np.random.default_rng(5)
    return {
        "cauchy": rng.standard_cauchy(n),
        "wide": np.exp(rng.normal(0, 40, n)) * rng.choice([-1, 1], n),
        "ties": np.round(rng.standard_cauchy(n), 1),
        "few": rng.choice([1.0, 2.0, 1e300], n),
        "constant": np.full(n, 5.0),
        "infinite": np.concatenate([rng.standard_cauchy(n - 40), np.full(20, np.inf), np.full(20, -np.inf)]),
    }[kind]


KINDS = ("cauchy", "wide", "ties", "few", "constant", "infinite")


def passes(monkeypatch):
    """Counts the passes from here on, and those that fall back on histograms."""
    seen = {"sketch": 0, "histogram": 0}
    run, narrow = quantiles._pass, quantiles._narrow

    def counted(*args):
        seen["sketch"] += 1
        return run(*args)

    def narrowed(numbers, finite, searches):
        seen["histogram"] += len(searches)
        return narrow(numbers, finite, searches)

    monkeypatch.setattr(quantiles, "_pass", counted)
    monkeypatch.setattr(quantiles, "_narrow", narrowed)
    return seen


def all_kinds(spark):
    return spark.createDataFrame(pd.DataFrame({kind: heavy(kind) for kind in KINDS})).repartition(7).persist()


@pytest.mark.parametrize("q", [0.0, 0.5, 0.99, 1.0])
def test_heavy_tails_take_two_passes_and_equal_percentile(spark, monkeypatch, q):
    df = all_kinds(spark)
    seen = passes(monkeypatch)
    got = exact_quantiles(df, KINDS, q)
    assert seen == {"sketch": 2, "histogram": 0}
    for kind in KINDS:
        want = np.sort(heavy(kind))
        position = q * (len(want) - 1)
        low, high = want[int(np.floor(position))], want[int(np.ceil(position))]
        share = position - np.floor(position)
        assert got[kind] == (low if share == 0 or low == high else low + (high - low) * share)
    percentile = df.selectExpr(*[f"percentile({kind}, {q}D) AS {kind}" for kind in KINDS if kind != "infinite"])
    for kind, value in percentile.first().asDict().items():
        assert got[kind] == pytest.approx(value, rel=1e-14)


def test_more_than_can_be_gathered_is_sketched_again(spark, monkeypatch):
    df = all_kinds(spark)
    want = exact_quantiles(df, KINDS, 0.37)
    monkeypatch.setattr(quantiles, "SETTLE", 60)
    seen = passes(monkeypatch)
    assert exact_quantiles(df, KINDS, 0.37) == want
    assert seen["sketch"] > 2 and seen["histogram"] == 0


def test_a_bracket_that_fails_is_given_up_for_histograms(spark, monkeypatch):
    df = all_kinds(spark)
    want = exact_quantiles(df, KINDS, 0.37)

    def wrong(search, place, n, grid):
        search.low, search.high, search.inside = grid[-2], grid[-1], 1

    monkeypatch.setattr(quantiles, "_bracket", wrong)
    seen = passes(monkeypatch)
    assert exact_quantiles(df, KINDS, 0.37) == want
    assert seen["histogram"] >= 3

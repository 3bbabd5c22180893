from pyspark.sql import functions as F

from tillroll.functions import membership


def test_every_key_passes_and_few_others(spark):
    keys = spark.range(0, 90_000, 3)
    every = spark.range(-1000, 90_000)
    found = every.filter(membership.KeyFilter(keys, "id").may_hold(F.col("id")))
    assert found.join(keys, "id", "left_anti").count() < 0.01 * every.count()
    assert keys.join(found, "id", "left_anti").count() == 0


def test_nulls_nothing_and_a_full_filter(spark, monkeypatch):
    keys = spark.createDataFrame([(1,), (None,)], "id long")
    held = membership.KeyFilter(keys, "id").may_hold(F.col("id"))
    assert [r.id for r in keys.filter(held).collect()] == [1]
    assert keys.filter(membership.KeyFilter(keys.limit(0), "id").may_hold(F.col("id"))).collect() == []
    monkeypatch.setattr(membership, "MOST_BITS", 64)
    monkeypatch.setattr(membership, "LEAST_BITS", 64)
    many = spark.range(1000)
    assert many.filter(membership.KeyFilter(many, "id").may_hold(F.col("id"))).count() == 1000

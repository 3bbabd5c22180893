"""A Bloom filter of keys, built and tested by column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, places for each key, and the most bits of a filter: 16 MB.
BITS_PER_KEY = 16
PLACES = 3
MOST_BITS = 1 << 27
LEAST_BITS = 1 << 12


class KeyFilter:
    """Which keys may be in a set: every one that is, and few others.

    The set's keys set ``PLACES`` bits each in an array of longs, which an aggregate builds and a
    scalar subquery carries into the scan. With ``BITS_PER_KEY`` bits to a key about one other key in
    two hundred passes. The array stops growing at ``MOST_BITS``, beyond eight million keys, from
    where more and more others pass: rows that pass are only fewer to look at, and a join decides.
    """

    def __init__(self, keys: DataFrame, column: str):
        n = keys.count()
        wanted = max(LEAST_BITS, min(MOST_BITS, n * BITS_PER_KEY))
        self.bits = 1 << math.ceil(math.log2(wanted))
        self._spark = keys.sparkSession
        self._keys = keys.select(F.col(column).alias("key")).filter(F.col("key").isNotNull())

    def _places(self, key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(i)), F.lit(self.bits)) for i in range(PLACES)]

    def words(self) -> DataFrame:
        """One row: ``words``, an array of longs."""
        place = F.explode(F.array(*self._places(F.col("key")))).alias("place")
        mask = F.bit_or(F.expr("shiftleft(1L, cast(place % 64 as int))")).alias("mask")
        used = self._keys.select(place).groupBy(F.shiftright("place", 6).alias("word")).agg(mask)
        every = self._spark.range(self.bits // 64).withColumnRenamed("id", "word")
        filled = every.join(used, "word", "left").select("word", F.coalesce("mask", F.lit(0)).alias("mask"))
        return filled.agg(F.sort_array(F.collect_list(F.struct("word", "mask")))["mask"].alias("words"))

    def may_hold(self, key: Column) -> Column:
        """Whether ``key`` may be in the set; null is not."""
        words = self.words().scalar()
        held = key.isNotNull()
        for place in self._places(key):
            word = F.get(words, F.shiftright(place, 6).cast("int"))
            held = held & (word.bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(64)).cast("int"))) != 0)
        return held

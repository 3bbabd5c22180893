"""Mixing sources to target weights by Poisson replication.

A source's repetition rate is what its target share of the wanted documents comes to per document it
has. Every document draws its number of copies by inverting a Poisson distribution of that mean at a
hash of its key, so the draw needs no state and a lost task redraws the same. A rate above
``STEP`` is the sum of equal smaller ones, drawn independently, which keeps every table of
probabilities short. The copies are then put in a global random order by range-sorting a second
hash. Texts move once, in that sort; a source of any size is never gathered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import bits_from_md5, new_name, stored, unit_from_md5, without

SEED = 20_010
#: Largest mean drawn at once.
STEP = 8.0
#: Poisson(8) exceeds this with a probability under 2**-53, the finest a draw can tell.
MOST = 48


def power_weights(docs: DataFrame, source: str = "source", power: float = 0.5) -> DataFrame:
    """(source, weight): the source's number of documents to a power; below 1 lifts small ones."""
    return docs.groupBy(F.col(source).alias("source")).agg(
        F.pow(F.count("*").cast("double"), F.lit(power)).alias("weight")
    )


def repetition_rates(
    docs: DataFrame, weights: DataFrame, source: str = "source", total: Column | None = None
) -> DataFrame:
    """(source, rate, parts, cdf) for each source of ``docs``.

    ``weights``: (source, weight), shares in any unit; sources without documents are left out and
    the others share alike, sources without a weight get none. ``total``: wanted number of
    documents, an aggregate over a column ``n``; by default as many as there are.
    """
    counts = docs.groupBy(F.col(source).alias("source")).agg(F.count("*").alias("n"))
    given = weights.select(
        F.col("source").alias("__source"), F.greatest(F.col("weight"), F.lit(0.0)).alias("__weight")
    )
    both = stored(
        counts.join(given, F.col("source").eqNullSafe(F.col("__source")), "left").select(
            "source", "n", F.coalesce("__weight", F.lit(0.0)).alias("weight")
        ),
        "source-weights",
    )
    sums = both.agg(
        (total if total is not None else F.sum("n")).cast("double").alias("total"),
        F.sum("weight").alias("weight"),
    )
    wanted, weight = sums.select("total").scalar(), sums.select("weight").scalar()
    rate = F.coalesce(
        F.try_divide(F.col("weight") * wanted, weight * F.col("n").cast("double")), F.lit(0.0)
    )
    parts = F.greatest(F.ceil(F.col("rate") / F.lit(STEP)), F.lit(1)).cast("long")
    mean = F.col("rate") / F.col("parts")
    steps = F.sequence(F.lit(1), F.lit(MOST))
    start = F.struct(
        F.exp(-mean).alias("p"), F.exp(-mean).alias("at"), F.array(F.exp(-mean)).alias("cdf")
    )

    def next_step(acc: Column, k: Column) -> Column:
        p = acc["p"] * mean / k
        at = acc["at"] + p
        return F.struct(
            p.alias("p"), at.alias("at"), F.concat(acc["cdf"], F.array(at)).alias("cdf")
        )

    return (
        both.withColumn("rate", rate)
        .withColumn("parts", parts)
        .withColumn("cdf", F.aggregate(steps, start, next_step, lambda acc: acc["cdf"]))
        .select("source", "rate", "parts", "cdf")
    )


def replicate(
    docs: DataFrame,
    weights: DataFrame,
    source: str = "source",
    key: str = "doc_id",
    total: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """``docs``' columns, ``copy`` (long, from 0) and ``shuffle_key`` (long), in the key's order.

    A document of a source with rate r comes out a Poisson(r) number of times. Repeated rows with
    one key draw alike, each for itself. A null key, text or source is a value like others (null
    sources form one source). An empty table gives an empty one. Input columns named ``copy`` or
    ``shuffle_key`` are replaced.
    """
    docs = without(docs, "copy", "shuffle_key")
    # Stored so that its size is known when the join is planned: a short table goes to the
    # documents; only one beyond Spark's broadcast limit makes the documents move to it.
    rates = stored(repetition_rates(docs, weights, source, total), "source-rates").select(
        F.col("source").alias("__source"), F.col("parts").alias("__parts"), F.col("cdf").alias("__cdf")
    )
    part = new_name(docs, "__part")
    identity = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    u = unit_from_md5(F.lit(seed), identity, F.col(part))
    drawn = F.size(F.filter("__cdf", lambda at: at < u)).cast("long")
    copies = (
        docs.join(rates, F.col(source).eqNullSafe(F.col("__source")))
        .select(
            *[F.col(f"`{c}`") for c in docs.columns],
            "__cdf",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("__parts") - 1)).alias(part),
        )
        .withColumn("__drawn", drawn)
        .filter(F.col("__drawn") > 0)
        .select(
            *[F.col(f"`{c}`") for c in docs.columns],
            part,
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("__drawn") - 1)).alias("__n"),
        )
        .withColumn("copy", F.col(part) * (MOST + 1) + F.col("__n"))
        .withColumn("shuffle_key", bits_from_md5(F.lit(seed + 1), identity, F.col("copy")))
        .select(*[F.col(f"`{c}`") for c in docs.columns], "copy", "shuffle_key")
    )
    order = [F.col("shuffle_key"), F.col(key), F.col("copy")]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order)

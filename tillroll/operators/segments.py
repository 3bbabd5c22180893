"""Naming clusters and describing segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.functions.measures import integer_mean, percent
from tillroll.functions.quantiles import exact_quantiles

MEASURES = ("recency_days", "frequency", "monetary")
SEGMENT_COLUMNS = ("customer_id", *MEASURES, "cluster", "segment_name")


def overall_medians(customers: DataFrame) -> DataFrame:
    """One row: the interpolated median of each measure over all customers."""
    medians = exact_quantiles(customers, MEASURES, 0.5)
    columns = [F.lit(value).cast("double").alias(name) for name, value in medians.items()]
    return customers.sparkSession.range(1).select(*columns)


def cluster_means(customers: DataFrame) -> DataFrame:
    """Mean of each measure by cluster."""
    return customers.groupBy("cluster").agg(
        *[F.avg(F.col(name).cast("double")).alias(name) for name in MEASURES]
    )


def _segment_name(recent: Column, frequent: Column, high: Column) -> Column:
    return (
        F.when(recent & frequent & high, "Champions")
        .when(recent & ~frequent & ~high, "New / Low-Engagement")
        .when(recent, "Regular")
        .when(~frequent & ~high, "Lost / Lapsed")
        .otherwise("Occasional / Low-value")
    )


def cluster_names(customers: DataFrame) -> DataFrame:
    """(cluster, segment_name): each cluster's means against the medians of all customers."""
    medians = exact_quantiles(customers, MEASURES, 0.5)
    middle = {name: F.lit(value) for name, value in medians.items()}
    means = cluster_means(customers)
    return means.select(
        "cluster",
        _segment_name(
            F.col("recency_days") <= middle["recency_days"],
            F.col("frequency") >= middle["frequency"],
            F.col("monetary") >= middle["monetary"],
        ).alias("segment_name"),
    )


def label_segments(customers: DataFrame) -> DataFrame:
    """Customers with the name of their cluster. One row per cluster is joined: k rows."""
    names = cluster_names(customers)
    return customers.join(F.broadcast(names), "cluster")


def segment_table(labelled: DataFrame) -> DataFrame:
    """The customer-grain table that is stored and exported."""
    return labelled.select(*SEGMENT_COLUMNS)


def segment_profile(labelled: DataFrame) -> DataFrame:
    """Mean and count of each measure by cluster and name."""
    columns = []
    for name in MEASURES:
        columns.append(F.avg(F.col(name).cast("double")).alias(f"{name}_mean"))
        columns.append(F.count(name).alias(f"{name}_count"))
    return labelled.groupBy("cluster", "segment_name").agg(*columns)


def segment_stats(labelled: DataFrame) -> DataFrame:
    """Size and rounded means by name; clusters that share a name are one segment."""
    return (
        labelled.groupBy("segment_name")
        .agg(
            F.count("*").alias("customer_count"),
            integer_mean("recency_days", 1).alias("avg_recency_days"),
            integer_mean("frequency", 1).alias("avg_frequency"),
            F.round(F.avg("monetary"), 2).alias("avg_monetary"),
        )
        .orderBy(F.desc("avg_monetary"), "segment_name")
    )


def segment_shares(labelled: DataFrame) -> DataFrame:
    """Size of each segment and its share of all customers."""
    total = labelled.agg(F.count("*").alias("customers")).scalar()
    return (
        labelled.groupBy("segment_name")
        .agg(F.count("*").alias("customer_count"))
        .withColumn("pct_of_customers", percent(F.col("customer_count"), total))
    )

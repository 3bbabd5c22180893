"""Quality classifier: a sparse ensemble of rules (Friedman and Popescu's RuleFit).

A random forest of shallow trees is grown on text statistics. Every path from a root to a node is a
rule, a conjunction of comparisons. A logistic regression with a lasso penalty weights the rules and
drops most of them. The rest is compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

import math
import re
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import stored
from tillroll.llm.text_statistics import STATISTICS, with_statistics

TREES = 30
DEPTH = 3
BINS = 64
PENALTY = 0.001
SEED = 6
THRESHOLD = 0.3

#: (statistic, above, at most); a bound may be missing.
Rule = tuple[tuple[str, float | None, float | None], ...]


class RuleModel(NamedTuple):
    """Log odds of label 1: ``intercept`` plus the weights of the rules that hold."""

    intercept: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        odds = F.lit(self.intercept)
        for rule, weight in self.rules:
            odds = odds + F.when(condition(rule), F.lit(weight)).otherwise(F.lit(0.0))
        return 1.0 / (1.0 + F.exp(-odds))


def condition(rule: Rule) -> Column:
    """All of the rule's comparisons hold."""
    parts = []
    for name, above, most in rule:
        if above is not None:
            parts.append(F.col(name) > above)
        if most is not None:
            parts.append(F.col(name) <= most)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole & part
    return whole


def rules_of(description: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """The paths to all nodes but the root, from a fitted tree's printed form."""
    rules, path = [], []
    for line in description.splitlines():
        found = re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not found:
            continue
        indent, feature, sign, value = found.groups()
        while path and path[-1][0] >= len(indent):
            path.pop()
        path.append((len(indent), names[int(feature)], sign, float(value)))
        bounds: dict[str, list[float | None]] = {}
        for _, name, sign_, at in path:
            low, high = bounds.setdefault(name, [None, None])
            if sign_ == ">":
                bounds[name][0] = at if low is None else max(low, at)
            else:
                bounds[name][1] = at if high is None else min(high, at)
        rules.append(tuple((name, low, high) for name, (low, high) in sorted(bounds.items())))
    return rules


def fit(rows: DataFrame, label: str = "label") -> RuleModel:
    """A model of ``label`` (0 or 1) from ``STATISTICS``. Without rows, or with one label only, it
    has no rules and gives every text the smoothed share of label 1."""
    counts = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(label), F.lit(0)).alias("ones")).first()
    n, ones = int(counts["n"]), int(counts["ones"])
    if ones == 0 or ones == n:
        return RuleModel(_log_odds((ones + 1) / (n + 2)), [])
    forest = RandomForestClassifier(
        labelCol="label",
        featuresCol="features",
        numTrees=TREES,
        maxDepth=DEPTH,
        maxBins=BINS,
        minInstancesPerNode=5,
        subsamplingRate=0.7,
        featureSubsetStrategy="onethird",
        seed=SEED,
    )
    labelled = F.col(label).cast("double").alias("label")
    vectors = rows.select(labelled, array_to_vector(F.array(*STATISTICS)).alias("features"))
    trees = forest.fit(vectors).trees
    rules = sorted({rule for tree in trees for rule in rules_of(tree.toDebugString)}, key=str)
    if not rules:
        return RuleModel(_log_odds(ones / n), [])
    held = F.array(*[condition(rule).cast("double") for rule in rules])
    lasso = LogisticRegression(regParam=PENALTY, elasticNetParam=1.0, maxIter=100)
    fitted = lasso.fit(stored(rows.select(labelled, array_to_vector(held).alias("features")), "rules"))
    weights = fitted.coefficients.toArray().tolist()
    kept = [(rule, weight) for rule, weight in zip(rules, weights, strict=True) if abs(weight) > 1e-9]
    return RuleModel(float(fitted.intercept), kept)


def _log_odds(share: float) -> float:
    return math.log(share / (1 - share))


def held_out(key: Column) -> Column:
    """Every fifth key by hash: never learnt from."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def bounded_labels(
    labels: DataFrame, most: int, key: str = "doc_id", label: str = "quality"
) -> DataFrame:
    """(key, label) of the rows to learn from: those labelled and not held out, or, of more than
    ``most``, about that many, those whose key hashes lowest."""
    usable = labels.filter(~held_out(F.col(key)) & F.col(key).isNotNull() & F.col(label).isNotNull())
    usable = usable.select(key, label)
    n = usable.count()
    if n <= most:
        return usable
    return usable.filter(F.pmod(F.xxhash64(key), F.lit(1 << 40)) < (most << 40) // n)


def learn(
    statistics: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality"
) -> RuleModel:
    """A model from the labelled rows that are not held out. A null key or label is not labelled;
    with repeated rows all of them count."""
    known = labels.filter(~held_out(F.col(key)) & F.col(label).isNotNull()).select(
        F.col(key).alias("__key"), F.col(label).cast("int").alias("label")
    )
    rows = statistics.join(known, F.col(key) == F.col("__key")).select("label", *STATISTICS)
    return fit(stored(rows, "labelled"))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
) -> tuple[DataFrame, RuleModel]:
    """((key, held_out, score, predicted), the model): one row for each of ``docs``.

    Only the text decides the score. A null text is an empty one; repeated rows are scored alike;
    other columns are ignored; no rows give none.
    """
    statistics = stored(with_statistics(docs, text, [key]), "statistics")
    model = learn(statistics, labels, key, label)
    return scored(statistics, model, key), model


def scored(statistics: DataFrame, model: RuleModel, key: str = "doc_id") -> DataFrame:
    rows = statistics.select(key, held_out(F.col(key)).alias("held_out"), model.score().alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))

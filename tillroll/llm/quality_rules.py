"""Quality rules: plain text statistics, and a hashed n-gram likelihood ratio.

Words and word pairs are hashed into ``BUCKETS`` counters. One multinomial is estimated from trusted
documents, one from the whole corpus, and a document's verdict is the mean of the two multinomials'
log ratio over its words and pairs: how much more likely its wording is in the trusted target than in
the corpus at large. Dividing by the number of n-grams makes short and long texts comparable. The
threshold is a constant, so a verdict depends on the document and the two multinomials only.

DataFrame functions throughout. A text is handled within its row: no words are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.frames import stored, without

BUCKETS = 10_000
MIN_WORDS = 10
#: Greatest percentage of words in repeated windows.
MAX_REPEATED = 20
#: Least mean log ratio of a kept document.
THRESHOLD = -0.05

_SPACE = " \t\n\x0b\x0c\r"
_SPACES = r"[\x20\x09-\x0D]+"
_SYMBOLS = r"[#*$%&|<>]"


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, _SPACES), "")


def _word_hashes(words: Column) -> Column:
    return F.transform(words, lambda word: F.xxhash64(word))


def _joined(hashes: Column, others: Column, distance: int) -> Column:
    """Hashes of each element with that of ``others`` which is ``distance`` further on."""
    n = F.greatest(F.size(others) - distance, F.lit(0))
    return F.transform(
        F.slice(hashes, F.lit(1), n), lambda h, i: F.xxhash64(h, others[i + distance])
    )


def _bucket(n_gram: Column, buckets: int) -> Column:
    return F.pmod(n_gram, F.lit(buckets)).cast("int")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _covered_words(windows: Column, k: int) -> Column:
    """How many words stand in windows of ``k`` words that occur twice or more."""

    def count(pairs: Column) -> Column:
        def twin(pair: Column, j: Column) -> Column:
            before, after = F.get(pairs, j - 1), F.get(pairs, j + 1)
            return F.coalesce(before["h"] == pair["h"], F.lit(False)) | F.coalesce(
                after["h"] == pair["h"], F.lit(False)
            )

        starts = F.sort_array(F.transform(F.filter(pairs, twin), lambda pair: pair["i"]))
        zero = F.struct(F.lit(-k).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(
            starts,
            zero,
            lambda acc, i: F.struct(
                i.alias("last"), (acc["n"] + F.least(F.lit(k), i - acc["last"])).alias("n")
            ),
            lambda acc: acc["n"],
        )

    by_hash = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows), _let(by_hash, count)
    ).otherwise(F.lit(0).cast("long"))


def log_ratios(
    docs: DataFrame,
    trusted: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    buckets: int = BUCKETS,
) -> DataFrame:
    """One row: ``log_ratio``, an array with each bucket's log ratio, trusted over all.

    Counts cover every document, the trusted ones those whose key is in ``trusted``. One is added to
    every count, so a bucket that neither has seen has nearly no say. Without trusted documents, or
    without any, all ratios are about zero. Null texts are empty; repeated rows count each time.
    """
    # Trusted keys may be as many as documents: both sides are shuffled at any size.
    sure = trusted.select(F.col(key).alias("__sure")).distinct().hint("merge")
    counted = (
        docs.select(F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
        .join(sure, F.col("__key") == F.col("__sure"), "left")
        .select(F.col("__sure").isNotNull().alias("__is_sure"), _words(F.col("__text")).alias("__words"))
        .select("__is_sure", _word_hashes(F.col("__words")).alias("__one"))
        .select("__is_sure", "__one", _joined(F.col("__one"), F.col("__one"), 1).alias("__two"))
        .select("__is_sure", F.explode(F.concat("__one", "__two")).alias("__n_gram"))
        .select("__is_sure", _bucket(F.col("__n_gram"), buckets).alias("bucket"))
        .groupBy("bucket", "__is_sure")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(
            F.sum("n").alias("corpus"),
            F.sum(F.when(F.col("__is_sure"), F.col("n")).otherwise(0)).alias("target"),
        )
    )
    table = stored(counted, "bucket-counts")
    total = table.agg(F.sum("corpus").alias("corpus"), F.sum("target").alias("target"))

    def log_share(name: str) -> Column:
        n = F.coalesce(F.col(name), F.lit(0)) + 1.0
        whole = F.coalesce(total.select(name).scalar(), F.lit(0)) + float(buckets)
        return F.log(n) - F.log(whole)

    every = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
    ratio = every.join(table, "bucket", "left").select(
        F.struct("bucket", (log_share("target") - log_share("corpus")).alias("ratio")).alias("pair")
    )
    return stored(
        ratio.agg(F.sort_array(F.collect_list("pair"))["ratio"].alias("log_ratio")), "log-ratios"
    )


def with_quality(
    docs: DataFrame,
    ratios: DataFrame,
    text: str = "text",
    threshold: float = THRESHOLD,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` with statistics and verdict, one row for each of its rows.

    ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words`` (long),
    ``base_failed`` (boolean), ``log_ratio`` (double: mean over words and pairs, 0 without words),
    ``kept`` (boolean: neither failed nor below ``threshold``). A null text is an empty one and
    fails. Input columns of these names are replaced.
    """
    docs = without(
        docs,
        *("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"),
        *("base_failed", "log_ratio", "kept"),
    )
    columns = [F.col(f"`{c}`") for c in docs.columns]
    text_column = F.coalesce(F.col(text).cast("string"), F.lit(""))
    lines = F.filter(
        F.split(F.col("__text"), "\n"), lambda line: F.btrim(line, F.lit(_SPACE)) != ""
    )
    score = F.aggregate(
        F.concat("__one", "__two"),
        F.lit(0.0),
        lambda acc, n_gram: acc + F.col("__table")[_bucket(n_gram, buckets)],
    )
    n_words = F.col("n_words")
    failed = (n_words < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * n_words)
    return (
        docs.withColumn("__text", text_column)
        .withColumn("__words", _words(F.col("__text")))
        .withColumn("__lines", lines)
        .withColumn("__one", _word_hashes(F.col("__words")))
        .withColumn("__two", _joined(F.col("__one"), F.col("__one"), 1))
        .withColumn("__four", _joined(F.col("__two"), F.col("__two"), 2))
        .withColumn("__five", _joined(F.col("__four"), F.col("__one"), 4))
        .withColumn("__table", ratios.select("log_ratio").scalar())
        # Through explode() no filter on the outcome is pushed down: pushed, it would put each of
        # the arrays above inside the next one's lambda.
        .select(
            *columns,
            F.explode(
                F.array(
                    F.struct(
                        F.size("__words").cast("long").alias("n_words"),
                        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"),
                        F.regexp_count("__text", F.lit(_SYMBOLS)).cast("long").alias("n_symbols"),
                        (F.size("__lines") - F.size(F.array_distinct("__lines")))
                        .cast("long")
                        .alias("n_dup_lines"),
                        _covered_words(F.col("__five"), 5).alias("n_repeat_words"),
                        score.alias("__score"),
                    )
                )
            ).alias("__measured"),
        )
        .select(*columns, "__measured.*")
        .withColumn("base_failed", failed)
        .withColumn(
            "log_ratio", F.col("__score") / F.greatest(2 * n_words - 1, F.lit(1)).cast("double")
        )
        .withColumn("kept", ~F.col("base_failed") & (F.col("log_ratio") >= threshold))
        .drop("__score")
    )


def trusted_of(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """Keys of the documents that are labelled as good."""
    return labels.filter(F.col("quality") == 1).select(key)

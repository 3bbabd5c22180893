"""Language identification of web pages by fusing evidence.

Text likelihoods are multinomials over hashed three-byte sequences, counted for each language over
all documents whose language is known. A page's posterior is

    P(language | host) * P(text | language) * P(declared | language) * P(suffix | language)

up to scale. ``declared`` is the language attribute of the markup, ``suffix`` the address's last
label. What a host usually serves is smoothed by its domain, and the domain by all pages; how far
declarations and suffixes can be relied on is estimated as well, all by grouped sums of what the texts
alone say. A page's own share is left out of its host's and domain's sums.
"""

from __future__ import annotations

import html
import re
import sys
from collections.abc import Iterator
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W
from tillroll.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 8192
#: Sequences overlap and wording repeats, so more of them than this say no more.
EVIDENCE = 100
#: How many pages' worth the wider group counts for in a narrower one's estimate.
STRENGTH = 5.0
#: Languages that a model may have: so many times ``BUCKETS`` numbers come to the driver.
MOST_LANGUAGES = 200
#: Languages that a task sums up before it hands on what it has.
LANGUAGES_HELD = 256

_SCRIPT = re.compile(r"(?is)<(script|style)\b.*?(?:</\1\s*>|\Z)|<!--.*?(?:-->|\Z)")
_TAG = re.compile(r"(?s)<[^>]*(?:>|\Z)")
_HTML = re.compile(r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b")


def _sequences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Text and bucket of every three bytes in a row, A-Z in lower case, digits and signs alike."""
    data, offsets = W.text_bytes(texts)
    fold = np.arange(256, dtype=np.uint64)
    fold[65:91] = fold[97:123]
    fold[:65] = 32
    folded = fold[data]
    if len(folded) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = folded[:-2] | (folded[1:-1] << np.uint64(8)) | (folded[2:] << np.uint64(16))
    rows = np.repeat(np.arange(len(texts)), np.diff(offsets))
    inside = (rows[:-2] == rows[2:]) & (code != 0x202020)
    bucket = (code[inside] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - 13)
    return rows[:-2][inside], bucket.astype(np.int64)


def text_model(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages in order, and log P(bucket | language), one row for each.

    Counted over all documents with a language; one is added to every count. What comes to the
    driver is one number for each language and bucket. More than ``MOST_LANGUAGES`` different values
    are an error: the column should hold language codes.
    """
    named = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).cast("string").alias("lang"))
    if named.distinct().limit(MOST_LANGUAGES + 1).count() > MOST_LANGUAGES:
        raise ValueError(f"column {lang} has more than {MOST_LANGUAGES} languages")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            names, buckets, counts = [], [], []
            for name, sums in held.items():
                at = np.flatnonzero(sums)
                names += [name] * len(at)
                buckets.append(at)
                counts.append(sums[at])
            held.clear()
            columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (buckets, counts)]
            return pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), *map(pa.array, columns)], names=["lang", "bucket", "n"]
            )

        for batch in batches:
            for block in W.blocks(batch, "text"):
                rows, buckets = _sequences(block.column("text"))
                names = block.column("lang").dictionary_encode()
                code = names.indices.to_numpy(zero_copy_only=False)[rows]
                kinds = names.dictionary.to_pylist()
                sums = np.bincount(code * BUCKETS + buckets, minlength=len(kinds) * BUCKETS)
                for i, name in enumerate(kinds):
                    own = sums[i * BUCKETS : (i + 1) * BUCKETS].astype(np.int64)
                    held[name] = held[name] + own if name in held else own
                if len(held) > LANGUAGES_HELD:
                    yield flush()
        yield flush()

    counted = (
        docs.filter(F.col(lang).isNotNull())
        .select(F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"))
        .mapInArrow(count, "lang string, bucket long, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    table = counted.toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.ones((len(languages), BUCKETS))
    index = {name: i for i, name in enumerate(languages)}
    counts[table["lang"].map(index).to_numpy(int), table["bucket"].to_numpy(int)] += table["n"]
    return languages, np.log(counts) - np.log(counts.sum(axis=1, keepdims=True))


def visible_text(page: str) -> str:
    return html.unescape(_TAG.sub(" ", _SCRIPT.sub(" ", page)))


def address_parts(url: str) -> tuple[str, str, str]:
    """(host, domain, suffix); empty where there is none. A domain is the last two labels."""
    try:
        host = (urlsplit(url).hostname or "").strip(".").lower()
    except ValueError:
        host = ""
    labels = host.split(".")
    return host, ".".join(labels[-2:]), labels[-1] if len(labels) > 1 else ""


def page_evidence(
    pages: DataFrame,
    languages: list[str],
    log_share: np.ndarray,
    key: str = "page_id",
    url: str = "url",
    markup: str = "html",
) -> DataFrame:
    """(key, host, domain, suffix, declared, text): ``text`` has P(language | text) with all
    languages as likely beforehand, in the order of ``languages``."""
    schema = T.StructType(
        [
            T.StructField(key, pages.schema[key].dataType),
            *[T.StructField(c, T.StringType()) for c in ("host", "domain", "suffix", "declared")],
            T.StructField("text", T.ArrayType(T.DoubleType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in W.blocks(batch, "markup"):
                bodies = [x or "" for x in block.column("markup").to_pylist()]
                texts = pa.array([visible_text(x) for x in bodies], pa.large_string())
                rows, buckets = _sequences(texts)
                spans = W.row_spans(rows, len(bodies))
                n = np.diff(spans)
                logs = np.stack(
                    [W.sums_by_row(own[buckets], spans) for own in log_share], axis=1
                ) if len(languages) else np.zeros((len(bodies), 0))
                logs *= (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None]
                if len(languages):
                    logs -= logs.max(axis=1, keepdims=True)
                share = np.exp(logs)
                share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
                address = [address_parts(x or "") for x in block.column("url").to_pylist()]
                declared = [m.group(1).lower() if (m := _HTML.search(x)) else "" for x in bodies]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("key"),
                        *[pa.array([a[i] for a in address], pa.string()) for i in range(3)],
                        pa.array(declared, pa.string()),
                        pa.array(list(share), pa.list_(pa.float64())),
                    ],
                    names=schema.names,
                )

    return pages.select(
        F.col(key).alias("key"),
        F.col(url).cast("string").alias("url"),
        F.col(markup).cast("string").alias("markup"),
    ).mapInArrow(run, schema)


def _sums(rows: DataFrame, by: str, n: int, name: str) -> DataFrame:
    """(``by``, ``name``): by value, how much of each language the texts say there is."""
    return rows.groupBy(by).agg(F.array(*[F.sum(F.col("text")[i]) for i in range(n)]).alias(name))


def _total(column: Column) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda acc, x: acc + x)


def identify(
    pages: DataFrame,
    docs: DataFrame,
    key: str = "page_id",
    url: str = "url",
    markup: str = "html",
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """(key, lang, probability, text_lang, declared, host), one row for each of ``pages``.

    ``text_lang`` is what the text alone says. A page without text, address or declaration is decided
    by what else there is; of equals the first language in order. Nulls are empty. Without any
    document of known language, ``lang``, ``text_lang`` and ``probability`` are null. Repeated rows
    count and are answered each; no rows give none. Columns not named are ignored.
    """
    languages, log_share = text_model(docs, text, lang)
    n = len(languages)
    rows = stored(page_evidence(pages, languages, log_share, key, url, markup), "page-evidence")
    if n == 0:
        nothing = F.lit(None).cast("string")
        return rows.select(
            key,
            nothing.alias("lang"),
            F.lit(None).cast("double").alias("probability"),
            nothing.alias("text_lang"),
            "declared",
            "host",
        )
    whole = _sums(rows.withColumn("all", F.lit(1)), "all", n, "sums")
    pages_by_language = F.array(*[F.col("sums")[i] for i in range(n)])
    overall = whole.select(pages_by_language.alias("all_sums"))
    joined = (
        rows.join(_sums(rows, "host", n, "host_sums"), "host")
        .join(_sums(rows, "domain", n, "domain_sums"), "domain")
        .join(_sums(rows, "suffix", n, "suffix_sums"), "suffix")
        .join(_sums(rows, "declared", n, "declared_sums"), "declared")
        .withColumn("all_sums", overall.scalar())
    )
    everything = _total(F.col("all_sums"))
    prior = F.transform("all_sums", lambda x: (x + 1.0) / (everything + float(n)))

    def narrower(sums: str, wider: Column) -> Column:
        """Shares in a group without the page itself, smoothed by the wider group's."""
        others = F.zip_with(F.col(sums), F.col("text"), lambda s, t: F.greatest(s - t, F.lit(0.0)))
        size = F.greatest(_total(F.col(sums)) - 1.0, F.lit(0.0))
        return F.zip_with(others, wider, lambda o, w: (o + STRENGTH * w) / (size + STRENGTH))

    def reliability(sums: str) -> Column:
        """P(value | language), smoothed by the value's overall share; 1 without a value."""
        share = _total(F.col(sums)) / everything
        return F.zip_with(
            F.col(sums), F.col("all_sums"), lambda s, a: (s + STRENGTH * share) / (a + STRENGTH)
        )

    def one_if_missing(name: str, weights: Column) -> Column:
        return F.when(F.col(name) == "", F.array(*[F.lit(1.0)] * n)).otherwise(weights)

    fused = (
        joined.withColumn("by_all", prior)
        .withColumn("by_domain", narrower("domain_sums", F.col("by_all")))
        .withColumn("by_host", narrower("host_sums", F.col("by_domain")))
        .withColumn("by_suffix", one_if_missing("suffix", reliability("suffix_sums")))
        .withColumn("by_declared", one_if_missing("declared", reliability("declared_sums")))
        .withColumn(
            "weights",
            F.transform(
                F.sequence(F.lit(0), F.lit(n - 1)),
                lambda i: F.when(F.col("host") == "", F.col("by_all")[i]).otherwise(F.col("by_host")[i])
                * F.col("text")[i]
                * F.col("by_suffix")[i]
                * F.col("by_declared")[i],
            ),
        )
    )
    names = F.array(*[F.lit(name) for name in languages])

    def first_best(column: str) -> Column:
        return names[(F.array_position(column, F.array_max(column)) - 1).cast("int")]

    return fused.select(
        key,
        first_best("weights").alias("lang"),
        (F.array_max("weights") / _total(F.col("weights"))).alias("probability"),
        first_best("text").alias("text_lang"),
        "declared",
        "host",
    )

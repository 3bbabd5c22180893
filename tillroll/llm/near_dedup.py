"""Near-duplicate documents by MinHash bands, odd sketches and full shingle sets.

1. Every text becomes its set of distinct five-word shingles, ``SAMPLES`` MinHash samples of it,
   band keys over runs of ``ROWS`` samples, and an odd sketch: ``BITS`` parity bits into which the
   samples are folded. Texts with equal sets form a class; from here on one document stands for it.
2. Documents that share a band key form a bucket. At similarity 0.75 two documents share one with
   probability 1 - (1 - 0.75**4)**32 = 1 - 5e-6, and likelier above.
3. In each bucket all are held against its first document. The XOR of two odd sketches has about
   bits / 2 * (1 - exp(-4 * samples * (1 - J) / bits)) bits; pairs far beyond what 0.75 gives are
   dropped, the others are confirmed on the full sets. Linked documents are joined to components.
4. What is left to find are links between different components of one bucket. The documents of such
   buckets get an odd sketch of ``FINE_SAMPLES`` samples, whose estimate is within 0.06 of the truth
   for all but one pair in ten million. All pairs are held against each other by both sketches inside
   the join, so only those at the edge of 0.75 or above come out of it, and are confirmed on the full
   sets. Pairs inside a component need no test: they cannot change the result.

The texts of all documents are shuffled once, to pick those that share a bucket with another.

A group of thousands of near copies thus costs one pair for each member, not one for each pair. Nothing
is capped: every banded pair between different components is tested.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W
from tillroll.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHINGLE = 5
PERCENT = 75
BANDS, ROWS = 32, 4
SAMPLES = BANDS * ROWS
BITS = 512
FINE_SAMPLES, FINE_BITS = 2048, 4096
#: Pairs whose sketches point to a similarity below these are not confirmed: some five standard
#: deviations under 0.75.
LEAST_LIKELY = 0.45
FINE_LEAST_LIKELY = 0.69
#: Documents confirmed against one copy of another document's set.
GROUP = 256

_SKETCH = [f"s{i}" for i in range(BITS // 64)]
_FINE = [f"f{i}" for i in range(FINE_BITS // 64)]
_MEMBER = ["rep", "bands", *_SKETCH, *_FINE]


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text in ascending order, their texts, and where each begins."""
    words = W.words_of(texts, W.alphabet(lower=True))
    hashes, at = W.windows(words, k)
    found, rows = [hashes], [words.rows[at]]
    counts = np.diff(words.first)
    for n in range(1, k):
        short = np.flatnonzero(counts == n)
        if len(short):
            hashes, at = W.windows(words, n)
            own = np.isin(words.rows[at], short)
            found.append(hashes[own])
            rows.append(words.rows[at][own])
    rows, hashes, _ = W.distinct_by_row(np.concatenate(rows), np.concatenate(found))
    return hashes, rows, W.row_spans(rows, len(texts))


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def minhashes(hashes: np.ndarray, spans: np.ndarray, samples: int) -> Iterator[np.ndarray]:
    """Sample by sample, the least of each text's hashes under another order; 0 for an empty set."""
    flip = W.random_words(samples, 71)
    factor = W.random_words(samples, 72) | np.uint64(1)
    full = np.flatnonzero(np.diff(spans))
    begins = spans[:-1][full]
    scratch = np.empty_like(hashes)
    for i in range(samples):
        least = np.zeros(len(spans) - 1, np.uint64)
        if len(full):
            np.bitwise_xor(hashes, flip[i], out=scratch)
            np.multiply(scratch, factor[i], out=scratch)
            least[full] = np.minimum.reduceat(scratch, begins)
        yield least


def fold(bits: np.ndarray, sample: np.ndarray, salt: np.uint64) -> None:
    """Flip one bit of each text's sketch (a row of ``bits``) where the sample says."""
    place = W.mix(sample ^ salt) % np.uint64(bits.shape[1] * 64)
    at = (place >> np.uint64(6)).astype(np.int64)
    bits[np.arange(len(bits)), at] ^= np.uint64(1) << (place & np.uint64(63))


def signatures(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n, k1, k2, bands, s0...): set size, a 128-bit hash of the set, band keys, odd sketch."""
    schema = T.StructType(
        [
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("n", T.LongType()),
            T.StructField("k1", T.LongType()),
            T.StructField("k2", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            *[T.StructField(name, T.LongType()) for name in _SKETCH],
        ]
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = W.random_words(SAMPLES, 73)
        for batch in batches:
            for block in W.blocks(batch, "text"):
                hashes, _, spans = shingle_sets(block.column("text"))
                rows = block.num_rows
                bits = np.zeros((rows, len(_SKETCH)), np.uint64)
                keys = np.tile(np.arange(BANDS, dtype=np.uint64), (rows, 1))
                for i, sample in enumerate(minhashes(hashes, spans, SAMPLES)):
                    fold(bits, sample, salt[i])
                    keys[:, i // ROWS] = W.mix(keys[:, i // ROWS] ^ sample)
                sums = [W.sums_by_row(W.mix(hashes ^ np.uint64(c)), spans) for c in (0x1F, 0xA5C3)]
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(rows + 1) * BANDS, pa.int32()), _signed(keys.reshape(-1))
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("key"),
                        pa.array(np.diff(spans).astype(np.int64)),
                        _signed(sums[0]),
                        _signed(sums[1]),
                        bands,
                        *[_signed(bits[:, i]) for i in range(len(_SKETCH))],
                    ],
                    names=schema.names,
                )

    return docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).mapInArrow(
        sign, schema
    )


def fine_sketches(texts: DataFrame) -> DataFrame:
    """(doc, f0...): an odd sketch of ``FINE_SAMPLES`` samples for each of (doc, text)."""
    schema = T.StructType(
        [texts.schema["doc"], *[T.StructField(name, T.LongType()) for name in _FINE]]
    )

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = W.random_words(FINE_SAMPLES, 74)
        for batch in batches:
            for block in W.blocks(batch, "text", W.BLOCK_BYTES // 4):
                hashes, _, spans = shingle_sets(block.column("text"))
                bits = np.zeros((block.num_rows, len(_FINE)), np.uint64)
                for i, sample in enumerate(minhashes(hashes, spans, FINE_SAMPLES)):
                    fold(bits, sample, salt[i])
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc"), *[_signed(bits[:, i]) for i in range(len(_FINE))]],
                    names=schema.names,
                )

    return texts.select("doc", "text").mapInArrow(sketch, schema)


def most_bits(similarity: float, samples: int = SAMPLES, bits: int = BITS) -> int:
    """Bits that the sketches of two documents of this similarity differ in, as expected."""
    return math.ceil(bits / 2 * (1 - math.exp(-4 * samples * (1 - similarity) / bits)))


def _differing(a: str, b: str, names: list[str]) -> Column:
    counts = [F.bit_count(F.col(a + s).bitwiseXOR(F.col(b + s))) for s in names]
    return sum(counts[1:], counts[0])


def _likely(a: str, b: str) -> Column:
    return _differing(a, b, _SKETCH) <= most_bits(LEAST_LIKELY)


def _very_likely(a: str, b: str) -> Column:
    return _differing(a, b, _FINE) <= most_bits(FINE_LEAST_LIKELY, FINE_SAMPLES, FINE_BITS)


def _sketches(classes: DataFrame, prefix: str) -> DataFrame:
    return classes.select(
        F.col("rep").alias(f"{prefix}rep"), *[F.col(s).alias(f"{prefix}{s}") for s in _SKETCH]
    )


def confirmed(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough; ``texts`` is (doc, text).

    All partners of a document meet one copy of its set, in groups of about ``GROUP``; a task holds
    two sets at a time.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).cast("long").alias("groups"))
    grouped = pairs.join(counts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("g")
    )
    roles = (
        grouped.select(F.col("a").alias("doc"), "a", "g", F.lit(0).alias("role"))
        .distinct()
        .unionByName(grouped.select(F.col("b").alias("doc"), "a", "g", F.lit(1).alias("role")))
    )
    kind = texts.schema["doc"].dataType
    schema = T.StructType([T.StructField("a", kind), T.StructField("b", kind)])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, sets = None, []
        for batch in batches:
            for block in W.blocks(batch, "text"):
                hashes, _, spans = shingle_sets(block.column("text"))
                left, group, role, doc = (block.column(c) for c in ("a", "g", "role", "doc"))
                first, second = [], []
                groups, roles_ = group.to_pylist(), role.to_pylist()
                lefts = left.to_pylist()
                for i in range(block.num_rows):
                    own = hashes[spans[i] : spans[i + 1]]
                    at = (lefts[i], groups[i])
                    if at != held:
                        held, sets = at, []
                    if roles_[i] == 0:
                        sets.append(own.copy())
                        continue
                    for other in sets:
                        place = np.searchsorted(other, own)
                        place[place == len(other)] = 0
                        common = int(np.count_nonzero(other[place] == own)) if len(other) else 0
                        if 100 * common >= PERCENT * (len(own) + len(other) - common) > 0:
                            first.append(i)
                            second.append(i)
                            break
                yield pa.RecordBatch.from_arrays(
                    [left.take(pa.array(first, pa.int64())), doc.take(pa.array(second, pa.int64()))],
                    names=["a", "b"],
                )

    return (
        texts.join(roles.hint("merge"), "doc")
        .select("a", "g", "role", "doc", "text")
        .repartition("a", "g")
        .sortWithinPartitions("a", "g", "role")
        .mapInArrow(compare, schema)
        .distinct()
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for each node of ``edges`` (a, b): the smallest node it is connected with,
    itself included. Alternating large-star and small-star rounds (Kiveris et al., 2014)."""

    def mark(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    now = stored(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u != v")
        .distinct(),
        "edges",
    )
    seen = mark(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (
            both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).distinct()
        smaller = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(smaller, "u")
            .filter("v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(smaller.select("u", F.col("m").alias("v")))
            .distinct()
        )
        now = stored(small, "edges")
        before, seen = seen, mark(now)
        if before == seen:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept), one row for each of ``docs``.

    Words are what stands between ASCII white space, A-Z in lower case. A text of one to four words
    has one shingle, all of it; an empty or null text has none and is linked with nothing, as is a
    row with a null key. Rows that share a key count as one document. Other columns are ignored; an
    empty table gives an empty one.
    """
    signed = stored(signatures(docs, key, text), "signatures")
    classes = stored(
        signed.filter((F.col("n") > 0) & F.col("key").isNotNull())
        .groupBy("k1", "k2")
        .agg(
            F.min("key").alias("rep"),
            F.first("bands").alias("bands"),
            *[F.first(s).alias(s) for s in _SKETCH],
        ),
        "classes",
    )
    buckets = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = (
        buckets.groupBy("bucket")
        .agg(F.min("rep").alias("leader"), F.count("*").alias("size"))
        .filter("size > 1")
    )
    members = stored(
        buckets.join(shared, "bucket").filter("rep != leader").select("bucket", "rep", "leader", "size"),
        "bucket-members",
    )
    # Their number follows that of the documents: both sides are shuffled at any size.
    together = (
        members.select(F.col("rep").alias("doc"))
        .unionByName(members.select(F.col("leader").alias("doc")))
        .distinct()
        .hint("merge")
    )
    texts = stored(
        docs.select(F.col(key).alias("doc"), F.col(text).cast("string").alias("text")).join(
            together, "doc"
        ),
        "bucket-texts",
    )
    to_leader = (
        members.select("leader", "rep")
        .distinct()
        .join(_sketches(classes, "a_"), F.col("leader") == F.col("a_rep"))
        .join(_sketches(classes, "b_"), F.col("rep") == F.col("b_rep"))
        .filter(_likely("a_", "b_"))
        .select(F.col("leader").alias("a"), F.col("rep").alias("b"))
    )
    links = stored(confirmed(stored(to_leader, "pairs"), texts), "links")
    found = components(links)

    labelled = (
        members.filter("size > 2")
        .join(found, F.col("rep") == F.col("node"), "left")
        .select("bucket", "rep", F.coalesce("component", "rep").alias("component"))
    )
    mixed = (
        labelled.groupBy("bucket", "component")
        .agg(F.count("*").alias("n"))
        .groupBy("bucket")
        .agg(F.max(F.struct("n", "component"))["component"].alias("largest"), F.count("*").alias("n"))
        .filter("n > 1")
        .select("bucket", "largest")
    )
    rest = stored(labelled.join(mixed, "bucket"), "mixed-buckets")
    fine = fine_sketches(
        texts.join(rest.select(F.col("rep").alias("doc")).distinct().hint("merge"), "doc")
    ).groupBy("doc").agg(*[F.min(f).alias(f) for f in _FINE])
    sketched = stored(
        fine.join(classes, F.col("doc") == F.col("rep")).select(*_MEMBER), "fine-sketches"
    )
    rows = rest.join(sketched, "rep").select(
        "bucket",
        F.col("component").alias("a_component"),
        "largest",
        *[F.col(c).alias(f"a_{c}") for c in _MEMBER],
    )
    others = rows.select(
        F.col("bucket").alias("b_bucket"),
        F.col("a_component").alias("b_component"),
        *[F.col(f"a_{c}").alias(f"b_{c}") for c in _MEMBER],
    )
    # A pair comes out of its first common bucket only. Were one of the two its leader, the pair would
    # have been tested before.
    across = (
        rows.filter("a_component != largest")
        .join(
            others,
            (F.col("bucket") == F.col("b_bucket"))
            & (F.col("a_component") != F.col("b_component"))
            & ((F.col("b_component") == F.col("largest")) | (F.col("a_rep") < F.col("b_rep")))
            & _likely("a_", "b_")
            & _very_likely("a_", "b_")
            & (F.array_intersect("a_bands", "b_bands")[0] == F.col("bucket")),
        )
        .select(F.least("a_rep", "b_rep").alias("a"), F.greatest("a_rep", "b_rep").alias("b"))
    )
    across = stored(across, "pairs")
    if not across.isEmpty():
        more = confirmed(across, texts)
        found = components(
            found.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(more)
        )
    placed = classes.select("k1", "k2", "rep").join(found, F.col("rep") == F.col("node"), "left").select(
        "k1", "k2", F.coalesce("component", "rep").alias("component")
    )
    own = F.when((F.col("n") > 0) & F.col("key").isNotNull(), F.col("component")).otherwise(F.col("key"))
    return (
        signed.select("key", "n", "k1", "k2")
        .join(placed, ["k1", "k2"], "left")
        .select(
            F.col("key").alias(key),
            F.col("n").alias("n_shingles"),
            own.alias("component_id"),
            own.eqNullSafe(F.col("key")).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each component, that of the smallest key; of rows that share a key, that with the
    least text. Rows with a null key all stay. The columns are those of ``docs``."""
    found = stored(near_duplicates(docs, key, text), "near-duplicates")
    # As many keys as documents: both sides are shuffled at any size.
    kept = found.filter(F.col("kept") & F.col(key).isNotNull()).select(key).distinct().hint("merge")
    names = [f"`{c}`" for c in docs.columns]
    rest = [F.col(c) for c in (f"`{text}`", *[n for n in names if n not in (f"`{key}`", f"`{text}`")])]
    one = (
        docs.join(kept, key, "left_semi")
        .groupBy(key)
        .agg(F.min(F.struct(*rest)).alias("__row"))
        .select(*[F.col(key) if n == f"`{key}`" else F.col("__row")[n.strip("`")] for n in names])
    )
    return one.toDF(*docs.columns).unionByName(docs.filter(F.col(key).isNull()))

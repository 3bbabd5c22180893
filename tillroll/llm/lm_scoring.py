"""Stupid-backoff language-model scores (Brants et al., 2007) of a corpus under its own counts.

The score of a word after its context is count(context, word) / count(context) if that n-gram was
seen ``min_count`` times, else ``BACKOFF`` times the score after the context without its first word,
and in the end count(word) / words. A document's score is the sum of the scores' logarithms.

The join is laid out so that n-grams travel once, as hashes:

1. Documents are dealt into chunks of some megabytes, each text compressed by itself. A chunk's distinct n-grams of all orders, with
   their counts, are sorted by hash and cut at fixed bounds of the hash range, so that each of the
   count table's partitions gets one packet from each chunk. A frequent n-gram is one entry of a
   packet, however often it occurs.
2. In its partition the packets are merged into the n-gram count table, and every packet is joined
   with it: the answer lists the counts in the packet's order.
3. Chunks meet their answers; n-grams find their counts by rank, and scores are summed per document.

Chunks and partitions are bounded by the parameters; their numbers follow the corpus. N-grams are
told apart by 64 bits of hash at every size.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W
from tillroll.llm.frames import stored, text_mb

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ORDER = 3
MIN_COUNT = 2
BACKOFF = 0.4
#: Megabytes of text handled together, and about so many n-grams to a partition of the count table.
CHUNK_MB = 8.0
PARTITION_N_GRAMS = 2_000_000


class Entries(NamedTuple):
    """A chunk's distinct n-grams, ascending. ``at[n]``: of order n + 1, by word, the index of the
    n-gram that ends at the word, or -1. ``first``: by text, its first word, and the end."""

    hashes: np.ndarray
    counts: np.ndarray
    at: list[np.ndarray]
    first: np.ndarray


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each ``text`` as Zstandard bytes, for the one time that texts are dealt out; ``size``: its own."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        for block in W.blocks(batch, "text"):
            texts = block.column("text")
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("key"),
                    pa.array([pack(text.as_buffer()) for text in texts], pa.binary()),
                    pc.binary_length(texts).cast(pa.int64()),
                    block.column("chunk"),
                ],
                names=["key", "text", "size", "chunk"],
            )


def _texts(table: pa.Table) -> Iterator[pa.Array]:
    """What ``_compressed`` packed, about ``BLOCK_BYTES`` of it at a time."""
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    block, held = [], 0
    for packed, size in zip(table.column("text"), table.column("size").to_pylist(), strict=True):
        if block and held + size > W.BLOCK_BYTES:
            yield pa.array(block, pa.large_binary()).cast(pa.large_string())
            block, held = [], 0
        block.append(unpack(packed.as_buffer()))
        held += size
    if block:
        yield pa.array(block, pa.large_binary()).cast(pa.large_string())


def entries_of(texts: Iterable[pa.Array], order: int) -> Entries:
    letters = W.alphabet(lower=True)
    found: list[list[np.ndarray]] = [[] for _ in range(order)]
    places: list[list[np.ndarray]] = [[] for _ in range(order)]
    first, n = [np.zeros(1, np.int64)], 0
    for block in texts:
        words = W.words_of(block, letters)
        for k in range(order):
            hashes, at = W.windows(words, k + 1)
            found[k].append(hashes)
            places[k].append(at + (n + k))
        first.append(words.first[1:] + n)
        n += len(words.hashes)
    own = [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in found]
    hashes, which, counts = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    at, begin = [], 0
    for k in range(order):
        index = np.full(n, -1, np.int32)
        if places[k]:
            index[np.concatenate(places[k])] = which[begin : begin + len(own[k])]
        at.append(index)
        begin += len(own[k])
    return Entries(hashes, counts, at, np.concatenate(first))


def _bounds(partitions: int) -> np.ndarray:
    """Where each partition of the hash range begins; ``partitions`` is a power of two above 1."""
    return np.arange(partitions, dtype=np.uint64) * np.uint64((1 << 64) // partitions)


def _packed(values: np.ndarray) -> bytes:
    """Unsigned numbers by byte plane, lowest first, compressed."""
    import zstandard

    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes)


def _unpacked(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<u8").reshape(-1)


def _steps(hashes: np.ndarray) -> np.ndarray:
    """Ascending numbers as differences, which are shorter."""
    return np.diff(hashes, prepend=np.uint64(0))


_PACKET = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("hashes", T.BinaryType()),
        T.StructField("counts", T.BinaryType()),
    ]
)
_ANSWER = T.StructType(
    [
        T.StructField("chunk", T.LongType()),
        T.StructField("part", T.LongType()),
        T.StructField("counts", T.BinaryType()),
    ]
)


def score_documents(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    order: int = ORDER,
    min_count: int = MIN_COUNT,
    backoff: float = BACKOFF,
    chunk_mb: float = CHUNK_MB,
    partition_n_grams: int = PARTITION_N_GRAMS,
) -> DataFrame:
    """(key, n_words, n_by_order, log_score, mean_log_score), one row for each of ``docs``.

    Words stand between ASCII white space, A-Z in lower case. N-grams do not cross documents; counts
    cover all documents and tell n-grams apart by 64-bit hashes. ``n_by_order[i]``: words whose score came from order i + 1. ``log_score``:
    sum of natural logarithms, 0 without words; ``mean_log_score``: null without words. Null texts
    are empty; repeated rows count and are scored each; other columns are ignored.
    """
    # From a terabyte on chunks grow as well, so that packets do not thin out as fast.
    mb = text_mb(docs, text)
    chunk = max(chunk_mb, chunk_mb * math.sqrt(mb / 1e6))
    chunks = max(1, math.ceil(mb / chunk))
    n_grams = mb * 1e6 / 6 * order
    partitions = 1 << max(3, math.ceil(math.log2(max(1.0, n_grams / partition_n_grams))))

    kind = docs.schema[key].dataType
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    dealt = (
        rows.withColumn("chunk", F.pmod(F.xxhash64("key", F.xxhash64("text")), F.lit(chunks)).cast("long"))
        .mapInArrow(
            _compressed,
            T.StructType(
                [
                    T.StructField("key", kind),
                    T.StructField("text", T.BinaryType()),
                    T.StructField("size", T.LongType()),
                    T.StructField("chunk", T.LongType()),
                ]
            ),
        )
        .repartition(chunks, "chunk")
    )

    def send(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending")])
        found = entries_of(_texts(table), order)
        cuts = np.append(np.searchsorted(found.hashes, _bounds(partitions)), len(found.hashes))
        own = [i for i in range(partitions) if cuts[i] < cuts[i + 1]]
        return pa.table(
            [
                pa.array([group[0].as_py()] * len(own), pa.int64()),
                pa.array(own, pa.int64()),
                pa.array(
                    [_packed(_steps(found.hashes[cuts[i] : cuts[i + 1]])) for i in own], pa.binary()
                ),
                pa.array([_packed(found.counts[cuts[i] : cuts[i + 1]]) for i in own], pa.binary()),
            ],
            names=_PACKET.names,
        )

    def answer(table: pa.Table) -> pa.Table:
        hashes = [
            np.cumsum(_unpacked(x), dtype=np.uint64) for x in table.column("hashes").to_pylist()
        ]
        counts = [_unpacked(x) for x in table.column("counts").to_pylist()]
        everything = np.concatenate(hashes)
        _, which = np.unique(everything, return_inverse=True)
        total = np.bincount(which, weights=np.concatenate(counts)).astype(np.uint64)[which]
        ends = np.cumsum([len(x) for x in hashes])
        return pa.table(
            [
                table.column("chunk"),
                table.column("part"),
                pa.array([_packed(x) for x in np.split(total, ends[:-1])], pa.binary()),
            ],
            names=_ANSWER.names,
        )

    result = T.StructType(
        [
            T.StructField(key, kind),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_by_order", T.ArrayType(T.LongType())),
            T.StructField("log_sum", T.DoubleType()),
        ]
    )

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending")])
        found = entries_of(_texts(table), order)
        answers = answers.sort_by([("part", "ascending")])
        parts = [_unpacked(x) for x in answers.column("counts").to_pylist()]
        counts = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        counts = counts.astype(np.float64)
        n = len(found.at[0])
        log = np.zeros(n)
        used = np.zeros(n, np.int64)
        open_ = np.ones(n, dtype=bool)
        for k in range(order, 1, -1):
            at = found.at[k - 1]
            seen = np.flatnonzero(open_ & (at >= 0))
            seen = seen[counts[at[seen]] >= min_count]
            log[seen] += np.log(counts[at[seen]]) - np.log(counts[found.at[k - 2][seen - 1]])
            used[seen] = k
            open_[seen] = False
            # Only a word that has so long a context gives it up.
            log[open_ & (at >= 0)] += math.log(backoff)
        log[open_] += np.log(counts[found.at[0][open_]])
        used[open_] = 1
        first = found.first
        by_order = np.stack(
            [W.sums_by_row((used == k).astype(np.int64), first) for k in range(1, order + 1)], axis=1
        )
        return pa.table(
            [
                table.column("key"),
                pa.array(np.diff(first).astype(np.int64)),
                pa.array(list(by_order), pa.list_(pa.int64())),
                pa.array(W.sums_by_row(log, first)),
            ],
            names=result.names,
        )

    packets = dealt.groupBy("chunk").applyInArrow(send, _PACKET)
    answers = packets.groupBy("part").applyInArrow(answer, _ANSWER)
    sums = stored(
        dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, result),
        "document-scores",
    )
    log_words = F.log(F.greatest(sums.agg(F.sum("n_words").alias("n")).scalar(), F.lit(1)))
    total = F.col("log_sum") - F.col("n_by_order")[0] * log_words
    return sums.select(
        key,
        "n_words",
        "n_by_order",
        total.alias("log_score"),
        F.when(F.col("n_words") > 0, total / F.col("n_words")).alias("mean_log_score"),
    )

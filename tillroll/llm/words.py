"""Words of many texts at once, as hashes, straight from an Arrow column's bytes.

A text's bytes are cut into words at separator bytes, and every word gets a 64-bit polynomial hash
from one running sum over the whole block of texts, so the cost is a few passes over the bytes and
no Python work per word. Word windows (shingles, n-grams) are hashed from the word hashes. Hashes
depend on the words alone: not on the block, the task or the machine.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle

# Executors need not have this package: its functions travel to them by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Text handled at a time inside a task; one longer text is a block of its own.
BLOCK_BYTES = 2_000_000

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of the input reaches every bit."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xA0761D6478BD642F)
    x ^= x >> np.uint64(32)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    start = np.uint64((seed * 0x2545F4914F6CDD1D + 0x632BE59BD9B4E019) & _MASK)
    return mix(mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_BASE) + start))


class Alphabet(NamedTuple):
    """``inside``: by byte, whether it belongs to a word. ``value``: what it adds to a hash."""

    inside: np.ndarray
    value: np.ndarray


def alphabet(lower: bool = False, alphanumeric: bool = False) -> Alphabet:
    """Words are what stands between the six ASCII white-space bytes, or with ``alphanumeric``
    runs of ASCII letters, digits and non-ASCII bytes. ``lower`` folds A-Z."""
    code = np.arange(256)
    if alphanumeric:
        inside = (
            ((code >= 48) & (code <= 57))
            | ((code >= 65) & (code <= 90))
            | ((code >= 97) & (code <= 122))
            | (code >= 128)
        )
    else:
        inside = ~((code == 32) | ((code >= 9) & (code <= 13)))
    value = random_words(256, 1)
    if lower:
        value[65:91] = value[97:123]
    return Alphabet(inside, value)


class Words(NamedTuple):
    """``starts``, ``ends``: byte positions in ``data``. ``first``: by row, its first word's index,
    and one more entry, the number of words. ``rows``: each word's row."""

    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray
    rows: np.ndarray


#: Bytes whose hashes are summed up at a time.
_STRIDE = 1 << 16
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """``base`` to the powers 0 to n - 1; ``n`` is at most ``_STRIDE``."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = min(_STRIDE, max(n, 1 << 14, 2 * (0 if have is None else len(have))))
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = _powers[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes end to end, and where each begins (one more entry: the end). Null: empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
    if len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def hashes_between(
    values: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = None
) -> np.ndarray:
    """A hash of the run of ``values`` from each start to each end, the same wherever the run stands.

    Runs are in ascending order and do not overlap. With ``table``, the run is of its entries at
    ``values``. The sums are taken stride by stride, so memory beside the arguments follows the
    number of runs.
    """
    at_start = np.zeros(len(starts), np.uint64)
    at_end = np.zeros(len(starts), np.uint64)
    down = np.zeros(len(starts), np.uint64)
    total = np.zeros(1, np.uint64)
    for a in range(0, len(values), _STRIDE):
        part = values[a : a + _STRIDE]
        n = len(part)
        sums = np.zeros(n + 1, np.uint64)
        own = (part if table is None else table[part]) * _power(_BASE, n)
        np.cumsum(own * np.uint64(pow(_BASE, a, 1 << 64)), out=sums[1:])
        sums += total
        total = sums[n:].copy()
        i, j = np.searchsorted(starts, (a, a + n))
        at_start[i:j] = sums[starts[i:j] - a]
        back = np.uint64(pow(_BASE_INVERSE, a, 1 << 64))
        down[i:j] = _power(_BASE_INVERSE, n)[starts[i:j] - a] * back
        i, j = np.searchsorted(ends, (a, a + n), side="right")
        at_end[i:j] = sums[ends[i:j] - a]
    return mix((at_end - at_start) * down)


def words_of(texts: pa.Array, letters: Alphabet) -> Words:
    data, offsets = text_bytes(texts)
    n = len(data)
    inside = letters.inside[data]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | edge[1:n]
    finish = inside.copy()
    finish[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(finish) + 1
    hashes = hashes_between(data, starts, ends, letters.value)
    first = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(len(texts)), np.diff(first))
    return Words(data, offsets, starts, ends, hashes, first, rows)


def windows(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``k`` words from each word on, and the words at which such a window fits."""
    n = len(words.hashes)
    if n < k:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.rows[: n - k + 1] == words.rows[k - 1 :])
    value = words.hashes[: n - k + 1].copy()
    for j in range(1, k):
        value *= np.uint64(_STEP)
        value += words.hashes[j : n - k + 1 + j]
    return mix(value[at] + np.uint64(k)), at


def blocks(batch: pa.RecordBatch, column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows that hold about ``most`` bytes of text."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes, dtype=np.int64) - 1) // most
    cuts = np.flatnonzero(np.diff(group)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)


def row_spans(rows: np.ndarray, n: int) -> np.ndarray:
    """For ascending ``rows``: where each of ``n`` rows begins, and the end."""
    return np.searchsorted(rows, np.arange(n + 1))


def sums_by_row(values: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Sum of ``values`` over each span; integers wrap."""
    total = np.zeros(len(values) + 1, dtype=values.dtype)
    np.cumsum(values, out=total[1:])
    return total[spans[1:]] - total[spans[:-1]]


def distinct_by_row(rows: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (row, hash) in ascending order, and how often each occurs."""
    if len(hashes) == 0:
        return rows, hashes, np.zeros(0, np.int64)
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return rows[at], hashes[at], np.diff(np.append(at, len(rows)))

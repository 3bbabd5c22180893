"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A is a byte-level BPE, B a piece BPE with byte fallback. Both write a text as tokens that
spell the same bytes, a space and the text. Where a token of A and one of B end at the same byte, both
are cut; the tokens between two cuts are a group, and each A token of a group is linked with each B
token of it.

The cuts come from a galloping intersection of the two lists of token ends: each end of the shorter
list is looked for in the longer one, from where a close earlier one was found, in steps that double,
then by bisection between the last two steps. The ends of many texts are one ascending list, and many
ends gallop side by side. Ends in common slice the groups, and the differences of their ranks in the
two lists say how many tokens of each a group has and so which ranges of them overlap.

How many documents of the corpus hold a pair of ids linked is counted by grouped aggregation. Documents
are dealt into chunks; a chunk sends each different pair once, with its number of documents, the sums
are joined back to the chunks' pairs, and the documents of a chunk look theirs up.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W
from tillroll.llm.frames import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes that a tokenizer gets at a time, where there is a place to cut.
PIECE = 1 << 16
#: Ends between two that gallop one after the other; the others start from the last of those.
_STRIDE = 64
#: Items whose text is made at a time.
_ITEMS = 1 << 18
#: Pairs of one group that are written out; a larger group's are counted by different ids.
_PAIRS = 1 << 20
#: Links to a chunk: about 8 MB of text.
CHUNK_LINKS = 2_000_000
#: A pair of ids is one number: A's above this many bits, B's within them.
ID_BITS = 20


def gallop(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """For each of ascending ``short``, how many of ascending ``long`` are less."""
    n = len(long)
    marks = []
    low = 0
    for end in short[::_STRIDE].tolist():
        high, step = low, 1
        while high < n and long[high] < end:
            low = high + 1
            high += step
            step *= 2
        low += int(np.searchsorted(long[low : min(high, n)], end))
        marks.append(low)
    low = np.repeat(np.array(marks, np.int64), _STRIDE)[: len(short)]
    high = low.copy()
    step = 1
    some = np.flatnonzero(high < n)
    while len(some := some[long[high[some]] < short[some]]):
        low[some] = high[some] + 1
        high[some] += step
        step *= 2
        some = some[high[some] < n]
    np.minimum(high, n, out=high)
    some = np.flatnonzero(low < high)
    while len(some):
        middle = (low[some] + high[some]) // 2
        less = long[middle] < short[some]
        low[some] = np.where(less, middle + 1, low[some])
        high[some] = np.where(less, high[some], middle)
        some = some[low[some] < high[some]]
    return low


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ascending ``a`` and ``b`` of the numbers that stand in both."""
    if len(a) > len(b):
        second, first = common_ends(b, a)
        return first, second
    rank = gallop(a, b)
    found = np.flatnonzero(rank < len(b))
    found = found[b[rank[found]] == a[found]]
    return found, rank[found]


def byte_of_sign() -> dict[str, int]:
    """The signs that a byte-level vocabulary writes bytes as: printable Latin-1 as itself, the other
    bytes, in order, as the code points from 256 on."""
    itself = [*range(33, 127), *range(161, 173), *range(174, 256)]
    signs = {chr(byte): byte for byte in itself}
    others = [byte for byte in range(256) if byte not in set(itself)]
    return signs | {chr(256 + i): byte for i, byte in enumerate(others)}


class Spelling:
    """The bytes that ids stand for."""

    def __init__(self, tokens: list[bytes]):
        self.length = np.array([len(token) for token in tokens], np.int64)
        self._at = np.cumsum(self.length) - self.length
        self._bytes = np.frombuffer(b"".join(tokens), np.uint8)

    def of(self, ids: np.ndarray) -> np.ndarray:
        length = self.length[ids]
        after = np.cumsum(length)
        place = np.repeat(self._at[ids] - (after - length), length)
        return self._bytes[place + np.arange(len(place))]


class Tokenizers:
    """Ids of pieces of text under both tokenizers, without special tokens.

    ``path_a``: a byte-level BPE, as a ``tokenizers`` file or, which is faster, as ranks (``.tiktoken``).
    ``path_b``: a piece model. A piece of text begins with the space that B adds by itself.
    """

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        tokens_a = self._ranks(path_a) if path_a.endswith(".tiktoken") else self._file(path_a)
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        tokens_b = [
            bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("▁", " ").encode()
            for i, piece in enumerate(pieces)
        ]
        if max(len(tokens_a), len(tokens_b)) > 1 << ID_BITS:
            raise ValueError(f"ids have more than {ID_BITS} bits")
        self.spelling = Spelling(tokens_a), Spelling(tokens_b)
        #: No piece goes on over a space that follows other text, so there texts can be cut.
        self.cuts = not any("▁" in piece.lstrip("▁") for piece in pieces)

    def _ranks(self, path: str) -> list[bytes]:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as file:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
        coder = tiktoken.Encoding(
            "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._encode_a = coder.encode_ordinary
        return sorted(ranks, key=ranks.get)

    def _file(self, path: str) -> list[bytes]:
        from tokenizers import Tokenizer

        coder = Tokenizer.from_file(path)
        coder.encode_special_tokens = True  # their strings in a text are ordinary text
        self._encode_a = lambda text: coder.encode(text, add_special_tokens=False).ids
        byte = byte_of_sign()
        signs = [coder.id_to_token(i) or "" for i in range(coder.get_vocab_size())]
        return [bytes(byte[c] for c in sign) if all(c in byte for c in sign) else sign.encode() for sign in signs]

    def encode(self, pieces: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        return [self._encode_a(piece) for piece in pieces], self._b.encode([piece[1:] for piece in pieces], num_threads=1)

    def pieces(self, data: np.ndarray, offsets: np.ndarray, most: int) -> np.ndarray:
        """Where pieces of about ``most`` bytes begin. ``data``: texts end to end, a space before each."""
        first = offsets[:-1]
        if not self.cuts or not len(first) or np.diff(offsets).max() <= most:
            return first
        # A space goes to what follows it if what stands before is not white space. A byte beyond
        # ASCII may belong to white space; then what follows has to be visible ASCII.
        before, after = data[:-2], data[2:]
        seen = (after > 32) & (after < 127)
        begins = (data[1:-1] == 32) & (((before > 32) & (before < 127)) | ((before >= 128) & seen))
        at = np.flatnonzero(begins) + 1
        # Not across the edge of two texts, and not with nothing after it.
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        at = at[~edge[at] & ~edge[at + 1]]
        text = np.searchsorted(offsets, at, side="right") - 1
        part = (at - offsets[text]) // most
        new = np.ones(len(at), dtype=bool)
        new[1:] = (part[1:] != part[:-1]) | (text[1:] != text[:-1])
        return np.union1d(first, at[new & (part > 0)])


class Side(NamedTuple):
    """One tokenizer's ids of texts that are spelled well, end to end. ``first``: by text, where its
    ids begin, and the end. ``cuts``: where groups end, as places in ``ids``."""

    ids: np.ndarray
    first: np.ndarray
    cuts: np.ndarray


class Aligned(NamedTuple):
    """``good``: by text, whether it is not empty and both tokenizers spell it. Other texts have no
    ids. ``groups``: by text, its first group, and the end."""

    good: np.ndarray
    a: Side
    b: Side
    groups: np.ndarray


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.array([len(x) for x in lists], np.int64)
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, counts.sum()), counts


def _spelled(spelling: Spelling, ids: np.ndarray, first: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """By text, whether its ids spell its bytes."""
    size = np.diff(offsets)
    good = W.sums_by_row(spelling.length[ids], first) == size
    for i in np.flatnonzero(good & (size > _ITEMS)).tolist():  # long texts some ids at a time
        at = offsets[i]
        for a in range(first[i], first[i + 1], _ITEMS // 8):
            part = spelling.of(ids[a : min(a + _ITEMS // 8, first[i + 1])])
            good[i] &= np.array_equal(part, data[at : at + len(part)])
            at += len(part)
    short = good & (size <= _ITEMS)
    part = spelling.of(ids[np.repeat(short, np.diff(first))])
    wrong = part != data[np.repeat(short, size)]
    spans = np.append(0, np.cumsum(np.where(short, size, 0)))
    return good & (W.sums_by_row(wrong.astype(np.int64), spans) == 0)


def align(tokenizers: Tokenizers, texts: pa.Array, most: int = PIECE) -> Aligned:
    """``texts`` aligned; null ones are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
    data, offsets = W.text_bytes(pc.binary_join_element_wise(space, texts, nothing))
    n = len(texts)
    starts = tokenizers.pieces(data, offsets, most)
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    pieces = [data[a:b].tobytes().decode() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
    text = np.searchsorted(offsets, starts, side="right") - 1
    good = np.diff(offsets) > 1
    sides = []
    for lists, spelling in zip(tokenizers.encode(pieces), tokenizers.spelling, strict=True):
        ids, counts = _flat(lists)
        first = np.append(0, np.cumsum(np.bincount(text, weights=counts, minlength=n).astype(np.int64)))
        good &= _spelled(spelling, ids, first, data, offsets)
        sides.append((ids, first))
    kept, ends = [], []
    for (ids, first), spelling in zip(sides, tokenizers.spelling, strict=True):
        ids = ids[np.repeat(good, np.diff(first))]
        first = np.append(0, np.cumsum(np.where(good, np.diff(first), 0)))
        kept.append((ids, first))
        ends.append(np.cumsum(spelling.length[ids]))
    # Texts that are spelled well have the same bytes on both sides, so all ends are one list.
    cuts = [at + 1 for at in common_ends(*ends)]
    a, b = (Side(ids, first, own) for (ids, first), own in zip(kept, cuts, strict=True))
    return Aligned(good, a, b, np.searchsorted(a.cuts, a.first, side="right"))


def group_digests(found: Aligned) -> list[str]:
    """By text, the SHA-256 of its groups as ``a1,a2|b1;a3|b2,b3``; empty for a text without."""
    a, b = found.a, found.b
    n_a, n_b = np.diff(a.cuts, prepend=0), np.diff(b.cuts, prepend=0)
    items = len(a.ids) + len(b.ids)
    ids = np.empty(items, np.int64)
    after = np.empty(items, np.uint8)
    # A group's A ids come after all B ids of earlier groups, its B ids after its A ids.
    place_a = np.arange(len(a.ids)) + np.repeat(b.cuts - n_b, n_a)
    place_b = np.arange(len(b.ids)) + np.repeat(a.cuts, n_b)
    ids[place_a], ids[place_b] = a.ids, b.ids
    after[:] = ord(",")
    after[place_a[a.cuts - 1]], after[place_b[b.cuts - 1]] = ord("|"), ord(";")
    first = a.first + b.first
    hashes = [hashlib.sha256() if good else None for good in found.good]
    held = 0  # the text that the items now belong to
    for begin in range(0, items, _ITEMS):
        part = slice(begin, min(begin + _ITEMS, items))
        digits = _DIGITS.length[ids[part]]
        end = np.cumsum(digits + 1)
        text = np.empty(int(end[-1]), np.uint8)
        sign = np.zeros(len(text), dtype=bool)
        sign[end - 1] = True
        text[sign], text[~sign] = after[part], _DIGITS.of(ids[part])
        while held < len(hashes):
            low, high = max(first[held], part.start), min(first[held + 1], part.stop)
            if low < high:
                own = text[end[low - part.start - 1] if low > part.start else 0 : end[high - part.start - 1]]
                # The last group of a text is followed by nothing.
                hashes[held].update(own[:-1] if high == first[held + 1] else own)
            if first[held + 1] > part.stop:
                break
            held += 1
    return [own.hexdigest() if own is not None else "" for own in hashes]


_DIGITS = Spelling([str(i).encode() for i in range(1 << 17)])


def links(found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different links of each text, ascending: text, pair of ids, how often."""
    a, b = found.a, found.b
    n_a, n_b = np.diff(a.cuts, prepend=0), np.diff(b.cuts, prepend=0)
    row = np.repeat(np.arange(len(found.good)), np.diff(found.groups))
    small = n_a * n_b <= _PAIRS
    times_a = np.repeat(np.where(small, n_b, 0), n_a)  # how many links an A token has
    own_a = np.repeat(a.ids, times_a)
    begin = np.repeat(np.repeat(b.cuts - n_b, n_a), times_a)
    nth = np.arange(len(own_a)) - np.repeat(np.cumsum(times_a) - times_a, times_a)
    keys = [np.repeat(np.repeat(row, n_a), times_a) << (2 * ID_BITS) | own_a << ID_BITS | b.ids[begin + nth]]
    counts = [np.ones(len(own_a), np.int64)]
    for g in np.flatnonzero(~small).tolist():
        ids_a, often_a = np.unique(a.ids[a.cuts[g] - n_a[g] : a.cuts[g]], return_counts=True)
        ids_b, often_b = np.unique(b.ids[b.cuts[g] - n_b[g] : b.cuts[g]], return_counts=True)
        keys.append((int(row[g]) << (2 * ID_BITS) | ids_a[:, None] << ID_BITS | ids_b[None, :]).ravel())
        counts.append((often_a[:, None] * often_b[None, :]).ravel())
    key = np.concatenate(keys)
    order = np.argsort(key)
    key, count = key[order], np.concatenate(counts)[order]
    at = np.flatnonzero(np.diff(key, prepend=-1))
    times = np.add.reduceat(count, at) if len(at) else count
    key = key[at]
    return key >> (2 * ID_BITS), key & ((1 << (2 * ID_BITS)) - 1), times


def _packed(pairs: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending pairs as differences, and their times, by byte plane and compressed."""
    import zstandard

    both = np.concatenate([np.diff(pairs, prepend=0), times]).astype("<i8")
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(both.view(np.uint8).reshape(-1, 8).T))


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view("<i8").reshape(-1)
    n = len(both) // 2
    return np.cumsum(both[:n]), both[n:]


def _links_of(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, pair and times of every link of a column of packed links."""
    parts = [_unpacked(x) if x else (np.zeros(0, np.int64),) * 2 for x in column.to_pylist()]
    rows = np.repeat(np.arange(len(parts)), [len(pairs) for pairs, _ in parts])
    pairs, times = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*parts, strict=True))
    return rows, pairs, times


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, pa.int32()))


def alignments(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    key: str = "doc_id",
    text: str = "text",
    with_tokens: bool = False,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups_sha256, links[, a, b, cuts_a, cuts_b]): a row for
    each of ``docs``.

    ``groups_sha256``: SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``. ``links``: the different links
    and how often each occurs, packed. With ``with_tokens`` the ids of both tokenizers and, for each
    group, how many tokens of either stand up to its end. Special tokens are never added, and strings
    that spell one are plain text. Null and empty texts, and texts that one of the tokenizers does
    not spell byte by byte (one with U+2581 in it, which B takes for a space), have no tokens: zeros
    and empty strings. Repeated rows give repeated results; other columns are ignored; an empty
    table gives none. A text of any length is encoded whole.
    """
    fields = [
        T.StructField(key, docs.schema[key].dataType),
        *[T.StructField(name, T.LongType()) for name in ("n_a", "n_b", "n_groups", "n_links")],
        T.StructField("groups_sha256", T.StringType()),
        T.StructField("links", T.BinaryType()),
    ]
    lists = ("a", "b", "cuts_a", "cuts_b") if with_tokens else ()
    fields += [T.StructField(name, T.ArrayType(T.IntegerType())) for name in lists]
    names = [field.name for field in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizers = Tokenizers(path_a, path_b)
        for batch in batches:
            for block in W.blocks(batch, "text"):
                found = align(tokenizers, block.column("text"))
                linked, pairs, times = links(found)
                of = W.row_spans(linked, block.num_rows)
                packed = [
                    _packed(pairs[a:b], times[a:b]) if good else b""
                    for a, b, good in zip(of, of[1:], found.good, strict=False)
                ]
                sides = (found.a, found.b)
                columns = [
                    block.column("key"),
                    *[pa.array(np.diff(side.first)) for side in sides],
                    pa.array(np.diff(found.groups)),
                    pa.array(W.sums_by_row(times, of)),
                    pa.array(group_digests(found)),
                    pa.array(packed, pa.binary()),
                ]
                if with_tokens:
                    for side in sides:
                        columns.append(_lists(side.ids, side.first))
                    for side in sides:
                        shift = np.repeat(side.first[:-1], np.diff(found.groups))
                        columns.append(_lists(side.cuts - shift, found.groups))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, T.StructType(fields))


def link_counts(asked: DataFrame) -> DataFrame:
    """(pair, count, best) from (pair, n): in how many documents a pair is linked, and whether no
    pair with the same A id is in more."""
    counts = asked.groupBy("pair").agg(F.sum("n").alias("count"))
    # The pairs of one A id are no more than B has ids.
    most = F.max("count").over(Window.partitionBy(F.shiftright("pair", ID_BITS)))
    return counts.select("pair", "count", (F.col("count") == most).alias("best"))


def aligned_documents(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    key: str = "doc_id",
    text: str = "text",
    chunk_links: int = CHUNK_LINKS,
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each of ``docs``.

    A pair of ids counts the documents that hold it linked, each once, over all rows; repeated rows
    are documents of their own. ``n_best``: links whose pair counts as much as any of its A id's;
    ``count_sum``: the sum of the counts over all links. See ``alignments`` for the rest.
    """
    rows = stored(alignments(docs, path_a, path_b, key, text), "alignments")
    chunks = max(1, math.ceil((rows.agg(F.sum("n_links")).first()[0] or 0) / chunk_links))
    chunk = F.pmod(F.xxhash64(key, "groups_sha256"), F.lit(chunks)).cast("long")
    shown = ("n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    dealt = rows.select(F.col(key).alias("key"), *shown, "links", chunk.alias("chunk")).repartition(chunks, "chunk")
    pair_type = T.StructType(
        [T.StructField(name, T.LongType()) for name in ("chunk", "pair", "n")]
    )

    def ask(group: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        _, pairs, _ = _links_of(table.column("links"))
        own, n = np.unique(pairs, return_counts=True)
        chunk = np.full(len(own), group[0].as_py())
        return pa.table([pa.array(chunk), pa.array(own), pa.array(n)], names=pair_type.names)

    asked = stored(dealt.groupBy("chunk").applyInArrow(ask, pair_type), "linked-pairs")
    # Neither side is bounded: both are shuffled at any size.
    answers = asked.select("chunk", "pair").join(link_counts(asked).hint("merge"), "pair")
    result = T.StructType(
        [
            T.StructField(key, docs.schema[key].dataType),
            *[T.StructField(name, rows.schema[name].dataType) for name in shown],
            T.StructField("n_best", T.LongType()),
            T.StructField("count_sum", T.LongType()),
        ]
    )

    def score(table: pa.Table, answers: pa.Table) -> pa.Table:
        answers = answers.sort_by("pair")
        known, count = answers.column("pair").to_numpy(), answers.column("count").to_numpy()
        best = answers.column("best").to_numpy().astype(np.int64)
        linked, pairs, times = _links_of(table.column("links"))
        at = np.searchsorted(known, pairs)
        spans = W.row_spans(linked, table.num_rows)
        return pa.table(
            [
                *[table.column(name) for name in ("key", *shown)],
                pa.array(W.sums_by_row(best[at] * times, spans)),
                pa.array(W.sums_by_row(count[at] * times, spans)),
            ],
            names=result.names,
        )

    scored = dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, result)
    return scored.select(key, "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")

"""Token ids of whole texts, cut into pieces that fit a sequence.

A text's ids are the tokenizer's own. Since the tokenizer drops white space and treats what stands
between as independent, each distinct run of letters, digit or run of signs is encoded once per
worker and looked up afterwards; stretches with anything unusual in them (an apostrophe, which can
begin a contraction, control characters, letters beyond Latin-1) are encoded as they stand, by the
whole tokenizer. So are whole texts in which a special token is spelled out: the tokenizer gives such
a string the special token's id.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillroll.llm import words as W

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_TOKENS = 4096
END_ID = 1
#: Distinct runs remembered by a worker; beyond that it starts afresh.
REMEMBERED = 1_000_000


class WordTokenizer:
    """Ids of blocks of texts under a lower-casing BPE tokenizer whose words end at white space."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self._whole = Tokenizer.from_file(path)
        added = self._whole.get_added_tokens_decoder().values()
        self._special = [token.content for token in added]
        self._model = self._whole.model
        self._bytes = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        code = np.arange(256)
        letter = ((code >= 65) & (code <= 90)) | ((code >= 97) & (code <= 122)) | (code >= 128)
        digit = (code >= 48) & (code <= 57)
        space = (code == 32) | ((code >= 9) & (code <= 13))
        self._kind = np.where(space, 0, np.where(letter, 1, np.where(digit, 2, 3))).astype(np.uint8)
        self._odd = (code == 39) | ((code < 32) & ~space) | (code == 127)
        self._raw = W.random_words(256, 2)
        self._folded = W.random_words(256, 1)
        self._folded[65:91] = self._folded[97:123]
        self._folded[0x80:0x9F] = self._folded[0xA0:0xBF]  # capitals of Latin-1 after 0xC3
        self._forget()

    def _forget(self) -> None:
        self._known = np.zeros(0, np.uint64)
        self._at = np.zeros(0, np.int64)
        self._length = np.zeros(0, np.int64)
        self._ids = np.zeros(0, np.uint32)

    def _encode(self, run: bytes, odd: bool) -> list[int]:
        text = run.decode("utf-8", "replace")
        if odd:
            return self._whole.encode(text, add_special_tokens=False).ids
        text = text.lower()
        if not text.isascii():
            text = self._bytes.pre_tokenize_str(text)[0][0]
        return [token.id for token in self._model.tokenize(text)]

    def _runs(self, texts: pa.Array):
        data, offsets = W.text_bytes(texts)
        n = len(data)
        kind = self._kind[data]
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        changed = np.ones(n, dtype=bool)
        changed[1:] = (kind[1:] != kind[:-1]) | edge[1:n] | (kind[1:] == 2)
        inside = kind != 0
        odd = self._odd[data]
        high = data >= 0x80
        value = self._folded[data]
        odd_start = np.zeros(0, np.int64)
        if high.any() or odd.any():
            lead = data == 0xC3
            after = np.zeros(n, dtype=bool)
            after[1:] = lead[:-1]
            odd |= (high & ~lead & ~after) | (after & ((data == 0x97) | (data == 0xB7)))
            if odd.any():
                begin = inside.copy()
                begin[1:] &= ~inside[:-1] | edge[1:n]
                stretch = np.cumsum(begin) - 1
                strange = np.zeros(int(stretch[-1]) + 1 if n else 0, dtype=bool)
                strange[stretch[odd]] = True
                within = strange[stretch] & inside
                changed &= ~within | begin
                changed |= begin
                value = np.where(within, self._raw[data], value)
                odd_start = np.flatnonzero(begin)[strange]
        begin = changed & inside
        finish = inside.copy()
        finish[:-1] &= begin[1:] | ~inside[1:] | edge[1:n]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(finish) + 1
        hashes = W.hashes_between(value, starts, ends)
        is_odd = np.zeros(len(starts), dtype=bool)
        is_odd[np.searchsorted(starts, odd_start)] = True
        hashes[is_odd] ^= np.uint64(0x5851F42D4C957F2D)
        return data, starts, ends, hashes, is_odd, np.searchsorted(starts, offsets)

    def _learn(self, fresh: np.ndarray, runs: list[bytes], odd: np.ndarray) -> None:
        coded = [self._encode(run, strange) for run, strange in zip(runs, odd, strict=True)]
        length = np.array([len(x) for x in coded], np.int64)
        at = len(self._ids) + np.cumsum(length) - length
        self._ids = np.concatenate(
            [self._ids, np.array([x for ids in coded for x in ids], np.uint32)]
        )
        place = np.searchsorted(self._known, fresh)
        self._known = np.insert(self._known, place, fresh)
        self._at = np.insert(self._at, place, at)
        self._length = np.insert(self._length, place, length)

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids end to end, and where each text's begin (one more entry: the end)."""
        spelled = np.zeros(len(texts), dtype=bool)
        for token in self._special:
            found = pc.fill_null(pc.match_substring(texts, token), False)
            spelled |= found.to_numpy(zero_copy_only=False)
        if not spelled.any():
            return self._ids_of(texts)
        flat, first = self._ids_of(pc.if_else(pa.array(spelled), pa.scalar("", texts.type), texts))
        length = np.diff(first)
        whole = [
            np.array(self._whole.encode(text.as_py(), add_special_tokens=False).ids, np.uint32)
            for text in texts.filter(pa.array(spelled))
        ]
        length[spelled] = [len(ids) for ids in whole]
        first = np.append(0, np.cumsum(length))
        every = np.empty(first[-1], np.uint32)
        from_whole = np.repeat(spelled, length)
        every[~from_whole] = flat
        every[from_whole] = np.concatenate(whole)
        return every, first

    def _ids_of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        data, starts, ends, hashes, is_odd, first = self._runs(texts)
        distinct, example, which = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self._known) > REMEMBERED:
            self._forget()
        place = np.searchsorted(self._known, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        within = place < len(self._known)
        known[within] = self._known[place[within]] == distinct[within]
        if not known.all():
            example = example[~known]
            runs = [
                data[a:b].tobytes()
                for a, b in zip(starts[example].tolist(), ends[example].tolist(), strict=True)
            ]
            self._learn(distinct[~known], runs, is_odd[example])
        place = np.searchsorted(self._known, distinct)
        length = self._length[place][which]
        after = np.cumsum(length)
        shift = self._at[place][which] - (after - length)
        flat = self._ids[np.repeat(shift, length) + np.arange(after[-1] if len(after) else 0)]
        return flat, np.append(0, after)[first]


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    key: str = "doc_id",
    text: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = False,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) for each row of ``docs``.

    A document's ids are its text's followed by ``end_id``, so an empty or null text has one. Ids
    are cut only where a document is longer than ``max_tokens``. ``ids_crc32`` is over the ids as
    little-endian 32-bit numbers. Repeated rows give repeated pieces; other columns are ignored; an
    empty table gives no pieces. A string that spells a special token is that token, as the
    tokenizer has it.
    """
    kind = docs.schema[key].dataType
    fields = [
        T.StructField(key, kind),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
    ]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(tokenizer_path)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            for block in W.blocks(batch, "__text"):
                flat, first = tokenizer.ids(block.column("__text"))
                row, piece, start, length, crc, ids = [], [], [], [], [], []
                bounds = first.tolist()
                for i in range(block.num_rows):
                    own = np.concatenate([flat[bounds[i] : bounds[i + 1]], end])
                    for j, a in enumerate(range(0, len(own), max_tokens)):
                        part = own[a : a + max_tokens]
                        row.append(i)
                        piece.append(j)
                        start.append(a)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.astype("<u4").tobytes()))
                        if with_ids:
                            ids.append(part.astype(np.int32))
                columns = [
                    block.column("__key").take(pa.array(row, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).mapInArrow(
        cut, T.StructType(fields)
    )

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.llm import alignment
from tillroll.llm.queries import tokenizer_path

PATHS = tokenizer_path("byte_bpe_50k.tiktoken"), tokenizer_path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def encode():
    """Ids and bytes of a text's tokens under both tokenizers, straight from the libraries."""
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    signs = alignment.byte_of_sign()
    assert len(signs) == 256 and ByteLevel().decode([c for c, x in signs.items() if x < 128]).isascii()

    def run(text):
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(signs[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            bytes_b.append(bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
        return ids_a, bytes_a, ids_b, bytes_b

    return run


def groups_of(text, encode):
    """The groups as (A ids, B ids); none if the tokens do not spell the text."""
    if not text:
        return []
    ids_a, bytes_a, ids_b, bytes_b = encode(text)
    whole = (" " + text).encode()
    if b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
        return []

    def ends(parts):
        total, out = 0, []
        for part in parts:
            total += len(part)
            out.append(total)
        return out

    ends_a, ends_b = ends(bytes_a), ends(bytes_b)
    cuts = set(ends_a) & set(ends_b)
    own: dict[int, tuple[list, list]] = {cut: ([], []) for cut in sorted(cuts)}
    for side, (ids, at) in enumerate(((ids_a, ends_a), (ids_b, ends_b))):
        waiting = []
        for token, end in zip(ids, at, strict=True):
            waiting.append(token)
            if end in cuts:
                own[end][side].extend(waiting)
                waiting = []
    return list(own.values())


def expected(rows, encode):
    every = [(key, groups_of(text, encode)) for key, text in rows]
    links = [Counter((a, b) for own_a, own_b in groups for a in own_a for b in own_b) for _, groups in every]
    counts = Counter(pair for own in links for pair in own)
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    for (key, groups), own in zip(every, links, strict=True):
        text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        yield (
            key,
            sum(len(a) for a, _ in groups),
            sum(len(b) for _, b in groups),
            len(groups),
            sum(own.values()),
            sum(n for pair, n in own.items() if counts[pair] == most[pair[0]]),
            sum(n * counts[pair] for pair, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        )


def as_tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_against_brute_force(spark, sf, awkward, encode):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(awkward.select("doc_id", "text"))
    docs = docs.unionByName(
        spark.createDataFrame(
            [
                (901, "under▁score"),
                (902, "  two  spaces  "),
                (903, " "),
                (904, "\n\ttabs\r\n   x　 y  z"),
                (905, "<s> <unk> <0x41> <|endoftext|>"),
                (906, "😀👩‍👩‍👧 नमस्ते 한국어 日本語 \u0000 ﻿"),
                (907, "a" * 20_000),
                (908, "'s 't don't 3.14 ½"),
            ],
            "doc_id long, text string",
        )
    ).withColumns({name: F.lit("x") for name in ("links", "chunk", "n_a", "pair", "key")})
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    want = sorted(expected(rows, encode), key=str)
    assert as_tuples(alignment.aligned_documents(docs, *PATHS)) == want
    assert as_tuples(alignment.aligned_documents(docs.repartition(3), *PATHS, chunk_links=50_000)) == want


def test_nothing(spark, nothing):
    assert alignment.aligned_documents(nothing, *PATHS).collect() == []
    only_empty = spark.createDataFrame([(1, ""), (2, None)], "doc_id long, text string")
    rows = as_tuples(alignment.aligned_documents(only_empty, *PATHS))
    assert rows == [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")]


def test_tokens_and_cuts_on_request(spark, sf, encode):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").limit(40)
    rows = alignment.alignments(docs, *PATHS, with_tokens=True).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert len(rows) == 40
    for r in rows:
        groups, a, b = [], 0, 0
        for end_a, end_b in zip(r.cuts_a, r.cuts_b, strict=True):
            groups.append((r.a[a:end_a], r.b[b:end_b]))
            a, b = end_a, end_b
        assert groups == groups_of(texts[r.doc_id], encode)


_ENDS = st.lists(st.integers(0, 300), unique=True).map(sorted)


@settings(max_examples=300, deadline=None)
@given(_ENDS, _ENDS, st.booleans())
def test_common_ends(a, b, dense):
    if dense:  # many ends between two that gallop by themselves
        a = sorted({*a, *range(100, 400)})
    first, second = alignment.common_ends(np.array(a, np.int64), np.array(b, np.int64))
    common = sorted(set(a) & set(b))
    assert [a[i] for i in first] == common == [b[i] for i in second]
    few = np.array(sorted({*b, 10_000}), np.int64)
    assert alignment.gallop(np.array(a), few).tolist() == [sum(x < y for x in few) for y in a]


_TOKENIZERS = alignment.Tokenizers(*PATHS)
_PARTS = st.one_of(
    st.text(alphabet=st.characters(codec="utf-8"), max_size=20),
    st.sampled_from([" ", "  ", "\n", "\u00a0", "\u3000", "\u2003 ", "'s", "don't", "word", "Ünï", "12", "▁", "…"]),
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(_PARTS, max_size=8).map("".join), min_size=1, max_size=4))
def test_pieces_make_the_whole(texts):
    """Texts cut wherever they may be cut encode as if they were not."""
    whole = alignment.align(_TOKENIZERS, pa.array(texts, pa.string()))
    cut = alignment.align(_TOKENIZERS, pa.array(texts, pa.string()), most=1)
    for one, other in ((whole.a, cut.a), (whole.b, cut.b)):
        assert one.ids.tolist() == other.ids.tolist()
        assert one.first.tolist() == other.first.tolist() and one.cuts.tolist() == other.cuts.tolist()
    assert whole.good.tolist() == cut.good.tolist()


def test_large_groups_are_counted_by_different_ids(monkeypatch, encode):
    texts = ["some words, and others; " * 3, "ß" * 50, "한국어 " * 9]
    found = alignment.align(_TOKENIZERS, pa.array(texts))
    rows, pairs, times = alignment.links(found)
    monkeypatch.setattr(alignment, "_PAIRS", 0)
    for one, other in zip((rows, pairs, times), alignment.links(found), strict=True):
        assert one.tolist() == other.tolist()
    monkeypatch.setattr(alignment, "_ITEMS", 16)
    parts = [groups_of(text, encode) for text in texts]
    written = [";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in own) for own in parts]
    assert alignment.group_digests(found) == [hashlib.sha256(x.encode()).hexdigest() for x in written]


def test_both_files_of_one_vocabulary_agree(encode):
    from_file = alignment.Tokenizers(tokenizer_path("byte_bpe_50k.json"), PATHS[1])
    texts = ["The <|endoftext|> cat's 12 naïve\n\n  words…", "a" * 5000, "ab1 " * 300]
    assert from_file.encode(texts) == _TOKENIZERS.encode(texts)
    assert from_file.spelling[0].of(np.arange(50256)).tobytes() == _TOKENIZERS.spelling[0].of(np.arange(50256)).tobytes()

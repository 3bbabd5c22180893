import hashlib
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tillroll.llm import mixing, packing, tokens
from tillroll.llm.queries import tokenizer_path


def best_fit_decreasing(lengths, size):
    """One piece at a time: the number of sequences."""
    gaps = []
    for length in sorted(lengths, reverse=True):
        fitting = [g for g in gaps if g >= length]
        if fitting:
            gaps.remove(min(fitting))
            gaps.append(min(fitting) - length)
        else:
            gaps.append(size - length)
    return len(gaps)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=80))
def test_runs_are_best_fit_decreasing(lengths):
    runs = packing.best_fit_runs(dict(Counter(lengths)), 30)
    filled = {}
    for length, rank, n, per, first, offset in runs:
        for i in range(n):
            filled.setdefault(first + i // per, []).append((offset + i % per * length, length))
    assert sorted(x for own in filled.values() for _, x in own) == sorted(lengths)
    for own in filled.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 30
    assert len(filled) == best_fit_decreasing(lengths, 30)


def expected_pieces(text, tokenizer):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [1]
    for piece, a in enumerate(range(0, len(ids), 4096)):
        own = ids[a : a + 4096]
        yield piece, a, len(own), zlib.crc32(np.array(own, "<u4").tobytes())


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_pieces_are_the_tokenizers(spark, sf, awkward, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(awkward.select("doc_id", "text"))
    got = packing.pack_documents(docs, tokenizer_path()).collect()
    expected = Counter()
    for row in docs.collect():
        expected.update((row.doc_id, *piece) for piece in expected_pieces(row.text, tokenizer))
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == expected
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096
    assert len(ends) == best_fit_decreasing([r.length for r in got], 4096)


_PARTS = st.one_of(
    st.text(alphabet=st.characters(codec="utf-8"), max_size=60),
    st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "don't", " "]),
)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(_PARTS, max_size=4).map("".join), max_size=4))
def test_any_text_encodes_as_a_whole(tokenizer, texts):
    import pyarrow as pa

    flat, first = _OWN.ids(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        assert flat[first[i] : first[i + 1]].tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_spelled_special_tokens_are_special(tokenizer):
    import pyarrow as pa

    flat, _ = _OWN.ids(pa.array(["<|endoftext|> hi"]))
    assert flat.tolist() == [49407, 1883] == tokenizer.encode("<|endoftext|> hi", add_special_tokens=False).ids


_OWN = tokens.WordTokenizer(tokenizer_path())


def test_ids_are_kept_on_request_and_nothing_gives_nothing(spark, awkward, nothing):
    rows = packing.pack_documents(awkward.filter("doc_id = 5"), tokenizer_path(), with_ids=True).collect()
    assert rows[0].ids[-1] == 1 and len(rows[0].ids) == rows[0].length
    assert packing.pack_documents(nothing, tokenizer_path()).collect() == []
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(1, 5000)], "doc_id long, length long"))


def draw(key, part, mean):
    u = (int(hashlib.md5(f"{mixing.SEED}:{key}:{part}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    p = at = math.exp(-mean)
    n = 0
    while at < u:
        n += 1
        p *= mean / n
        at += p
    return n


def test_copies_are_the_poisson_draws(spark):
    rows = [(i, "big" if i % 3 else "small" if i % 2 else None) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string")
    weights = spark.createDataFrame(
        [("big", 1.0), ("small", 30.0), (None, 1.0), ("absent", 5.0)], "source string, weight double"
    )
    out = mixing.replicate(docs, weights).collect()
    counts = Counter(s for _, s in rows)
    got = Counter(r.doc_id for r in out)
    for key, source in rows:
        weight = {"big": 1.0, "small": 30.0, None: 1.0}[source]
        rate = weight / 32.0 * 3000 / counts[source]
        parts = max(1, math.ceil(rate / mixing.STEP))
        assert got[key] == sum(draw(key, part, rate / parts) for part in range(parts))
    assert [r.shuffle_key for r in out] == sorted(r.shuffle_key for r in out)
    shares = Counter(r.source for r in out)
    assert abs(shares["small"] / len(out) - 30 / 32) < 0.02
    assert len({(r.doc_id, r.copy) for r in out}) == len(out)


def test_mixing_awkward_rows(awkward, nothing):
    out = mixing.replicate(awkward, mixing.power_weights(awkward))
    assert out.columns == [c for c in awkward.columns if c != "copy"] + ["copy", "shuffle_key"]
    assert out.count() > 0
    assert mixing.replicate(nothing, mixing.power_weights(nothing)).collect() == []
    none = mixing.replicate(awkward, mixing.power_weights(awkward).filter("false"))
    assert none.collect() == []

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tillroll.llm import merkle


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    return h("".join(map(field, (row.doc_id, row.source, row.lang, row.n_chars, text))))


def climbed(nodes, fan=8):
    """The top, and for each node the siblings (left, right) of each level."""
    paths = [[] for _ in nodes]
    at, level = list(range(len(nodes))), list(nodes)
    while len(level) > 1:
        for i, node in enumerate(at):
            run = node // fan * fan
            paths[i].append(("".join(level[run:node]), "".join(level[node + 1 : run + fan])))
            at[i] = node // fan
        level = [h("".join(level[a : a + fan])) for a in range(0, len(level), fan)]
    return level[0], paths


def expected(rows, fan=8):
    groups = defaultdict(list)
    for row in rows:
        groups[row.lang].append((row.doc_id is not None, row.doc_id or 0, leaf(row, row.text), row))
    order = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda x: x[:3])
        trees[lang] = climbed([x[2] for x in groups[lang]], fan)
    root, above = climbed([trees[lang][0] for lang in order], fan)
    for lang, up in zip(order, above, strict=True):
        subroot, paths = trees[lang]
        for (_, _, own, row), path in zip(groups[lang], paths, strict=True):
            path = path + up
            node, text = own, row.text
            if row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 3 == 0 and text:
                node = leaf(row, "".join(c.lower() if "A" <= c <= "Z" else c for c in text))
            for left, right in path:
                node = h(left + node + right)
            proof = h("".join(a + b for a, b in path))
            yield row.doc_id, own, subroot, root, proof, node, node == root


def as_tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_every_document(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = as_tuples(merkle.verified_rows(docs))
    assert got == sorted(expected(docs.collect()), key=str)
    assert {row[-1] for row in got} == {True, False}


def test_awkward_rows(awkward, nothing):
    docs = awkward.withColumns({c: F.lit(1) for c in ("leaf", "grp", "hash", "place", "path", "level0", "top")})
    assert as_tuples(merkle.verified_rows(docs)) == sorted(expected(docs.collect()), key=str)
    assert merkle.verified_rows(nothing).collect() == []
    assert merkle.manifest(nothing).root().collect() == []


@pytest.mark.parametrize(("fan", "depth", "parts"), [(2, 2, 7), (8, 1, 50), (8, 3, 1)])
def test_tiers_and_partitions_make_no_difference(spark, fan, depth, parts):
    """Groups of all sizes around the blocks' own: up to five tiers."""
    sizes = [1, 2, 3, 4, 5, 8, 9, 64, 65, 300]
    rows = [(i, "s", f"g{n}", n, f"Text {i}") for n in sizes for i in range(1000 * n, 1000 * n + n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    made = merkle.manifest(docs.repartition(parts), fan=fan, depth=depth)
    proofs = made.proofs()
    found = proofs.select(
        *("doc_id", "leaf", "subroot", "root"),
        merkle.proof_hash(F.col("path")).alias("proof"),
        merkle.folded(F.col("path"), F.col("leaf")).alias("folded"),
    )
    want = sorted((row[:5] for row in expected(docs.collect(), fan)), key=str)
    got = found.collect()
    assert sorted((tuple(row)[:5] for row in got), key=str) == want
    assert all(row.folded == row.root for row in got)
    assert made.subroots.count() == len(sizes)

import math
from collections import Counter, defaultdict

import corpus_pipeline
from pyspark.sql import functions as F
from tillroll.llm import mixing, near_dedup, quality_rules
from tillroll.llm.frames import stored

NAMES = ["quality_rules", "quality_classifier", "near_dedup", "mixing", "packing"]


def test_stages_in_order_keep_the_columns(spark, sf, split):
    """Each stage against plain Python on what the stage before kept."""
    assert [name for name, _ in corpus_pipeline.STAGES] == NAMES
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {"documents": docs}
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        rows = stored(stage(spark, rows, sf), name)
        kept[name] = rows
        if name != "packing":
            assert rows.columns == docs.columns
    ids = {name: Counter(r.doc_id for r in df.select("doc_id").collect()) for name, df in kept.items()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}

    for name in NAMES[:3]:
        assert set(ids[name].values()) == {1}
    assert ids["near_dedup"].keys() <= ids["quality_classifier"].keys() <= ids["quality_rules"].keys()
    for r in kept["quality_rules"].collect():
        assert len(split(r.text)) >= quality_rules.MIN_WORDS
    good = [key for key, label in labels.items() if label == 1 and key in ids["quality_rules"]]
    assert sum(key in ids["quality_classifier"] for key in good) > 0.98 * len(good)

    # One document of each group, and no group gone.
    sets = {}
    for r in kept["quality_classifier"].collect():
        w = split(r.text, lower=True)
        sets[r.doc_id] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    postings = defaultdict(list)
    above = {key: key for key in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    for key in sorted(sets):
        common = Counter(other for s in sets[key] for other in postings[s])
        for other, n in common.items():
            union = len(sets[key]) + len(sets[other]) - n
            if 100 * n >= near_dedup.PERCENT * union:
                low, high = sorted((top(key), top(other)))
                above[high] = low
        for s in sets[key]:
            postings[s].append(key)
    assert ids["near_dedup"].keys() == {top(key) for key in sets}

    # Copies follow the rates of the sources.
    sources = Counter(r.source for r in kept["near_dedup"].collect())
    roots = sum(math.sqrt(n) for n in sources.values())
    mixed = Counter(r.source for r in kept["mixing"].collect())
    for source, n in sources.items():
        mean = math.sqrt(n) / roots * sources.total()
        assert abs(mixed[source] - mean) < 6 * math.sqrt(mean) + 1
    assert mixing.STEP > 0 and ids["mixing"].keys() <= ids["near_dedup"].keys()

    pieces = kept["packing"].collect()
    first = Counter(r.doc_id for r in pieces if r.piece == 0)
    assert first == ids["mixing"]
    ends = {}
    for r in sorted(pieces, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_columns_named_like_those_of_operators_come_out_unchanged(spark, sf):
    extra = ("kept", "n_words", "words", "copy", "score", "capitals", "rep", "shuffle_key", "text_")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    docs = docs.withColumns({name: F.concat(F.lit(name), F.col("doc_id")) for name in extra})
    rows = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        rows = stored(stage(spark, rows, sf), name)
        assert rows.schema.simpleString() == docs.schema.simpleString()
        assert rows.join(docs, docs.columns, "left_anti").count() == 0
        assert rows.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, rows, sf).count() > 0

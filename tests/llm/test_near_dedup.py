import random

from tillroll.llm import near_dedup


def brute(rows, split):
    sets = {}
    for key, text in rows:
        w = split(text, lower=True)
        found = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())
        sets[key] = found
    above = {key: key for key in sets}

    def top(x):
        while above[x] != x:
            x = above[x]
        return x

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
                low, high = sorted((top(a), top(b)))
                above[high] = low
    return {key: (len(sets[key]), top(key)) for key in sets}


def planted():
    """Copies with many small edits each, so that similarities spread on both sides of 0.75."""
    draw = random.Random(3)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows, key = [], 100
    for size, length, edits in ((120, 120, 12), (40, 300, 20), (30, 6, 1)):
        base = [draw.choice(vocabulary) for _ in range(length)]
        for _ in range(size):
            own = list(base)
            for _ in range(draw.randint(0, edits)):
                own[draw.randrange(length)] = draw.choice(vocabulary)
            rows.append((key, " ".join(own)))
            key += 1
    rows += [(key + i, rows[0][1].upper()) for i in range(5)]
    rows += [(key + 10 + i, " ".join(draw.choice(vocabulary) for _ in range(80))) for i in range(40)]
    draw.shuffle(rows)
    return rows


def test_components_as_by_comparing_all_pairs(spark, split):
    rows = planted()
    found = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in found.collect()}
    expected = brute(rows, split)
    assert got == expected
    assert len({c for _, c in expected.values()}) > 60  # some of the edited copies stand alone


def test_awkward_rows(spark, awkward, nothing):
    got = near_dedup.near_duplicates(awkward).collect()
    assert len(got) == awkward.count()
    by_key = {r.doc_id: r for r in got}
    assert (by_key[1].n_shingles, by_key[2].n_shingles, by_key[3].n_shingles) == (0, 0, 0)
    assert by_key[5].component_id == by_key[6].component_id == 5
    assert by_key[8].component_id == 7 and not by_key[8].kept
    assert by_key[None].component_id is None and by_key[None].kept
    assert near_dedup.near_duplicates(nothing).collect() == []
    left = near_dedup.without_near_duplicates(awkward)
    assert left.columns == awkward.columns
    assert sorted(r.doc_id or 0 for r in left.collect()) == [0, 1, 2, 3, 4, 5, 7, 9, 10]


def test_sketches_estimate_high_similarities():
    import numpy as np
    import pyarrow as pa

    a = [f"x{i}" for i in range(1000)]
    b = a[:900] + [f"y{i}" for i in range(100)]
    hashes, _, spans = near_dedup.shingle_sets(pa.array([" ".join(a), " ".join(b)]))
    true = 896 / (2 * 996 - 896)
    bits = np.zeros((2, near_dedup.FINE_BITS // 64), np.uint64)
    for i, sample in enumerate(near_dedup.minhashes(hashes, spans, near_dedup.FINE_SAMPLES)):
        near_dedup.fold(bits, sample, np.uint64(i * 7919 + 1))
    differing = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
    n, k = near_dedup.FINE_BITS, near_dedup.FINE_SAMPLES
    estimate = 1 + n / (4 * k) * np.log(1 - 2 * differing / n)
    assert abs(estimate - true) < 0.05

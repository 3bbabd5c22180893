"""Operators without SQL, each recomputed in plain Python on whole small tables."""

import math
import re
import struct
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tillroll.llm import language_id, license_scan, lm_scoring, quality_rules, rule_classifier, text_statistics, warc


@pytest.fixture(scope="module")
def docs(spark, sf, awkward):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    return rows.unionByName(awkward.select(rows.columns)).repartition(5)


CLASHING = ("kept", "key", "text_", "words", "score", "label", "host", "rank", "chunk", "n", "log_ratio", "lang_", "rows")


def clashing(df):
    return df.withColumns({name: F.lit("x") for name in CLASHING if name not in df.columns})


# Text statistics -------------------------------------------------------------------------------


def statistics(text, split):
    text = text or ""
    data, w = text.encode(), split(text)
    n = len(w)
    size = [len(x.encode()) for x in w]
    pairs, fives = set(zip(w, w[1:])), Counter(tuple(w[i : i + 5]) for i in range(n - 4))
    lines = [tuple(split(line)) for line in text.split("\n") if split(line)]

    def share(part, whole):
        return part / max(whole, 1)

    def among(chars):
        return sum(data.count(c) for c in chars.encode())

    ended = [x[-1] in ".!?" for x in w]
    letters = sum(bytes([b]).isalpha() for b in data)
    signs = [c for c in range(33, 127) if not chr(c).isalnum()]
    return {
        "words": n,
        "word_length": share(sum(size), n),
        "short_words": share(sum(x <= 3 for x in size), n),
        "long_words": share(sum(x >= 15 for x in size), n),
        "distinct_words": share(len(set(w)), n),
        "top_word": share(max(Counter(w).values(), default=0), n),
        "distinct_pairs": share(len(pairs), n - 1),
        "repeated_fives": share(sum(x for x in fives.values() if x > 1), n - 4),
        "lines": len(lines),
        "line_words": share(n, len(lines)),
        "repeated_lines": share(len(lines) - len(set(lines)), len(lines)),
        "ended_lines": share(sum(line[-1][-1] in ".!?" for line in lines), len(lines)),
        "sentence_ends": share(sum(ended), n),
        "capitals": share(sum(65 <= b <= 90 for b in data), letters),
        "digits": share(sum(48 <= b <= 57 for b in data), len(data)),
        "signs": share(sum(b in signs for b in data), len(data)),
        "symbols": share(among("#*$%&|<>"), len(data)),
        "exclamations": share(among("!"), n),
        "other_alphabets": share(sum(b >= 128 for b in data), len(data)),
    }


def test_all_statistics(docs, split):
    rows = text_statistics.with_statistics(docs, keep=["doc_id", "text"]).collect()
    assert len(rows) == docs.count()
    for r in rows:
        want = statistics(r.text, split)
        assert tuple(want) == text_statistics.STATISTICS
        for name, value in want.items():
            assert math.isclose(r[name], value, abs_tol=1e-12), (r.doc_id, name)


# Quality classifier ----------------------------------------------------------------------------


def test_scores_are_the_rules_sum(spark, sf, docs, split):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scored, model = rule_classifier.classify(clashing(docs), clashing(labels))
    assert model.rules
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        own = statistics(r.text, split)
        odds = model.intercept
        for rule, weight in model.rules:
            holds = all((a is None or own[name] > a) and (b is None or own[name] <= b) for name, a, b in rule)
            odds += weight * holds
        want[r.doc_id, round(1 / (1 + math.exp(-odds)), 9)] += 1
    assert Counter((r.doc_id, round(r.score, 9)) for r in scored.collect()) == want


# Quality rules ---------------------------------------------------------------------------------


def test_log_ratio_of_every_document(spark, sf, docs, split, nothing):
    trusted = quality_rules.trusted_of(spark.read.parquet(f"{sf}/labels.parquet"))
    ratios = quality_rules.log_ratios(clashing(docs), trusted)
    table = ratios.first().log_ratio

    def number(value):
        return struct.unpack("<q", struct.pack("<Q", value))[0]

    def word(w):
        return number(xxhash.xxh64_intdigest(w.encode(), seed=42))

    def pair(a, b):
        first = xxhash.xxh64_intdigest(struct.pack("<q", a), seed=42)
        return number(xxhash.xxh64_intdigest(struct.pack("<q", b), seed=first))

    got = quality_rules.with_quality(docs, ratios).collect()
    assert len(got) == docs.count()
    for r in got:
        one = [word(w) for w in split(r.text)]
        grams = one + [pair(a, b) for a, b in zip(one, one[1:])]
        want = sum(table[h % quality_rules.BUCKETS] for h in grams) / max(1, 2 * len(one) - 1)
        assert math.isclose(r.log_ratio, want, abs_tol=1e-9), r.doc_id
    empty = quality_rules.log_ratios(nothing, trusted).first().log_ratio
    assert len(empty) == quality_rules.BUCKETS and all(abs(x) < 1e-12 for x in empty)


# License scan ----------------------------------------------------------------------------------


def license_words(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", lower)


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)]


def all_windows(text, template):
    """Best (containment, first word, last word) of all windows of a text, by exact counting."""
    wanted = set(shingles(license_words(template)))
    m = len(license_words(template))
    window = m + max(3, m // 4)
    own, best = shingles(license_words(text)), None
    for begin in range(0, len(own), window - m + 1):
        at = [i for i, s in enumerate(own[begin : begin + window - 4]) if s in wanted]
        share = len({own[begin + i] for i in at}) / len(wanted)
        if share >= license_scan.CONTAINMENT and (best is None or share > best[0]):
            best = (share, begin + at[0], begin + at[-1] + 4)
    return best


def test_scan_finds_what_every_window_holds(spark, docs):
    texts = dict(license_scan.TEMPLATES)
    rows, key = [], 10_000
    for name, body in texts.items():
        w = body.split()
        for change in (0, 11, 17, 29):  # every so many-th word changed: partly beyond the threshold
            edited = " ".join(f"x{i}" if change and i % change == 5 else word for i, word in enumerate(w))
            rows.append((key, "Überall steht etwas davor. " * (key % 7) + edited.upper() + " and after " * (key % 5)))
            key += 1
        rows += [(key, body + " " + body), (key + 1, " ".join(w[: len(w) * 4 // 5]))]
        key += 2
    planted = spark.createDataFrame(rows, "doc_id long, text string")
    every = docs.select("doc_id", "text").unionByName(planted)
    want = Counter()
    for r in every.collect():
        for name, body in texts.items():
            best = all_windows(r.text, body)
            if best:
                want[r.doc_id, name, round(best[0], 9), best[1], best[2]] += 1
    got = license_scan.scan(clashing(every)).collect()
    assert Counter((r.doc_id, r.license, round(r.containment, 9), r.first_word, r.last_word) for r in got) == want
    assert len({r.license for r in got}) == len(texts)


# Language identification -----------------------------------------------------------------------


def sequences(text):
    data = bytes(b + 32 if 65 <= b <= 90 else 32 if b < 65 else b for b in text.encode())
    codes = [int.from_bytes(data[i : i + 3], "little") for i in range(len(data) - 2)]
    return [(c * 0x9E3779B97F4A7C15 % 2**64) >> 51 for c in codes if c != 0x202020]


def fused(pages, rows):
    """{page: (lang, probability)} from the definition."""
    languages = sorted({lang for lang, _ in rows if lang is not None})
    counts = {lang: np.ones(language_id.BUCKETS) for lang in languages}
    for lang, text in rows:
        if lang is not None:
            np.add.at(counts[lang], sequences(text or ""), 1)
    logs = {lang: np.log(own / own.sum()) for lang, own in counts.items()}
    evidence = []
    for url, markup in pages:
        found = sequences(language_id.visible_text(markup or ""))
        weigh = min(len(found), language_id.EVIDENCE) / max(len(found), 1)
        own = np.array([logs[lang][found].sum() * weigh for lang in languages])
        share = np.exp(own - own.max())
        declared = re.search(r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-z]{2,3})\b", markup or "")
        evidence.append((share / share.sum(), *language_id.address_parts(url or ""), declared.group(1).lower() if declared else ""))
    sums = [defaultdict(lambda: np.zeros(len(languages))) for _ in range(5)]
    for share, *keys in evidence:
        for group, value in zip(sums, [*keys, "all"]):
            group[value] += share
    total = sums[4]["all"]
    k = language_id.STRENGTH
    out = []
    for share, host, domain, suffix, declared in evidence:
        prior = (total + 1) / (total.sum() + len(languages))
        for group, value in ((sums[1], domain), (sums[0], host)):
            others = np.maximum(group[value] - share, 0)
            narrow = (others + k * prior) / (max(group[value].sum() - 1, 0) + k)
            prior = narrow if host else prior
        weights = prior * share
        for group, value in ((sums[2], suffix), (sums[3], declared)):
            if value:
                weights = weights * (group[value] + k * group[value].sum() / total.sum()) / (total + k)
        out.append((languages[int(weights.argmax())], weights.max() / weights.sum()))
    return out


def test_fused_posterior_of_every_page(spark, sf, docs):
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    very_long = "<html lang=fr><p>" + "le monde entier regarde encore une fois " * 40_000
    extra = [
        (9001, "http://a.example.org/x", "<html lang='de'><p>die der und zu</p>"),
        (9002, "http://b.example.org", None),
        (9003, None, "<p>the of and that is in"),
        (9004, "not an address", ""),
        (9005, "http://[broken", "<script>the of and</script><!-- und --><html lang=zz>"),
        (9006, "http://a.example.org/y", very_long),
        (None, "http://a.example.org/z", "<p>the and of"),
        (9001, "http://a.example.org/x", "<html lang='de'><p>die der und zu</p>"),
    ]
    pages = clashing(pages.unionByName(spark.createDataFrame(extra, "page_id long, url string, html string")))
    rows = pages.select("page_id", "url", "html").collect()
    want = fused([(r.url, r.html) for r in rows], [(r.lang, r.text) for r in docs.select("lang", "text").collect()])
    got = language_id.identify(pages, clashing(docs)).collect()
    assert len(got) == len(rows)
    expected = Counter((r.page_id, lang, round(p, 6)) for r, (lang, p) in zip(rows, want))
    assert Counter((r.page_id, r.lang, round(r.probability, 6)) for r in got) == expected


def test_more_languages_than_a_model_may_have(spark, sf, docs, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 50)
    many = docs.withColumn("lang", F.concat(F.lit("l"), F.col("doc_id")))
    with pytest.raises(ValueError, match="languages"):
        language_id.identify(spark.read.parquet(f"{sf}/pages.parquet"), many)


# Empty tables and clashing names ---------------------------------------------------------------


def test_scores_with_clashing_names_are_the_same(docs, nothing):
    plain = lm_scoring.score_documents(docs)
    named = lm_scoring.score_documents(clashing(docs))
    assert named.columns == plain.columns
    assert Counter(map(str, named.collect())) == Counter(map(str, plain.collect()))
    assert lm_scoring.score_documents(nothing).collect() == []


def test_archives_with_clashing_names_and_without_pages(spark, sf, tmp_path):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    names = ("key", "payload", "payload_digest", "record_type", "refers_to", "payload_bytes", "record", "file")
    found = []
    for i, df in enumerate((pages, pages.withColumns({name: F.lit("x") for name in names}))):
        warc.write_archives(df, f"{tmp_path}/{i}")
        rows = warc.read_archives(spark, f"{tmp_path}/{i}")
        found.append(Counter(map(str, rows.select("key", "payload_digest", "record_type", "refers_to").collect())))
    assert found[0] == found[1] and sum(found[0].values()) == pages.count()
    warc.write_archives(pages.limit(0), f"{tmp_path}/none")
    assert warc.read_archives(spark, f"{tmp_path}/none").count() == 0

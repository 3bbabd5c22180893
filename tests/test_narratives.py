import json
import re
from datetime import datetime
from decimal import Decimal

from helpers import narratives_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillroll.functions.text import SENTENCE_STARTERS, stats_json, unsupported_terms
from tillroll.operators import narratives

T = [datetime(2026, 1, day) for day in range(1, 10)]


def now():
    return F.lit("2026-02-01").cast("timestamp_ntz")


def check(spark, text, **stats):
    names = list(stats)
    df = spark.createDataFrame([(text, *stats.values())], ["text", *names])
    return df.select(unsupported_terms(F.col("text"), stats_json(F.struct(*names)))).first()[0]


def test_flags_only_words_absent_from_the_inputs(spark):
    text = "Our best market is Ireland, not France. Ireland again. A B12 X_Ray Zoé Paris2 USA IT"
    # one letter is no word; B12, X_Ray and Zoé are no runs of Latin letters; "it" is a starter
    assert check(spark, text, country="france") == ["Ireland", "Ireland", "USA"]


def test_substrings_and_keys_count_as_input(spark):
    assert check(spark, "Count Rye Land", country="Finland", rye_total=1) == []
    assert check(spark, "Finlands", country="Finland") == ["Finlands"]


def test_escapes_count_as_input(spark):
    # the escaped "é" is spelled u00e9, which glues E9 to the letters after it
    assert check(spark, "Cle Nand", a="clé", b="x\nand") == ["Cle"]


ALPHABET = "AbcZ eé_9.ßΩ\n\"ê"


@settings(max_examples=6, deadline=None)
@given(
    st.lists(
        st.tuples(st.text(ALPHABET, max_size=40), st.text(ALPHABET, max_size=12)),
        min_size=30,
        max_size=60,
    )
)
def test_same_as_a_regular_expression_over_escaped_json(spark, pairs):
    rows = [(i, *pair) for i, pair in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, t string, value string")
    terms = unsupported_terms(F.col("t"), stats_json(F.struct("value")))
    got = [row[0] for row in df.orderBy("i").select(terms).collect()]
    for found, (text, source) in zip(got, pairs):
        stats = json.dumps({"value": source}).lower()
        assert found == [
            word
            for word in re.findall(r"\b[A-Z][a-zA-Z]+\b", text)
            if word.lower() not in SENTENCE_STARTERS and word.lower() not in stats
        ]


def test_missing_members_stay_in_the_json(spark):
    df = spark.sql("SELECT named_struct('a', CAST(NULL AS STRING), 'b', 1.50BD) AS s")
    assert json.loads(df.select(stats_json(F.col("s"))).first()[0]) == {"a": None, "b": 1.5}


def test_latest_keeps_ties_and_newest_does_not(spark):
    history = narratives_of(
        spark,
        (1, "segment", "a", "{}", "old", T[0]),
        (2, "segment", "a", "{}", "tie 1", T[1]),
        (3, "segment", "A", "{}", "tie 2", T[1]),
        (4, "executive", None, "{}", "late", T[3]),
        (5, "executive", None, "{}", "early", T[2]),
    )
    latest = narratives.latest_narratives(history).collect()
    assert sorted(r.narrative_text for r in latest) == ["late", "tie 1", "tie 2"]
    assert sorted(r.id for r in narratives.newest_by_id(history).collect()) == [3, 5]


def incoming(spark, *rows):
    return spark.createDataFrame(
        list(rows),
        "seq long, narrative_type string, reference_key string, input_stats string, "
        "narrative_text string",
    )


def test_upsert_updates_in_place_and_adds(spark):
    history = narratives_of(
        spark,
        (3, "executive", None, "{}", "old", T[0]),
        (8, "segment", "a", "{}", "kept", T[1]),
    )
    saved = incoming(
        spark,
        (1, "executive", None, "{1}", "first", ),
        (2, "executive", None, "{2}", "second"),
        (3, "anomaly", None, "{}", "x"),
        (4, "anomaly", None, "{}", "y"),
        (5, "segment", "b", "{}", "added"),
    )
    got = {r.id: r for r in narratives.upsert(history, saved, now()).collect()}
    assert set(got) == {3, 8, 11, 13}
    assert got[3].narrative_text == "second" and got[3].input_stats == "{2}"
    assert got[3].generated_at == datetime(2026, 2, 1)
    assert got[8].narrative_text == "kept" and got[8].generated_at == T[1]
    assert got[11].narrative_type == "anomaly" and got[11].narrative_text == "y"
    assert got[13].reference_key == "b"


def test_first_upsert_fills_an_empty_history(spark):
    saved = incoming(spark, (1, "segment", "a", "{}", "x"), (2, "executive", None, "{}", "y"))
    got = narratives.upsert(narratives_of(spark), saved, now())
    assert sorted(r.id for r in got.collect()) == [1, 2]


def test_one_type_alone(spark):
    saved = incoming(spark, (1, "segment", "a", "{}", "x"), (2, "anomaly", None, "{}", "y"))
    assert [r.seq for r in narratives.only_type(saved, "Anomaly").collect()] == [2]
    assert narratives.only_type(saved, None).count() == 2


def make(spark):
    stats = spark.createDataFrame(
        [
            ("Regular", 2, Decimal("5.0"), Decimal("1.5"), Decimal("10.00")),
            ("Champions", 1, Decimal("3.1"), Decimal("9.0"), Decimal("99.50")),
        ],
        "segment_name string, customer_count long, avg_recency_days decimal(18,1), "
        "avg_frequency decimal(18,1), avg_monetary decimal(18,2)",
    )
    overview = spark.createDataFrame(
        [(3, 300, 1.0)], "total_anomalies long, total_scored long, pct_anomalous double"
    )
    top = spark.createDataFrame(
        [
            (8, 1, Decimal("2.0"), Decimal("7.00"), None),
            (9, 2, Decimal("4.0"), Decimal("8.00"), "EIRE"),
        ],
        "customer_id int, anomaly_count long, avg_quantity decimal(18,1), "
        "avg_order_value decimal(18,2), country string",
    )
    segments = narratives.segment_narratives(stats)
    anomaly = narratives.anomaly_narrative(overview, top, seq=6)
    return segments, anomaly, narratives.executive_narrative(segments, anomaly, seq=7)


def test_texts_keep_the_order_and_store_what_they_used(spark):
    segments, anomaly, executive = make(spark)
    rows = segments.orderBy("seq").collect()
    assert [r.reference_key for r in rows] == ["Champions", "Regular"]
    assert "$99.50" in rows[0].narrative_text and rows[0].flagged_terms == []
    stored = json.loads(rows[0].input_stats)
    assert stored["customer_count"] == 1 and stored["_flagged_terms"] == []
    row = anomaly.first()
    assert row.narrative_text.index("Customer 9 (EIRE)") < row.narrative_text.index("Customer 8")
    stored = json.loads(row.input_stats)
    assert [c["customer_id"] for c in stored["top_customers"]] == [9, 8]
    assert stored["top_customers"][1]["country"] is None
    assert stored["_flagged_terms"] == row.flagged_terms == ["Of", "Unusual"]
    row = executive.first()
    assert row.reference_key is None
    assert row.narrative_text.startswith("Champions: ")
    stored = json.loads(row.input_stats)
    assert list(stored["segment_narratives"]) == ["Champions", "Regular"]

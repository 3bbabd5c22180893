import re

import pytest

SEPARATORS = "[\x20\x09-\x0d]+"


def words(text, lower=False):
    if lower:
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    return [w for w in re.split(SEPARATORS, text or "") if w]


@pytest.fixture(scope="session")
def split():
    return words


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in every column, empty and white-space texts, a very long one, ties, repeated rows, and
    columns named like those that operators add."""
    long_text = " ".join(f"word{i % 977} Ünï{i % 13}" for i in range(30_000))
    line = "one two three four five six seven eight nine ten eleven twelve\n"
    rows = [
        (1, "", "en", "a", 0),
        (2, None, None, None, None),
        (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
        (4, long_text, "de", "b", len(long_text)),
        (5, "alpha beta", "en", "a", 10),
        (6, "Alpha BETA", "en", "b", 10),
        (7, line * 3, "en", None, 3 * len(line)),
        (8, line * 3, "en", "a", 3 * len(line)),
        (8, line * 3, "en", "a", 3 * len(line)),
        (9, "don't stop… it’s éclair 3.14% <b>ÀÉ×÷ß</b> <|endoftext|> ñandú", "es", "c", 60),
        (None, "a row without a key has words of its own", "fr", "c", 40),
        (10, line + "and some more words that only this one has", "en", "a", 100),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    extra = {name: "x" for name in ("copy", "kept", "Score", "words", "rep", "key")}
    from pyspark.sql import functions as F

    return spark.createDataFrame(rows, schema).withColumns({k: F.lit(v) for k, v in extra.items()})


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward.limit(0)

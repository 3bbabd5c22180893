"""JSON of input statistics, and the check of a text against them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that start sentences and say nothing about facts.
SENTENCE_STARTERS = (
    "our", "this", "these", "those", "given", "by", "we", "it", "the",
    "a", "an", "that", "with", "as", "since", "while", "in",
    "for", "to", "and", "but", "so", "average", "customers", "segment",
)

# A capital followed by at least one more Latin letter, with no letter, digit or underscore of any
# script on either side. Spelled out, since what \b means for other scripts differs between engines
# and releases.
CAPITALISED_WORD = r"(?<![\p{L}\p{N}_])[A-Z][a-zA-Z]+(?![\p{L}\p{N}_])"


def stats_json(stats: Column) -> Column:
    """A struct as JSON: NULL members stay, text beyond ASCII is escaped."""
    return F.to_json(
        stats, {"ignoreNullFields": "false", "writeNonAsciiCharacterAsCodePoint": "true"}
    )


def capitalised_words(text: Column) -> Column:
    """Capitalised words in order, repeats included."""
    return F.regexp_extract_all(text, F.lit(CAPITALISED_WORD), F.lit(0))


def unsupported_terms(text: Column, stats: Column) -> Column:
    """Capitalised words of ``text`` found nowhere in the JSON of its inputs, keys included.

    ``stats`` is lower-cased once per row: the one-element array binds it outside the word loop.
    """

    def check(source: Column) -> Column:
        return F.filter(
            capitalised_words(text),
            lambda word: ~F.lower(word).isin(*SENTENCE_STARTERS)
            & ~F.contains(source, F.lower(word)),
        )

    return F.element_at(F.transform(F.array(F.lower(stats)), check), 1)

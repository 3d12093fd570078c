"""Text, number and list columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as blank around a value.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"

# How much of a message and of a payload sample the failure table takes.
MESSAGE_LIMIT = 2000
PAYLOAD_LIMIT = 4096


def strip(c: Column) -> Column:
    """Blanks removed on both ends, tabs and line ends included."""
    return F.btrim(c, F.lit(WHITESPACE))


def text_or_null(c: Column) -> Column:
    """Stripped text; an empty value becomes NULL."""
    return F.nullif(strip(c), F.lit(""))


def int_or_null(c: Column) -> Column:
    """Text to int; empty or malformed text becomes NULL (see ``malformed``)."""
    return text_or_null(c).try_cast("int")


def double_or_null(c: Column) -> Column:
    return text_or_null(c).try_cast("double")


def malformed(raw: Column, parsed: Column) -> Column:
    """True where a non-empty text did not survive its conversion."""
    return text_or_null(raw).isNotNull() & parsed.isNull()


def flag(c: Column) -> Column:
    """``"1"`` is true, everything else, NULL too, is false."""
    return F.coalesce(strip(c) == "1", F.lit(False))


def words(c: Column) -> Column:
    """Distinct lower-case alphanumeric tokens of a name; NULL gives an empty list."""
    found = F.regexp_extract_all(F.lower(c), F.lit("[a-z0-9]+"), F.lit(0))
    return F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))


def sorted_set(c: Column) -> Column:
    """Sorted distinct non-null members; NULL gives an empty list."""
    kept = F.filter(c, lambda x: x.isNotNull())
    return F.coalesce(F.array_sort(F.array_distinct(kept)), F.array().cast("array<string>"))


def english_text(translations: Column) -> Column:
    """Text of the first translation whose language starts with ``en``, else of the first.

    A match decides even when its text is empty, so the choice tests for a match and
    not for a text.
    """
    english = F.filter(translations, lambda t: F.lower(t["language"]).startswith("en"))
    return F.when(F.size(english) > 0, F.get(english, F.lit(0))["text"]).otherwise(
        F.get(translations, F.lit(0))["text"]
    )


def short_message(c: Column) -> Column:
    return F.left(c, F.lit(MESSAGE_LIMIT))


def payload_head(c: Column) -> Column:
    """First bytes of a binary payload."""
    return F.substring(c, 1, PAYLOAD_LIMIT)


def payload_cut(c: Column) -> Column:
    return F.coalesce(F.octet_length(c) > PAYLOAD_LIMIT, F.lit(False))


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the words of a name (letters and digits of any script), each word
    padded by two blanks in front and one behind."""
    found = F.regexp_extract_all(F.lower(c), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))
    parts = F.coalesce(F.array_distinct(found), F.array().cast("array<string>"))

    def grams(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        return F.transform(
            F.sequence(F.lit(1), F.length(padded) - 2),
            lambda i: F.substr(padded, i, F.lit(3)),
        )

    return F.array_distinct(F.flatten(F.transform(parts, grams)))

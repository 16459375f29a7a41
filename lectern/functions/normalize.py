"""Normalisers and display defaults for catalog fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lectern.functions.vocabulary import BLANKS, LANGUAGE_GROUPS

MAX_LENGTH = 2**31 - 1


def filled(value: Column) -> Column:
    """True when a text is neither null nor empty (blanks count as filled)."""
    return value.isNotNull() & (value != "")


def first_filled(*values: Column) -> Column:
    """The first filled value; the last one as it is when none before it is filled."""
    result = values[-1]
    for value in reversed(values[:-1]):
        result = F.when(filled(value), value).otherwise(result)
    return result


def stripped(value: Column) -> Column:
    """``value`` without leading and trailing blanks of any kind."""
    return F.btrim(value, F.lit(BLANKS))


def language_key(raw: Column) -> Column:
    return F.lower(stripped(raw))


def language_name(raw: Column) -> Column:
    """Group name of a raw language; ``Other`` when there is none.

    An unknown language keeps its spelling, with its first character in upper case.
    """
    key = language_key(raw)
    name = F.when(raw.isNull() | (raw == ""), F.lit("Other"))
    for group, spellings in LANGUAGE_GROUPS.items():
        name = name.when(key.isin(*spellings), F.lit(group))
    return name.otherwise(
        F.concat(F.upper(F.substring(raw, 1, 1)), F.substring(raw, 2, MAX_LENGTH))
    )


def language_label(raw: Column) -> Column:
    """Language as a course card shows it."""
    return (
        F.when(raw.isNull() | (raw == ""), F.lit("English"))
        .when(language_key(raw).isin("en", "en-us", "english"), F.lit("English"))
        .when(F.length(raw) == 2, F.upper(raw))
        .otherwise(raw)
    )


def language_detail(raw: Column) -> Column:
    return first_filled(raw, F.lit("English"))


def level_label(raw: Column) -> Column:
    """Level as a course card shows it: without the word "level"."""
    bare = stripped(F.regexp_replace(raw, "(?i)level", ""))
    return (
        F.when(raw.isNull() | (raw == ""), F.lit("Unspecified"))
        .when(F.lower(bare) == "introductory", F.lit("Beginner"))
        .otherwise(bare)
    )


def level_detail(raw: Column) -> Column:
    return first_filled(raw, F.lit("Unspecified"))


def similarity_from_distance(distance: Column) -> Column:
    """Cosine of two unit vectors at Euclidean ``distance``."""
    return 1.0 - F.pow(distance, F.lit(2.0)) / 2.0

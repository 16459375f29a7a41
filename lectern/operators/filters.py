"""Catalog predicates. A filter that is unset or ``All`` adds nothing."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import normalize as N
from lectern.functions.text import contains_ci
from lectern.functions.vocabulary import LANGUAGE_GROUPS

ALL = "All"


@dataclass(frozen=True)
class CourseFilter:
    """What a listing asks for. ``regex`` reads texts as patterns, not literally."""

    category: str | None = None
    language: str | None = None
    level: str | None = None
    source_repository: str | None = None
    search: str | None = None
    regex: bool = False


def with_filter_columns(courses: DataFrame) -> DataFrame:
    """Add the columns that turn the common filters into plain equality.

    A stored catalog that has them lets parquet skip row groups: ``category_key`` and
    ``language_group`` reach the scan as pushed filters, ``lower(...)`` would not.
    """
    return courses.withColumns(
        {
            "category_key": F.lower("category"),
            "language_key": N.language_key(F.col("language")),
            "language_group": N.language_name(F.col("language")),
        }
    )


def category_is(value: str, stored: bool = False) -> Column:
    wanted = F.lower(F.lit(value))
    return (F.col("category_key") if stored else F.lower("category")) == wanted


def language_is(value: str, stored: bool = False) -> Column:
    """A group name stands for its spellings, any other value for itself."""
    key = F.col("language_key") if stored else N.language_key(F.col("language"))
    if value not in LANGUAGE_GROUPS:
        return key == N.language_key(F.lit(value))
    if stored:
        return F.col("language_group") == value
    return key.isin(*LANGUAGE_GROUPS[value])


def level_has(value: str, regex: bool = False) -> Column:
    level = F.col("level")
    if value == "Beginner":
        return contains_ci(level, "Beginner") | contains_ci(level, "Introductory")
    return contains_ci(level, value, regex)


def source_has(value: str, regex: bool = False) -> Column:
    return contains_ci(F.col("source_repository"), value, regex)


def title_has(value: str, regex: bool = False) -> Column:
    return contains_ci(F.col("title"), value, regex)


def has_required_fields(*names: str) -> Column:
    """True when every named text is filled (a blank is filled, null is not)."""
    return reduce(Column.__and__, (N.filled(F.col(name)) for name in names))


def predicates(wanted: CourseFilter, stored: bool = False) -> list[Column]:
    found = []
    if wanted.category and wanted.category != ALL:
        found.append(category_is(wanted.category, stored))
    if wanted.language and wanted.language != ALL:
        found.append(language_is(wanted.language, stored))
    if wanted.level and wanted.level != ALL:
        found.append(level_has(wanted.level, wanted.regex))
    if wanted.source_repository and wanted.source_repository != ALL:
        found.append(source_has(wanted.source_repository, wanted.regex))
    if wanted.search:
        found.append(title_has(wanted.search, wanted.regex))
    return found


def apply_filter(courses: DataFrame, wanted: CourseFilter) -> DataFrame:
    stored = {"category_key", "language_key", "language_group"} <= set(courses.columns)
    return reduce(DataFrame.filter, predicates(wanted, stored), courses)

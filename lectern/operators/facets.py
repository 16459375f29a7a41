"""Facet values offered to narrow a listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.functions import normalize as N

TOP_CATEGORIES = 30


def category_counts(courses: DataFrame) -> DataFrame:
    """Courses per category, exactly as spelled; null is a category of its own."""
    return courses.groupBy("category").agg(F.count("*").alias("n"))


def top_categories(counts: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    """The ``top`` most frequent of ``category, n``, without blank ones, by name.

    Blank categories are dropped after the cut, so they can take up places in it.
    """
    cut = counts.orderBy(F.desc("n"), F.asc_nulls_first("category")).limit(top)
    return cut.filter(N.stripped(F.col("category")) != "").orderBy("category")


def category_facet(courses: DataFrame, top: int = TOP_CATEGORIES) -> DataFrame:
    return top_categories(category_counts(courses), top)


def with_language_names(spellings: DataFrame) -> DataFrame:
    """The distinct names of ``language`` spellings, by name."""
    return (
        spellings.filter(N.filled(F.col("language")))
        .select(N.language_name(F.col("language")).alias("language"))
        .distinct()
        .orderBy("language")
    )


def language_facet(courses: DataFrame) -> DataFrame:
    """Distinct language names by name.

    Raw spellings are made distinct first: they are few, so only they are named and
    shuffled again.
    """
    return with_language_names(courses.select("language").distinct())

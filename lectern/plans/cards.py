"""Courses as they are shown: defaults filled in, names normalised."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import normalize as N
from lectern.functions.text import highlight

URL_COLUMNS = ("original_url", "url", "link")


def course_url(courses: DataFrame) -> Column:
    """The first filled link among the columns that are there."""
    return N.first_filled(*(F.col(c) for c in URL_COLUMNS if c in courses.columns))


def course_cards(courses: DataFrame, search: str | None = None) -> DataFrame:
    """The projection of a listing: badges and the title with its matches marked."""
    return courses.select(
        "_id",
        highlight(F.col("title"), search).alias("title"),
        N.first_filled(F.col("category"), F.lit("General")).alias("category"),
        N.language_label(F.col("language")).alias("language"),
        N.level_label(F.col("level")).alias("level"),
        N.first_filled(F.col("source_repository"), F.lit("Unknown")).alias("source"),
    )


def course_details(courses: DataFrame) -> DataFrame:
    """The projection of a course page."""
    return courses.select(
        "_id",
        "title",
        N.first_filled(F.col("category"), F.lit("General")).alias("category"),
        N.language_detail(F.col("language")).alias("language"),
        N.level_detail(F.col("level")).alias("level"),
        N.first_filled(F.col("source_repository"), F.lit("External")).alias("source"),
        N.first_filled(F.col("description"), F.lit("No description available.")).alias(
            "description"
        ),
        course_url(courses).alias("url"),
    )

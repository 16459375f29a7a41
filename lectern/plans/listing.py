"""Listings, lookups and facets over the catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.operators.facets import category_facet, language_facet
from lectern.operators.filters import CourseFilter, apply_filter
from lectern.operators.paging import PAGE_SIZE, page_of


@dataclass(frozen=True)
class Listing:
    """One page of a filtered catalog and the size of the whole result."""

    data: DataFrame
    total: DataFrame

    def count(self) -> int:
        return self.data.count()


def list_courses(
    courses: DataFrame,
    category: str | None = None,
    language: str | None = None,
    level: str | None = None,
    source_repository: str | None = None,
    search: str | None = None,
    page: object = 1,
    limit: object = PAGE_SIZE,
    after: str | None = None,
    regex: bool = False,
) -> Listing:
    """Courses that meet every set filter, ordered by id, one page of them."""
    wanted = CourseFilter(category, language, level, source_repository, search, regex)
    found = apply_filter(courses, wanted)
    return Listing(
        data=page_of(found, page, limit, after=after),
        total=found.agg(F.count("*").alias("total")),
    )


def course_by_id(courses: DataFrame, course_id: str) -> DataFrame:
    """The course with this id, or no row. The filter reaches the parquet scan."""
    return courses.filter(F.col("_id") == course_id).limit(1)


@dataclass(frozen=True)
class Facets:
    categories: DataFrame
    languages: DataFrame


def facets(courses: DataFrame) -> Facets:
    return Facets(category_facet(courses), language_facet(courses))

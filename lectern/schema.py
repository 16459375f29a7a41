"""Explicit schemas of the stored tables and of the harvested feeds."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.StringType()) for name in names]


COURSE = T.StructType(
    _strings("_id", "title", "description", "category", "skills", "level")
    + _strings("original_url", "source_repository", "language")
    + [
        T.StructField("last_updated", T.TimestampType()),
        T.StructField("cluster", T.IntegerType()),
    ]
)

NEIGHBOUR = T.StructType(
    [
        T.StructField("similar_doc_id", T.StringType()),
        T.StructField("similarity_score", T.DoubleType()),
    ]
)

SIMILARITY = T.StructType(
    [
        T.StructField("_id", T.StringType()),
        T.StructField("top_5_similar_docs", T.ArrayType(NEIGHBOUR)),
    ]
)

LIKES = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("course_id", T.StringType()),
    ]
)

EDX_COLUMNS = (
    "title",
    "course_description",
    "summary",
    "subject",
    "Level",
    "course_url",
    "language",
)

COURSERA_PAGE = T.StructType(
    [
        T.StructField(
            "rows",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(
                            "row",
                            T.StructType(
                                _strings(
                                    "title",
                                    "Skills",
                                    "Description",
                                    "Course Name",
                                    "Level",
                                    "URL",
                                )
                            ),
                        )
                    ]
                )
            ),
        )
    ]
)

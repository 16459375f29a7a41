"""The two harvested feeds, read and mapped onto the unified course record.

Readers add ``__seq``, the position of a record in its feed, so that "the last record
of a URL wins" means the same as when records are stored one after the other.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions import normalize as N
from lectern.functions.vocabulary import CSV_MISSING
from lectern.operators.merge import SEQUENCE
from lectern.schema import COURSERA_PAGE, EDX_COLUMNS
from lectern.sources.paged import LENGTH, read_pages

EDX_FILES = "*[eE][dD][xX]*.csv"  # file names, not folders
CSV_OPTIONS = {
    "header": "true",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "enforceSchema": "false",
    "mode": "FAILFAST",
}


FILE = "__file"


def with_file(raw: DataFrame) -> DataFrame:
    """Keep when the file of each row was saved, and its path."""
    saved = F.struct("_metadata.file_modification_time", "_metadata.file_path")
    return raw.select("*", saved.alias(FILE))


def _position() -> Column:
    return F.struct(F.col(FILE), F.monotonically_increasing_id().alias("row"))


def edx_records(raw: DataFrame) -> DataFrame:
    """Cells by header name; a missing cell or column is an empty text.

    ``raw`` comes from :func:`with_file`, as it does for :func:`coursera_records`.
    """
    present = set(raw.columns)
    cells = []
    for name in EDX_COLUMNS:
        cell = F.col(f"`{name}`") if name in present else F.lit(None).cast("string")
        text = F.when(cell.isin(*CSV_MISSING), F.lit("")).otherwise(cell)
        cells.append(F.coalesce(text, F.lit("")).alias(name))
    return raw.select(*cells, _position().alias(SEQUENCE))


def read_edx_csv(
    spark: SparkSession, folder: str, pattern: str = EDX_FILES, multi_line: bool = True
) -> DataFrame:
    """All CSV files of ``folder`` whose name contains ``edx``, columns by header.

    With ``multi_line`` a file is one task, since a cell may span lines.
    """
    options = CSV_OPTIONS | {"multiLine": str(multi_line).lower(), "pathGlobFilter": pattern}
    raw = spark.read.options(**options).csv(folder)
    return edx_records(with_file(raw))


def coursera_records(pages: DataFrame) -> DataFrame:
    """One record per element of each page's ``rows``."""
    items = pages.select(
        _position().alias("page"), F.posexplode("rows").alias("pos", "item")
    )
    return items.select("item.row.*", F.struct("page", "pos").alias(SEQUENCE))


def read_coursera_pages(
    spark: SparkSession, folder: str, multi_line: bool = False
) -> DataFrame:
    """Saved response pages, one JSON document per line (or per file)."""
    pages = (
        spark.read.schema(COURSERA_PAGE)
        .options(multiLine=str(multi_line).lower(), mode="FAILFAST")
        .json(folder)
    )
    return coursera_records(with_file(pages))


def paged_records(rows: DataFrame) -> DataFrame:
    """Records of rows (page, pos, row) of a paged feed, in the order of the pages."""
    return rows.select("row.*", F.struct("page", "pos").alias(SEQUENCE))


def read_coursera_paged(spark: SparkSession, folder: str, length: int = LENGTH) -> DataFrame:
    """A paged feed up to its first empty page, one task per page."""
    return paged_records(read_pages(spark, folder, length))


def unified_edx(records: DataFrame, as_of: datetime.datetime) -> DataFrame:
    """edX records as courses (this feed knows no skills)."""
    return records.select(
        "title",
        N.first_filled(F.col("course_description"), F.col("summary")).alias("description"),
        F.col("subject").alias("category"),
        F.col("Level").alias("level"),
        F.col("course_url").alias("original_url"),
        F.lit("edX").alias("source_repository"),
        N.first_filled(F.col("language"), F.lit("en")).alias("language"),
        F.lit(as_of).alias("last_updated"),
        F.lit(None).cast("int").alias("cluster"),
        SEQUENCE,
    )


def unified_coursera(records: DataFrame, as_of: datetime.datetime) -> DataFrame:
    """Coursera records as courses (this feed knows no category and no language)."""
    return records.select(
        "title",
        F.col("Skills").alias("skills"),
        N.first_filled(F.col("Description"), F.col("`Course Name`")).alias("description"),
        F.lit("General").alias("category"),
        F.col("Level").alias("level"),
        F.col("URL").alias("original_url"),
        F.lit("Coursera").alias("source_repository"),
        F.lit("en").alias("language"),
        F.lit(as_of).alias("last_updated"),
        F.lit(None).cast("int").alias("cluster"),
        SEQUENCE,
    )

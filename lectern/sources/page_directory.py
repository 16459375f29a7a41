"""Pages of a stored, sorted table by a directory of its files.

The table is written sorted by key, in files of at most ``FILE_ROWS`` rows. The directory
has a row per file: its first key, and how many rows lie before it. A page is looked up
there and read from the files it lies in, one or two as a rule, so that page 10,000 costs
what page 1 costs. A filtered listing has other ranks than the table: store it with a
directory of its own, or page on by key (``page_of(after=...)``).

Rows of equal keys are in the order of all their columns that can be ordered, so that
pages never overlap. Null keys come first, as in an ascending sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.paging import PAGE_SIZE, as_number
from lectern.sources.catalog import read_catalog

FILE_ROWS = 10_000
DIRECTORY = "file string, first string, before long, n long"


def _order(table: DataFrame, key: str) -> list[str]:
    unordered = (T.MapType, T.VariantType)
    sortable = [f.name for f in table.schema if not isinstance(f.dataType, unordered)]
    return [key, *[c for c in sortable if c != key]]


def write_sorted(table: DataFrame, path: str, key: str = "_id", file_rows: int = FILE_ROWS) -> None:
    """Write ``table`` and its directory below ``path``."""
    spark, order = table.sparkSession, _order(table, key)
    placed = table.repartitionByRange(*order).sortWithinPartitions(*order)
    placed.write.option("maxRecordsPerFile", file_rows).parquet(f"{path}/rows")
    files = (
        read_catalog(spark, f"{path}/rows", table.schema)
        .groupBy(F.col("_metadata.file_path").alias("file"))
        .agg(F.min(F.struct(*order)).alias("least"), F.count("*").alias("n"))
    )
    # A row per file, not per course. Files are in the order of their least rows.
    before = Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)
    files.select(
        "file",
        F.col(f"least.{key}").cast("string").alias("first"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"),
        "n",
    ).coalesce(1).write.parquet(f"{path}/directory")


def directory(spark: SparkSession, path: str) -> DataFrame:
    return read_catalog(spark, f"{path}/directory", DIRECTORY)


def page_at(
    spark: SparkSession, path: str, schema: T.StructType, page: object = 1,
    limit: object = PAGE_SIZE, key: str = "_id",
) -> DataFrame:
    """Page ``page`` of the sorted table, read from the files that hold it."""
    number, size = as_number(page, 1), as_number(limit, PAGE_SIZE)
    if number < 1 or size < 1:
        raise ValueError("page and limit must be positive")
    start = (number - 1) * size
    inside = (F.col("before") < start + size) & (F.col("before") + F.col("n") > start)
    files = directory(spark, path).filter(inside).orderBy("before").collect()
    if not files:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(schema).parquet(*[f.file for f in files])
    skipped = start - files[0].before
    return rows.orderBy(*_order(rows, key)).offset(skipped).limit(size)

"""Stored tables: a plain parquet read, and a catalog that is updated in parts.

Spark has no ``MERGE`` on parquet. The catalog is partitioned by a hash of the course's
URL, and an upsert rewrites only the partitions its batch falls into
(``partitionOverwriteMode=dynamic``). Facet counts are kept per partition beside the
courses and are rewritten with them, so that they never need a count of the catalog.

The merged partitions are written to the scratch folder before they replace the stored
ones. Merging a batch once more changes nothing, so a batch that failed half-way is
repaired by its replay. One writer at a time: Spark gives no isolation between two.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.operators.facets import top_categories, with_language_names
from lectern.operators.merge import merge_upsert
from lectern.schema import COURSE
from lectern.scratch import stage

#: Partitions of a catalog. One is rewritten by a task: take more for larger catalogs.
BUCKETS = 64
FACETS = ("category", "language")
#: Bytes of text that one task sorts, at about twice as many bytes of memory.
TASK_BYTES = 16 << 20
COUNTS = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def read_catalog(spark: SparkSession, path: str, schema: T.StructType = COURSE) -> DataFrame:
    """A stored table with its declared schema (nothing is inferred)."""
    return spark.read.schema(schema).parquet(path)


def sorted_by(table: DataFrame, key: str) -> DataFrame:
    """``table`` in ranges of ``key``, sorted within each; a range has about ``TASK_BYTES``."""
    texts = [f.name for f in table.schema if isinstance(f.dataType, T.StringType)]
    sizes = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in texts]
    size = table.agg(F.sum(sum(sizes, F.lit(0)))).first()[0] or 0
    tasks = max(1, -(-size // TASK_BYTES))
    return table.repartitionByRange(tasks, key).sortWithinPartitions(key)


class CatalogStore:
    """Courses and their facet counts under ``root``, partitioned by URL."""

    def __init__(
        self, spark: SparkSession, root: str, schema: T.StructType = COURSE, buckets: int = BUCKETS
    ):
        self.spark, self.root, self.schema, self.buckets = spark, root.rstrip("/"), schema, buckets

    def _stored(self, name: str, schema: T.StructType) -> DataFrame:
        """A stored table with its ``bucket``; an empty one before the first write."""
        full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
        try:
            return read_catalog(self.spark, f"{self.root}/{name}", full)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], full)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("original_url"), F.lit(self.buckets)).cast("int")

    def read(self) -> DataFrame:
        return self._stored("courses", self.schema).drop("bucket")

    def _replace(self, name: str, table: DataFrame) -> None:
        placed = table.repartition(self.buckets, "bucket")
        writer = placed.write.partitionBy("bucket").option("partitionOverwriteMode", "dynamic")
        writer.mode("overwrite").parquet(f"{self.root}/{name}")

    def _save(self, courses: DataFrame) -> None:
        """Put ``courses`` (written, with ``bucket``) in place of what their buckets hold."""
        self._replace("courses", courses)
        pairs = [F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in FACETS]
        found = courses.select("bucket", F.inline(F.array(*pairs)))
        counts = found.groupBy("bucket", "kind", "value").agg(F.count("*").alias("n"))
        self._replace("facets", counts)

    def upsert(self, batch: DataFrame, preserve: Sequence[str] = ("cluster",)) -> list[int]:
        """Merge ``batch``, one row per URL, and return the partitions it has changed."""
        bucket = batch.select(self._bucket().alias("b")).distinct()
        touched = sorted(r.b for r in bucket.collect())  # at most one per partition
        if not touched:
            return []
        stored = self._stored("courses", self.schema).filter(F.col("bucket").isin(touched))
        merged = merge_upsert(stored.drop("bucket"), batch, "original_url", preserve)
        fields = [
            (F.col(f.name) if f.name in merged.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in self.schema
        ]
        merged = merged.select(*fields).withColumn("bucket", self._bucket())
        self._save(stage(merged, "merged"))
        return touched

    def facet_counts(self, kind: str) -> DataFrame:
        """``kind, n``: courses per value as spelled, from the kept counts alone."""
        kept = self._stored("facets", COUNTS).filter(F.col("kind") == kind)
        return kept.groupBy(F.col("value").alias(kind)).agg(F.sum("n").alias("n"))

    def category_facet(self) -> DataFrame:
        return top_categories(self.facet_counts("category"))

    def language_facet(self) -> DataFrame:
        return with_language_names(self.facet_counts("language"))

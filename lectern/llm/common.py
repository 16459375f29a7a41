"""What several operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.scratch import stage

# Rows of a lookup table up to which it is broadcast; larger ones are shuffled.
BROADCAST_ROWS = 500_000
# Rows and bytes that a Python worker receives at once.
BATCH_ROWS = 20_000
BATCH_BYTES = 4 << 20


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def fold(n: int, doc_id: str = "doc_id") -> Column:
    """The remainder that says which documents a model may learn from; null ids have none."""
    return F.crc32(F.col(doc_id).cast("string")) % n


def if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is counted and found to be small."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def small_batches(spark: SparkSession) -> None:
    """Bound what a Python worker holds at once; texts differ in length by far."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def append_columns(
    df: DataFrame,
    inputs: Sequence[str],
    fields: Sequence[T.StructField],
    make: Callable[[], Callable[..., list[pa.Array]]],
) -> DataFrame:
    """``df`` with columns that numpy code makes from ``inputs``, batch by batch.

    ``make`` runs once per task and returns a function from the input arrays to the new
    ones. Columns that are named like a new one are replaced.
    """
    small_batches(df.sparkSession)
    names = [f.name for f in fields]
    replaced = {n.lower() for n in names}
    reads = [f"__in{i}" for i in range(len(inputs))]
    sent = df.select(
        *[F.col(f"`{c}`") for c in df.columns if c.lower() not in replaced],
        *[F.col(f"`{c}`").alias(r) for c, r in zip(inputs, reads)],
    )
    rest = [c for c in sent.columns if c not in reads]
    schema = T.StructType([sent.schema[c] for c in rest] + list(fields))

    def run(batches):
        function = make()
        for batch in batches:
            made = function(*[batch.column(batch.schema.get_field_index(r)) for r in reads])
            columns = [batch.column(batch.schema.get_field_index(c)) for c in rest]
            yield pa.RecordBatch.from_arrays(columns + made, names=rest + names)

    return sent.mapInArrow(run, schema)


def ranked(
    df: DataFrame, order: Sequence[Column], within: Sequence[str] = (), name: str = "rank"
) -> DataFrame:
    """``df`` with each row's gapless position from 0 in ``order``, per group ``within``.

    Rows are range-partitioned by group and order, so a group of any size is spread over
    tasks; a position is the row's place in its partition and what lies before that. The
    sorted rows are written out, which pins their places. Give an order without ties
    where reruns must agree. Nulls form a group of their own.
    """
    keys = [F.col(c) for c in within]
    by = [*keys, *order]
    placed = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    placed = stage(placed, "ranked").withColumn("__part", F.shiftright("__at", 33))
    pieces = placed.groupBy(*within, "__part").agg(
        F.min("__at").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    before = Window.partitionBy(*within).orderBy("__part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    pieces = stage(
        pieces.select(
            *[F.col(c).alias(f"__{c}") for c in within],
            F.col("__part").alias("__of"),
            (F.coalesce(F.sum("__n").over(before), F.lit(0)) - F.col("__first")).alias("__shift"),
        ),
        "pieces",
    )
    same = F.col("__part") == F.col("__of")
    for c in within:
        same &= F.col(c).eqNullSafe(F.col(f"__{c}"))
    return (
        placed.join(if_small(pieces), same)
        .withColumn(name, F.col("__at") + F.col("__shift"))
        .drop("__at", "__part", "__of", "__shift", *[f"__{c}" for c in within])
    )


def components(links: DataFrame) -> DataFrame:
    """Connected components of ``links`` (a, b): rows (node, root), root the smallest id.

    Alternates large-star and small-star steps until every node points at its root, in
    about the logarithm of the longest path. Each step groups edges by node; minima are
    combined before the shuffle. Roots themselves and nodes without links have no row.
    """
    edges = stage(
        links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .filter("u <> v")
        .distinct(),
        "edges",
    )
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u")
            .filter("v > u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        large = stage(large, "large_star")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.filter("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = stage(small, "small_star")
        now = edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % F.lit(1 << 40))
        ).first()
        if now == seen:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now


def encoded(text: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null is empty."""
    return [b"" if t is None else t.encode("utf-8", "replace") for t in text.to_pylist()]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers."""
    with np.errstate(over="ignore"):
        x = values.astype(np.uint64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return x ^ (x >> np.uint64(32))

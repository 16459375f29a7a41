"""Keeping one row per key: de-duplication and field-wise upserts."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.filters import has_required_fields

# A batch is broadcast when it stays within both limits.
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 64 << 20
SEQUENCE = "__seq"


def union_sources(*feeds: DataFrame) -> DataFrame:
    """All feeds in one table; a column a feed lacks is null there."""
    first, *rest = feeds
    for feed in rest:
        first = first.unionByName(feed, allowMissingColumns=True)
    return first


def accepted(records: DataFrame, *required: str) -> DataFrame:
    """Records that may be stored: title and URL must be filled."""
    return records.filter(has_required_fields(*(required or ("title", "original_url"))))


def last_per_key(
    records: DataFrame, key: str | Sequence[str], order: str | Column = SEQUENCE
) -> DataFrame:
    """The last record of each key in ``order``.

    The ``row_number`` cut runs before the shuffle too (WindowGroupLimit), so a key
    that holds much of a batch sends one row per task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    latest_first = Window.partitionBy(*keys).orderBy(
        F.desc(order) if isinstance(order, str) else order.desc()
    )
    return (
        records.withColumn("__rn", F.row_number().over(latest_first))
        .filter(F.col("__rn") == 1)
        .drop("__rn")
    )


def course_id(url: Column) -> Column:
    """Id of a course that has none yet: it depends on its URL only."""
    return F.sha2(url, 256)


def is_small(batch: DataFrame, rows: int, size: int) -> bool:
    """Whether ``batch`` has at most so many rows and bytes (of its cells as text)."""
    cells = (F.octet_length(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in batch.columns)
    width = reduce(Column.__add__, cells).cast("long")
    found = batch.agg(F.count("*").alias("n"), F.sum(width).alias("bytes")).first()
    return found.n <= rows and (found.bytes or 0) <= size


def merge_upsert(
    existing: DataFrame,
    incoming: DataFrame,
    key: str | Sequence[str] = "original_url",
    preserve: Sequence[str] = ("cluster",),
    broadcast_rows: int = BROADCAST_ROWS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``existing`` with the fields that ``incoming`` supplies set, new keys added.

    * a column that ``incoming`` lacks keeps its stored value; a null it supplies
      overwrites, except in a ``preserve`` column of a row that is already stored;
    * both sides hold a key at most once (see :func:`last_per_key`);
    * a stored ``_id`` never changes, a new row gets one derived from its URL.

    A batch whose rows and bytes are counted and found small is broadcast, so the
    stored table is not shuffled; a larger one is merged by one full outer join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    supplied = [c for c in incoming.columns if c not in keys]
    columns = existing.columns + [c for c in incoming.columns if c not in existing.columns]
    types = {f.name: f.dataType for f in (*incoming.schema, *existing.schema)}
    kept = set(preserve) | {"_id"}

    batch = incoming.select(*keys, F.struct(F.lit(True).alias("__in"), *supplied).alias("__new"))
    matched = F.col("__new").isNotNull()

    def merged(name: str, known: Column) -> Column:
        old = F.col(name) if name in existing.columns else F.lit(None)
        if name in keys:
            value = F.col(name)
        elif name not in supplied:
            value = old
        elif name in kept:
            value = F.when(matched & ~known, F.col("__new")[name]).otherwise(old)
        else:
            value = F.when(matched, F.col("__new")[name]).otherwise(old)
        if name == "_id" and "original_url" in columns and "_id" not in keys:
            value = F.coalesce(value, course_id(F.col("original_url") if "original_url" in keys
                                                else merged("original_url", known)))
        return value.cast(types[name]).alias(name)

    if not is_small(incoming, broadcast_rows, broadcast_bytes):
        known = F.coalesce(F.col("__old"), F.lit(False))
        both = existing.withColumn("__old", F.lit(True)).join(batch, keys, "full_outer")
        return both.select(*(merged(c, known) for c in columns))

    updated = existing.join(F.broadcast(batch), keys, "left")
    stored_keys = existing.select(*keys).join(
        F.broadcast(incoming.select(*keys)), keys, "left_semi"
    )
    fresh = batch.join(F.broadcast(stored_keys), keys, "left_anti")
    for name in existing.columns:
        if name not in keys:
            fresh = fresh.withColumn(name, F.lit(None).cast(types[name]))
    return updated.select(*(merged(c, F.lit(True)) for c in columns)).unionByName(
        fresh.select(*(merged(c, F.lit(False)) for c in columns))
    )

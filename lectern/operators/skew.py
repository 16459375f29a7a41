"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key is hot when it has more than 1/HOT_SHARE of the rows, so at most HOT_SHARE
# keys can be hot, however large the table is. That bounds what is broadcast.
HOT_SHARE = 10_000
HOT_ROWS = 1_000_000


def hot_keys(
    facts: DataFrame,
    key: str | Sequence[str],
    hot_rows: int = HOT_ROWS,
    hot_share: int = HOT_SHARE,
    counted: DataFrame | None = None,
) -> DataFrame | None:
    """The keys with more than ``hot_rows`` rows and their row count ``n``, if any.

    At most ``hot_share`` keys are returned: in a large table the limit on rows is
    raised to the share of the table that only so many keys can exceed. The counts
    are combined before the shuffle, so a hot key costs a row per task. Where the rows
    per key are known already, they are passed as ``counted`` (key, ``n``).
    """
    keys = [key] if isinstance(key, str) else list(key)
    if counted is None:
        total = facts.count()
        counted = facts.groupBy(*keys).agg(F.count("*").alias("n"))
    else:
        total = counted.agg(F.sum("n")).first()[0] or 0
    if total <= hot_rows:
        return None
    counted = counted.filter(F.col("n") > max(hot_rows, total // hot_share))
    found = counted.collect()
    if not found:
        return None
    return facts.sparkSession.createDataFrame(found, counted.schema)


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str | Sequence[str],
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
    hot_share: int = HOT_SHARE,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Join many ``facts`` per key to the one ``lookup`` row per key.

    Facts of a hot key stay where they are and meet their lookup row by broadcast;
    all other facts are shuffled.
    """
    keys = [key] if isinstance(key, str) else list(key)
    hot = hot_keys(facts, keys, hot_rows, hot_share, counted)
    if hot is None:
        return facts.join(lookup, keys, how)
    hot = hot.select(*keys)
    marked = facts.join(F.broadcast(hot.withColumn("__hot", F.lit(True))), keys, "left")
    hot_lookup = lookup.join(F.broadcast(hot), keys, "left_semi")
    at_rest = (
        marked.filter(F.col("__hot")).drop("__hot").join(F.broadcast(hot_lookup), keys, how)
    )
    moved = marked.filter(F.col("__hot").isNull()).drop("__hot").join(lookup, keys, how)
    return moved.unionByName(at_rest)

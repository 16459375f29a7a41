"""Feed to catalog: read, map, keep the complete records, merge the last of each URL."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lectern.operators.merge import SEQUENCE, accepted, last_per_key, merge_upsert
from lectern.scratch import stage
from lectern.sources import feeds

SOURCES = {
    "edx": (feeds.read_edx_csv, feeds.unified_edx),
    "coursera": (feeds.read_coursera_pages, feeds.unified_coursera),
    "coursera-paged": (feeds.read_coursera_paged, feeds.unified_coursera),
}


def read_source(
    spark: SparkSession,
    source: str,
    folder: str,
    as_of: datetime.datetime,
    **reading: object,
) -> DataFrame:
    """The accepted records of a feed, repeated URLs included, with their position.

    ``reading`` goes to the feed's reader: ``pattern`` for file names and, for CSV,
    ``multi_line=False`` where no cell has a line feed, so that files can be split.
    """
    try:
        read, unify = SOURCES[source.lower()]
    except KeyError:
        raise ValueError(f"unknown source {source!r}: use one of {sorted(SOURCES)}") from None
    return accepted(unify(read(spark, folder, **reading), as_of))


def harvest(
    spark: SparkSession,
    source: str,
    folder: str,
    catalog: DataFrame,
    as_of: datetime.datetime,
    preserve: Sequence[str] = ("cluster",),
    observed: Observation | None = None,
    **reading: object,
) -> DataFrame:
    """``catalog`` after this feed was merged into it.

    The batch is written out first: the merge reads it more than once, and the feed's
    text files should be parsed once. ``observed`` gets the number of ``accepted`` records,
    repeated URLs included, while the batch is written.
    """
    records = read_source(spark, source, folder, as_of, **reading)
    if observed is not None:
        records = records.observe(observed, F.count(F.lit(1)).alias("accepted"))
    batch = stage(last_per_key(records, "original_url").drop(SEQUENCE), "batch")
    return merge_upsert(catalog, batch, "original_url", preserve)

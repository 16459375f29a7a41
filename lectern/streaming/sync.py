"""Incremental harvest: merge the feed files that are new since the last run."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from lectern.operators.merge import SEQUENCE, accepted, last_per_key
from lectern.schema import COURSERA_PAGE
from lectern.scratch import stage
from lectern.sources import feeds
from lectern.sources.catalog import CatalogStore
from lectern.sources.paged import stream_pages


def _feed_stream(
    spark: SparkSession, source: str, folder: str, files_per_batch: int | None, pattern: str | None
) -> DataFrame:
    options = {"mode": "FAILFAST"}
    if files_per_batch:
        options["maxFilesPerTrigger"] = str(files_per_batch)
    if source == "edx":
        options |= feeds.CSV_OPTIONS | {"pathGlobFilter": pattern or feeds.EDX_FILES}
        header = spark.read.options(**options).csv(folder).schema
        return spark.readStream.schema(header).options(**options).csv(folder)
    if pattern:
        options["pathGlobFilter"] = pattern
    return spark.readStream.schema(COURSERA_PAGE).options(**options).json(folder)


FEEDS = {
    "edx": (feeds.edx_records, feeds.unified_edx),
    "coursera": (feeds.coursera_records, feeds.unified_coursera),
    "coursera-paged": (feeds.paged_records, feeds.unified_coursera),
}


def sync_available_now(
    spark: SparkSession,
    source: str,
    folder: str,
    store: CatalogStore,
    checkpoint: str,
    as_of: datetime.datetime,
    files_per_batch: int | None = None,
    pattern: str | None = None,
) -> None:
    """Merge all new files of ``folder`` into ``store``, then stop.

    All new files (or pages of a paged feed) are one batch, and so one merge, unless
    ``files_per_batch`` is set; of a paged feed, a run takes that many pages at most. A
    batch rewrites the partitions of ``store`` that its URLs fall into. Merging a batch
    once more changes nothing, so a batch that is replayed after a failure, another
    checkpoint, or another folder with the same records does no harm. The checkpoint
    keeps which files have been merged.
    """
    source = source.lower()
    if source not in FEEDS:
        raise ValueError(f"unknown source {source!r}: use one of {sorted(FEEDS)}")
    records, unify = FEEDS[source]
    if source == "coursera-paged":
        raw = stream_pages(spark, folder, max_pages=files_per_batch)
    else:
        raw = feeds.with_file(_feed_stream(spark, source, folder, files_per_batch, pattern))

    def apply(batch: DataFrame, number: int) -> None:
        last = last_per_key(accepted(unify(records(batch), as_of)), "original_url")
        store.upsert(stage(last.drop(SEQUENCE), "batch"))

    query = (
        raw.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

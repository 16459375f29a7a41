"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``virtual`` points on a ring of hashes. A row belongs to the first point
clockwise of its key's hash. Rows of an arc are ranked by hash; a shard takes its arcs'
rows as far as its capacity goes, and the rest of an arc continues clockwise to the next
shard with room. Capacities sum up to the number of rows and differ by one at most, so the
balance is exact: the law is ``rows``. Most rows stay at the shard of their arc, and when
a shard is added, only rows of its arcs and what overflows elsewhere move.

Only the number of rows per arc reaches the driver (shards x virtual numbers), where it is
split into segments: ranks from and to of an arc, and their shard. A row finds its
segment by arc and rank. Since equal keys are ranked too, no key is too frequent.

A null key is a key. Repeated rows are rows of their own. An empty table has no shards.
Input columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import ranked

VIRTUAL = 64
# The ring is cut into so many equal cells, to find a row's arc without a search.
CELLS = 1 << 12
RING_BITS = 48


def _hash(name: str) -> int:
    return int(hashlib.md5(name.encode()).hexdigest()[: RING_BITS // 4], 16)


def ring_hash(key: Column) -> Column:
    """The place of a key on the ring, a number below 2^48; a null key has a place too."""
    name = F.coalesce(F.concat(F.lit("k"), key.cast("string")), F.lit("null"))
    return F.conv(F.substring(F.md5(name), 1, RING_BITS // 4), 16, 10).cast("long")


def ring(shards: int, virtual: int = VIRTUAL) -> list[tuple[int, int]]:
    """The (place, shard) of all points, clockwise. A shard's points depend on it alone."""
    points = [(_hash(f"shard {s} point {v}"), s) for s in range(shards) for v in range(virtual)]
    return sorted(points)


def with_arc(rows: DataFrame, points: Sequence[tuple[int, int]]) -> DataFrame:
    """Add ``arc``, the number of the first point at or after ``place``, clockwise."""
    width = (1 << RING_BITS) // CELLS
    cells: list[list[int]] = [[] for _ in range(CELLS)]
    for place, _ in points:
        cells[place // width].append(place)
    table, before = [], 0
    for cell, places in enumerate(cells):
        table.append((cell, before, places))
        before += len(places)
    spark = rows.sparkSession
    cells_df = spark.createDataFrame(table, "cell long, before long, places array<long>")
    joined = rows.withColumn("cell", F.expr(f"place div {width}")).join(
        F.broadcast(cells_df), "cell"
    )
    passed = F.size(F.filter("places", lambda p: p < F.col("place")))
    arc = (F.col("before") + passed) % len(points)
    return joined.withColumn("arc", arc.cast("int")).drop("cell", "before", "places")


def segments(
    counts: dict[int, int], points: Sequence[tuple[int, int]], shards: int
) -> list[tuple[int, int, int, int, int, int]]:
    """(arc, first rank, end rank, shard, first slot, hops) so that every shard is full."""
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    placed, waiting = [], []

    def take(arc: int, first: int, end: int, shard: int, hops: int) -> int:
        n = min(end - first, room[shard])
        if n:
            placed.append((arc, first, first + n, shard, filled[shard], hops))
            room[shard] -= n
            filled[shard] += n
        return first + n

    for arc, (_, shard) in enumerate(points):
        rest = take(arc, 0, counts.get(arc, 0), shard, 0)
        if rest < counts.get(arc, 0):
            waiting.append((arc, rest))
    for arc, first in waiting:
        hops = 0
        while first < counts[arc]:
            hops += 1
            first = take(arc, first, counts[arc], points[(arc + hops) % len(points)][1], hops)
    return placed


def assign(
    rows: DataFrame, key: str, shards: int, virtual: int = VIRTUAL, tie: Sequence[Column] = ()
) -> DataFrame:
    """``rows`` with home_shard, shard, slot (gapless from 0 in a shard) and hops.

    ``tie`` orders rows whose keys are equal; without it their order may vary.
    """
    names = ["home_shard", "shard", "slot", "hops"]
    points = ring(shards, virtual)
    kept = [F.col(f"`{c}`").alias(f"_{c}") for c in rows.columns if c.lower() not in names]
    named = rows.select(*kept, ring_hash(rows[key]).alias("place"), *[
        t.alias(f"tie{i}") for i, t in enumerate(tie)
    ])
    order = [F.col("place"), F.col(f"`_{key}`"), *[F.col(f"tie{i}") for i in range(len(tie))]]
    placed = ranked(with_arc(named, points), order, within=["arc"], name="rank")
    counts = {r["arc"]: r["count"] for r in placed.groupBy("arc").count().collect()}
    spark = rows.sparkSession
    table = spark.createDataFrame(
        [(a, points[a][1], *rest) for a, *rest in segments(counts, points, shards)],
        "of int, home_shard int, first long, end long, shard int, base long, hops int",
    )
    found = placed.join(
        F.broadcast(table),
        (F.col("arc") == F.col("of")) & (F.col("rank") >= F.col("first"))
        & (F.col("rank") < F.col("end")),
    )
    return found.select(
        *[F.col(f"`_{c}`").alias(c) for c in rows.columns if c.lower() not in names],
        "home_shard",
        "shard",
        (F.col("base") + F.col("rank") - F.col("first")).alias("slot"),
        "hops",
    )

"""Exact Jaccard self-join of word shingle sets with set-relation skipping.

A text's set is its distinct shingles of ``SHINGLE`` words (a shorter text is one shingle,
a text without words has an empty set and no links). Shingles are 64-bit hashes. Two
documents link when their sets' Jaccard similarity is at least ``PERCENT`` / 100, in
integers: ``100 * intersection >= PERCENT * union``.

1. Documents with equal sets form a class; one set stands for all of them.
2. Each set is ordered, frequent shingles last, and its first shingles are its prefix:
   two sets that link share one of them. The order is the same everywhere: shingles that
   repeat within batches of documents are counted over all of them and the most frequent
   ones kept in a table of bounded size; all others rank before, by hash. The order
   decides how much is compared, never what is found.
3. The prefixes form an index: a list per shingle, sorted by position in the set, then
   size. It is range-partitioned, so that a long list is spread over tasks, and lists of
   one entry are dropped as the sorted rows stream by.
4. Index-level skipping: at a position too far from the front, too little of the set
   remains to reach the similarity. A list is compared with its head first, the entry
   nearest to the front, in rounds: heads are checked with the members they may reach,
   links join components, and lists whose entries are in one component are skipped. The
   last round compares what is left, entries of different components, by pairs that pass
   the bounds on size and position. So copies of one another never make all pairs. What
   two prefixes have in common bounds a pair's overlap; only pairs that may still link
   are checked by their whole sets.
5. Answer-level skipping: a set that is nearly its head's keeps what it lacks and adds.
   Its overlap with another set is the head's overlap, computed once, less what it lacks
   and plus what it adds; its own set is not shipped again.

``count_links`` also counts every link, in a second pass over the linked sets:

6. In a component too large for one cell, sets so near to a hub that any two of them link
   need no comparison. All others are dealt to blocks by hash, and a cell of two blocks
   counts each set's links by its shared shingles, in a sparse-to-dense product. No pair is
   emitted: a cell returns a row per set. Small components are packed into cells whole. The
   blocks' number grows with a component, so a set is sent to as many cells as it has
   blocks; a cell's rows and shingles stay bounded.

Copies, ties and repeated rows link as their sets do. The result has a row per input row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import components, encoded, if_small, mixed, small_batches
from lectern.operators.skew import lookup_join
from lectern.scratch import stage

SHINGLE, PERCENT = 5, 80
#: Shingles whose frequency is known when sets are ordered, at most.
FREQUENT = 1 << 17
#: Rounds that compare lists with their heads before what is left is compared in pairs.
ROUNDS = 2
#: Sets with more copies than this get their labels by broadcast, as far as these are few.
HOT_COPIES = 100
#: Hubs per large component that sets may group around when links are counted, and the
#: sets that such a group has at least.
HUBS, TIGHT = 3, 16
#: Classes and shingles of a block whose links are counted at once. Components of up to as
#: many classes are packed; blocks of very large ones have up to 16 times as many.
CELL, CELL_TOKENS = 64, 1 << 18
# Shingles per product of a cell.
COLUMNS = 4096
# Bytes of text and shingles that are worked on at once.
PIECE, COUNTED = 1 << 19, 1 << 21
# A set is kept as a difference from its head if it differs in at most this share.
NEAR = 0.2

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_ODD = 0x9E3779B97F4A7C15


def _powers(n: int) -> np.ndarray:
    factors = np.full(n + 1, _ODD, np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS = _powers(1 << 16)


def _hashed_words(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word's lower-cased bytes, and where the words start."""
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]])))
    starts, ends = edge[0::2], edge[1::2]
    if len(starts) == 0:
        return np.empty(0, np.uint64), starts
    sizes = ends - starts
    values = _BYTE[_LOWER[data]]
    longest = int(sizes.max())
    powers = _POWERS if longest < len(_POWERS) else _powers(longest)
    first = np.zeros(len(data), np.int64)
    first[starts] = starts
    place = np.arange(len(data)) - np.maximum.accumulate(first)
    place[space] = 0
    with np.errstate(over="ignore"):
        terms = np.where(space, np.uint64(0), values * powers[place])
        return mixed(np.add.reduceat(terms, starts) + sizes.astype(np.uint64)), starts


def shingles(raw: bytes, width: int = SHINGLE) -> np.ndarray:
    """The sorted distinct shingle hashes of a text of any length."""
    words, _ = _hashed_words(raw)
    if len(words) == 0:
        return words
    n = max(1, len(words) - width + 1)
    found = np.full(n, min(len(words), width), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(min(len(words), width)):
            found = mixed(found * np.uint64(3) + words[k : k + n])
    return np.unique(found)


def shingle_sets(raws: list[bytes], width: int = SHINGLE) -> list[np.ndarray]:
    """``shingles`` of many texts, hashed together in pieces of about ``PIECE`` bytes."""
    found: list[np.ndarray] = []
    at = 0
    while at < len(raws):
        end, size = at, 0
        while end < len(raws) and (end == at or size + len(raws[end]) < PIECE):
            size += len(raws[end])
            end += 1
        found += _piece(raws[at:end], width)
        at = end
    return found


def _piece(raws: list[bytes], width: int) -> list[np.ndarray]:
    if len(raws) == 1:
        return [shingles(raws[0], width)]
    words, starts = _hashed_words(b"\n".join(raws))
    limits = np.cumsum([len(r) + 1 for r in raws])
    ends = np.searchsorted(starts, limits)
    n = max(0, len(words) - width + 1)
    hashed = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            hashed = mixed(hashed * np.uint64(3) + words[k : k + n])
    found = []
    for first, end, raw in zip(np.append(0, ends[:-1]).tolist(), ends.tolist(), raws):
        if end - first < width:
            found.append(shingles(raw, width))
            continue
        own = np.sort(hashed[first : end - width + 1])
        fresh = own[1:] != own[:-1]
        found.append(own if fresh.all() else own[np.append(True, fresh)])
    return found


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """How many first elements of an ordered set of ``n`` a linked set must meet."""
    return n + 1 - -(-percent * n // 100) if n else 0


def _signature(elements: np.ndarray) -> tuple[int, int]:
    """128 bits that two sets share only if they are equal, for all purposes."""
    with np.errstate(over="ignore"):
        one = mixed(elements ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
        two = mixed(elements * np.uint64(5) + np.uint64(7)).sum(dtype=np.uint64)
    return int(np.int64(one.astype(np.int64))), int(np.int64(two.astype(np.int64)))


def _frequent(docs: DataFrame, text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the most frequent shingles, and their counts.

    Counts are those of shingles that several different texts of a batch share, summed up
    over all batches: the more frequent a shingle, the closer to its frequency.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def flush():
            found, n = np.unique(np.concatenate(waiting), return_counts=True)
            found, n = found[n > 1].view(np.int64), n[n > 1]
            waiting.clear()
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["s", "n"])

        for batch in batches:
            texts = sorted(set(encoded(batch.column(0))))  # copies count once
            for own in shingle_sets(texts):
                waiting.append(own)
                size += len(own)
                if size > COUNTED:
                    yield flush()
                    size = 0
        if waiting:
            yield flush()

    counts = stage(
        docs.select(text)
        .mapInArrow(count, "s long, n long")
        .groupBy("s")
        .agg(F.sum("n").alias("n")),
        "shingle_counts",
    )
    # The lowest count such that no more than FREQUENT shingles reach it.
    by_size = counts.groupBy(F.floor(F.log2("n") * 4).alias("size")).count().collect()
    kept, least = 0, None
    for size, n in sorted(((r["size"], r["count"]) for r in by_size), reverse=True):
        if kept + n > FREQUENT:
            break
        kept, least = kept + n, size
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    found = counts.filter(F.floor(F.log2("n") * 4) >= least).toPandas()
    s, n = found["s"].to_numpy(np.int64).view(np.uint64), found["n"].to_numpy(np.int64)
    order = np.argsort(s)
    return s[order], n[order]


def _ordered(elements: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """A set in the order of the index: unknown by hash, then known by frequency."""
    if len(known) == 0 or len(elements) == 0:
        return elements
    at = np.minimum(np.searchsorted(known, elements), len(known) - 1)
    n = np.where(known[at] == elements, counts[at], 0)
    return elements[np.argsort(n, kind="stable")] if n.any() else elements


def _sets(docs: DataFrame, doc_id: str, text: str, percent: int) -> DataFrame:
    """Rows (doc_id, text_hash, n, hi, lo, prefix)."""
    shared = docs.sparkSession.sparkContext.broadcast(_frequent(docs, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = shared.value
        for batch in batches:
            sizes, his, los, prefixes = [], [], [], []
            for own in shingle_sets(encoded(batch.column(2))):
                hi, lo = _signature(own)
                first = _ordered(own, known, counts)[: prefix_length(len(own), percent)]
                sizes.append(len(own))
                his.append(hi)
                los.append(lo)
                prefixes.append(first.view(np.int64))
            made = [
                pa.array(sizes, pa.int64()),
                pa.array(his, pa.int64()),
                pa.array(los, pa.int64()),
                pa.array(prefixes, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made],
                names=["doc_id", "text_hash", "n", "hi", "lo", "prefix"],
            )

    return docs.select(doc_id, F.xxhash64(text), text).mapInArrow(
        run, "doc_id long, text_hash long, n long, hi long, lo long, prefix array<long>"
    )


def _lists(classes: DataFrame) -> DataFrame:
    """The index without lists of one entry: rows (token, pos, n, class).

    The rows of a task are sorted. The first and the last list of a task are kept as they
    are, since they may go on in another task.
    """
    entries = classes.filter("n > 0").select(
        "class", "n", F.posexplode("prefix").alias("pos", "token")
    )
    entries = entries.select("token", F.col("pos").cast("long").alias("pos"), "n", "class")
    order = ["token", "pos", "n", "class"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, kept = None, None  # a last entry that may be alone; the list known to stay
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            if held is not None:
                table = pa.concat_tables([held, table]).combine_chunks()
            token = table.column("token").to_numpy()
            kept = token[0] if kept is None else kept
            starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            sizes = np.diff(np.append(starts, len(token)))
            keep = np.repeat(sizes > 1, sizes) | (token == kept)
            held = None if keep[-1] else table.slice(len(token) - 1)
            kept = token[-1] if keep[-1] else kept
            yield from table.filter(pa.array(keep)).to_batches()
        if held is not None:
            yield from held.to_batches()

    placed = entries.repartitionByRange(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(run, "token long, pos long, n long, class long")


def _may_link(percent: int) -> str:
    """Bounds on size and position that every linked pair (a_, b_) meets at some shingle."""
    least = f"ceil({percent} * (a_n + b_n) / {100 + percent})"
    return (
        f"100 * least(a_n, b_n) >= {percent} * greatest(a_n, b_n)"
        f" AND least(a_n - a_pos, b_n - b_pos) >= {least}"
    )


def _entry(prefix: str) -> list:
    return [F.col(c).alias(f"{prefix}_{c}") for c in ("class", "n", "pos")]


def _head_pairs(lists: DataFrame, percent: int, number: int) -> DataFrame:
    """Pairs (a, b) of a list's head and its entries of other components.

    The head is the entry nearest to the front; after round 0, that of a component picked
    by a hash, so that heads differ from round to round.
    """
    turn = F.lit(0) if number == 0 else F.xxhash64("root", F.lit(number))
    head = F.min(F.struct(turn.alias("turn"), "pos", "n", "class", "root")).alias("head")
    heads = lists.groupBy("token").agg(
        head, F.min("root").alias("low"), F.max("root").alias("high")
    )
    heads = heads.filter("low <> high").select(
        "token",
        F.col("head.class").alias("a_class"),
        F.col("head.n").alias("a_n"),
        F.col("head.pos").alias("a_pos"),
        F.col("head.root").alias("a_root"),
    )
    others = lists.select("token", "root", *_entry("b"))
    return (
        others.join(heads, "token")
        .filter(f"root <> a_root AND {_may_link(percent)}")
        .select(F.col("a_class").alias("a"), F.col("b_class").alias("b"))
        .distinct()
    )


def _left_pairs(lists: DataFrame, percent: int, number: int) -> DataFrame:
    """Pairs of entries of one list that are in different components, where they may link.

    Lists are joined by bands of sizes, so that sizes too far apart don't meet.
    """
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent)) + 1e-9)
    spread = lists.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    lists = lists.join(spread.filter("low <> high").select("token"), "token", "left_semi")
    lists = stage(lists.withColumn("band", band.cast("int")), "left_lists")
    one = lists.select("token", "band", F.col("root").alias("a_root"), *_entry("a"))
    two = lists.select(
        "token",
        F.explode(F.array("band", F.col("band") + 1)).alias("band"),
        F.col("root").alias("b_root"),
        *_entry("b"),
    )
    return (
        one.join(two, ["token", "band"])
        .filter(
            "a_root <> b_root AND (a_n > b_n OR (a_n = b_n AND a_class > b_class))"
            f" AND {_may_link(percent)}"
        )
        .select(F.col("a_class").alias("a"), F.col("b_class").alias("b"))
        .distinct()
    )


def _bodies(docs: DataFrame, classes: DataFrame, wanted: DataFrame, doc_id: str, text: str):
    """Rows (class, elements), the sets of the ``wanted`` classes, from their texts."""
    asked = classes.select("class", "hi", "lo", "one.*").join(
        if_small(wanted), "class", "left_semi"
    )
    asked = stage(asked, "asked")
    found = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("hash"), F.col(text).alias("text")
    )
    same = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("hash") == F.col("text_hash"))
    found = found.join(if_small(asked), same)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sets = [], []
            rows = zip(
                batch.column("class").to_pylist(), batch.column("hi").to_pylist(),
                batch.column("lo").to_pylist(), encoded(batch.column("text")),
            )
            for key, hi, lo, raw in rows:
                own = shingles(raw)
                if _signature(own) == (hi, lo):
                    keys.append(key)
                    sets.append(own.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array([len(e) // 8 for e in sets], pa.int64()),
                    pa.array(sets, pa.binary()),
                ],
                names=["class", "n", "elements"],
            )

    return found.select("class", "hi", "lo", "text").mapInArrow(
        run, "class long, n long, elements binary"
    )


def _common(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Which elements of ``one`` are in the sorted set ``two``."""
    if len(one) == 0 or len(two) == 0:
        return np.zeros(len(one), bool)
    at = np.minimum(np.searchsorted(two, one), len(two) - 1)
    return two[at] == one


def _both(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with ``column`` and ``n`` of both, from ``rows`` (class, n, column)."""
    for side in ("a", "b"):
        own = rows.select(
            F.col("class").alias(side), F.col("n").alias(f"n_{side}"),
            F.col(column).alias(f"{column}_{side}"),
        )
        pairs = pairs.join(own, side)
    return pairs


def _promising(pairs: DataFrame, classes: DataFrame, wanted: DataFrame, percent: int):
    """``pairs`` whose prefixes leave it open that they link.

    Of two ordered sets, all common elements up to the end of that prefix which ends first
    are common to the prefixes; the others are in the rest of its set.
    """
    own = classes.select("class", "n", "prefix").join(if_small(wanted), "class", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            names = ("n_a", "n_b", "prefix_a", "prefix_b")
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            sizes_a, sizes_b = (c.to_pylist() for c in columns[:2])
            for n, m, one, two in zip(sizes_a, sizes_b, columns[2], columns[3]):
                x, y = one.values.to_numpy(), np.sort(two.values.to_numpy())
                most = int(_common(x, y).sum()) + max(n - len(x), m - len(y))
                keep.append((100 + percent) * most >= percent * (n + m))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return _both(pairs, own, "prefix").mapInArrow(run, "a long, b long")


def _overlaps(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (a, b, n_a, n_b, common, lacks, adds) of ``pairs``, by the whole sets.

    ``lacks`` and ``adds`` are what b lacks of a, and adds, where they link and are near.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["a", "b", "n_a", "n_b"]
        for batch in batches:
            found, lacks, adds = [], [], []
            columns = [batch.column(batch.schema.get_field_index(c)) for c in names]
            bodies = [
                batch.column(batch.schema.get_field_index(c)).to_pylist()
                for c in ("elements_a", "elements_b")
            ]
            for one, two in zip(*bodies):
                x, y = np.frombuffer(one, np.uint64), np.frombuffer(two, np.uint64)
                shared = _common(x, y)
                n = int(shared.sum())
                union = len(x) + len(y) - n
                near = 100 * n >= percent * union and union - n <= NEAR * len(x)
                found.append(n)
                lacks.append(x[~shared].tobytes() if near else None)
                adds.append(y[~_common(y, x)].tobytes() if near else None)
            yield pa.RecordBatch.from_arrays(
                [
                    *columns,
                    pa.array(found, pa.int64()),
                    pa.array(lacks, pa.binary()),
                    pa.array(adds, pa.binary()),
                ],
                names=[*names, "common", "lacks", "adds"],
            )

    return _both(pairs, sets, "elements").mapInArrow(
        run, "a long, b long, n_a long, n_b long, common long, lacks binary, adds binary"
    )


def _derived(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (a, b, n_a, n_b, common) of ``pairs`` from the overlaps of a with b's base.

    ``pairs``: a, b, lacks, adds of b towards its base, and n_a, n_base, base_common.
    """
    own = sets.select(F.col("class").alias("a"), F.col("elements").alias("elements_a"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            sizes, found = [], []
            for r in rows:
                head, less, more = (
                    np.frombuffer(r[c], np.uint64) for c in ("elements_a", "lacks", "adds")
                )
                sizes.append(r["n_base"] - len(less) + len(more))
                change = int(_common(more, head).sum()) - int(_common(less, head).sum())
                found.append(r["base_common"] + change)
            names = ("a", "b", "n_a")
            kept = [batch.column(batch.schema.get_field_index(c)) for c in names]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes, pa.int64()), pa.array(found, pa.int64())],
                names=[*names, "n_b", "common"],
            )

    return pairs.join(own, "a").mapInArrow(
        run, "a long, b long, n_a long, n_b long, common long"
    )


def _checked(pairs: DataFrame, sets: DataFrame, near: DataFrame | None, percent: int):
    """Rows (a, b, lacks, adds) of ``pairs`` that link."""
    linked = f"100 * common >= {percent} * (n_a + n_b - common)"
    if near is None:
        return _overlaps(pairs, sets, percent).filter(linked).select("a", "b", "lacks", "adds")
    based = pairs.join(near.withColumnRenamed("class", "b"), "b", "left")
    based = stage(based.withColumn("base", F.coalesce("base", "b")), "based")
    whole = based.select("a", F.col("base").alias("b")).filter("a <> b").distinct()
    whole = stage(_overlaps(whole, sets, percent).drop("lacks", "adds"), "overlaps")
    # Where the base is the head itself, the pair was checked when the base was found.
    known = whole.select(
        "a", F.col("b").alias("base"), "n_a", F.col("n_b").alias("n_base"),
        F.col("common").alias("base_common"),
    )
    derived = based.filter("base <> b").join(known, ["a", "base"])
    direct = whole.join(based.filter("base = b").select("a", "b"), ["a", "b"], "left_semi")
    found = direct.select("a", "b", "n_a", "n_b", "common").unionByName(_derived(derived, sets))
    nothing = F.lit(None).cast("binary")
    return found.filter(linked).select("a", "b", nothing.alias("lacks"), nothing.alias("adds"))


def join(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id) for all rows of ``docs``.

    ``component_id`` is the smallest id reachable by links, the own one included.
    """
    docs = docs.select(F.col(doc_id).cast("long").alias(doc_id), F.col(text).alias(text))
    rows, classes, _, roots = _linked(docs, doc_id, text, percent, rounds)
    return _labelled(rows, classes, roots)


def count_links(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
    rounds: int = ROUNDS,
) -> DataFrame:
    """``join`` with ``n_links``: how many other rows a row's set links with, all counted."""
    docs = docs.select(F.col(doc_id).cast("long").alias(doc_id), F.col(text).alias(text))
    rows, classes, links, roots = _linked(docs, doc_id, text, percent, rounds)
    counts = classes.select("class", F.lit(0).alias("more")).limit(0)
    if links is not None:
        groups, sets = _groups(docs, classes, links, roots, percent, doc_id, text)
        counts = _counted(groups, sets, percent)
    n_links = F.coalesce("more", F.col("copies") - 1)
    counts = classes.join(counts, "class", "left").select(
        "hi", "lo", F.when(F.col("n") > 0, n_links).otherwise(0).cast("long").alias("n_links")
    )
    return _labelled(rows, classes, roots, counts)


def _linked(docs: DataFrame, doc_id: str, text: str, percent: int, rounds: int) -> tuple:
    """The sets' rows, their classes, links that join components, and roots."""
    small_batches(docs.sparkSession)
    rows = stage(_sets(docs, doc_id, text, percent), "sets")
    again = rows.groupBy("doc_id", "text_hash").count().filter("count > 1")
    repeated = again.limit(1).count() > 0
    classes = rows.groupBy("hi", "lo", "n").agg(
        F.min("doc_id").alias("label"),
        F.min(F.struct("doc_id", "text_hash")).alias("one"),
        F.first("prefix").alias("prefix"),
        F.count(F.lit(1)).alias("copies"),
    )
    classes = stage(classes.withColumn("class", F.monotonically_increasing_id()), "classes")
    lists = stage(_lists(classes), "lists")
    links = roots = sets = near = tested = None
    for number in range(rounds + 1):
        if roots is None:
            placed = lists.withColumn("root", F.col("class"))
        else:
            placed = lists.join(if_small(roots), lists["class"] == F.col("node"), "left")
            placed = placed.withColumn("root", F.coalesce("root", "class")).drop("node")
        find = _head_pairs if number < rounds else _left_pairs
        pairs = find(placed, percent, number)
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
            other = tested.select(F.col("b").alias("a"), F.col("a").alias("b"))
            pairs = pairs.join(other, ["a", "b"], "left_anti")
        pairs = stage(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        pairs = stage(_promising(pairs, classes, _members(pairs), percent), "promising")
        if not pairs.limit(1).count():
            continue
        wanted = _members(pairs)
        if near is not None:  # a set near its base is not needed as a member
            based = pairs.join(near.withColumnRenamed("class", "b"), "b", "left")
            wanted = _members(based.select("a", F.coalesce("base", "b").alias("b")))
        if sets is not None:
            wanted = wanted.join(sets, "class", "left_anti")
        more = _bodies(docs, classes, stage(wanted, "wanted"), doc_id, text)
        # Where rows repeat, each of them has the body of their class; one is enough.
        more = stage(more.dropDuplicates(["class"]) if repeated else more, "bodies")
        sets = more if sets is None else sets.unionByName(more)
        found = stage(_checked(pairs, sets, near, percent), "links")
        own = found.select("a", "b")
        links = own if links is None else links.unionByName(own)
        if near is None:
            near = stage(
                found.filter("lacks IS NOT NULL")
                .groupBy(F.col("b").alias("class"))
                .agg(F.min_by(F.struct("a", "lacks", "adds"), "a").alias("x"))
                .select("class", F.col("x.a").alias("base"), "x.lacks", "x.adds"),
                "near",
            )
        roots = components(links)
    return rows, classes, links, roots


def _groups(
    docs: DataFrame, classes: DataFrame, links: DataFrame, roots: DataFrame, percent: int,
    doc_id: str, text: str,
) -> tuple[DataFrame, DataFrame]:
    """Rows (class, root, head, n, copies) of all classes with links; their sets.

    Any two classes of one ``head`` link, since their sets are that near to its set. It is
    null where there is none, and in components that fit in a cell, which need none.
    """
    degrees = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").count()
    placed = degrees.join(roots, degrees["class"] == F.col("node"), "left").select(
        "class", "count", F.coalesce("root", "class").alias("root")
    )
    placed = placed.join(classes.select("class", "n", "copies"), "class")
    placed = stage(placed, "placed")
    sets = _bodies(docs, classes, placed.select("class"), doc_id, text)
    sets = stage(sets.dropDuplicates(["class"]), "linked_sets")  # repeated rows have one
    large = placed.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    large = stage(large.filter(F.col("size") > CELL).select("root"), "large")
    left, members = placed.join(if_small(large), "root", "left_semi"), None
    for _ in range(HUBS):
        hubs = left.groupBy("root").agg(
            F.max_by(F.struct("class", "n"), F.struct("count", "class")).alias("hub")
        )
        hubs = hubs.select("root", F.col("hub.class").alias("a"), F.col("hub.n").alias("of_n"))
        hubs = stage(hubs, "hubs")
        if not hubs.limit(1).count():
            break
        pairs = left.join(if_small(hubs), "root").filter(
            f"class <> a AND 100 * least(n, of_n) >= {percent} * greatest(n, of_n)"
        )
        found = _overlaps(pairs.select("a", F.col("class").alias("b")), sets, percent)
        found = found.filter(
            f"2 * (100 * (n_a - common) + {percent} * (n_b - common)) <= {100 - percent} * n_a"
        ).select(F.col("b").alias("class"), F.col("a").alias("head"))
        own = hubs.select(F.col("a").alias("class"), F.col("a").alias("head"))
        found = stage(found.unionByName(own), "near_hubs")
        members = found if members is None else members.unionByName(found)
        left = stage(left.join(found, "class", "left_anti"), "left")
    if members is None:
        groups = placed.withColumn("head", F.lit(None).cast("long"))
    else:
        many = members.groupBy("head").count().filter(F.col("count") >= TIGHT).select("head")
        members = members.join(if_small(stage(many, "tight")), "head", "left_semi")
        groups = placed.join(members, "class", "left")
    return stage(groups.select("class", "root", "head", "n", "copies"), "groups"), sets


def _cells(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """Rows (big, cell, low, high, block, class, n, copies, elements), one per cell of a class.

    Components of up to ``CELL`` classes are packed into cells whole. The classes of a larger
    one are dealt to blocks, those of one head to blocks of their own, and a cell holds two
    blocks, or one: every two blocks meet once, but for those of one head.
    """
    sized = groups.groupBy("root", F.coalesce("head", F.lit(-1)).alias("team")).agg(
        F.count(F.lit(1)).alias("size"), F.sum("n").alias("tokens")
    )
    parts = F.expr(
        f"greatest(1, least(size div {CELL}, greatest(32, size div {16 * CELL})),"
        f" tokens div {CELL_TOKENS})"
    )
    of_root = Window.partitionBy("root")
    before = of_root.orderBy("team").rowsBetween(Window.unboundedPreceding, -1)
    sized = stage(
        sized.withColumn("parts", parts).select(
            "root", "team", "parts", "size", "tokens",
            F.sum("size").over(of_root).alias("whole"),
            F.sum("parts").over(of_root).alias("blocks"),
            F.coalesce(F.sum("parts").over(before), F.lit(0)).alias("first"),
        ),
        "sized",
    )
    small = sized.filter(F.col("whole") <= CELL)
    total = small.agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens")).first()
    packs = 1 + max((total.size or 0) // (4 * CELL), (total.tokens or 0) // CELL_TOKENS)
    blocks = sized.filter(F.col("whole") > CELL)
    blocks = if_small(
        blocks.select(
            F.col("root").alias("of"), F.col("team").alias("of_team"), "parts", "blocks", "first"
        )
    )
    same = (F.col("root") == F.col("of")) & (
        F.coalesce("head", F.lit(-1)) == F.col("of_team")
    )
    rows = groups.join(blocks, same, "left").join(sets.select("class", "elements"), "class")
    rest = ["class", "n", "copies", "elements"]
    none = F.lit(-1).cast("long")
    packed = rows.filter("of IS NULL").select(
        F.lit(False).alias("big"), F.pmod(F.xxhash64("root"), F.lit(packs)).alias("cell"),
        none.alias("low"), none.alias("high"), none.alias("block"), *rest,
    )
    block = F.col("first") + F.pmod(F.xxhash64("class"), F.col("parts"))
    met = rows.filter("of IS NOT NULL").withColumn("block", block.cast("long"))
    met = met.withColumn("other", F.explode(F.expr("sequence(0L, CAST(blocks - 1 AS BIGINT))")))
    met = met.filter("head IS NULL OR other < first OR other >= first + parts")
    met = met.select(
        F.lit(True).alias("big"), F.col("root").alias("cell"),
        F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", *rest,
    )
    return packed.unionByName(met)


def _cell_links(
    bodies: list[np.ndarray], copies: np.ndarray, side: np.ndarray | None, percent: int
) -> np.ndarray:
    """For each set, the copies of those in its cell that it links with.

    ``side`` marks the sets of one of two blocks, which meet those of the other only;
    without it all meet.
    """
    sizes = np.array([len(b) for b in bodies])
    tokens, place = np.unique(np.concatenate(bodies), return_inverse=True)
    owner = np.repeat(np.arange(len(bodies)), sizes)
    shared = np.bincount(place, minlength=len(tokens)) > 1
    kept = shared[place]
    at, owner = (np.cumsum(shared) - 1)[place[kept]], owner[kept]
    order = np.argsort(at, kind="stable")
    at, owner = at[order], owner[order]
    every = np.arange(len(bodies))
    one, two = (every, every) if side is None else (every[side], every[~side])
    common = np.zeros((len(one), len(two)), np.int64)
    for start in range(0, int(shared.sum()), COLUMNS):
        low, high = np.searchsorted(at, [start, start + COLUMNS])
        has = np.zeros((len(bodies), COLUMNS), np.float32)
        has[owner[low:high], at[low:high] - start] = 1
        common += (has[one] @ has[two].T).astype(np.int64)
    links = 100 * common >= percent * (sizes[one][:, None] + sizes[two][None, :] - common)
    more = np.zeros(len(bodies), np.int64)
    if side is None:
        np.fill_diagonal(links, False)
        return links @ copies
    more[one], more[two] = links @ copies[two], copies[one] @ links
    return more


def _counted(groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (class, more): the other rows that each class with links links with."""

    def count(cell: pd.DataFrame) -> pd.DataFrame:
        bodies = [np.frombuffer(e, np.uint64) for e in cell["elements"]]
        two = cell["low"].iloc[0] != cell["high"].iloc[0]
        side = (cell["block"] == cell["low"]).to_numpy() if two else None
        more = _cell_links(bodies, cell["copies"].to_numpy(np.int64), side, percent)
        return pd.DataFrame({"class": cell["class"], "more": more})

    cells = _cells(groups, sets).groupBy("big", "cell", "low", "high")
    met = cells.applyInPandas(count, "class long, more long")
    met = met.groupBy("class").agg(F.sum("more").alias("more"))
    heads = groups.filter("head IS NOT NULL").groupBy("head").agg(F.sum("copies").alias("docs"))
    return (
        groups.join(if_small(stage(heads, "heads")), "head", "left")
        .join(met, "class", "left")
        .select(
            "class", F.expr("coalesce(docs, copies) - 1 + coalesce(more, 0)").alias("more")
        )
    )


def _members(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("class")).distinct()


def _labelled(
    rows: DataFrame, classes: DataFrame, roots: DataFrame | None, counts: DataFrame | None = None
) -> DataFrame:
    """Each row with the smallest id of its class's component, and its class's ``counts``."""
    labels = classes.select("class", "hi", "lo", "n", "label")
    if roots is not None:
        labels = labels.join(roots, labels["class"] == F.col("node"), "left").select(
            "hi", "lo", "n", "label", F.coalesce("root", "class").alias("root")
        )
        linked = labels.groupBy("root").agg(F.min("label").alias("component"))
        labels = labels.join(linked, "root")
    else:
        labels = labels.withColumn("component", F.col("label"))
    labels = labels.select("hi", "lo", F.col("n").alias("of_n"), "component")
    if counts is not None:
        labels = labels.join(counts, ["hi", "lo"])
    copies = classes.select("hi", "lo", F.col("copies").alias("n"))
    found = lookup_join(
        rows.select("doc_id", "n", "hi", "lo"), labels, ["hi", "lo"],
        hot_rows=HOT_COPIES, counted=copies,
    )
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"),
        *([] if counts is None else ["n_links"]),
    )

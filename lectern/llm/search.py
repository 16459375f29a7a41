r"""Ranked lexical search by pipelined term partitioning.

Terms are the maximal runs of ASCII letters and digits and of characters beyond ASCII, with
A-Z in lower case. A document's score for an item sums, over the item's terms, repeats
included, ``w * ((1000000000 * tf) div (1000 * tf + 12 * m))`` with

* ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))``, the term's weight;
* ``m = 100 - 25 + ((25 * n * N) div L)`` for a document of ``n`` terms, repeats included;
* ``N`` the documents with a term, ``L`` all their terms, ``df`` those that hold the term.

1. Whole texts are read once. What they hold of the items' terms is written as blocks of at
   most ``BLOCK_ROWS`` documents or ``BLOCK_POSTINGS`` entries. ``n``, ``N``, ``L`` and ``df``
   are counted over all documents and all their terms.
2. Terms are dealt to ``OWNERS`` owners, rare ones to the first, so that a later owner has
   about ``SHARE`` times the entries of the one before. An owner's part of a block is a row
   of term numbers, documents and contributions, all whole numbers.
3. Items travel in bundles of at most ``BUNDLE``. A bundle's accumulators, a sparse list of
   documents and sums per item and block, pass through the owners in turn: at each, they are
   cogrouped with that owner's entries of the block, and what these contribute is added.
4. A document leaves the bundle when what the later owners can add at most, by the block's
   highest contribution of each term, can't lift it to the ``top``-th best sum of its block
   so far. No document among the best is lost.
5. After the last owner, each block's best become rows, and a window per item picks the best
   of all blocks. Equal scores are in order of id, missing ids last.

A group that meets in a task has one block and one bundle, however frequent a term or large
the table. All items' terms are known to the tasks that read texts; items are dealt into as
many passes as keep their texts within ``PASS_BYTES``, so that what is broadcast is bounded.

Each row of the documents is a document of its own, repeated ids and missing ids included.
A null or empty text has no terms. An item is told by its id; rows of one id are one item
with the terms of all of them, rows without an id are left out. Items without terms, and an
empty table, give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import encoded, small_batches
from lectern.scratch import stage

TOP = 20
OWNERS, SHARE = 4, 4
BUNDLE = 1024
BLOCK_ROWS, BLOCK_POSTINGS = 1 << 13, 1 << 20
PASS_BYTES = 16 << 20
# Sums below this are exact as doubles.
EXACT = 1 << 53

_TERM = bytearray(b" " * 128 + bytes(range(128, 256)))
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _TERM[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    _TERM[_c] = _c + 32
_TERM = bytes(_TERM)


def terms(raw: bytes) -> list[bytes]:
    """The terms of a UTF-8 text, in order."""
    return raw.translate(_TERM).split()


class _Items:
    """The items of a pass: their terms as numbers, and how often each holds them."""

    def __init__(self, rows: list[tuple[int, str]]):
        counts: dict[int, Counter] = {}
        for item, text in rows:
            counts.setdefault(item, Counter()).update(terms((text or "").encode()))
        counts = {item: held for item, held in sorted(counts.items()) if held}
        self.ids = list(counts)
        self.number = {t: i for i, t in enumerate(sorted(set().union(*counts.values())))}
        self.terms = [
            np.array([self.number[t] for t in held], np.int64) for held in counts.values()
        ]
        self.times = [np.array(list(held.values()), np.int64) for held in counts.values()]


def _packed(values: np.ndarray, kind: type) -> bytes:
    return np.asarray(values).astype(kind).tobytes()


_BLOCK = "block long, ids array<long>, sizes binary, docs binary, terms binary, tfs binary"


def _blocks(docs: DataFrame, doc_id: str, text: str, items: Broadcast) -> DataFrame:
    """Rows ``_BLOCK``: documents by ascending id, their sizes, and entries by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = items.value.number
        held: list[tuple] = []  # (no id, id, size, term numbers, counts)
        entries = made = 0

        def flush(first: int):
            held.sort(key=lambda row: row[:2])
            lengths = [len(row[3]) for row in held]
            row = [
                [first],
                [[None if missing else of for missing, of, *_ in held]],
                [_packed([row[2] for row in held], np.int64)],
                [_packed(np.repeat(np.arange(len(held)), lengths), np.int32)],
                [_packed([t for row in held for t in row[3]], np.int32)],
                [_packed([n for row in held for n in row[4]], np.int32)],
            ]
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 4]
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(v, k) for v, k in zip(row, kinds)],
                names=["block", "ids", "sizes", "docs", "terms", "tfs"],
            )

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                       encoded(batch.column(2)))
            for at, of, raw in rows:
                counts = Counter(terms(raw))
                if not counts:
                    continue
                if not held:
                    made = at
                known = [(number[t], n) for t, n in counts.items() if t in number]
                held.append((of is None, of or 0, counts.total(),
                             [t for t, _ in known], [n for _, n in known]))
                entries += len(known)
                if len(held) >= BLOCK_ROWS or entries >= BLOCK_POSTINGS:
                    yield flush(made)
                    entries = 0
        if held:
            yield flush(made)

    rows = docs.select(
        F.monotonically_increasing_id(), F.col(doc_id).cast("long"), F.col(text)
    )
    return rows.mapInArrow(run, _BLOCK)


def _counted(blocks: DataFrame, n_terms: int) -> tuple[int, int, np.ndarray]:
    """N, L and each term's df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(n_terms, np.int64), 0, 0
        for batch in batches:
            for sizes, of in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                sizes = np.frombuffer(sizes, np.int64)
                n, total = n + len(sizes), total + int(sizes.sum())
                df += np.bincount(np.frombuffer(of, np.int32), minlength=n_terms)
        found = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(found, [-1, -2])), pa.array(np.append(df[found], [n, total]))],
            names=["term", "n"],
        )

    counts = blocks.select("sizes", "terms").mapInArrow(run, "term long, n long")
    found = dict(counts.groupBy("term").agg(F.sum("n")).collect())
    df = np.zeros(n_terms, np.int64)
    n, total = found.pop(-1, 0), found.pop(-2, 0)
    df[np.fromiter(found, np.int64, len(found))] = list(found.values())
    return n, total, df


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()],
                    np.int64)


def owners_of(df: np.ndarray, owners: int = OWNERS, share: int = SHARE) -> np.ndarray:
    """Each term's owner: rare terms first, a later owner has ``share`` times the entries."""
    order = np.argsort(df, kind="stable")
    reached = np.cumsum(df[order])
    parts = np.cumsum([share**i for i in range(owners)], dtype=np.float64)
    limits = parts / parts[-1] * (reached[-1] if len(reached) else 0)
    owner = np.empty(len(df), np.int64)
    owner[order] = np.minimum(np.searchsorted(limits, reached), owners - 1)
    return owner


_ENTRIES = "block long, bundle int, owner int, docs binary, terms binary, gains binary, rest binary"


def _owned(blocks: DataFrame, plan: Broadcast) -> DataFrame:
    """Rows ``_ENTRIES``: by owner, sorted by term, what each entry contributes once.

    ``rest``: what later owners can add to a document of the block at most, per item.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, n, total, weight, owner, owners = plan.value
        per_bundle = range(0, len(items.ids), BUNDLE)
        for batch in batches:
            for row in batch.to_pylist():
                sizes, docs, of, tf = (
                    np.frombuffer(row[c], k) for c, k in (
                        ("sizes", np.int64), ("docs", np.int32), ("terms", np.int32),
                        ("tfs", np.int32))
                )
                m = 75 + (25 * sizes * n) // total
                tf = tf.astype(np.int64)
                gains = weight[of] * ((1_000_000_000 * tf) // (1000 * tf + 12 * m[docs]))
                order = np.lexsort((docs, of))
                docs, of, gains = docs[order], of[order], gains[order]
                most = np.zeros(len(weight), np.int64)
                starts = np.flatnonzero(np.diff(of, prepend=-1))
                if len(starts):
                    most[of[starts]] = np.maximum.reduceat(gains, starts)
                made = []
                for turn in range(owners):
                    own, later = owner[of] == turn, np.where(owner > turn, most, 0)
                    rest = [int((later[t] * k).sum()) for t, k in zip(items.terms, items.times)]
                    for bundle, first in enumerate(per_bundle):
                        made.append((
                            row["block"], bundle, turn, _packed(docs[own], np.int32),
                            _packed(of[own], np.int32), _packed(gains[own], np.int64),
                            _packed(rest[first : first + BUNDLE], np.int64),
                        ))
                kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(v), k) for v, k in zip(zip(*made), kinds)],
                    names=[f.split()[0] for f in _ENTRIES.split(", ")],
                )

    return blocks.mapInArrow(run, _ENTRIES)


_STATE = "block long, bundle int, item int, least long, open boolean, docs binary, sums binary"
_STATE_NAMES = [f.split()[0] for f in _STATE.split(", ")]


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``starts[i] .. starts[i] + lengths[i] - 1`` for all ``i`` in turn."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def _added(held: np.ndarray, times: np.ndarray, of: np.ndarray, docs: np.ndarray,
           gains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Documents and sums that an item's terms ``held`` get from an owner's entries."""
    first, end = np.searchsorted(of, held), np.searchsorted(of, held, "right")
    at = _spans(first, end - first)
    if len(at) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    size = int(docs.max()) + 1
    values = gains[at] * np.repeat(times, end - first)
    if int(values.max()) * len(values) < EXACT:
        sums = np.bincount(docs[at], values, size).astype(np.int64)
    else:
        sums = np.zeros(size, np.int64)
        np.add.at(sums, docs[at], values)
    found = np.flatnonzero(sums)
    return found, sums[found]


def _visit(items: Broadcast, top: int):
    """What an owner does with a bundle: the cogrouped tables of one block."""

    def run(state: pa.Table, entries: pa.Table) -> pa.Table:
        known = {r["item"]: r for r in state.to_pylist()}
        rows = entries.to_pylist()  # one at most: every block has a row per owner and bundle
        if not rows:
            return state.select(_STATE_NAMES)
        row = rows[0]
        of, docs = np.frombuffer(row["terms"], np.int32), np.frombuffer(row["docs"], np.int32)
        gains, rest = np.frombuffer(row["gains"], np.int64), np.frombuffer(row["rest"], np.int64)
        made = []
        for place, more in enumerate(rest.tolist()):
            item = row["bundle"] * BUNDLE + place
            found, sums = _added(items.value.terms[item], items.value.times[item], of, docs, gains)
            before, least = known.get(item), 0
            if before is not None:
                least = before["least"]
                own = np.frombuffer(before["docs"], np.int32).astype(np.int64)
                at = np.minimum(np.searchsorted(found, own), max(len(found) - 1, 0))
                hit = found[at] == own if len(found) else np.zeros(len(own), bool)
                total = np.frombuffer(before["sums"], np.int64).copy()
                total[hit] += sums[at[hit]]
                if before["open"]:  # documents that come in here
                    fresh = ~np.isin(found, own)
                    own = np.concatenate([own, found[fresh]])
                    total = np.concatenate([total, sums[fresh]])
                order = np.argsort(own)
                found, sums = own[order], total[order]
            if len(sums) >= top:
                least = max(least, int(np.partition(sums, -top)[-top]))
            keep = sums + more >= least
            made.append((
                row["block"], row["bundle"], item, least, more > 0 and more >= least,
                _packed(found[keep], np.int32), _packed(sums[keep], np.int64),
            ))
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary()]
        return pa.table([pa.array(list(v), k) for v, k in zip(zip(*made), kinds)], _STATE_NAMES)

    return run


def _best(state: DataFrame, blocks: DataFrame, items: Broadcast, top: int) -> DataFrame:
    """Rows (item_id, doc_id, score): the best of each block."""

    def run(bundles: pa.Table, of: pa.Table) -> pa.Table:
        ids = of.column("ids").combine_chunks().flatten() if of.num_rows else pa.array([], pa.int64())
        made: list[list] = [[], [], []]
        for row in bundles.to_pylist():
            docs, sums = np.frombuffer(row["docs"], np.int32), np.frombuffer(row["sums"], np.int64)
            order = np.lexsort((docs, -sums))[:top]  # documents are numbered by ascending id
            made[0] += [items.value.ids[row["item"]]] * len(order)
            made[1] += ids.take(pa.array(docs[order])).to_pylist()
            made[2] += sums[order].tolist()
        return pa.table([pa.array(v, pa.int64()) for v in made], ["item_id", "doc_id", "score"])

    named = blocks.select("block", "ids")
    return state.groupBy("block").cogroup(named.groupBy("block")).applyInArrow(
        run, "item_id long, doc_id long, score long"
    )


def _one_pass(
    docs: DataFrame, rows: list[tuple[int, str]], doc_id: str, text: str, top: int
) -> DataFrame | None:
    context = docs.sparkSession.sparkContext
    items = _Items(rows)
    if not items.ids:
        return None
    shared = context.broadcast(items)
    blocks = stage(_blocks(docs, doc_id, text, shared), "term_blocks")
    n, total, df = _counted(blocks, len(items.number))
    if not total:
        return None
    plan = context.broadcast((items, n, total, weights(n, df), owners_of(df), OWNERS))
    entries = stage(_owned(blocks, plan), "owned_terms")
    state = docs.sparkSession.createDataFrame([], _STATE)
    for owner in range(OWNERS):
        own = entries.filter(F.col("owner") == owner)
        state = state.groupBy("block", "bundle").cogroup(own.groupBy("block", "bundle"))
        state = state.applyInArrow(_visit(shared, top), _STATE)
    return _best(state, blocks, shared, top)


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    top: int = TOP,
) -> DataFrame:
    """Rows (item_id, rank, doc_id, score): each item's ``top`` documents with a score."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.filter(F.col(item_id).isNotNull()).select(
        F.col(item_id).cast("long").alias("item"), F.col(text).alias("text")
    )
    size = asked.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    passes = max(1, -(-size // PASS_BYTES))
    number = F.pmod(F.xxhash64("item"), F.lit(passes))
    found = []
    for turn in range(passes):
        rows = [tuple(r) for r in asked.filter(number == turn).collect()]
        best = _one_pass(docs, rows, doc_id, text, top)
        if best is not None:
            found.append(best)
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best_first = Window.partitionBy("item_id").orderBy(
        F.desc("score"), F.col("doc_id").asc_nulls_last()
    )
    return (
        reduce(DataFrame.unionByName, found)
        .withColumn("rank", F.row_number().over(best_first))
        .filter(F.col("rank") <= top)
        .select("item_id", "rank", "doc_id", "score")
    )

r"""Line de-duplication across documents: keep bitmaps instead of texts.

A text's lines are what ``\n`` separates; a null or empty text is one empty line. A line's
key is the line without ``[\x20\x09-\x0D]`` at both ends, in lower case as far as A-Z goes.
Keys of fewer than ``LEAST`` code points are never dropped. Of a longer key, the document of
the smallest id that holds it keeps all its lines, however many; all other documents lose
theirs.

1. A line becomes a row of its key's 128-bit hash, its document and its position: about 40
   bytes, whatever its length. These rows are written once.
2. Keys with more than 1/``HOT_SHARE`` of the lines are found by a sketch of bounded size.
   There are at most ``HOT_SHARE`` of them, so their first documents, combined in each task,
   are broadcast and their lines stay where they are. That decides the plan only.
3. All other rows are range-partitioned by hash and sorted within that by document and
   position. A running window streams over each key's rows: its first row names the document
   that keeps the key, and rows of other documents are dropped lines.
4. The positions of a document's dropped lines become its bitmap of kept lines in run-length
   form: ``keep``, an array of runs (first line, number of lines) in order. A document that
   loses nothing has one run. The lists are broadcast to the texts while they are small;
   beyond ``BROADCAST_BYTES`` texts and lists are shuffled.

Rows are told apart by id and text. Rows of one id are one document: none of them makes
another one lose a line. Rows without an id are one document that comes after all others.
Equal rows get equal bitmaps. Columns other than these two are passed through; those named
like a new one, in any case, are replaced. A table without rows gives none.
Nothing here runs Python on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.scratch import stage

#: Keys of fewer code points are never dropped.
LEAST = 10
#: A key is hot if it has more than this part of all lines, and HOT_LINES at least.
HOT_SHARE = 10_000
HOT_LINES = 100
#: Size of all lists of dropped lines up to which they are broadcast to where the texts are.
BROADCAST_BYTES = 32 << 20
#: Keys that the sketch follows; its error is about 3.5 / TRACKED of all lines.
TRACKED = 1 << 16
#: What is stripped, and the letters that are lower-cased.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

MADE = ("n_lines", "n_dropped", "keep")


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    bare = F.btrim(line, F.lit(SPACE))
    # Without multi-byte characters the JVM's own lower-casing touches A-Z only.
    ascii_only = F.octet_length(bare) == F.length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def _keyed(docs: DataFrame, least: int) -> DataFrame:
    """Rows (h1, h2, id, of, pos): the lines that are long enough to be dropped."""
    lines = docs.select("id", "of", F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    lines = lines.select("id", "of", "pos", line_key(F.col("line")).alias("key"))
    return lines.filter(F.length("key") >= least).select(
        F.xxhash64("key").alias("h1"),
        F.xxhash64(F.lit(1), "key").alias("h2"),
        "id", "of", "pos",
    )


def _hot_keys(lines: DataFrame, share: int, least: int) -> list[int]:
    """``h1`` of the keys that hold much of the table, ``share`` of them at most."""
    found = lines.agg(
        F.count(F.lit(1)).alias("n"),
        F.expr(f"approx_top_k(h1, {share}, {max(TRACKED, share)})").alias("top"),
    ).first()
    limit = max(found.n // share, least)
    return [e["item"] for e in found.top or [] if e["count"] > limit]


def _dropped(lines: DataFrame, hot: list[int]) -> DataFrame:
    """Rows (id, of, pos) of the lines that another document keeps."""
    rare, found = lines, None
    if hot:
        keys = F.broadcast(lines.sparkSession.createDataFrame([(h,) for h in hot], "h1 long"))
        rare = lines.join(keys, "h1", "left_anti")
        common = lines.join(keys, "h1", "left_semi")
        firsts = common.groupBy("h1", "h2").agg(
            F.min(F.struct(F.col("id").isNull(), "id")).alias("first")
        )
        firsts = firsts.select("h1", "h2", F.col("first.id").alias("keeper"))
        found = common.join(F.broadcast(firsts), ["h1", "h2"])
    order = [F.col("h1"), F.col("h2"), F.col("id").asc_nulls_last(), F.col("pos")]
    placed = rare.repartitionByRange("h1", "h2").sortWithinPartitions(*order)
    running = (
        Window.partitionBy("h1", "h2")
        .orderBy(*order[2:])
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    streamed = placed.withColumn("keeper", F.first("id").over(running))
    found = streamed if found is None else streamed.unionByName(found)
    return found.filter(~F.col("id").eqNullSafe(F.col("keeper"))).select("id", "of", "pos")


def keep_bitmaps(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    least: int = LEAST,
    hot_share: int = HOT_SHARE,
    hot_lines: int = HOT_LINES,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``docs`` with n_lines, n_dropped (long) and ``keep``, the runs of lines that stay."""
    rows = docs.select(
        F.col(doc_id).alias("id"), F.xxhash64(text).alias("of"), F.col(text).alias("text")
    )
    lines = stage(_keyed(rows, least), "line_keys")
    dropped = _dropped(lines, _hot_keys(lines, hot_share, hot_lines))
    lost = dropped.groupBy("id", "of").agg(F.array_sort(F.collect_set("pos")).alias("gone"))
    lost = stage(lost.select(*[F.col(c).alias(f"__{c}") for c in ("id", "of", "gone")]), "dropped")
    size = lost.agg(F.sum(F.size("__gone") * F.lit(4) + F.lit(64))).first()[0] or 0
    rest = [c for c in docs.columns if c.lower() not in MADE]
    same = F.col(doc_id).eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__of"))
    # Few lists go to the texts. Many meet them by a shuffle that doesn't sort the texts.
    lost = F.broadcast(lost) if size <= broadcast_bytes else lost.hint("shuffle_hash")
    joined = docs.select(*[F.col(f"`{c}`") for c in rest]).join(lost, same, "left")
    gone = F.coalesce("__gone", F.array().cast("array<int>"))
    value = F.coalesce(F.col(text), F.lit(""))
    feeds = F.octet_length(value) - F.octet_length(F.replace(value, F.lit("\n"), F.lit("")))
    n_lines = feeds + 1  # cheaper than to split once more
    before = F.concat(F.array(F.lit(-1)), gone)
    runs = F.zip_with(
        before, F.concat(gone, F.array(n_lines)),
        lambda a, b: F.struct((a + 1).alias("first"), (b - a - 1).alias("n")),
    )
    return joined.select(
        *[F.col(f"`{c}`") for c in rest],
        n_lines.cast("long").alias("n_lines"),
        F.size(gone).cast("long").alias("n_dropped"),
        F.filter(runs, lambda r: r["n"] > 0).alias("keep"),
    )


def kept_text(text: Column, keep: Column) -> Column:
    r"""The lines of ``text`` in the runs of ``keep``, joined by ``\n``."""

    def joined(x: Column) -> Column:
        runs = F.transform(x["keep"], lambda r: F.slice(x["lines"], r["first"] + 1, r["n"]))
        return F.array_join(F.flatten(runs), "\n")

    # As an element of an array, the lines are split once and not once per run.
    once = F.array(F.struct(lines_of(text).alias("lines"), keep.alias("keep")))
    return F.element_at(F.transform(once, joined), 1)

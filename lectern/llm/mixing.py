"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source is to be taken ``target / source size`` times, a number with a
fraction. Its whole part is taken as it is. The fractions are rounded together: two
documents meet, and a random transfer of words between them settles one of them, which is
then taken or not; the other goes on to meet the next. Transfers keep the sum of the words
and the mean of every fraction, so a source's taken words miss what they should be by the
last document's words at most, which is rounded by chance.

The meetings form a reduction tree. Documents are ranked by source and size, in blocks of
``BLOCK`` neighbours; a block is one array, folded in one pass, and leaves one document
unsettled. What ``BLOCK`` blocks leave is folded again, until each source has one. No
array is longer than ``BLOCK``, however large a source is.

Large documents are settled first (those above their source's mean size, then those above
the mean of the rest); the fractions of the others are set to what then remains of the
target. So a source usually misses its target by a small document, and where large ones
are most of its words, by one of those.

Chance is a hash of the seed, the round and the rows' ranks, so reruns agree.

Null or empty texts have size 0 and are taken 0 times. Null is a source of its own, last
in order. A source without words has target 0. Repeated rows are documents of their own.
Input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import if_small, ranked
from lectern.scratch import stage

WORD = r"[^\x20\x09-\x0D]+"
BLOCK = 32
#: Most copies of a document, and of a source's words.
MOST_TIMES = 3.0
CLASSES = 3
SETTLED = "array<struct<key:bigint,up:boolean>>"


def words(text: Column) -> Column:
    """The number of words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: float = MOST_TIMES, cycle: int = 3) -> DataFrame:
    """Rows (source, source_size, target) from rows (source, size).

    Sources by code point, null last, weigh 1 to ``cycle``, repeating, and share all
    words by weight. A target stops at ``most`` times the source's words; the excess is
    shared again by weight among the others, until no target is above its limit.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    sources = ranked(sources, order, name="place").select(
        "source", "source_size", (F.col("place") % cycle + 1).cast("double").alias("weight")
    )
    sources = stage(sources, "sources")
    limit = most * F.col("source_size")
    rate, capped = None, F.lit(False)
    while True:
        # The rate only rises, so a source that was at its limit stays there.
        total, fixed, weight = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(capped, limit).otherwise(0.0)),
            F.sum(F.when(capped, 0.0).otherwise(F.col("weight"))),
        ).first()
        if not weight or rate == (total - fixed) / weight:
            break
        rate = (total - fixed) / weight
        capped = F.lit(rate) * F.col("weight") > limit
    target = F.when(capped, limit).otherwise(F.lit(rate) * F.col("weight"))
    return sources.select("source", "source_size", target.cast("double").alias("target"))


def _meet(acc: Column, x: Column, seed: str) -> Column:
    """``acc`` after it has met ``x``: one of the two is settled, the other carried on."""
    give = F.least(acc["size"] - acc["mass"], x["mass"])
    take = F.least(acc["mass"], x["size"] - x["mass"])
    name = F.concat_ws(":", F.lit(seed), acc["key"].cast("string"), x["key"].cast("string"))
    chance = F.conv(F.substring(F.md5(name), 1, 12), 16, 10).cast("double") / float(1 << 48)
    rises = chance * (give + take) < take

    def settle(rises: Column) -> Column:
        first = F.when(rises, acc["size"] - acc["mass"] <= x["mass"]).otherwise(
            acc["mass"] <= x["size"] - x["mass"]
        )
        return F.struct(first.alias("first"), (first == rises).alias("up"))

    def carry(s: Column) -> Column:
        def pick(column: str, settled: bool) -> Column:
            one, two = (acc, x) if settled else (x, acc)
            return F.when(s["first"], one[column]).otherwise(two[column])

        gone = F.when(s["up"], pick("size", True)).otherwise(0.0)
        entry = F.struct(pick("key", True).alias("key"), s["up"].alias("up"))
        return F.struct(
            F.concat(acc["done"], F.array(entry)).alias("done"),
            pick("key", False).alias("key"),
            pick("size", False).alias("size"),
            F.greatest(acc["mass"] + x["mass"] - gone, F.lit(0.0)).alias("mass"),
        )

    # One-element arrays, so that chance and outcome are computed once per meeting.
    outcome = F.transform(F.array(rises), settle)
    return F.element_at(F.transform(outcome, carry), 1)


def _meet_by(seed: str):
    return lambda acc, x: _meet(acc, x, seed)


def _settle(
    rows: DataFrame, seed: str, most: int, later: DataFrame | None = None
) -> DataFrame:
    """Rows (key, up) for ``rows`` (source, key, size, mass), settled in a tree.

    ``key`` is a rank below ``most``; ``mass``, from 0 to ``size``, is the words to take.
    ``later`` (of, planned, limit) says how many words of the source's later classes are to
    be taken, and how many can be. The last row of a source goes to the side that these can
    make up for, by chance if that is both or none, or if there are no later classes.
    """
    if later is None:
        later = rows.sparkSession.createDataFrame([], "of string, planned double, limit double")
    settled = []
    turn, width = 0, 1
    while width < most or turn == 0:
        turn, width = turn + 1, width * BLOCK
        blocks = rows.groupBy("source", F.expr(f"key div {width}").alias("block")).agg(
            F.sort_array(F.collect_list(F.struct("key", "size", "mass"))).alias("rows")
        )
        head = F.col("rows")[0]
        start = F.struct(
            F.expr("array()").cast(SETTLED).alias("done"),
            head["key"].alias("key"),
            head["size"].alias("size"),
            head["mass"].alias("mass"),
        )
        rest = F.slice("rows", 2, BLOCK)
        folded = F.aggregate(rest, start, _meet_by(f"{seed}:{turn}"))
        level = stage(blocks.select("source", folded.alias("fold")), "fold")
        settled.append(level.select(F.explode("fold.done").alias("s")).select("s.key", "s.up"))
        rows = level.select("source", "fold.key", "fold.size", "fold.mass")
    chance = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), "key")), 1, 12), 16, 10)
    last = chance.cast("double") / float(1 << 48) * F.col("size") < F.col("mass")
    ended = rows.join(if_small(later), rows["source"].eqNullSafe(F.col("of")), "left")
    up_fits = F.col("size") - F.col("mass") <= F.col("planned")
    down_fits = F.col("planned") + F.col("mass") <= F.col("limit")
    side = F.when(up_fits & ~down_fits, True).when(down_fits & ~up_fits, False).otherwise(last)
    settled.append(ended.select("key", side.alias("up")))
    out = settled[0]
    for more in settled[1:]:
        out = out.unionByName(more)
    return out


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: int = 17,
    prefix: str = "",
) -> DataFrame:
    """``docs`` with size, source_size, target and copies, all named with ``prefix``.

    The rows are written out once with a row number and are not shuffled with their
    texts; everything else works on (source, size) and joins the copies by row number.
    """
    added = [prefix + c for c in ("size", "source_size", "target", "copies")]
    replaced = {c.lower() for c in added}
    rows = docs.select(
        *[docs[c] for c in docs.columns if c.lower() not in replaced],
        words(docs[text]).alias("__size"),
        F.xxhash64(docs[doc_id], docs[text]).alias("__tie"),
        F.monotonically_increasing_id().alias("__row"),
    )
    rows = stage(rows, "mix_rows")
    source_of = F.col(f"`{source}`").cast("string").alias("source")
    small = rows.select(source_of, F.col("__size").alias("size"), F.col("__tie").alias("tie"),
                        F.col("__row").alias("row"), F.col(f"`{doc_id}`").alias("id"))
    goal = stage(targets(small), "targets")
    many = if_small(goal.select(*[F.col(c).alias(f"__goal_{c}") for c in goal.columns]))
    order = [F.col("source"), F.col("size").desc(), *map(F.col, ("id", "tie", "row"))]
    placed = ranked(small.filter("size > 0"), order, name="key").drop("tie", "id")
    placed = stage(_classed(placed), "classed")
    total = placed.count()
    left = goal.select("source", F.col("target").alias("left"))
    done = None
    for number in range(CLASSES):
        own = placed.filter(F.col("class") == number)
        rest = placed.filter(F.col("class") >= number).groupBy("source").agg(
            F.sum("size").alias("words"),
            F.sum(F.when(F.col("class") > number, F.col("size")).otherwise(0)).alias("later"),
        )
        times = F.least(F.greatest(F.col("left") / F.col("words"), F.lit(0.0)), F.lit(MOST_TIMES))
        rate = left.join(rest, left["source"].eqNullSafe(rest["source"])).select(
            left["source"].alias("of"), times.alias("times"),
            (times * F.col("later")).alias("planned"),
            (F.lit(MOST_TIMES) * F.col("later")).cast("double").alias("limit"),
        )
        rated = own.join(if_small(rate), own["source"].eqNullSafe(F.col("of"))).select(
            "source", "row", "key", F.col("size").cast("double").alias("size"),
            F.floor("times").alias("whole"),
            ((F.col("times") - F.floor("times")) * F.col("size")).alias("mass"),
        )
        rated = stage(rated, "rated")
        ups = _settle(
            rated.filter("mass > 0").select("source", "key", "size", "mass"),
            f"{seed}:{number}", total, rate.select("of", "planned", "limit"),
        )
        taken = rated.join(ups.filter("up").select("key", "up"), "key", "left").select(
            "source", "row", "size",
            (F.col("whole") + F.when(F.col("up"), 1).otherwise(0)).cast("long").alias("copies"),
        )
        taken = stage(taken, "taken")
        done = taken if done is None else done.unionByName(taken)
        spent = taken.groupBy(F.col("source").alias("of")).agg(
            F.sum(F.col("copies") * F.col("size")).alias("spent")
        )
        left = stage(
            left.join(spent, left["source"].eqNullSafe(F.col("of")), "left").select(
                "source", (F.col("left") - F.coalesce("spent", F.lit(0.0))).alias("left")
            ),
            "left",
        )
    copies = if_small(done.select(F.col("row").alias("__row"), F.col("copies").alias("__copies")))
    out = rows.join(copies, "__row", "left").join(
        many, F.col(f"`{source}`").cast("string").eqNullSafe(F.col("__goal_source")), "left"
    )
    return out.select(
        *[F.col(f"`{c}`") for c in docs.columns if c.lower() not in replaced],
        F.col("__size").alias(added[0]),
        F.col("__goal_source_size").alias(added[1]),
        F.col("__goal_target").alias(added[2]),
        F.coalesce("__copies", F.lit(0).cast("long")).alias(added[3]),
    )


def _classed(rows: DataFrame) -> DataFrame:
    """Add ``class``: 0 for sizes above the source's mean, 1 above the mean of the rest."""
    for number in range(CLASSES - 1):
        left = rows if number == 0 else rows.filter(F.col("class") == number)
        mean = left.groupBy(F.col("source").alias("of")).agg(F.avg("size").alias("mean"))
        joined = rows.join(
            if_small(mean), rows["source"].eqNullSafe(F.col("of")), "left"
        )
        before = F.lit(0) if number == 0 else F.col("class")
        later = F.coalesce(F.col("size") <= F.col("mean"), F.lit(False))
        rows = joined.withColumn(
            "class", before + F.when((before == number) & later, 1).otherwise(0)
        ).drop("of", "mean")
    return rows

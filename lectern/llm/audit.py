r"""Which of five filters remove which documents, alone, together and in every order.

A document fails

* A with fewer than 100 words, words being maximal ``[^\x20\x09-\x0D]+``;
* B if 100 * distinct words < 80 * words;
* C if 100 * characters ``[A-Z]`` > 10 * code points;
* D if it holds any of ``#$%&*|``;
* E if a document of a smaller id, removed or not, has the same text.

A null text is empty. A document's failures are the bits of one number, its mask.

1. Texts are read once, by JVM functions: four bits, and 128 bits of hash for E. Texts that
   occur repeatedly are looked up by hash; very frequent ones by broadcast.
2. Rows are counted by part and mask: 32 rows a part, combined before they are shuffled.
3. From these, all 32 coalitions are tabulated per part: how many documents a set of filters
   removes, and how many of those are good or toxic.
4. What a filter removes in an order is the difference of two coalitions: the filters up to
   it, and those before it.
5. The Shapley values are the exact solution of a constrained least squares problem: the
   additive game nearest to the tabulated one, coalitions weighted by the Shapley kernel,
   with the same total. The normal equations are solved in rationals. All orders together
   remove ``k!`` times that by a filter, a whole number.

Rows without an id come after all others: they fail E if a row with an id has their text.
Rows of one id don't make each other fail. A label counts if any label row of the id has it;
rows without an id have no labels. Repeated rows count repeatedly. A table without rows has
no parts and gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from fractions import Fraction
from functools import reduce
from itertools import permutations
from math import comb, factorial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators.skew import lookup_join
from lectern.scratch import stage

FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 100, 80, 10
#: Texts with more copies than this are looked up by broadcast, as far as these are few.
HOT_COPIES = 100
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def _bits(*failures: Column) -> Column:
    set_bits = [f.cast("int") * F.lit(1 << i) for i, f in enumerate(failures)]
    return reduce(Column.__add__, set_bits)


def own_failures(text: Column) -> Column:
    """The bits of what a text fails by itself: A, B, C and D."""

    def by_words(words: Column) -> Column:
        n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
        return _bits(n < LEAST_WORDS, distinct * 100 < n * LEAST_DISTINCT)

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    # As an element of an array, the words are split once and not once per use.
    first = F.element_at(F.transform(F.array(words), by_words), 1)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    second = _bits(
        capitals * 100 > F.length(text).cast("long") * MOST_CAPITALS,
        F.regexp_like(text, F.lit(r"[#$%&*|]")),
    )
    return first + second * 4


def masked(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """Rows (part, mask, good, toxic), one per row of ``docs``."""
    value = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        own_failures(value).alias("bits"),
        F.xxhash64(value).alias("h1"),
        F.xxhash64(F.lit(1), value).alias("h2"),
    )
    rows = stage(rows, "failures")
    repeated = rows.groupBy("h1", "h2").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("n")
    )
    repeated = stage(repeated.filter("n > 1"), "repeated_texts")
    marks = labels.filter(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    no = F.lit(False)
    # Rows without an id would all meet in one task of the join.
    marked = rows.filter("id IS NOT NULL").join(marks, "id", "left").unionByName(
        rows.filter("id IS NULL").withColumns({"good": no, "toxic": no})
    )
    marked = lookup_join(
        marked, repeated.drop("n"), ["h1", "h2"], "left",
        hot_rows=HOT_COPIES, counted=repeated.drop("first"),
    )
    copy = F.col("first").isNotNull() & F.coalesce(F.col("id") > F.col("first"), F.lit(True))
    return marked.select(
        "part",
        (F.col("bits") + copy.cast("int") * F.lit(16)).alias("mask"),
        F.coalesce("good", no).alias("good"),
        F.coalesce("toxic", no).alias("toxic"),
    )


def coalitions(rows: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """Per part, ``removed``, ``good`` and ``toxic`` (arrays by coalition), and ``alone``.

    ``alone`` counts the rows by mask; the others those that a coalition removes.
    """
    counts = rows.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("good").alias("good"),
        F.count_if("toxic").alias("toxic"),
    )
    spread = counts.withColumn("coalition", F.explode(F.sequence(F.lit(0), F.lit((1 << filters) - 1))))
    removed = F.col("mask").bitwiseAND(F.col("coalition")) != 0
    exactly = F.col("mask") == F.col("coalition")

    def total(name: str, where: Column) -> Column:
        return F.sum(F.when(where, F.col(name)).otherwise(0))

    table = spread.groupBy("part", "coalition").agg(
        total("n", removed).alias("removed"), total("good", removed).alias("good"),
        total("toxic", removed).alias("toxic"), total("n", exactly).alias("alone"),
    )
    names = ("removed", "good", "toxic", "alone")
    listed = F.array_sort(F.collect_list(F.struct("coalition", *names)))
    return table.groupBy("part").agg(listed.alias("of")).select(
        "part", *[F.col(f"of.{name}").alias(name) for name in names]
    )


def solve(matrix: list[list[Fraction]], values: list[Fraction]) -> list[Fraction]:
    """The solution of a regular system of equations, in rationals."""
    rows = [[*row, value] for row, value in zip(matrix, values)]
    for i in range(len(rows)):
        pivot = next(r for r in range(i, len(rows)) if rows[r][i] != 0)
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(len(rows)):
            if r != i and rows[r][i] != 0:
                factor = rows[r][i]
                rows[r] = [x - factor * y for x, y in zip(rows[r], rows[i])]
    return [row[-1] for row in rows]


def shapley(values: Sequence[int], filters: int) -> list[Fraction]:
    """Shapley values of a game given by coalition, as weighted least squares.

    Minimises the kernel-weighted squares of value less the members' sum over all proper
    coalitions, where all members sum up to the value of the full one.
    """
    full = (1 << filters) - 1
    if filters == 1:
        return [Fraction(values[1])]
    normal = [[Fraction(0)] * (filters + 1) for _ in range(filters + 1)]
    right = [Fraction(0)] * filters + [Fraction(values[full])]
    for coalition in range(1, full):
        size = coalition.bit_count()
        weight = Fraction(filters - 1, comb(filters, size) * size * (filters - size))
        members = [i for i in range(filters) if coalition >> i & 1]
        for i in members:
            right[i] += weight * values[coalition]
            for j in members:
                normal[i][j] += weight
    for i in range(filters):  # the multiplier of the constraint
        normal[i][filters] = normal[filters][i] = Fraction(1)
    return solve(normal, right)[:filters]


def steps(
    removed: Sequence[int], good: Sequence[int], toxic: Sequence[int], alone: Sequence[int],
    filters: str = FILTERS,
) -> list[tuple]:
    """All orders and their steps: what ``RESULT`` lists after ``part``."""
    total, full = sum(alone), len(removed) - 1
    orders = factorial(len(filters))
    shares = [int(orders * share) for share in shapley(removed, len(filters))]
    found = []
    for order in permutations(range(len(filters))):
        name, before = "".join(filters[i] for i in order), 0
        for step, i in enumerate(order, 1):
            after = before | 1 << i
            here = removed[after] - removed[before]
            found.append((
                name, step, total - removed[after], here, removed[1 << i] - here,
                removed[full] - removed[full ^ 1 << i], good[after] - good[before],
                toxic[after] - toxic[before], shares[i],
            ))
            before = after
    return found


def audit(
    docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
    part: str = "lang",
) -> DataFrame:
    """One row per part, order of the filters, and step; see ``RESULT``."""
    names = [field.split()[0] for field in RESULT.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                games = [[int(v) for v in game] for game in row[1:]]
                made = pd.DataFrame(steps(*games), columns=names[1:])
                made.insert(0, "part", row[0])
                yield made

    table = coalitions(masked(docs, labels, doc_id, text, part))
    return table.mapInPandas(run, RESULT)

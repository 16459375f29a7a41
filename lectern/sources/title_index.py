"""A trigram index of titles, for literal searches that don't scan the catalog.

``build_title_index`` writes a row ``gram, _id`` for each distinct run of three characters
of a lower-cased title, sorted by gram. The end of a title is filled up with ``END``, so
that every place of a title starts a gram. A search reads the grams of its word only, by
filters that reach the row groups of the scan; a word of one or two characters is the
beginning of grams. Titles that hold all of them are looked up and searched for the word.

Rows are sorted in tasks of about ``TASK_CHARS`` characters of titles each, however many
there are. A frequent gram's rows are spread over files; the ids of a word's grams are counted before
they are shuffled. Titles that are null or empty have no grams and are never found, as no
word is in them. Repeated ids are one course for the index.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators.filters import title_has
from lectern.sources.catalog import read_catalog

GRAM = 3
END = "\x00"
SCHEMA = "gram string, _id string"
#: Characters of titles whose grams one task sorts, at about 50 bytes of memory each.
TASK_CHARS = 2_000_000
#: Found ids up to which they are given to the scan of the catalog as a filter.
PUSHED_IDS = 1_000
#: Found ids up to which they are broadcast to the catalog; more are joined by a shuffle.
BROADCAST_IDS = 500_000


def grams(text: Column) -> Column:
    """The distinct grams of a text in lower case."""

    def runs(characters: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(characters) - GRAM)
        return F.transform(
            at, lambda i: F.concat(*[F.get(characters, i + k) for k in range(GRAM)])
        )

    filled = F.concat(F.lower(text), F.lit(END * (GRAM - 1)))
    # As an element of an array, the text is split once and not once per gram.
    once = F.array(F.filter(F.split(filled, "", -1), lambda c: c != ""))
    found = F.array_distinct(F.element_at(F.transform(once, runs), 1))
    return F.when(F.length(text) > 0, found)


def build_title_index(courses: DataFrame, path: str) -> None:
    rows = courses.select(F.explode(grams(F.col("title"))).alias("gram"), "_id")
    chars = courses.agg(F.sum(F.length("title"))).first()[0] or 0
    # A given number is kept; one that Spark chooses makes larger tasks of larger tables.
    tasks = max(1, -(-chars // TASK_CHARS))
    placed = rows.repartitionByRange(tasks, "gram", "_id").sortWithinPartitions("gram", "_id")
    placed.write.parquet(path)


def candidates(spark: SparkSession, path: str, word: str) -> DataFrame:
    """``_id`` of the titles that hold all grams of ``word``."""
    index = read_catalog(spark, path, SCHEMA)
    lower = spark.createDataFrame([(word,)], "w string").select(F.lower("w")).first()[0]
    if len(lower) < GRAM:
        return index.filter(F.col("gram").startswith(lower)).select("_id").distinct()
    wanted = sorted({lower[i : i + GRAM] for i in range(len(lower) - GRAM + 1)})
    held = index.filter(F.col("gram").isin(wanted)).groupBy("_id").agg(
        F.count_distinct("gram").alias("n")
    )
    return held.filter(F.col("n") == len(wanted)).select("_id")


def search_titles(courses: DataFrame, path: str, word: str) -> DataFrame:
    """The ``courses`` whose title contains ``word``, by the index at ``path``."""
    if not word:
        return courses
    found = candidates(courses.sparkSession, path, word)
    first = found.limit(PUSHED_IDS + 1).collect()
    if len(first) <= PUSHED_IDS:
        near = courses.filter(F.col("_id").isin([r[0] for r in first]))
    else:
        few = found.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
        near = courses.join(F.broadcast(found) if few else found, "_id", "left_semi")
    return near.filter(title_has(word))

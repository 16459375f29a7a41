"""Document fingerprints by I-Match with several randomised lexicon subsets.

The lexicon holds the terms within a band of inverse document frequency: those in at
least ``LOW`` and at most ``HIGH`` of the documents. Frequencies are counted over all
documents. A text's distinct lexicon terms are sorted, and of each of ``SUBSETS`` random
parts of the lexicon, the terms found there are hashed together: that is one component of
the fingerprint. A text changes the components of the terms it gains or loses, and keeps
the others. The likeness of two fingerprints is the share of equal components among those
that are not empty in both.

The band bounds the lexicon: at most (a text's distinct terms on average) / ``LOW`` terms
can reach the lower limit. A lexicon of up to ``LEXICON`` terms is one lookup table, read by
every task, and texts are fingerprinted in place, without a shuffle of their terms; a larger
one meets the terms in a join. That decides the plan only.

The parts of the lexicon are disjoint, a random one per term, so that a fingerprint changes
by degrees: of an edited text, the parts that the edit doesn't touch stay equal.

A text without lexicon terms is fingerprinted by all its terms, one without terms (null is
empty) has empty components. Fingerprints that are equal have likeness 1. Equal texts have
equal fingerprints. Where ids repeat, the next document is the one of the next greater id
with the smallest text; null ids come last.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import ranked
from lectern.scratch import stage

LOW, HIGH = 0.002, 0.1
#: Terms up to which the lexicon is a table that each task reads.
LEXICON = 1 << 17
SUBSETS = 64
BETWEEN_TERMS = r"[^\p{L}\p{N}]+"
# The lookup table's buckets.
BUCKETS = 1 << 13
DIGITS = 3
EMPTY = "-" * DIGITS


def terms(text: Column) -> Column:
    """The distinct terms of a text, lower-cased, as 64-bit hashes."""
    found = F.filter(F.split(F.lower(text), BETWEEN_TERMS), lambda t: t != "")
    return F.array_distinct(F.transform(found, lambda t: F.xxhash64(t)))


def lexicon(docs: DataFrame, text: str = "text", low: float = LOW, high: float = HIGH):
    """Rows (term, df), the terms within the band. Counts are combined before the shuffle."""
    counts = (
        docs.select(F.explode(terms(F.col(text))).alias("term"))
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("df"))
    )
    counts = stage(counts.filter("df > 1"), "frequencies")
    documents = docs.count()
    least = max(2.0, low * documents)
    return counts.filter((F.col("df") >= least) & (F.col("df") <= max(high * documents, least)))


def _table(found: DataFrame) -> Column:
    """The lexicon as one array of buckets, each the array of its terms."""
    bucket = F.pmod("term", F.lit(BUCKETS)).alias("bucket")
    filled = found.groupBy(bucket).agg(F.collect_list("term").alias("terms"))
    all_buckets = found.sparkSession.range(BUCKETS).select(F.col("id").alias("bucket"))
    rows = all_buckets.join(filled, "bucket", "left").select(
        F.struct("bucket", F.coalesce("terms", F.array().cast("array<bigint>")).alias("terms"))
        .alias("row")
    )
    one = rows.agg(F.array_sort(F.collect_list("row")).alias("rows"))
    return stage(one.select(F.col("rows.terms").alias("terms")), "lexicon").scalar()


def _with(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, though it is used several times."""
    return F.element_at(F.transform(F.array(value), use), 1)


def components(own: Column) -> Column:
    """``SUBSETS`` components of ``DIGITS`` hexadecimal digits each, as one string.

    ``own``: the sorted terms that count.
    """
    nothing = F.xxhash64(F.array().cast("array<bigint>"))
    subset = F.sequence(F.lit(0), F.lit(SUBSETS - 1))
    part = lambda t: F.pmod(F.shiftright(t, 20), F.lit(SUBSETS))
    hashes = F.transform(subset, lambda k: F.xxhash64(F.filter(own, lambda t: part(t) == k)))
    return F.array_join(
        F.transform(
            hashes,
            lambda h: F.when(h == nothing, EMPTY).otherwise(
                F.lower(F.right(F.lpad(F.hex(h), 16, "0"), F.lit(DIGITS)))
            ),
        ),
        "",
    )


def fingerprint(text: Column, table: Column) -> Column:
    """The components of a text's lexicon terms, or of all its terms if it has none."""

    def known(term: Column) -> Column:
        bucket = (F.pmod(term, F.lit(BUCKETS)) + 1).cast("int")
        return F.array_contains(F.element_at(table, bucket), term)

    def chosen(found: Column) -> Column:
        return _with(
            F.filter(found, known),
            lambda own: F.array_sort(F.when(F.size(own) > 0, own).otherwise(found)),
        )

    return _with(_with(terms(text), chosen), components)


def _joined_fingerprints(found: DataFrame, listed: DataFrame) -> DataFrame:
    """``found`` (text, edited, ...) with both fingerprints, by a join of all their terms.

    The lexicon's terms are in a part of the documents at most, so none of them is hot.
    """
    found = stage(found.withColumn("row", F.monotonically_increasing_id()), "edited")
    both = found.select("row", F.explode(F.array(
        F.struct(F.lit(0).alias("of"), terms(F.col("text")).alias("all")),
        F.struct(F.lit(1).alias("of"), terms(F.col("edited")).alias("all")),
    )).alias("t"))
    both = both.select("row", "t.of", F.explode("t.all").alias("term"))
    own = both.join(listed.select("term"), "term", "left_semi").groupBy("row").agg(*[
        F.array_sort(F.collect_list(F.when(F.col("of") == i, F.col("term")))).alias(name)
        for i, name in enumerate(("own_text", "own_edited"))
    ])
    joined = found.join(own, "row", "left")
    for name, out in (("text", "fingerprint"), ("edited", "edited_fingerprint")):
        held = F.size(F.coalesce(f"own_{name}", F.array().cast("array<bigint>"))) > 0
        counted = F.when(held, F.col(f"own_{name}")).otherwise(F.array_sort(terms(F.col(name))))
        joined = joined.withColumn(out, _with(counted, components))
    return joined.drop("row", "own_text", "own_edited")


def likeness(one: Column, two: Column) -> Column:
    """The share of equal components among those not empty in both; 1 if all are equal."""
    places = F.sequence(F.lit(0), F.lit(SUBSETS - 1))

    def at(text: Column, k: Column) -> Column:
        return F.substring(text, k * DIGITS + 1, F.lit(DIGITS))

    equal = F.size(F.filter(places, lambda k: (at(one, k) == at(two, k)) & (at(one, k) != EMPTY)))
    either = F.size(
        F.filter(places, lambda k: (at(one, k) != EMPTY) | (at(two, k) != EMPTY))
    )
    return F.when(one == two, 1.0).otherwise(equal / either)


def edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (id, text, edited, mark, next_id, next_mark), one per document.

    In ``edited`` the last half of the characters is replaced by the first as many of the
    next document. Ids are ranked without texts; a document's beginning is sent to the one
    before it, so that texts are shuffled once.
    """
    rows = docs.select(
        F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text")
    )
    ids = rows.groupBy("id").agg(
        F.max(F.length("text")).alias("n"), F.count(F.lit(1)).alias("rows")
    )
    ids = stage(ranked(ids, [F.col("id").isNull(), F.col("id")], name="rank"), "ids")
    number, most = ids.agg(F.count(F.lit(1)), F.max("rows")).first()
    own = ids.select(
        F.col("id").alias("to"), F.floor(F.col("n") / 2).cast("int").alias("half"),
        ((F.col("rank") + 1) % F.lit(max(number, 1))).alias("rank"),
    )
    follows = own.join(ids.select(F.col("id").alias("next_id"), "rank"), "rank").drop("rank")
    follows = stage(follows, "follows")
    begins = rows.join(follows, rows["id"].eqNullSafe(follows["next_id"]), "left").select(
        "to", "next_id",
        F.expr("substring(text, 1, half)").alias("begin"),
        F.xxhash64("text").alias("next_mark"),
    )
    if (most or 0) > 1:
        begins = begins.groupBy("to", "next_id").agg(
            F.min(F.struct("begin", "next_mark")).alias("first")
        )
        begins = begins.select("to", "next_id", "first.*")
    joined = rows.join(begins, rows["id"].eqNullSafe(begins["to"]), "left")
    new = F.expr(
        "concat(substring(text, 1, length(text) - length(text) div 2),"
        " substring(coalesce(begin, ''), 1, cast(length(text) div 2 AS int)))"
    )
    return joined.select(
        "id", "text", new.alias("edited"), F.xxhash64("text").alias("mark"),
        "next_id", "next_mark",
    )


def compare_edited(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of texts and edited texts, and their likeness to those and to the next."""
    listed, found = lexicon(docs, text), edited(docs, doc_id, text)
    if listed.limit(LEXICON + 1).count() <= LEXICON:
        # A column of its own, since a subquery can't stand inside of a lambda function.
        found, table = found.withColumn("table", _table(listed)), F.col("table")
        found = found.withColumns({
            "fingerprint": fingerprint(F.col("text"), table),
            "edited_fingerprint": fingerprint(F.col("edited"), table),
        })
    else:
        found = _joined_fingerprints(found, listed)
    found = found.select(
        "id", "mark", "next_id", "next_mark",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
    )
    found = stage(found, "fingerprints")
    others = found.groupBy(F.col("id").alias("of"), F.col("mark").alias("of_mark")).agg(
        F.min("fingerprint").alias("next_fingerprint")
    )
    same = F.col("next_id").eqNullSafe(F.col("of")) & (F.col("next_mark") == F.col("of_mark"))
    return found.join(others, same, "left").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256", "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
    )

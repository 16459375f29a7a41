"""A training corpus from raw documents, in stages that are written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but
the last return the columns of ``docs``; columns they add meanwhile have names of their
own. A table without rows passes through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, jaccard, language, mixing, quality
from lectern.llm.bpe import RANKS
from lectern.llm.common import fold, if_small, read
from lectern.llm.quality import LEAST_QUALITY
from lectern.scratch import stage

#: Documents whose predicted language has at least this probability are kept.
LEAST_LANGUAGE = 0.5


def _same_columns(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[F.col(f"`{c}`") for c in docs.columns])


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality network accepts; it learns from labels of four folds."""
    learn = F.coalesce(fold(5) != 0, F.lit(False))
    net = quality.fit(docs, read(spark, sf_dir, "labels"), learn)
    scored = quality.score(docs, net, out="__quality")
    return _same_columns(scored.filter(F.col("__quality") >= LEAST_QUALITY), docs)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told.

    The score is a posterior over the learned languages and near 1 for all but the shortest
    texts: those without a letter go, and those too short to tell; a longer text in a
    language that was not learned stays, under the learned one that is nearest to it.
    """
    model = language.fit(docs, F.coalesce(fold(3) != 1, F.lit(False)))
    found = language.predict(docs, model, lang="__lang", score="__score")
    certain = (F.col("__lang") != language.UNDETERMINED) & (F.col("__score") >= LEAST_LANGUAGE)
    return _same_columns(found.filter(certain), docs)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of similar ones, that of the smallest id.

    Rows are numbered and written first, so that repeated ids stay apart.
    """
    rows = stage(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    groups = jaccard.join(rows, doc_id="__row").select(
        F.col("doc_id").alias("__row"), F.col("component_id").alias("__group")
    )
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "__row"))
    kept = rows.select("__row", "doc_id").join(groups, "__row").groupBy("__group").agg(
        first.alias("__first")
    )
    kept = stage(kept.select("__first.__row"), "kept")
    return _same_columns(rows.join(if_small(kept), "__row", "left_semi"), docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as the mix takes it."""
    mixed = mixing.mix(docs, prefix="__mix_")
    times = F.explode(F.array_repeat(F.lit(1), F.col("__mix_copies").cast("int")))
    return _same_columns(mixed.withColumn("__mix_copy", times), docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as packed token ids instead of texts, and a digest of what these decode to."""
    path = public_tokenizers.path(RANKS)
    encoded = bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    decoded = bpe.decode(encoded, path, decoded="__decoded")
    return decoded.withColumn("decoded_sha256", F.sha2("__decoded", 256)).drop("__decoded")


STAGES = [
    ("quality classifier", good_quality),
    ("language ID", known_language),
    ("near duplicates", without_near_duplicates),
    ("mixing", mixed_sources),
    ("byte-level BPE", token_ids),
]

#: A network, a model and hashed choices: SQL can't express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)

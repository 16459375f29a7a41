"""Language by multinomial naive Bayes over hashed character n-grams.

Texts are lower-cased; their n-grams of 1 to 3 code points are hashed into ``BUCKETS``.
The model is a matrix of log probabilities, languages by buckets, with add-one smoothing,
and the languages' log priors. It is broadcast in blocks of ``BLOCK`` languages, one as a
rule; where there are more, texts are scored block by block and the best one is kept. A
batch of texts is scored at once: the rows of the matrix at the n-grams' buckets are
summed per text.

A text that is null or has no letter is ``und`` with score 0. Otherwise the score is the
posterior probability of the predicted language. Ties go to the first language in order.
Without any row to learn from there are no languages, and every text is ``und``.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import append_columns, small_batches
from lectern.scratch import stage

BUCKETS = 1 << 15
ORDERS = 3
#: Documents per language that the model is fitted on, about (a hash picks them). A
#: language with fewer is used in full.
PER_LANGUAGE = 4_000
#: Languages of a block of the matrix, so that what is broadcast at a time is bounded.
BLOCK = 256
UNDETERMINED = "und"
# n-grams that are hashed and looked up at a time.
SLICE = 1 << 17


@dataclass(frozen=True)
class Block:
    languages: list[str]
    weights: np.ndarray  # buckets x languages
    prior: np.ndarray


@dataclass(frozen=True)
class Model:
    """``languages`` in order, dealt to ``blocks``."""

    languages: list[str]
    blocks: list[Block]


def _codes(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), "<u4")


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """The bucket of each n-gram of one order."""
    size = len(codes) - order + 1
    if size <= 0:
        return np.empty(0, np.int64)
    h = np.full(size, order, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(order):
            h = (h ^ codes[k : k + size]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
    return (h & np.uint64(BUCKETS - 1)).astype(np.int64)


def _slices(codes: np.ndarray):
    """Pieces of a text, each followed by what its last n-grams need of the next one."""
    for at in range(0, max(len(codes), 1), SLICE):
        yield codes[at : at + SLICE + ORDERS - 1], min(SLICE, len(codes) - at)


def _grams(codes: np.ndarray) -> np.ndarray:
    """The buckets of all n-grams of a text of any length."""
    found = [
        _buckets(piece, n)[:own] for piece, own in _slices(codes) for n in range(1, ORDERS + 1)
    ]
    return np.concatenate(found)


def fit(
    docs: DataFrame,
    learn: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = PER_LANGUAGE,
) -> Model:
    """Fit on the rows where ``learn`` holds and the language is not null.

    The number of rows per language is counted first; a hash of the id then picks about
    ``per_language`` of each. N-grams are counted per task before they are shuffled.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.filter(learn & docs[lang].isNotNull()).select(
        docs[lang].cast("string").alias("lang"),
        docs[text].alias("text"),
        F.pmod(F.xxhash64(docs[doc_id]), F.lit(1 << 30)).alias("place"),
    )
    counts = rows.groupBy("lang").count().orderBy("lang").collect()  # a row per language
    languages = [r["lang"] for r in counts]
    if not languages:
        return Model([], [])
    share = spark.createDataFrame(
        [(r["lang"], min(1.0, per_language / r["count"])) for r in counts],
        "lang string, share double",
    )
    chosen = rows.join(F.broadcast(share), "lang").filter(
        F.col("place") <= F.col("share") * (1 << 30)
    )
    index = {name: i for i, name in enumerate(languages)}

    def count(batches):
        totals = {}
        for batch in batches:
            for name, value in zip(
                batch.column("lang").to_pylist(), batch.column("text").to_pylist()
            ):
                own = totals.setdefault(index[name], np.zeros(BUCKETS, np.int64))
                own += np.bincount(_grams(_codes(value)), minlength=BUCKETS)
        for i, own in totals.items():
            at = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), i)), pa.array(at), pa.array(own[at])],
                names=["i", "bucket", "n"],
            )

    found = (
        chosen.select("lang", "text")
        .mapInArrow(count, "i long, bucket long, n long")
        .groupBy("i", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    found = stage(found, "grams") if len(languages) > BLOCK else found
    total, blocks = sum(r["count"] for r in counts), []
    for first in range(0, len(languages), BLOCK):
        own = counts[first : first + BLOCK]
        part = found.filter(F.col("i").between(first, first + len(own) - 1)).toPandas()
        table = np.ones((BUCKETS, len(own)))  # and at most so many rows were received
        at = part["bucket"].to_numpy(int), part["i"].to_numpy(int) - first
        table[at] += part["n"].to_numpy(float)
        blocks.append(Block(
            languages[first : first + BLOCK],
            np.log(table / table.sum(axis=0)).astype(np.float32),
            np.log(np.array([r["count"] for r in own], float) / total),
        ))
    return Model(languages, blocks)


def score_texts(
    model: Block, texts: list[str | None]
) -> tuple[list[str | None], list[float | None], list[float | None]]:
    """The best language of a block, its log score, and what all of the block have beside it.

    The last is the sum of the probabilities of all, where that of the best one is 1. Texts
    that are not scored have nulls.
    """
    names, tops, masses = ([None] * len(texts) for _ in range(3))
    asked = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
    sums = np.zeros((len(asked), len(model.languages)))
    waiting: list[np.ndarray] = []
    rows: list[int] = []

    def flush():
        if rows:
            starts = np.cumsum([0, *map(len, waiting)])[:-1]
            found = model.weights[np.concatenate(waiting)]
            np.add.at(sums, rows, np.add.reduceat(found, starts, axis=0, dtype=float))
            waiting.clear()
            rows.clear()

    for row, i in enumerate(asked):
        for piece, own in _slices(_codes(texts[i])):
            grams = [_buckets(piece, n)[:own] for n in range(1, ORDERS + 1)]
            waiting.append(np.concatenate(grams))
            rows.append(row)
            if sum(map(len, waiting)) >= SLICE:
                flush()
    flush()
    sums += model.prior
    best = sums.argmax(axis=1) if len(asked) else []
    for row, i in enumerate(asked):
        names[i] = model.languages[best[row]]
        tops[i] = float(sums[row, best[row]])
        masses[i] = float(np.exp(sums[row] - tops[i]).sum())
    return names, tops, masses


def predict(
    docs: DataFrame,
    model: Model,
    text: str = "text",
    lang: str = "lang_pred",
    score: str = "score",
) -> DataFrame:
    """Add the predicted language and its score to ``docs``."""
    made, found = docs, []
    for number, block in enumerate(model.blocks):
        names = [f"__{what}{number}" for what in ("lang", "top", "mass")]
        made = _with_block(made, block, text, names)
        found.append(F.struct(
            F.col(names[1]).alias("top"), F.lit(-number).alias("first"),
            F.col(names[0]).alias("lang"), F.col(names[2]).alias("mass"),
        ))
    outs = {lang.lower(), score.lower()}
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in outs]
    nothing = F.lit(UNDETERMINED).alias(lang), F.lit(0.0).alias(score)
    if not found:
        return docs.select(*kept, *nothing)
    best = found[0] if len(found) == 1 else F.greatest(*found)
    beside = sum(f["mass"] * F.exp(f["top"] - best["top"]) for f in found)
    return made.select(
        *kept,
        F.coalesce(best["lang"], F.lit(UNDETERMINED)).alias(lang),
        F.coalesce(1.0 / beside, F.lit(0.0)).alias(score),
    )


def _with_block(docs: DataFrame, block: Block, text: str, names: list[str]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def make():
        def run(texts):
            langs, tops, masses = score_texts(shared.value, texts.to_pylist())
            return [pa.array(langs, pa.string()), pa.array(tops, pa.float64()),
                    pa.array(masses, pa.float64())]

        return run

    kinds = (T.StringType(), T.DoubleType(), T.DoubleType())
    return append_columns(docs, [text], [T.StructField(*f) for f in zip(names, kinds)], make)

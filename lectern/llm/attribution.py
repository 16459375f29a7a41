"""Token counts of a document's fields and sections, by the tokens' character spans.

A document, the concatenation of its text ``fields``, is encoded once, as a whole. Its
sections are the lines of each field (a line ends after its line feed, or with its field).
The tokens' lengths in bytes give their spans in characters; a token that is a part of a
character spans that character. Sorted spans are then joined to the sorted sections.

A token that crosses a boundary goes, whole, to the section that has most of its
characters, and to the earlier one where two have as many. So the counts of a document's
sections add up to its number of tokens. ``n_crossing`` is how many of a section's tokens
reach into another one.

Every field has a section: a null or empty field has one of no characters and no tokens.
Repeated rows give their sections each. Extra columns are not used.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import small_batches

SCHEMA = (
    "doc_id long, field string, section int, first_char long, end_char long,"
    " n_tokens long, n_crossing long"
)


def load(ranks_path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a rank file, and each token's number of bytes."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return encoding(ranks, pattern)


def encoding(ranks: dict[bytes, int], pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        sizes[rank] = len(token)
    own = tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
    )
    return own, sizes


def spans(raw: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end character of each token, from the tokens' ``sizes`` in bytes."""
    leads = np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)
    ends = np.cumsum(sizes)
    return leads[ends - sizes] - 1, leads[ends - 1]


def attribute(first: np.ndarray, end: np.ndarray, limits: np.ndarray) -> tuple:
    """Tokens and crossing tokens per section; ``limits`` are the sections' ends, rising.

    Sections follow each other without gaps from 0, so section s starts where s - 1 ends.
    """
    n = len(limits)
    owner = np.searchsorted(limits, first, side="right")
    last = np.searchsorted(limits, end - 1, side="right")
    crossing = np.flatnonzero(owner != last)
    for t in crossing:
        cuts = np.concatenate([[first[t]], limits[owner[t] : last[t]], [end[t]]])
        owner[t] += np.diff(cuts).argmax()  # the first of the largest
    return np.bincount(owner, minlength=n), np.bincount(owner[crossing], minlength=n)


def _lines(texts: Sequence[str]) -> tuple[list[int], list[int], np.ndarray]:
    """Field number, section number and end of each section of a document."""
    fields, sections, limits, base = [], [], [], 0
    for f, text in enumerate(texts):
        found, at = [], text.find("\n")
        while at >= 0:
            found.append(at + 1)
            at = text.find("\n", at + 1)
        if not found or found[-1] < len(text):
            found.append(len(text))
        fields += [f] * len(found)
        sections += range(len(found))
        limits += [base + end for end in found]
        base += len(text)
    return fields, sections, np.array(limits)


def token_counts(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    doc_id: str = "doc_id",
    fields: Sequence[str] = ("text",),
) -> DataFrame:
    """A row per section: doc_id, field, section, first_char, end_char and token counts."""
    spark = docs.sparkSession
    small_batches(spark)
    with open(ranks_path, "rb") as lines:
        vocabulary = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    shared = spark.sparkContext.broadcast(vocabulary)  # as large as the vocabulary
    names = list(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, sizes = encoding(shared.value, pattern)
        for batch in batches:
            ids, field, section, first, end, tokens, crossing = ([] for _ in range(7))
            columns = [batch.column(i + 1).to_pylist() for i in range(len(names))]
            for key, *texts in zip(batch.column(0).to_pylist(), *columns):
                texts = [t or "" for t in texts]
                of, number, limits = _lines(texts)
                whole = "".join(texts)
                found = np.array(own.encode_ordinary(whole), np.int64)
                if len(found):
                    counts = attribute(*spans(whole.encode(), sizes[found]), limits)
                else:
                    counts = np.zeros((2, len(limits)), np.int64)
                ids += [key] * len(of)
                field += [names[f] for f in of]
                section += number
                first.append(np.concatenate([[0], limits[:-1]]))
                end.append(limits)
                tokens.append(counts[0])
                crossing.append(counts[1])
            whole_columns = [
                pa.array(np.concatenate(c) if c else [], pa.int64())
                for c in (first, end, tokens, crossing)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(field, pa.string()),
                    pa.array(section, pa.int32()),
                    *whole_columns,
                ],
                names=[c.split()[0] for c in SCHEMA.split(", ")],
            )

    rows = docs.select(F.col(doc_id).cast("long"), *[F.col(f"`{f}`") for f in names])
    return rows.mapInArrow(run, SCHEMA)

"""Byte-level BPE by a sentencepiece model that is written straight from the vocabulary.

A rank file (token bytes and rank) becomes a sentencepiece BPE model without training:
each token is one piece, its bytes mapped to printable characters, its score the
negative rank, so that the merge sentencepiece prefers is the one of lowest rank. The
normaliser is the identity and no prefix is added. Text is cut into pre-tokens by the
vocabulary's pattern; each is encoded on its own. Decoding maps pieces back to bytes.

Null and empty texts have no tokens. Repeated rows are encoded each. Columns of the
input that are named like an output are replaced.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as spm

from lectern.llm.common import append_columns

#: The rank file that the queries and the pipeline use, of those in the tokenizer folder.
RANKS = "byte_bpe_50k.tiktoken"
# Encoded pre-tokens that a worker remembers.
REMEMBERED = 200_000
UNKNOWN = "<unk>"


def read_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file, in the order of their ranks, which have no gaps."""
    with open(path, "rb") as lines:
        ranks = {int(r): base64.b64decode(t) for t, r in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("the ranks have gaps")
    return [ranks[i] for i in range(len(ranks))]


def byte_letters() -> list[str]:
    """A printable character for each byte: itself where it is one, else one from 256 up."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letters[b] for b in range(256)]


def model_bytes(tokens: list[bytes]) -> bytes:
    """The serialised sentencepiece model whose piece ids are the ranks."""
    letters = byte_letters()
    model = spm.ModelProto()
    for rank, token in enumerate(tokens):
        piece = model.pieces.add()
        piece.piece = "".join(letters[b] for b in token)
        piece.score = -float(rank)
    unknown = model.pieces.add()
    unknown.piece, unknown.score = UNKNOWN, 0.0
    unknown.type = spm.ModelProto.SentencePiece.UNKNOWN
    spec = model.trainer_spec
    spec.model_type = spm.TrainerSpec.BPE
    spec.vocab_size = len(model.pieces)
    spec.unk_id, spec.bos_id, spec.eos_id, spec.pad_id = len(tokens), -1, -1, -1
    spec.unk_piece = UNKNOWN
    rules = model.normalizer_spec
    rules.name = "identity"
    rules.add_dummy_prefix = False
    rules.remove_extra_whitespaces = False
    rules.escape_whitespaces = False
    return model.SerializeToString()


class Encoded(dict):
    """Packed ids of pre-tokens, encoded when first asked for."""

    def __init__(self, model: bytes) -> None:
        super().__init__()
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.letters = {b: c for b, c in enumerate(byte_letters())}

    def __missing__(self, word: str) -> bytes:
        mapped = word.encode("utf-8", "replace").decode("latin-1").translate(self.letters)
        whole = self.pieces.piece_to_id(mapped)
        known = whole != self.pieces.unk_id()
        ids = [whole] if known else self.pieces.encode(mapped)
        packed = self[word] = np.array(ids, "<u4").tobytes()
        return packed


def token_bytes(model: bytes) -> list[bytes]:
    """The bytes of every piece, by the inverse of the mapping to characters."""
    back = {c: b for b, c in enumerate(byte_letters())}
    pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
    ids = range(pieces.get_piece_size() - 1)
    return [bytes(back[c] for c in pieces.id_to_piece(i)) for i in ids]


def _model(spark: SparkSession, ranks_path: str):
    return spark.sparkContext.broadcast(model_bytes(read_ranks(ranks_path)))


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    n_tokens: str = "n_tokens",
) -> DataFrame:
    """Add ``ids`` (token ids, packed as little-endian unsigned 32-bit) and their number.

    The model's size is that of the vocabulary, so it is broadcast.
    """
    model = _model(docs.sparkSession, ranks_path)

    def make():
        cut, known = regex.compile(pattern), Encoded(model.value)

        def run(texts):
            packed = []
            for value in texts.to_pylist():
                if len(known) > REMEMBERED:
                    known.clear()
                packed.append(b"".join(map(known.__getitem__, cut.findall(value or ""))))
            return [
                pa.array(packed, pa.binary()),
                pa.array([len(p) // 4 for p in packed], pa.int64()),
            ]

        return run

    fields = [T.StructField(ids, T.BinaryType()), T.StructField(n_tokens, T.LongType())]
    return append_columns(docs, [text], fields, make)


def decode(
    encoded: DataFrame, ranks_path: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """Add ``decoded``, the bytes that packed ``ids`` stand for; null ids give none."""
    model = _model(encoded.sparkSession, ranks_path)

    def make():
        table = token_bytes(model.value)

        def run(packed):
            texts = [
                b"".join(map(table.__getitem__, np.frombuffer(p or b"", "<u4").tolist()))
                for p in packed.to_pylist()
            ]
            return [pa.array(texts, pa.binary())]

        return run

    return append_columns(encoded, [ids], [T.StructField(decoded, T.BinaryType())], make)

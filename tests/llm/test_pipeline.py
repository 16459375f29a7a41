"""The registered queries and the pipeline, against brute force over the smallest tables."""

import base64
import collections
import pathlib
import struct
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from lectern.llm import queries as llm
from test_operators import SCHEMA, brute_components, brute_targets, odd_rows, words_of

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet").toPandas()


def run(spark, name):
    return entry.queries()[name](spark, SF_DIR).toPandas()


def test_all_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "language ID", "near duplicates", "mixing", "byte-level BPE",
    ]


def test_tool_calls_equal_their_sql(spark):
    con = duckdb.connect()
    con.execute(
        f"CREATE VIEW conversations AS SELECT * FROM '{SF_DIR}/conversations.parquet'"
    )
    want = con.execute(llm.oracle_sql()["op1_tool_calls"])
    names = [d[0] for d in want.description]
    got = entry.queries()["op1_tool_calls"](spark, SF_DIR).select(*names).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want.fetchall()))


def test_tool_calls_lose_no_turn(spark, tmp_path):
    turns = [
        (1, 1, "user", "a"), (1, 2, "assistant", "b"), (None, 4, "assistant", "c"),
        (1, None, "assistant", "d"), (1, 5, "tool", "e"), (None, None, None, "f"),
    ]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    table.write.parquet(f"{tmp_path}/conversations.parquet")
    got = entry.queries()["op1_tool_calls"](spark, str(tmp_path)).collect()
    assert all(any(f'"{t[3]}"' in r.message for r in got) for t in turns)
    assert collections.Counter(r.status for r in got) == {
        "linked": 1, "no call": 2, "other role": 2
    }


def test_jaccard_query(spark, docs):
    got = run(spark, "op3_jaccard_join")
    want = brute_components(list(zip(docs.doc_id.tolist(), docs.text.tolist())))
    columns = ["doc_id", "n_shingles", "component_id"]
    assert sorted(got[columns].itertuples(index=False, name=None)) == sorted(want)


def test_mixing_query(spark, docs):
    got = run(spark, "op4_pivotal_mixing").merge(docs[["doc_id", "source", "text"]], on="doc_id")
    assert len(got) == len(docs)
    assert (got["size"] == got.text.map(lambda t: len(words_of(t)))).all()
    assert (got.taken <= 3 * got["size"]).all()
    sizes = got.groupby("source")["size"].sum().to_dict()
    want = brute_targets(sizes)
    taken = got.groupby("source").taken.sum()
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(200, 0.1 * target)


def test_sharding_query(spark, docs):
    got = run(spark, "op5_bounded_ring").merge(docs[["doc_id", "text"]], on="doc_id")
    assert (got["size"] == got.text.map(lambda t: len(t.encode()) + 1)).all()
    assert (got.text_crc32 == got.text.map(lambda t: zlib.crc32(t.encode()))).all()
    sizes = got.groupby("shard").size()
    assert len(sizes) == 8 and sizes.max() - sizes.min() <= 1
    for _, own in got.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_token_counts_query(spark, docs):
    got = run(spark, "op2_token_attribution").groupby("doc_id").n_tokens.sum()
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    own = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    for key, text in zip(docs.doc_id, docs.text):
        assert got[key] == len(own.encode_ordinary(text))


@pytest.mark.parametrize("name, fold", [("op7_quality_cnn", (5, 0)), ("op9_language_nb", (3, 1))])
def test_classifiers_hold_out_their_folds(spark, docs, name, fold):
    got = run(spark, name)
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    n, rest = fold
    want = got.doc_id.map(lambda i: zlib.crc32(str(i).encode()) % n == rest)
    assert (got.held_out == want).all()
    held = got[got.held_out].merge(docs, on="doc_id")
    if name.startswith("op9"):
        assert (held.lang_pred == held.lang).mean() > 0.95
    else:
        labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas()
        held = held.merge(labels, on="doc_id")
        assert ((held.predicted == 1) == (held.quality == 1)).mean() > 0.6


def test_near_duplicate_query(spark):
    got = run(spark, "op10_e8_lattice").set_index("vec_id")
    table = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").toPandas()
    x = np.array([np.array(v, float) for v in table.embedding])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    links = (x @ x.T >= 0.9).sum(axis=1) - 1
    found = got.loc[table.vec_id].n_links.to_numpy()
    assert (found <= links).all() and found.sum() >= 0.9 * links.sum()


def test_pipeline_by_its_parts(spark, docs):
    """Each stage against what its decisions should leave, on that stage's own input."""
    stages = dict(corpus_pipeline.STAGES)
    given = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = stages["quality classifier"](spark, given, SF_DIR)
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    clean = labels.filter("quality = 1").join(given, "doc_id", "left_semi")
    kept = clean.join(good, "doc_id", "left_semi").count()
    assert kept >= 0.95 * clean.count() and good.columns == given.columns
    known = stages["language ID"](spark, given, SF_DIR)
    assert known.count() == given.count() and known.columns == given.columns
    single = stages["near duplicates"](spark, given, SF_DIR)
    rows = brute_components(list(zip(docs.doc_id.tolist(), docs.text.tolist())))
    assert sorted(r.doc_id for r in single.collect()) == sorted({c for _, _, c in rows})
    mixed = stages["mixing"](spark, given, SF_DIR).collect()
    sizes, taken = collections.Counter(), collections.Counter()
    for source, text in zip(docs.source, docs.text):
        sizes[source] += len(words_of(text))
    for r in mixed:
        taken[r.source] += len(words_of(r.text))
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= max(200, 0.1 * target)
    last = stages["byte-level BPE"](spark, given, SF_DIR).filter("doc_id = 3").collect()[0]
    assert last.n_tokens == len(bytes(last.ids)) // 4 == len(struct.unpack(f"<{last.n_tokens}I", last.ids))


def test_every_stage_takes_odd_rows_and_no_rows(spark):
    odd = spark.createDataFrame(odd_rows(), SCHEMA).withColumn("target", F.lit("clash"))
    for name, function in corpus_pipeline.STAGES:
        for table in (odd, odd.limit(0)):
            found = function(spark, table, SF_DIR)
            assert found.count() <= 3 * table.count()
            if name != "byte-level BPE":
                assert found.columns == table.columns

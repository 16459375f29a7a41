"""Ranked search, line de-duplication and the filter audit against brute force and SQL."""

import hashlib
import math
import pathlib
import re
from collections import Counter
from fractions import Fraction
from itertools import permutations

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lectern.llm import audit, linededup, search

SF_DIR = "/root/testdata/sf0.001"
LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, lang string, N_LINES int, part string, score string"
LONG = "\n".join(f"line {i % 700} of this long text" for i in range(20_000))
COMMON = "  A line that nearly all of them have "
TEXTS = [
    (3, f"{COMMON}\nfirst\n\tA LINE that nearly all of them have\nÉTÉ à la plage,  no"),
    (1, f"{COMMON}\nshort\nshort"),
    (2, "été à la plage,  no\nÉté à la plage,  no\n12345678 0"),
    (4, "12345678 0\n\n\x0b12345678 0\x0c\r\n"),
    (5, ""),
    (6, None),
    (7, LONG),
    (8, LONG + "\nline 5 of this long text"),
    (9, f"{COMMON}\n" * 40),
    (9, f"{COMMON}\n" * 40),  # a repeated row
    (1, "another text of the same id\n" + COMMON),
    (None, f"no id here\n{COMMON}"),
    (None, None),
    (10, "no id here\n北京 北京 东西 南北 中 a\n北京 北京 东西 南北 中 A"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "fr", None)[n % 3], n, "x", "y") for n, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def after(i, other):
    """Whether id ``i`` comes after ``other``; missing ids come last."""
    return (i is None, i or 0) > (other is None, other or 0)


# Line de-duplication


def key_of(line):
    return line.strip(" \t\n\x0b\f\r").translate(LOWER)


def kept_lines(rows):
    keepers = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            key = key_of(line)
            if len(key) >= 10 and (key not in keepers or after(keepers[key], i)):
                keepers[key] = i
    found = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key_of(x)) < 10 or keepers[key_of(x)] == i]
        found.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return found


def by_value(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("hot_lines, broadcast_bytes", [(1, 1 << 20), (10**9, 0)])
def test_lines_by_brute_force(docs, hot_lines, broadcast_bytes):
    """All keys hot, then none: the plan changes and the result doesn't."""
    marked = linededup.keep_bitmaps(
        docs, hot_share=1 << 14, hot_lines=hot_lines, broadcast_bytes=broadcast_bytes
    )
    assert sum(c.lower() == "n_lines" for c in marked.columns) == 1 and "score" in marked.columns
    text = linededup.kept_text(F.col("text"), F.col("keep"))
    got = marked.select("doc_id", "n_lines", "n_dropped", text).collect()
    assert by_value(map(tuple, got)) == by_value(kept_lines(TEXTS))


def test_bitmaps_are_runs_of_kept_lines(docs):
    for row in linededup.keep_bitmaps(docs).collect():
        runs = [(r["first"], r["n"]) for r in row.keep]
        assert all(n > 0 for _, n in runs)
        assert all(a + n < b for (a, n), (b, _) in zip(runs, runs[1:]))
        assert sum(n for _, n in runs) == row.n_lines - row.n_dropped


def test_no_lines_of_an_empty_table(empty):
    assert linededup.keep_bitmaps(empty).count() == 0


def test_line_dedup_stays_in_the_jvm(docs, capsys):
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("of"), "text")
    linededup._dropped(linededup._keyed(rows, 10), []).explain()
    linededup.keep_bitmaps(docs, broadcast_bytes=0).explain()
    plan = capsys.readouterr().out
    # One exchange by ranges of the hashes, one sort, and no other exchange for the window.
    assert plan.count("rangepartitioning(h1") == 1 and "hashpartitioning(h1" not in plan
    assert "Python" not in plan and "InArrow" not in plan


# Filter audit


def failures(rows):
    found = []
    for i, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found.append({
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": any(after(i, k) and (other or "") == text for k, other, _ in rows),
        })
    return found


def audited(rows, good, toxic):
    fails = failures(rows)
    got = []
    for part in {p or "" for *_, p in rows}:
        own = [(i, f) for (i, _, p), f in zip(rows, fails) if (p or "") == part]
        totals, steps = Counter(), []
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [i for i, x in left if x[f]]
                left = [(i, x) for i, x in left if not x[f]]
                redundant = sum(x[f] for _, x in own) - len(gone)
                only = sum(x[f] and sum(x.values()) == 1 for _, x in own)
                totals[f] += len(gone)
                steps.append((part, "".join(order), step, len(left), len(gone), redundant, only,
                              sum(i in good for i in gone), sum(i in toxic for i in gone)))
        got += [(*s, totals[s[1][s[2] - 1]]) for s in steps]
    return sorted(got)


def test_audit_by_brute_force(spark, docs, empty):
    words = " ".join(f"word{i}" for i in range(120))
    rows = [(r.doc_id, r.text, r.lang) for r in docs.select("doc_id", "text", "lang").collect()]
    rows += [(i, words, "en") for i in range(20, 30)]
    rows += [(i, words + " #" * (i % 2) + " ABCDEFGHIJ" * (i % 3 * 8), "de") for i in range(30, 50)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(
        [(i, i % 2, int(i % 3 == 0)) for i in range(40)]
        + [(20, 1, 0), (21, None, None), (None, 1, 1), (99, 1, 1)],
        "doc_id long, quality int, toxic int",
    )
    good = {i for i in range(40) if i % 2} | {20}
    want = audited(rows, good, {i for i in range(40) if i % 3 == 0})
    assert sorted(map(tuple, audit.audit(table, labels).collect())) == want
    assert audit.audit(empty, labels).count() == 0
    alone = audit.audit(table, labels.limit(0))
    assert alone.agg(F.sum("good_lost") + F.sum("toxic_lost")).first()[0] == 0


def test_shapley_values_by_their_definition():
    rng = np.random.default_rng(5)
    for filters in range(1, 6):
        values = [0, *rng.integers(0, 1000, 2**filters - 1).tolist()]
        want = [Fraction(0)] * filters
        orders = list(permutations(range(filters)))
        for order in orders:
            before = 0
            for i in order:
                want[i] += Fraction(values[before | 1 << i] - values[before], len(orders))
                before |= 1 << i
        assert audit.shapley(values, filters) == want


# Ranked search


def terms_of(text):
    pattern = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
    return re.findall(pattern, (text or "").translate(LOWER))


def ranked(rows, items, top):
    docs = [(i, Counter(terms_of(t))) for i, t in rows]
    docs = [(i, c) for i, c in docs if c]
    n_docs, total = len(docs), sum(c.total() for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    found = []
    for item, terms in items.items():
        scores = []
        for i, c in docs:
            m = 75 + (25 * c.total() * n_docs) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in terms if t in c
            )
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        found += [(item, r, s[3], -s[0]) for r, s in enumerate(sorted(scores)[:top], 1)]
    return sorted(found, key=repr)


def corpus():
    """Documents of a skewed vocabulary, with copies and ties."""
    rng = np.random.default_rng(11)
    words = [f"w{int(k)}" for k in rng.zipf(1.3, 6000) % 400]
    texts = [" ".join(words[i * 15 : i * 15 + 5 + i % 30]) for i in range(300)]
    return list(enumerate(texts + texts[:40])) + [(7, "w1 W2-w3 été"), (None, "w1 w2")]


ITEMS = [
    (1, "w1 w2, w3 W3 w250"), (2, "été Été w17"), (2, "and w2"), (3, ""), (4, None),
    (5, "nowhere"), (6, " ".join(f"w{i}" for i in range(400))), (None, "w1"),
]


@pytest.mark.parametrize("block, bundle, pass_bytes", [(8192, 1024, 1 << 24), (9, 2, 60)])
def test_search_by_brute_force(spark, docs, empty, monkeypatch, block, bundle, pass_bytes):
    """Small blocks, bundles and passes: documents are left out on the way, none is lost."""
    rows = corpus() + [(i, t) for i, t in TEXTS]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    wanted = {}
    for item, text in ITEMS:
        if item is not None:
            wanted[item] = wanted.get(item, []) + terms_of(text)
    monkeypatch.setattr(search, "BLOCK_ROWS", block)
    monkeypatch.setattr(search, "BUNDLE", bundle)
    monkeypatch.setattr(search, "PASS_BYTES", pass_bytes)
    got = [tuple(r) for r in search.search(table, items, top=4).collect()]
    assert sorted(got, key=repr) == ranked(rows, wanted, 4)
    assert search.search(empty, items).count() == 0
    assert search.search(docs, items.limit(0)).count() == 0


def test_owners_hold_whole_terms_rare_ones_first():
    df = np.array([5, 1, 1000, 1, 40, 300, 2])
    owner = search.owners_of(df, 3, 4)
    assert owner.max() == 2 and all(owner[np.argsort(df)] == np.sort(owner))
    assert search.owners_of(np.zeros(0, np.int64)).size == 0


def test_large_sums_are_exact():
    docs, of = np.array([0, 0, 1], np.int32), np.array([0, 1, 1], np.int32)
    gains = np.array([2**52, 2**53 + 1, 3], np.int64)
    found, sums = search._added(np.array([0, 1]), np.array([1, 1]), of, docs, gains)
    assert found.tolist() == [0, 1] and sums.tolist() == [2**52 + 2**53 + 1, 3]


# Registered queries


@pytest.mark.skipif(not pathlib.Path(SF_DIR).exists(), reason="no test tables")
@pytest.mark.parametrize("name", ["op11_term_pipeline", "op12_line_dedup", "op13_filter_audit"])
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for path in pathlib.Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    want = con.execute(entry.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = entry.queries()[name](spark, SF_DIR)
    assert sorted(got.columns) == sorted(names)
    rows = sorted(map(tuple, got.select(*names).collect()))
    assert rows == sorted(want.fetchall()) and len(rows) > 100


def test_digest_of_a_text_without_lines(spark, docs):
    marked = linededup.keep_bitmaps(docs.filter("doc_id = 5"))
    text = linededup.kept_text(F.col("text"), F.col("keep"))
    assert marked.select(F.sha2(text, 256)).first()[0] == hashlib.sha256(b"").hexdigest()

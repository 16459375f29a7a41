"""The operators of llm against brute force, and on rows that are out of the ordinary."""

import base64
import collections
import hashlib
import itertools
import json
import re
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F

from lectern.llm import (
    attribution,
    bpe,
    common,
    imatch,
    jaccard,
    language,
    lattice,
    mixing,
    quality,
    sharding,
    toolcalls,
)

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, size int"
LONG = " ".join(f"word{i % 977} line{i}" for i in range(20_000))
TEXTS = [
    "The quick brown fox jumps over the lazy dog and runs away.",
    "The quick brown fox jumps over the lazy dog and runs away.",
    "",
    None,
    "one",
    " \t\n ",
    "l'été ça va où\n\n  très bien 北京 😀\r\nfin",
    LONG,
    "12345 67890 !!! ???",
    "Und die Katze sitzt auf dem Dach, nicht wahr?",
]


def odd_rows():
    rows = []
    for i, text in enumerate(TEXTS):
        source = None if i % 4 == 3 else f"s{i % 3}"
        rows.append((i, text, "en" if i < 6 else None, source, 0, "x", i))
    rows.append((0, TEXTS[0], "en", "s0", 0, "x", 1))  # a repeated row
    rows.append((None, "no id here", None, "s1", None, None, None))
    rows.append((None, None, None, None, None, None, None))
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(odd_rows(), SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def encoding():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def words_of(text):
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


# Byte-level BPE


def test_bpe_equals_tiktoken_and_decodes(odd, empty, encoding):
    got = bpe.decode(bpe.encode(odd, PATH, public_tokenizers.PATTERN), PATH)
    assert "score" in got.columns and got.count() == odd.count()
    for row in got.collect():
        ids = encoding.encode_ordinary(row.text or "")
        assert bytes(row.ids) == struct.pack(f"<{len(ids)}I", *ids)
        assert row.n_tokens == len(ids)
        assert bytes(row.decoded) == (row.text or "").encode()
    assert bpe.encode(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_bpe_replaces_clashing_columns(odd):
    clash = odd.withColumn("ids", F.lit("old")).withColumn("N_TOKENS", F.lit(-1))
    got = bpe.encode(clash, PATH, public_tokenizers.PATTERN)
    assert sum(c.lower() == "n_tokens" for c in got.columns) == 1
    assert got.filter("n_tokens < 0").count() == 0


# Token counts


def test_token_counts_by_brute_force(odd, empty, encoding):
    two = odd.select("doc_id", "text", F.col("source"))
    got = collections.defaultdict(list)
    rows = attribution.token_counts(
        two, PATH, public_tokenizers.PATTERN, fields=["text", "source"]
    ).collect()
    for r in rows:
        got[r.doc_id].append(r)
    done = set()
    for row in odd.collect():
        if row.doc_id is None or row.doc_id in (0, 7) or row.doc_id in done:
            continue
        done.add(row.doc_id)
        whole = (row.text or "") + (row.source or "")
        own = sorted(got[row.doc_id], key=lambda r: (r.field != "text", r.section))
        raw, at, counts = whole.encode(), 0, [0] * len(own)
        for token in encoding.encode_ordinary(whole):
            size = len(encoding.decode_single_token_bytes(token))
            # The characters whose bytes the token touches.
            touched = {
                sum(1 for b in raw[: k + 1] if b & 0xC0 != 0x80) - 1 for k in range(at, at + size)
            }
            best = max(
                range(len(own)),
                key=lambda s: (
                    sum(own[s].first_char <= c < own[s].end_char for c in touched), -s
                ),
            )
            counts[best] += 1
            at += size
        assert [r.n_tokens for r in own] == counts
        assert own[-1].end_char == len(whole)
    assert sum(r.n_tokens for r in got[0]) == 2 * len(encoding.encode_ordinary(TEXTS[0] + "s0"))
    assert attribution.token_counts(empty, PATH, public_tokenizers.PATTERN).count() == 0


def test_a_crossing_token_goes_to_the_section_with_most_of_it():
    first, end = np.array([0, 2, 5]), np.array([2, 5, 6])
    counts, crossing = attribution.attribute(first, end, np.array([3, 6]))
    assert counts.tolist() == [1, 2] and crossing.tolist() == [0, 1]
    counts, _ = attribution.attribute(np.array([0]), np.array([2]), np.array([1, 2]))
    assert counts.tolist() == [1, 0]


# Language


def test_language(spark, odd, empty):
    sentences = {
        "en": "the cat sat on the mat with the dog and the bird was there",
        "de": "die katze und der hund sind nicht auf dem dach mit dem vogel",
    }
    rows = [
        (i, " ".join(sentences[lang].split()[k:]), lang)
        for i, (lang, k) in enumerate(itertools.product(sentences, range(8)))
    ]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(known, F.lit(True))
    found = language.predict(odd, model).collect()
    assert len(found) == odd.count()
    by_text = {r.text: r for r in found}
    assert by_text[TEXTS[0]].lang_pred == "en" and by_text[TEXTS[9]].lang_pred == "de"
    for text in ("", None, " \t\n ", "12345 67890 !!! ???"):
        assert (by_text[text].lang_pred, by_text[text].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in found)
    nothing = language.fit(empty, F.lit(True))
    assert {r.lang_pred for r in language.predict(odd, nothing).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


def test_language_scores_are_multinomial_bayes(spark):
    rows = [(1, "abab", "x"), (2, "bcbc", "y"), (3, "abc", "x")]
    known = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(known, F.lit(True))
    counts = {lang: collections.Counter() for lang in "xy"}
    for _, text, lang in rows:
        counts[lang].update(language._grams(language._codes(text)).tolist())
    log = {"x": np.log(2 / 3), "y": np.log(1 / 3)}
    for lang, own in counts.items():
        total = sum(own.values()) + language.BUCKETS
        for gram in language._grams(language._codes("abcb")).tolist():
            log[lang] += np.log((own[gram] + 1) / total)
    want = 1 / (1 + np.exp(log["y"] - log["x"]))
    names, tops, masses = language.score_texts(model.blocks[0], ["abcb"])
    scores = [1 / m for m in masses]
    assert names == ["x" if want >= 0.5 else "y"]
    assert scores[0] == pytest.approx(max(want, 1 - want), abs=1e-5)


def test_long_texts_are_scored_in_slices():
    model = language.Block(["a", "b"], np.random.rand(language.BUCKETS, 2).astype("f4"), np.zeros(2))
    text = "xyz " * (language.SLICE // 3)
    sums = model.weights[language._grams(language._codes(text))].sum(axis=0, dtype=float)
    whole = sum(max(0, len(text) - n + 1) for n in (1, 2, 3))
    assert len(language._grams(language._codes(text))) == whole
    assert language.score_texts(model, [text])[0] == [model.languages[sums.argmax()]]


# Quality


def test_quality_learns_and_takes_odd_rows(spark, odd, empty):
    rng = np.random.default_rng(3)
    rows, marks = [], []
    for i in range(160):
        own = "".join(rng.choice(list("abcdefgh "), 300))
        rows.append((i, own if i % 2 else own.replace("a", "!!"), None))
        marks.append((i, i % 2, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(
        [*marks, (5, None, 0)], "doc_id long, quality int, toxic int"
    )
    net = quality.fit(docs, labels, F.col("doc_id") < 120)
    found = quality.score(docs.filter("doc_id >= 120"), net).collect()
    right = sum((r.score >= 0.5) == (r.doc_id % 2 == 1) for r in found)
    assert right >= 0.9 * len(found)
    scores = quality.score(odd, net, out="p")
    assert scores.filter("p BETWEEN 0 AND 1").count() == odd.count()
    assert scores.filter("doc_id = 0").select("p").distinct().count() == 1
    assert quality.score(empty, net).count() == 0
    constant = quality.fit(docs, labels.limit(0), F.lit(True))
    assert {r.score for r in quality.score(odd, constant).collect()} == {0.5}


def test_quality_scores_are_a_plain_convolution():
    net = quality._start()
    text = ("some plain text " * 40).encode()
    codes = quality._padded(text)
    size = len(codes) - quality.WIDTH + 1
    response = np.array(
        [
            sum(net.tables[k][codes[i + k]] for k in range(quality.WIDTH))
            for i in range(size)
        ]
    )
    chunks = [
        response[at : at + 2 * quality.STEP].max(axis=0)
        for at in range(0, size - quality.STEP, quality.STEP)
    ]
    logits = [
        np.maximum(np.maximum(c, 0) @ net.hidden + net.hidden_bias, 0) @ net.out for c in chunks
    ]
    want = 1 / (1 + np.exp(-np.mean(logits)))
    assert quality.score_texts(net, net.pairs(), [text])[0] == pytest.approx(want, abs=1e-4)


def test_quality_gradient():
    net = quality._start()
    texts = [quality._padded(b"hello world, hello"), quality._padded(b"x" * 400)]
    labels = np.array([1.0, 0.0])

    def loss():
        p = [
            quality._sigmoid(
                quality._logits(net, quality._chunks(quality._step_maxima(net.pairs(), t))).mean()
            )
            for t in texts
        ]
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - np.array(p)))

    grads = quality._gradients(net, texts, labels)
    for parameter, grad in zip(net.parameters(), grads):
        at = np.unravel_index(np.abs(grad).argmax(), grad.shape)
        old = parameter[at]
        parameter[at] = old + 1e-2
        up = loss()
        parameter[at] = old - 1e-2
        down = loss()
        parameter[at] = old
        assert (up - down) / 2e-2 == pytest.approx(grad[at], rel=0.15, abs=1e-4)


# Jaccard join


def brute_components(rows, percent=80):
    sets = []
    for _, text in rows:
        w = words_of(text)
        n = max(1, len(w) - 4)
        sets.append({tuple(w[k : k + 5]) for k in range(n)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in itertools.combinations(range(len(rows)), 2):
        common_size = len(sets[i] & sets[j])
        if common_size and 100 * common_size >= percent * len(sets[i] | sets[j]):
            p, q = find(i), find(j)
            root[max(p, q)] = min(p, q)
    low = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            low[find(i)] = min(key, low.get(find(i), key))
    return [
        (key, len(sets[i]), low.get(find(i)) if sets[i] else key)
        for i, (key, _) in enumerate(rows)
    ]


def near_copies(seed, n=160, shared=40):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = list(rng.choice(vocabulary, shared))
    base = list(rng.choice(vocabulary, 120))
    rows = []
    for i in range(n):
        kind = i % 4
        if kind == 0:  # edits of one text, at various distances
            text = list(base)
            for at in rng.integers(0, len(text), rng.integers(0, 6)):
                text[at] = str(rng.choice(vocabulary))
        elif kind == 1:  # a common passage and little else
            text = passage + list(rng.choice(vocabulary, rng.integers(0, 14)))
        elif kind == 2:  # ends of one text
            text = base[: rng.integers(80, 121)]
        else:
            text = list(rng.choice(vocabulary, rng.integers(1, 60)))
        rows.append((i * 3, " ".join(text).replace("w1 ", "W1\t")))
    return rows


@pytest.mark.parametrize("seed, rounds", [(1, 2), (2, 0)])
def test_jaccard_components_by_brute_force(spark, seed, rounds):
    rows = near_copies(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard.join(docs, rounds=rounds).collect()
    assert sorted(map(tuple, got)) == sorted(brute_components(rows))


@pytest.mark.parametrize("hubs, tight, cell", [(3, 16, 64), (3, 2, 8), (0, 2, 8)])
def test_jaccard_counts_every_link(spark, odd, empty, monkeypatch, hubs, tight, cell):
    for name, value in (("HUBS", hubs), ("TIGHT", tight), ("CELL", cell)):
        monkeypatch.setattr(jaccard, name, value)
    rng = np.random.default_rng(4)
    rows, base = near_copies(3), [f"v{i}" for i in range(500)]
    for i in range(60):  # near copies, most of which link with one another
        text = list(base)
        for at in rng.integers(0, len(text), rng.integers(0, 12)):
            text[at] = f"x{rng.integers(0, 50)}"
        rows += [(1000 + 2 * i, " ".join(text))] * (1 + i % 2)
    sets = [set(zip(*[t.lower().split()[k:] for k in range(5)])) for _, t in rows]
    sets = [s or {t} for s, (_, t) in zip(sets, rows)]
    want = collections.Counter()
    for i, j in itertools.permutations(range(len(rows)), 2):
        n = len(sets[i] & sets[j])
        want[rows[i][0]] += 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard.count_links(docs).collect()
    assert len(got) == len(rows) and sum(want.values()) > 5_000
    copies = collections.Counter(key for key, _ in rows)
    assert all(r.n_links == want[r.doc_id] / copies[r.doc_id] for r in got)
    assert sorted(r[:3] for r in got) == sorted(brute_components(rows))
    found = collections.Counter(r.n_links for r in jaccard.count_links(odd).collect())
    assert found == {2: 3, 0: odd.count() - 3}
    assert jaccard.count_links(empty).count() == 0


def test_cell_counts_links_within_or_between_blocks():
    bodies = [np.arange(k, k + 50, dtype=np.uint64) for k in (0, 1, 2, 30, 100, 101)]
    copies = np.array([1, 10, 100, 1_000, 10_000, 100_000])
    within = jaccard._cell_links(bodies, copies, None, 80)
    assert list(within) == [110, 101, 11, 0, 100_000, 10_000]
    side = np.array([True, True, False, False, True, False])
    between = jaccard._cell_links(bodies, copies, side, 80)
    assert list(between) == [100, 100, 11, 0, 100_000, 10_000]
    alone = jaccard._cell_links(bodies, copies, np.ones(6, bool), 80)
    assert list(alone) == [0] * 6


def test_jaccard_on_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]

    def shown(found):
        return sorted(tuple("" if v is None else v for v in r) for r in found if r[0] is not None)

    got = jaccard.join(odd).collect()
    assert len(got) == len(rows)
    assert shown(map(tuple, got)) == shown(brute_components(rows))
    assert jaccard.join(empty).count() == 0


def test_shingles_lower_only_ascii_and_split_only_at_ascii_spaces():
    one = jaccard.shingles("A b\tC\x0bd e f".encode())
    assert np.array_equal(one, jaccard.shingles(b"a B c d E F  "))
    assert len(jaccard.shingles("É b c d e".encode())) == 1
    assert not np.array_equal(
        jaccard.shingles("É b c d e".encode()), jaccard.shingles("é b c d e".encode())
    )
    assert len(jaccard.shingles("a b c d e".encode())) == 1
    many = [f"{a}{b}" * n for a in "abc" for b in "xyz" for n in (1, 9, 99)]
    assert len({int(jaccard.shingles(w.encode())[0]) for w in many}) == len(many)


# Mixing


def brute_targets(sizes, most=3.0):
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    order += [None] if None in sizes else []
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        rest = total - sum(most * sizes[s] for s in capped)
        rate = rest / sum(weight[s] for s in free) if free else 0
        over = {s for s in free if rate * weight[s] > most * sizes[s]}
        if not over:
            return {s: most * sizes[s] if s in capped else rate * weight[s] for s in order}
        capped |= over


def test_mixing_targets_and_taken_words(spark):
    rng = np.random.default_rng(8)
    rows = [
        (i, "w " * int(rng.integers(0, 80)), ["big", "b", "Z", None, "é"][min(int(rng.exponential(1)), 4)])
        for i in range(1500)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs.repartition(3)).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id, r.size, r.copies)
    assert sorted(map(key, got)) == sorted(map(key, again))
    sizes = collections.Counter()
    for r in got:
        assert r.size == len(words_of(r.text)) and 0 <= r.copies <= 3
        sizes[r.source] += r.size
    want = brute_targets(sizes)
    taken = collections.Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        taken[r.source] += r.copies * r.size
    for s, target in want.items():
        assert abs(taken[s] - target) <= 80


def test_meetings_keep_words_and_means(spark):
    """Many trees of equal documents: each is taken with its probability."""
    rows = spark.range(3000).select(
        F.concat(F.lit("s"), (F.col("id") % 100).cast("string")).alias("source"),
        F.col("id").alias("key"),
        (F.col("id") % 3 + 1).cast("double").alias("size"),
    )
    rows = rows.withColumn("mass", F.col("size") * 0.3)
    ups = mixing._settle(rows, "seed", 3000)
    got = rows.join(ups, "key").toPandas()
    assert len(got) == 3000
    for _, own in got.groupby("source"):
        assert abs((own["size"] * own.up).sum() - own.mass.sum()) < 3
    for _, own in got.groupby("size"):
        assert own.up.mean() == pytest.approx(0.3, abs=0.05)


def test_mixing_odd_rows(odd, empty):
    got = mixing.mix(odd, prefix="m_")
    assert [c for c in got.columns if not c.startswith("m_")] == odd.columns
    assert got.count() == odd.count()
    assert got.filter("m_size = 0 AND m_copies > 0").count() == 0
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(odd.filter("text IS NULL OR text = ''")).filter("copies > 0").count() == 0


# Sharding


def test_ring_fills_every_shard(spark, odd, empty):
    docs = spark.range(1003).withColumn("home_shard", F.lit("old"))
    got = sharding.assign(docs, "id", 8).collect()
    assert len(got) == 1003
    by_shard = collections.defaultdict(list)
    for r in got:
        by_shard[r.shard].append(r.slot)
    assert {s: sorted(v) for s, v in by_shard.items()} == {
        s: list(range(len(v))) for s, v in by_shard.items()
    }
    sizes = list(map(len, by_shard.values()))
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 1
    points = sharding.ring(8)
    places = [p for p, _ in points]
    for r in got[:200]:
        h = int(hashlib.md5(f"k{r.id}".encode()).hexdigest()[:12], 16)
        at = next((i for i, p in enumerate(places) if p >= h), 0)
        assert r.home_shard == points[at][1]
        # Only a full shard is passed by, clockwise.
        assert points[(at + r.hops) % len(points)][1] == r.shard
    stay = sum(r.home_shard == r.shard for r in got)
    assert stay > 0.85 * len(got)
    assert sharding.assign(odd, "doc_id", 3).count() == odd.count()
    assert sharding.assign(empty, "doc_id", 3).count() == 0


def test_a_frequent_key_is_spread(spark):
    rows = spark.range(900).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id")).alias("k"))
    sizes = sharding.assign(rows, "k", 4).groupBy("shard").count().collect()
    assert {r["count"] for r in sizes} == {225}


def test_a_new_shard_moves_a_part_of_the_rows(spark):
    docs = spark.range(4000)
    old = {r.id: r.shard for r in sharding.assign(docs, "id", 8).collect()}
    new = {r.id: r.shard for r in sharding.assign(docs, "id", 9).collect()}
    assert sum(old[i] != new[i] for i in old) < 0.4 * len(old)


# Fingerprints


def test_fingerprints(spark, odd, empty):
    rng = np.random.default_rng(4)
    vocabulary = [f"t{i}x" for i in range(300)]
    rows = [(i * 2, " ".join(rng.choice(vocabulary, 60))) for i in range(80)]
    rows[7] = (14, rows[3][1])
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in imatch.compare_edited(docs).collect()}
    for k, (key, text) in enumerate(rows):
        half = len(text) // 2
        want = text[: len(text) - half] + rows[(k + 1) % len(rows)][1][:half]
        assert got[key].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert got[key].n_chars == len(text)
    assert got[14].fingerprint == got[6].fingerprint
    near = np.mean([r.near_edited for r in got.values()])
    other = np.mean([r.near_next for r in got.values()])
    assert near > other + 0.05
    found = imatch.compare_edited(odd).collect()
    assert len(found) == odd.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert imatch.compare_edited(empty).count() == 0
    alone = imatch.compare_edited(odd.filter("doc_id = 4")).collect()[0]
    assert alone.edited_sha256 == hashlib.sha256(b"ono").hexdigest() and alone.near_next == 1


def test_more_languages_than_a_block(spark):
    rows = [(i, chr(0x4E00 + i % 300) * 9, f"l{i % 300:03d}") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    assert len(model.languages) == 300 and len(model.blocks) == 2
    got = language.predict(docs.withColumn("SCORE", F.lit("old")), model)
    assert got.columns == ["doc_id", "text", "lang", "lang_pred", "score"]
    found = got.collect()
    assert all(r.lang_pred == r.lang for r in found) and all(0.3 < r.score <= 1 for r in found)
    # As with one block of all languages.
    weights = np.concatenate([b.weights for b in model.blocks], axis=1)
    prior = np.concatenate([b.prior for b in model.blocks])
    whole = language.Block(model.languages, weights, prior)
    names, _, masses = language.score_texts(whole, [r.text for r in found])
    assert names == [r.lang_pred for r in found]
    assert np.allclose([r.score for r in found], [1 / m for m in masses])


def test_a_quality_model_learns_from_whole_long_texts(spark):
    """What tells the labels apart stands at the end of long texts."""
    filler = " ".join(f"w{k % 91}" for k in range(1500))
    rows = [(i, filler + (" GOOD" * 300 if i % 2 else " bad?" * 300)) for i in range(40)]
    docs = spark.createDataFrame(rows + rows[:5], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    found = quality.score(docs, quality.fit(docs, labels, F.lit(True))).collect()
    assert all((r.score > 0.5) == bool(r.doc_id % 2) for r in found)


@pytest.mark.parametrize("seed", range(17, 22))
def test_the_last_large_document_goes_where_the_rest_can_follow(spark, seed):
    """A source of 4,000 words with one document of 3,000, and a target of 5,333."""
    rows = [(0, "w " * 3000, "b"), *[(i, "w " * 50, "b") for i in range(1, 21)]]
    rows += [(100 + i, "w " * 100, s) for s, n in (("a", 40), ("c", 40)) for i in range(n)]
    docs = spark.createDataFrame(
        [(i, t, s, 1, "x") for i, t, s in rows], "doc_id long, text string, source string, SIZE int, Copies string"
    )
    got = mixing.mix(docs, seed=seed)
    assert sum(c.lower() == "size" for c in got.columns) == 1
    own = got.groupBy("source").agg(
        F.sum(F.col("copies") * F.col("size")).alias("taken"), F.first("target").alias("target")
    )
    for r in own.collect():
        assert abs(r.taken - r.target) <= 0.02 * r.target


def test_sharding_replaces_clashing_columns(spark):
    rows = spark.range(40).withColumn("Shard", F.lit("old")).withColumn("SLOT", F.lit("old"))
    got = sharding.assign(rows, "id", 4)
    assert got.columns == ["id", "home_shard", "shard", "slot", "hops"]
    assert got.select("shard").distinct().count() == 4


def test_repeated_rows_have_one_body(spark, monkeypatch):
    """Sixty repeats of two similar texts are compared once."""
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame(
        [(1, text)] * 60 + [(2, text + " more")] * 60, "doc_id long, text string"
    )
    compared = []
    whole = jaccard._overlaps

    def counted(pairs, sets, percent):
        found = whole(pairs, sets, percent)
        compared.append(found.count())
        return found

    monkeypatch.setattr(jaccard, "_overlaps", counted)
    monkeypatch.setattr(jaccard, "HOT_COPIES", 50)
    got = jaccard.count_links(docs).distinct().collect()
    assert sorted(tuple(r)[2:] for r in got) == [(1, 119), (1, 119)]
    assert max(compared) <= 1


def spark_hash(value, seed=42):
    raw = value.encode() if isinstance(value, str) else struct.pack("<q", value)
    return struct.unpack("<q", struct.pack("<Q", xxhash.xxh64_intdigest(raw, seed)))[0]


def brute_fingerprints(texts):
    """The fingerprint of any text, by the lexicon of ``texts``."""

    def terms(text):
        words = {w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w}
        return {spark_hash(w) for w in words}

    df = collections.Counter(t for text in texts for t in terms(text))
    low, high = max(2, imatch.LOW * len(texts)), imatch.HIGH * len(texts)
    listed = {t for t, n in df.items() if low <= n <= max(high, low)}

    def fingerprint(text):
        own = sorted((terms(text) & listed) or terms(text))
        parts = []
        for k in range(imatch.SUBSETS):
            part = [t for t in own if (t >> 20) % imatch.SUBSETS == k]
            h = 42
            for t in part:
                h = spark_hash(t, h % 2**64)
            parts.append(f"{h % 2**64:016x}"[-imatch.DIGITS :] if part else imatch.EMPTY)
        return parts

    return fingerprint


def brute_likeness(one, two):
    if one == two:
        return 1.0
    held = [(a, b) for a, b in zip(one, two) if a != imatch.EMPTY or b != imatch.EMPTY]
    return sum(a == b != imatch.EMPTY for a, b in held) / len(held)


@pytest.mark.parametrize("table_terms", [imatch.LEXICON, 5])
def test_fingerprints_and_likeness_by_brute_force(spark, monkeypatch, table_terms):
    """Whether the lexicon is a table or is joined, fingerprints are the same."""
    monkeypatch.setattr(imatch, "LEXICON", table_terms)
    rng = np.random.default_rng(9)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choice(words, rng.integers(3, 90))) for _ in range(60)]
    texts += [texts[0], "", None, "only here", "Été, ÉTÉ w1-w2", "!!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fingerprint = brute_fingerprints(texts)
    got = {r.doc_id: r for r in imatch.compare_edited(docs.repartition(3)).collect()}
    for i, text in enumerate(texts):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        half = len(text) // 2
        own, edit = fingerprint(text), fingerprint(text[: len(text) - half] + after[:half])
        assert got[i].fingerprint == "".join(own) and got[i].edited_fingerprint == "".join(edit)
        assert got[i].near_edited == pytest.approx(brute_likeness(own, edit))
        assert got[i].near_next == pytest.approx(brute_likeness(own, fingerprint(after)))


def test_a_lexicon_does_not_narrow_with_long_texts(spark):
    words = " ".join(f"w{k}" for k in range(3000))
    rows = [(i, words if i < 4 else f"text {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert imatch.lexicon(docs).count() == 3000


def test_lexicon_is_the_band(spark):
    rows = [(i, " ".join(f"t{k}" for k in range(1, 41) if i % k == 0)) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    frequency = collections.Counter(w for _, t in rows for w in set(t.split()))
    found = imatch.lexicon(docs, low=0.04, high=0.2).collect()
    want = sorted(n for n in frequency.values() if 8 <= n <= 40)
    assert sorted(r.df for r in found) == want


# Tool calls


def brute_levels(keys, edges):
    parents = {k: {p for a, p in edges if a == k and p in keys} for k in keys}
    level, changed = {}, True
    while changed:
        changed = False
        for k in keys:
            if k not in level and all(p in level for p in parents[k]):
                level[k] = max((level[p] + 1 for p in parents[k]), default=0)
                changed = True
    return {k: level.get(k, -1) for k in keys}


def test_levels_of_chains_graphs_and_cycles(spark):
    rng = np.random.default_rng(2)
    keys = [f"k{i}" for i in range(120)]
    edges = [(keys[i], keys[i - 1]) for i in range(1, 40)]
    edges += [
        (keys[i], keys[int(j)]) for i in range(41, 90) for j in rng.integers(30, i, rng.integers(0, 3))
    ]
    edges += [("k95", "k96"), ("k96", "k97"), ("k97", "k95"), ("k98", "k97"), ("k99", "k99")]
    edges += [("k100", "unknown"), ("k101", "k97"), ("k101", "k0"), ("k1", "k0")]
    got = toolcalls.levels(
        spark.createDataFrame([(k,) for k in keys], "key string"),
        spark.createDataFrame(edges, "key string, parent string"),
    )
    assert {r.key: r.level for r in got.collect()} == brute_levels(keys, edges)


def test_linking_validation_and_canonical_json(spark):
    calls = [
        (1, "b", 4, "search", '{"limit": 3, "query": "x"}', ["a"]),
        (1, "a", 2, "search", '{ "query":"\\u00e9\\n", "limit" : 2.0 }', []),
        (1, "a", 2, "search", '{ "query":"\\u00e9\\n", "limit" : 2.0 }', []),
        (2, "a", 1, "search", '{"limit": "3", "more": 1}', ["none"]),
        (2, "c", 3, "other", "{}", None),
        (2, "d", 5, "search", "not json", []),
        (2, "e", 6, "search", None, []),
        (2, "f", 7, "search", '{"query": "long long text", "limit": 99}', []),
        (None, "a", 1, "search", '{"query": "x"}', []),
        (3, None, 1, None, None, None),
    ]
    results = [
        (1, "a", 3, "first"), (1, "a", 5, "second"), (2, "z", 9, "lost"), (None, "a", 2, "x"),
        (1, "b", 5, None),
    ]
    schemas = [
        ("search", "query", "string", True, 10), ("search", "limit", "integer", False, 10),
    ]
    frames = (
        spark.createDataFrame(
            calls,
            "conv_id long, call_id string, turn long, tool string, arguments string,"
            " after array<string>",
        ).withColumn("content", F.lit("clash")),
        spark.createDataFrame(results, "conv_id long, call_id string, turn long, content string"),
        spark.createDataFrame(schemas, toolcalls.SCHEMA),
    )
    got = {(r.conv_id, r.call_id): r for r in toolcalls.link(*frames).collect()}
    assert len(got) == 10
    a = got[1, "a"]
    assert (a.n_calls, a.n_results, a.result_turn, a.level, a.position) == (2, 2, 3, 0, 0)
    assert a.errors == []
    assert a.message == (
        '{"arguments":{"limit":2,"query":"é\\n"},"call_id":"a","name":"search","result":"first"}'
    )
    assert (got[1, "b"].level, got[1, "b"].position, got[1, "b"].status) == (1, 1, "linked")
    assert got[2, "a"].errors == ["missing query", "type of limit", "unknown more"]
    assert got[2, "c"].errors == ["unknown tool"]
    assert got[2, "d"].errors == ["no JSON object"] == got[2, "e"].errors
    assert got[2, "f"].errors == ["limit too large", "query too large"]
    assert got[2, "z"].status == "no call" and got[2, "c"].status == "no result"
    assert got[None, "a"].errors == ["no identifier"]
    assert got[3, None].errors == ["no identifier", "unknown tool"]
    for r in got.values():
        assert list(json.loads(r.message)) == ["arguments", "call_id", "name", "result"]
    none = [f.limit(0) for f in frames]
    assert toolcalls.link(*none).count() == 0


def test_results_without_an_identifier_are_rows(spark):
    calls = spark.createDataFrame(
        [(1, "a", 1, "t", "{}", []), (None, "a", 1, "t", "{}", [])],
        "conv_id long, call_id string, turn long, tool string, arguments string,"
        " after array<string>",
    )
    results = [(1, "a", 2, "p"), (None, "a", 2, "q"), (1, None, 3, "r"), (None, None, None, "r")]
    results = spark.createDataFrame(
        results, "conv_id long, call_id string, turn long, content string"
    )
    schemas = spark.createDataFrame([("t", "x", "string", False, 1)], toolcalls.SCHEMA)
    got = toolcalls.link(calls, results, schemas).collect()
    assert sorted(r.status for r in got) == ["linked"] + ["no call"] * 3 + ["no result"]
    lost = [r for r in got if r.status == "no call"]
    assert sorted(json.loads(r.message)["result"] for r in lost) == ["q", "r", "r"]
    for r in lost:
        assert (r.n_calls, r.n_results, r.errors) == (0, 1, ["no identifier"])


# Lattice


def test_e8_points_are_the_nearest_of_the_lattice():
    rng = np.random.default_rng(6)
    x = rng.uniform(-2, 2, (400, 8))
    points = lattice.decode_e8(x)
    parity = points % 2
    assert ((parity == parity[:, :1]).all(axis=1)).all()  # all whole or all halves
    assert (points.sum(axis=1) % 4 == 0).all()
    shifts = [np.array(s) for s in itertools.product((-1, 1), repeat=8) if sum(s) % 4 == 0]
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((-2, 2), repeat=2):
            shift = np.zeros(8, int)
            shift[i], shift[j] = a, b
            shifts.append(shift)
    own = ((x - points / 2) ** 2).sum(axis=1)
    for shift in shifts:  # the neighbours of a lattice point are no nearer
        assert (((x - (points + shift) / 2) ** 2).sum(axis=1) >= own - 1e-9).all()


@pytest.mark.parametrize("size", [4, 16, 64, 768])
def test_recall_does_not_depend_on_the_number_of_components(size):
    rng = np.random.default_rng(size)

    def meet(cosine):
        one, two = rng.standard_normal((2, 2_000, size))
        one /= np.linalg.norm(one, axis=1, keepdims=True)
        two -= (one * two).sum(axis=1, keepdims=True) * one
        two /= np.linalg.norm(two, axis=1, keepdims=True)
        two = cosine * one + (1 - cosine**2) ** 0.5 * two
        a, b = (lattice.cells(x, 5, lattice.TABLES, lattice.WIDTH) for x in (one, two))
        return (a[..., None] == b[..., None, :]).any(axis=(1, 2, 3)).mean()

    assert meet(0.9) >= 0.95
    assert meet(0.0) <= 0.01


def test_near_duplicates_by_brute_force(spark):
    rng = np.random.default_rng(9)
    base = rng.standard_normal((40, 64))
    rows = []
    for i in range(600):
        x = base[i % 40] + rng.standard_normal(64) * (0.05 + 0.3 * (i % 5) / 5)
        rows.append((i * 2, [float(v) for v in x.astype("f4")], 0))
    rows += [(2001, rows[5][1], 1), (2003, rows[5][1], 1)]
    odd = [
        (3001, None, 0), (3002, [], 0), (3003, [0.0] * 64, 0), (3004, [1.0, None], 0),
        (3005, [float("nan")] * 64, 0), (3006, [float("inf")] + [0.0] * 63, 0), (3007, [1.0], 0),
        (3008, [2.0], 0), (None, [5.0, 5.0], 0),
    ]
    schema = "vec_id long, embedding array<float>, label int"
    table = spark.createDataFrame(rows + odd, schema).repartition(4)
    got = {r.vec_id: r for r in lattice.near_duplicates(table).collect()}
    assert len(got) == len(rows) + len(odd)
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    ids = [r[0] for r in rows]
    links = [got[i].n_links for i in ids]
    assert all(n <= m for n, m in zip(links, close.sum(axis=1)))
    assert sum(links) >= 0.95 * close.sum()
    assert got[2001].n_links == got[2003].n_links == got[10].n_links > 0
    assert got[2001].component_id == got[10].component_id
    assert (got[3007].n_links, got[3008].component_id, got[3008].kept) == (1, 3007, False)
    for i in (3001, 3002, 3003, 3004, 3005, 3006, None):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert lattice.near_duplicates(table.limit(0)).count() == 0


def test_large_cells_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(lattice, "BLOCK", 16)
    rng = np.random.default_rng(1)
    one = rng.standard_normal(32)
    rows = [(i, [float(v) for v in one + 0.01 * rng.standard_normal(32)]) for i in range(120)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = lattice.near_duplicates(table).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(119, 0)}


# Helpers


def test_ranks_and_components(spark):
    rows = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, None).otherwise(F.col("id") % 2).alias("g"),
        ((F.col("id") * 7919) % 500).alias("v"),
    )
    got = common.ranked(rows.repartition(6), [F.col("v")], within=["g"]).collect()
    for g in (None, 0, 1):
        own = sorted((r.v, r["rank"]) for r in got if r.g == g)
        assert [k for _, k in own] == list(range(len(own)))
    links = [(i, i + 1) for i in range(0, 60)] + [(100, 90), (90, 95), (7, 7)]
    frame = spark.createDataFrame(links, "a long, b long")
    found = {r.node: r.root for r in common.components(frame).collect()}
    assert found == {i: 0 for i in range(1, 61)} | {95: 90, 100: 90}
    assert common.components(frame.limit(0)).count() == 0


def test_folds_are_crc32(spark):
    got = spark.range(50).select("id", common.fold(5, "id").alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.id).encode()) % 5 for r in got)

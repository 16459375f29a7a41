"""The queries of this subpackage over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import (
    attribution,
    audit,
    bpe,
    imatch,
    jaccard,
    language,
    lattice,
    linededup,
    mixing,
    quality,
    search,
    sharding,
    toolcalls,
)
from lectern.llm.bpe import RANKS
from lectern.llm.common import fold, read
from lectern.llm.quality import LEAST_QUALITY

Query = Callable[[SparkSession, str], DataFrame]


SHARDS = 8


#: The tools of the test conversations: a system turn configures, a user turn asks.
TOOLS = [
    ("ask", "query", "string", True, 250),
    ("ask", "turn", "integer", True, 1_000),
    ("configure", "query", "string", True, 150),
    ("configure", "turn", "integer", True, 0),
]


def op1_tool_calls(spark, sf_dir):
    """Linked calls, and a row of status ``other role`` for each turn of any other role."""
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    number = F.col("turn").cast("string")
    parent = F.when(F.col("turn") == 1, 0).when(F.col("turn") > 1, F.col("turn") - 2)
    calls = turns.filter("role IN ('user', 'system')").select(
        "conv_id",
        F.concat(F.lit("call_"), number).alias("call_id"),
        "turn",
        F.when(F.col("role") == "system", "configure").otherwise("ask").alias("tool"),
        F.concat(
            F.lit('{ "turn": '), number,
            F.lit(', "query": '), toolcalls.json_string(F.col("text")), F.lit(" }"),
        ).alias("arguments"),
        F.array_compact(F.array(F.concat(F.lit("call_"), parent.cast("string")))).alias("after"),
    )
    results = turns.filter("role = 'assistant'").select(
        "conv_id",
        F.concat(F.lit("call_"), (F.col("turn") - 1).cast("string")).alias("call_id"),
        "turn",
        F.col("text").alias("content"),
    )
    linked = toolcalls.link(calls, results, spark.createDataFrame(TOOLS, toolcalls.SCHEMA))
    others = turns.filter("coalesce(role, '') NOT IN ('user', 'system', 'assistant')").select(
        "conv_id", "turn",
        F.lit(0).cast("long").alias("n_calls"), F.lit(0).cast("long").alias("n_results"),
        F.lit("other role").alias("status"),
        F.array(F.concat(F.lit("role "), toolcalls.json_string(F.col("role")))).alias("errors"),
        F.concat(
            F.lit('{"content":'), toolcalls.json_string(F.col("text")),
            F.lit(',"role":'), toolcalls.json_string(F.col("role")), F.lit("}"),
        ).alias("message"),
    )
    linked = linked.unionByName(others, allowMissingColumns=True)
    return linked.withColumn("errors", F.array_join("errors", "; "))


def op2_token_attribution(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return attribution.token_counts(
        docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    )


def op3_jaccard_join(spark, sf_dir):
    return jaccard.count_links(read(spark, sf_dir, "documents"))


def op4_pivotal_mixing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"),
        "copies",
    )


def op5_bounded_ring(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    raw = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    rows = docs.select(
        "doc_id",
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
    )
    placed = sharding.assign(rows, "doc_id", SHARDS, tie=[F.col("text_crc32"), F.col("size")])
    return placed.select(
        "doc_id", "size", "text_crc32",
        F.lit("rows").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "home_shard", "hops",
    )


def op6_imatch(spark, sf_dir):
    return imatch.compare_edited(read(spark, sf_dir, "documents"))


def op7_quality_cnn(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    net = quality.fit(docs, read(spark, sf_dir, "labels"), ~held_out)
    scored = quality.score(docs, net)
    return scored.select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        (F.col("score") >= LEAST_QUALITY).cast("int").alias("predicted"),
    )


def op8_byte_bpe(spark, sf_dir):
    path = public_tokenizers.path(RANKS)
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    ids = bpe.encode(docs, path, public_tokenizers.PATTERN).drop("text")
    both = bpe.decode(ids, path)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op9_language_nb(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(fold(3) == 1, F.lit(False))
    model = language.fit(docs, ~held_out)
    found = language.predict(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_e8_lattice(spark, sf_dir):
    return lattice.near_duplicates(read(spark, sf_dir, "embeddings"))


def op11_term_pipeline(spark, sf_dir):
    return search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_line_dedup(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = linededup.kept_text(F.col("text"), F.col("keep"))
    return linededup.keep_bitmaps(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(kept, 256).alias("kept_sha256")
    )


def op13_filter_audit(spark, sf_dir):
    return audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def queries() -> dict[str, Query]:
    return {
        "op1_tool_calls": op1_tool_calls,
        "op2_token_attribution": op2_token_attribution,
        "op3_jaccard_join": op3_jaccard_join,
        "op4_pivotal_mixing": op4_pivotal_mixing,
        "op5_bounded_ring": op5_bounded_ring,
        "op6_imatch": op6_imatch,
        "op7_quality_cnn": op7_quality_cnn,
        "op8_byte_bpe": op8_byte_bpe,
        "op9_language_nb": op9_language_nb,
        "op10_e8_lattice": op10_e8_lattice,
        "op11_term_pipeline": op11_term_pipeline,
        "op12_line_dedup": op12_line_dedup,
        "op13_filter_audit": op13_filter_audit,
    }


_TOOL_CALLS_SQL = """
WITH RECURSIVE calls AS (
    SELECT conv_id, 'call_' || turn AS call_id, turn,
           CASE role WHEN 'system' THEN 'configure' ELSE 'ask' END AS tool, text,
           CASE WHEN turn = 1 THEN 0 WHEN turn > 1 THEN turn - 2 END AS parent,
           count(*) OVER (PARTITION BY conv_id, turn) AS n_calls
    FROM conversations WHERE role IN ('user', 'system')
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY role DESC, text) = 1),
results AS (
    SELECT conv_id, 'call_' || (turn - 1) AS call_id, turn AS result_turn, text AS content,
           count(*) OVER (PARTITION BY conv_id, turn) AS n_results
    FROM conversations WHERE role = 'assistant'
    QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY text) = 1),
levels AS (
    SELECT conv_id, turn, 0 AS level FROM calls c WHERE NOT EXISTS (
        SELECT 1 FROM calls p WHERE p.conv_id = c.conv_id AND p.turn = c.parent)
    UNION ALL
    SELECT c.conv_id, c.turn, l.level + 1
    FROM calls c JOIN levels l ON c.conv_id = l.conv_id AND c.parent = l.turn),
placed AS (
    SELECT c.*, level, row_number() OVER (
        PARTITION BY conv_id ORDER BY level, turn, call_id) - 1 AS position
    FROM calls c JOIN levels USING (conv_id, turn))
SELECT conv_id, call_id, turn, tool, level, position, result_turn,
       coalesce(n_calls, 0) AS n_calls, coalesce(n_results, 0) AS n_results,
       CASE WHEN n_calls IS NULL THEN 'no call' WHEN n_results IS NULL THEN 'no result'
            ELSE 'linked' END AS status,
       CASE WHEN tool IS NULL THEN ''
            WHEN text IS NULL THEN 'type of query'
            ELSE concat_ws('; ',
                CASE WHEN length(text) > CASE tool WHEN 'ask' THEN 250 ELSE 150 END
                     THEN 'query too large' END,
                CASE WHEN turn > CASE tool WHEN 'ask' THEN 1000 ELSE 0 END
                     THEN 'turn too large' END) END AS errors,
       '{"arguments":' || CASE WHEN tool IS NULL THEN 'null'
                               ELSE CAST(json_object('query', text, 'turn', turn) AS VARCHAR) END
       || ',"call_id":' || CAST(to_json(call_id) AS VARCHAR)
       || ',"name":' || coalesce(CAST(to_json(tool) AS VARCHAR), 'null')
       || ',"result":' || coalesce(CAST(to_json(content) AS VARCHAR), 'null') || '}' AS message
FROM placed FULL JOIN results USING (conv_id, call_id)
UNION ALL
SELECT conv_id, NULL, turn, NULL, NULL, NULL, NULL, 0, 0, 'other role',
       'role ' || coalesce(CAST(to_json(role) AS VARCHAR), 'null'),
       '{"content":' || coalesce(CAST(to_json(text) AS VARCHAR), 'null')
       || ',"role":' || coalesce(CAST(to_json(role) AS VARCHAR), 'null') || '}'
FROM conversations WHERE coalesce(role, '') NOT IN ('user', 'system', 'assistant')"""


_SEARCH_SQL = r"""
WITH item_terms AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM benchmark WHERE item_id IS NOT NULL)
    GROUP BY item_id, term),
terms AS (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
sizes AS (SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM sizes),
entries AS (
    SELECT doc_id, term, count(*) AS tf FROM terms
    WHERE term IN (SELECT term FROM item_terms) GROUP BY doc_id, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * (SELECT docs FROM totals) + 2)
                                      / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM entries GROUP BY term),
gains AS (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (
        75 + (25 * n * (SELECT docs FROM totals)) // (SELECT words FROM totals)))) AS gain
    FROM entries JOIN weights USING (term) JOIN sizes USING (doc_id)),
scores AS (
    SELECT item_id, doc_id, CAST(sum(times * gain) AS BIGINT) AS score
    FROM item_terms JOIN gains USING (term) GROUP BY item_id, doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
    FROM scores WHERE score > 0)
WHERE rank <= 20"""

_LINES_SQL = r"""
WITH lines AS (
    SELECT doc_id, unnest(line) AS line, generate_subscripts(line, 1) AS pos
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS line FROM documents)),
keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
marked AS (
    SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS dropped
    FROM keyed)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM marked GROUP BY doc_id"""

_AUDIT_SQL = r"""
WITH docs AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents),
words AS (
    SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM docs),
failing AS (
    SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
           CAST(len(w) < 100 AS INTEGER)
           + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INTEGER)
           + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g'))
                      > 10 * length(text) AS INTEGER)
           + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
           + 16 * CAST(words.doc_id > min(words.doc_id) OVER (PARTITION BY text) AS INTEGER)
             AS mask
    FROM words LEFT JOIN labels ON labels.doc_id = words.doc_id),
counted AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good,
           count(*) FILTER (toxic) AS toxic
    FROM failing GROUP BY part, mask),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f),
orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
steps AS (
    SELECT filter_order, step, substring(filter_order, step, 1) AS f
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
bits AS (
    SELECT s.filter_order, s.step, s.f, CAST(1 << (ascii(s.f) - 65) AS INTEGER) AS bit,
           CAST(coalesce(sum(1 << (ascii(p.f) - 65)), 0) AS INTEGER) AS before
    FROM steps s LEFT JOIN steps p ON p.filter_order = s.filter_order AND p.step < s.step
    GROUP BY s.filter_order, s.step, s.f),
found AS (
    SELECT part, filter_order, step, f,
           coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0) AS kept,
           coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before = 0), 0) AS removed,
           coalesce(sum(n) FILTER (mask & bit > 0 AND mask & before > 0), 0) AS redundant,
           coalesce(sum(n) FILTER (mask = bit), 0) AS unique_fails,
           coalesce(sum(good) FILTER (mask & bit > 0 AND mask & before = 0), 0) AS good_lost,
           coalesce(sum(toxic) FILTER (mask & bit > 0 AND mask & before = 0), 0) AS toxic_lost
    FROM counted, bits GROUP BY part, filter_order, step, f)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM found"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_tool_calls": _TOOL_CALLS_SQL,
        "op11_term_pipeline": _SEARCH_SQL,
        "op12_line_dedup": _LINES_SQL,
        "op13_filter_audit": _AUDIT_SQL,
    }

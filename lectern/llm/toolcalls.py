"""Chat formatting: tool calls linked to results, ordered, validated, as canonical JSON.

* Linking: calls and results meet in a hash join by (conversation, identifier). A call
  that occurs repeatedly counts once, as its earliest row (by turn, then by content), and
  so does a result; the numbers of rows are returned. A result without a call is a row of
  its own, and so is a call without a result.
* Order: a call may name calls whose results it builds on. ``levels`` puts every call
  behind those, and calls of one level are in order of turn and identifier. ``position``
  counts from 0 in each conversation. Chains, however long, are contracted by pointer
  doubling, in the logarithm of their length; only calls that build on several others are
  resolved level by level. Calls on a cycle, or behind one, have level -1 and come first.
* Validation: a call's arguments must be a JSON object that has the required fields of its
  tool's schema, of the right types and sizes, and no others.
* ``message`` is canonical JSON: keys in the order of their UTF-16 units, as RFC 8785 has
  them, no white space, and one text per number. That is its exact decimal value, however
  long, without needless zeros: as ``100``, ``0.05``, or ``1.5e+30`` where the first digit is
  more than 21 places before the point or 6 behind it. Numbers whose exponent is no 64-bit
  integer keep their text. Arguments that are no JSON, or repeat a key, are kept as a string.

Calls and results without a conversation or an identifier can't be linked: they are rows of
their own, each with the error ``no identifier``; such results have status ``no call``.
Nothing here runs Python on rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import if_small, ranked
from lectern.scratch import stage

SCHEMA = "tool string, field string, type string, required boolean, most long"
#: JSON types of a schema, and what a value's type must look like.
TYPES = {
    "string": "^STRING$",
    "integer": "^BIGINT$|^DECIMAL\\(\\d+,0\\)$",
    "number": "^BIGINT$|^DECIMAL|^DOUBLE$",
    "boolean": "^BOOLEAN$",
    "array": "^ARRAY<",
    "object": "^OBJECT<",
}


def _key(call_id: str = "call_id") -> Column:
    """One value per conversation and identifier; null if one of them is missing.

    The length says where the conversation ends, whatever characters both have.
    """
    conversation = F.col("conv_id").cast("string")
    return F.concat(F.length(conversation).cast("string"), F.lit(":"), conversation, F.col(call_id))


def levels(calls: DataFrame, after: DataFrame) -> DataFrame:
    """Rows (key, level): 0 without predecessors, else one more than the highest of them.

    ``calls`` has each key once. ``after`` has rows (key, parent); parents that are no
    keys are left out. Keys on a cycle, or behind one, have level -1.
    """
    keys = calls.select("key")
    edges = after.select("key", "parent").filter("parent IS NOT NULL").distinct()
    edges = stage(
        edges.join(keys, "key", "left_semi").join(
            keys.withColumnRenamed("key", "parent"), "parent", "left_semi"
        ).select("key", "parent"),
        "edges",
    )
    parents = edges.groupBy("key").agg(
        F.count(F.lit(1)).alias("n"), F.min("parent").alias("parent")
    )
    nodes = stage(
        keys.join(parents, "key", "left").select(
            "key", F.coalesce("n", F.lit(0)).alias("n"), "parent"
        ),
        "nodes",
    )
    # Keys with one parent jump towards the nearest ancestor with none or several.
    jumps = nodes.filter("n = 1").select("key", F.col("parent").alias("to"), F.lit(1).alias("far"))
    jumps, turn, most = stage(jumps, "jumps"), 0, nodes.count()
    while (1 << turn) <= most:
        turn += 1
        nexts = jumps.select(
            F.col("key").alias("to"), F.col("to").alias("then"), F.col("far").alias("more")
        )
        moved = jumps.join(nexts, "to", "left").select(
            "key", F.coalesce("then", "to").alias("to"),
            (F.col("far") + F.coalesce("more", F.lit(0))).alias("far"),
            F.col("then").isNotNull().alias("moved"),
        )
        moved = stage(moved, "jumps")
        jumps = moved.drop("moved")
        if not moved.filter("moved").limit(1).count():
            break
    # Keys with several parents, by the ancestors that these jump to.
    ends = jumps.select(F.col("key").alias("parent"), "to", "far")
    waiting = edges.join(nodes.filter("n > 1").select("key"), "key", "left_semi").join(
        ends, "parent", "left"
    )
    waiting = stage(
        waiting.select(
            "key", F.coalesce("to", "parent").alias("to"),
            (F.coalesce("far", F.lit(0)) + 1).alias("far"),
        ),
        "waiting",
    )
    known = stage(nodes.filter("n = 0").select("key", F.lit(0).alias("level")), "known")
    while True:
        found = waiting.join(known.select(F.col("key").alias("to"), "level"), "to", "left")
        solved = found.groupBy("key").agg(
            F.max(F.col("level") + F.col("far")).alias("level"),
            F.count(F.when(F.col("level").isNull(), 1)).alias("open"),
        )
        solved = stage(solved.filter("open = 0").select("key", "level"), "solved")
        if not solved.limit(1).count():
            break
        waiting = stage(waiting.join(solved, "key", "left_anti"), "waiting")
        known = known.unionByName(solved)
    rest = jumps.join(
        known.select(F.col("key").alias("to"), F.col("level").alias("base")), "to"
    ).select("key", (F.col("base") + F.col("far")).cast("int").alias("level"))
    solved = known.select("key", F.col("level").cast("int").alias("level")).unionByName(rest)
    return keys.join(solved, "key", "left").select(
        "key", F.coalesce("level", F.lit(-1)).alias("level")
    )


def problems(calls: DataFrame, schemas: DataFrame) -> DataFrame:
    """``calls`` with ``errors``, sorted texts that say what is wrong with the arguments.

    ``schemas`` (see ``SCHEMA``) holds a tool's fields; ``most`` bounds a text's length, an
    array's size or a number. All fields of a tool are one small array, joined by tool.
    """
    tools = schemas.groupBy("tool").agg(
        F.collect_list(F.struct("field", "type", "required", "most")).alias("fields")
    )
    given = F.expr("try_variant_get(value, '$', 'map<string,variant>')")
    value = F.when(is_json(F.col("arguments")), F.try_parse_json("arguments"))
    rows = calls.withColumn("value", value).withColumn(
        "given", F.when(F.expr("schema_of_variant(value)").startswith("OBJECT"), given)
    )
    rows = rows.join(if_small(tools), "tool", "left")
    pattern = F.create_map(*[F.lit(x) for pair in TYPES.items() for x in pair])

    def check(f: Column) -> Column:
        value = F.element_at("given", f["field"])
        kind = F.schema_of_variant(value)
        text = F.try_variant_get(value, "$", "string")
        size = F.when(kind == "STRING", F.length(text)).when(
            kind.startswith("ARRAY"), F.size(F.try_variant_get(value, "$", "array<variant>"))
        ).otherwise(F.try_variant_get(value, "$", "double"))
        return (
            F.when(value.isNull() & f["required"], F.concat(F.lit("missing "), f["field"]))
            .when(value.isNull(), F.lit(None).cast("string"))
            .when(
                ~F.coalesce(F.regexp_like(kind, F.element_at(pattern, f["type"])), F.lit(False)),
                F.concat(F.lit("type of "), f["field"]),
            )
            .when(size > f["most"], F.concat(f["field"], F.lit(" too large")))
        )

    def known(name: Column) -> Column:
        return F.exists("fields", lambda f: f["field"] == name)

    unknown = F.transform(
        F.filter(F.map_keys("given"), lambda k: ~known(k)),
        lambda k: F.concat(F.lit("unknown "), k),
    )
    found = F.concat(F.filter(F.transform("fields", check), lambda e: e.isNotNull()), unknown)
    errors = (
        F.when(F.col("fields").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("given").isNull(), F.array(F.lit("no JSON object")))
        .otherwise(F.array_sort(found))
    )
    return rows.withColumn("errors", errors).drop("given", "fields", "value")


def is_json(text: Column) -> Column:
    """Whether all of ``text`` is one JSON value; the parser itself stops after the first.

    What ends early in brackets can't go on in braces, and the other way round.
    """
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}")))
    alone = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.coalesce(alone & named.isNotNull(), F.lit(False))


def canonical_number(text: Column) -> Column:
    """The one text of a JSON number's exact value."""
    sign, whole = F.regexp_extract(text, "^(-?)", 1), F.regexp_extract(text, "^-?([0-9]+)", 1)
    power = F.regexp_extract(text, "[eE][+]?(-?[0-9]+)", 1)
    shown = F.concat(whole, F.regexp_extract(text, "[.]([0-9]+)", 1))
    digits = F.ltrim(shown, F.lit("0"))
    moved = F.when(power == "", F.lit(0)).otherwise(power.try_cast("long"))
    point = F.length(whole) + F.length(digits) - F.length(shown) + moved
    value = F.array(F.struct(F.rtrim(digits, F.lit("0")).alias("d"), point.alias("p")))

    def written(x: Column) -> Column:  # the value is 0.d times ten to the power of p
        d, p, n = x["d"], x["p"], F.length(x["d"])
        places = p.cast("int")
        tail = F.when(n > 1, F.concat(F.lit("."), F.substring(d, 2, n))).otherwise("")
        return (
            F.when(d == "", "0")
            .when(p.between(n, 21), F.concat(sign, d, F.repeat(F.lit("0"), places - n)))
            .when(
                p.between(1, 21),
                F.concat(sign, F.substring(d, 1, places), F.lit("."), F.substring(d, places + 1, n)),
            )
            .when(p.between(-5, 0), F.concat(sign, F.lit("0."), F.repeat(F.lit("0"), -places), d))
            .otherwise(F.concat(
                sign, F.substring(d, 1, 1), tail, F.lit("e"), F.when(p > 0, "+").otherwise(""),
                (p - 1).cast("string"),
            ))
        )

    return F.coalesce(F.element_at(F.transform(value, written), 1), text)


# What stands for a number's text in a string, and for the escapes of backslash and quote
# while strings are told apart. None of these characters may stand in JSON as it is.
_NUMBER, _BACKSLASH, _QUOTE = "\\u0001", "\x02", "\x03"
_NUMBERS = "-?[0-9]+(?:[.][0-9]+)?(?:[eE][-+]?[0-9]+)?|[^-0-9]+|-"


def canonical(text: Column) -> Column:
    """JSON text in canonical form; a text that is no JSON as a JSON string.

    Numbers are put into strings, with a mark that other strings can't begin with, so that
    parsing doesn't change them, and taken out again.
    """
    hidden = F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH))
    hidden = F.replace(hidden, F.lit('\\"'), F.lit(_QUOTE))

    def outside(part: Column) -> Column:
        found = F.regexp_extract_all(part, F.lit(_NUMBERS), F.lit(0))
        number = lambda x: F.concat(F.lit(f'"{_NUMBER}'), canonical_number(x), F.lit('"'))
        return F.array_join(
            F.transform(found, lambda x: F.when(x.rlike("[0-9]"), number(x)).otherwise(x)), ""
        )

    def marked(part: Column, at: Column) -> Column:
        inside = F.replace(part, F.lit(_NUMBER), F.lit(_NUMBER * 2))
        return F.when(at % 2 == 0, outside(part)).otherwise(inside)

    parts = F.transform(F.split(hidden, '"', -1), marked)
    whole = F.replace(F.array_join(parts, '"'), F.lit(_QUOTE), F.lit('\\"'))
    whole = F.replace(whole, F.lit(_BACKSLASH), F.lit("\\\\"))
    found = F.to_json(F.try_parse_json(whole))
    found = F.regexp_replace(found, '"\\\\u0001([-+.e0-9]+)"', "$1")
    found = F.replace(found, F.lit(_NUMBER * 2), F.lit(_NUMBER))
    return F.when(is_json(text), F.coalesce(found, json_string(text))).otherwise(json_string(text))


def json_string(text: Column) -> Column:
    """A text as a JSON string; null as null."""
    wrapped = F.to_json(F.struct(text.alias("a")))
    value = wrapped.substr(F.lit(6), F.length(wrapped) - 6)
    return F.when(text.isNull(), "null").otherwise(value)


def link(calls: DataFrame, results: DataFrame, schemas: DataFrame) -> DataFrame:
    """One row per call, and per result without a call; see above for missing identifiers.

    ``calls``: conv_id, call_id, turn, tool, arguments (JSON text), after (array of the
    call_ids it builds on). ``results``: conv_id, call_id, turn, content.
    """
    content = ["turn", "tool", "arguments", "after"]
    named = calls.select("conv_id", "call_id", *content).withColumn("key", _key())
    loose = named.filter("key IS NULL")
    once = (
        named.filter("key IS NOT NULL")
        .groupBy("conv_id", "call_id", "key")
        .agg(F.min(F.struct(*content)).alias("call"), F.count(F.lit(1)).alias("n_calls"))
        .select("conv_id", "call_id", "key", "call.*", "n_calls")
    )
    once = stage(once, "calls")
    identified = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()
    answers = (
        results.filter(identified)
        .groupBy("conv_id", "call_id")
        .agg(
            F.min(F.struct("turn", "content")).alias("result"),
            F.count(F.lit(1)).alias("n_results"),
        )
        .select(
            F.col("conv_id"), F.col("call_id"), F.col("result.turn").alias("result_turn"),
            F.col("result.content").alias("content"), "n_results",
        )
    )
    prior = once.select("key", "conv_id", F.explode("after").alias("of"))
    prior = prior.select("key", _key("of").alias("parent"))
    placed = once.join(levels(once, prior), "key").drop("key")
    order = [F.col("level"), F.col("turn"), F.col("call_id")]
    placed = ranked(placed, order, within=["conv_id"], name="position")
    loose = loose.drop("key").select(
        "conv_id", "call_id", *content, F.lit(1).cast("long").alias("n_calls"),
        F.lit(-1).alias("level"), F.lit(None).cast("long").alias("position"),
    )
    unnamed = F.array(F.lit("no identifier"))
    # Rows without an identifier stay out of the join, where they would share one key.
    alone = problems(loose, schemas).withColumn("errors", F.concat(unnamed, "errors"))
    lost = results.filter(~identified).select(
        "conv_id", "call_id", F.col("turn").alias("result_turn"), "content",
        F.lit(1).cast("long").alias("n_results"), unnamed.alias("errors"),
    )
    joined = (
        problems(placed, schemas)
        .join(answers, ["conv_id", "call_id"], "full")
        .unionByName(alone, allowMissingColumns=True)
        .unionByName(lost, allowMissingColumns=True)
    )
    status = (
        F.when(F.col("n_calls").isNull(), "no call")
        .when(F.col("n_results").isNull(), "no result")
        .otherwise("linked")
    )
    message = F.concat(
        F.lit('{"arguments":'), F.coalesce(canonical(F.col("arguments")), F.lit("null")),
        F.lit(',"call_id":'), json_string(F.col("call_id")),
        F.lit(',"name":'), json_string(F.col("tool")),
        F.lit(',"result":'), json_string(F.col("content")),
        F.lit("}"),
    )
    return joined.select(
        "conv_id", "call_id", "turn", "tool", "level", "position", "result_turn",
        F.coalesce("n_calls", F.lit(0)).alias("n_calls"),
        F.coalesce("n_results", F.lit(0)).alias("n_results"),
        status.alias("status"),
        F.coalesce("errors", F.array().cast("array<string>")).alias("errors"),
        message.alias("message"),
    )

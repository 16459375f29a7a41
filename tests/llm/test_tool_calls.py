"""Keys and canonical JSON of linked tool calls."""

import json

import pytest
from pyspark.sql import functions as F

from lectern.llm import toolcalls

CALLS = "conv_id string, call_id string, turn long, tool string, arguments string, after array<string>"
RESULTS = "conv_id string, call_id string, turn long, content string"


def test_identifiers_with_separators_stay_apart(spark):
    calls = spark.createDataFrame(
        [
            ("a/b", "c", 1, "t", "{}", []), ("a", "b/c", 1, "t", "{}", []),
            ("1:a", "x", 1, "t", "{}", ["y"]), ("1", ":ax", 1, "t", "{}", None),
            ("1:a", "y", 2, "t", "{}", []),
        ],
        CALLS,
    )
    results = spark.createDataFrame([("a/b", "c", 2, "r")], RESULTS)
    schemas = spark.createDataFrame([], toolcalls.SCHEMA)
    got = toolcalls.link(calls, results, schemas).collect()
    assert sorted((r.conv_id, r.call_id, r.level, r.position, r.status) for r in got) == [
        ("1", ":ax", 0, 0, "no result"),
        ("1:a", "x", 1, 1, "no result"),
        ("1:a", "y", 0, 0, "no result"),
        ("a", "b/c", 0, 0, "no result"),
        ("a/b", "c", 0, 0, "linked"),
    ]


@pytest.mark.parametrize(
    "given, want",
    [
        ("1", "1"), ("1.0", "1"), ("1e0", "1"), ("100", "100"), ("1e2", "100"), ("1E+2", "100"),
        ("-0", "0"), ("-0.0e5", "0"), ("0.50", "0.5"), ("5e-6", "0.000005"), ("5e-7", "5e-7"),
        ("123.4500", "123.45"), ("-12.5e1", "-125"), ("1E400", "1e+400"), ("1.50e30", "1.5e+30"),
        ("1e21", "1e+21"), ("1e20", "100000000000000000000"), ("0.00012e-3", "1.2e-7"),
        ("12345678901234567890123456789012345678901234",
         "1.2345678901234567890123456789012345678901234e+43"),
        ("1e99999999999999999999", "1e99999999999999999999"),
    ],
)
def test_numbers_have_one_text(column, given, want):
    assert column([f'{{"a": [{given}]}}'], toolcalls.canonical(F.col("v"))) == [f'{{"a":[{want}]}}']


def test_strings_are_left_alone(column):
    values = [
        r'{"b": "1e2, \"2.0\" \\", "a": "x\\\\\"3"}', r'{"k\u0001": "\u00015", "l": "\u0001\u0001"}',
        r'"\\u00015"', '"5"', "[true, false, null, -1.0, {}]", '{"n": "a 1.0 b", "m": 1.0}',
    ]
    got = column(values, toolcalls.canonical(F.col("v")))
    for text, value in zip(got, values):
        assert json.loads(text) == json.loads(value)
    assert got[4] == "[true,false,null,-1,{}]" and got[5] == '{"m":1,"n":"a 1.0 b"}'


def test_what_is_no_json_becomes_a_string(column):
    values = ["01", "{", "", '{"a": 1, "a": 2}', "1 2", "1],[2", "1},{2", '{"a": 1} b', "nope", '{"a": .5}', "\x02", None]
    got = column(values, toolcalls.canonical(F.col("v")))
    assert [json.loads(t) for t in got] == values


def test_keys_are_in_order_of_utf16_units(column):
    got = column(['{"～": 1, "\U00010000": 2, "a": 3}'], toolcalls.canonical(F.col("v")))
    assert got == ['{"a":3,"\U00010000":2,"～":1}']


def test_many_escapes_in_one_string(column):
    text = json.dumps({"a": '\n"\\' * 20_000, "b": 1.5})
    got = column([text], toolcalls.canonical(F.col("v")))
    assert json.loads(got[0]) == json.loads(text)

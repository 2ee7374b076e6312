"""Which messages are documents, against Python's own parser."""

import json

import pytest
from pyspark.sql import functions as F

from tallybrook.functions import header_text
from tallybrook.streaming import judged, to_dead_letters, to_documents

SOUND = [
    '{"a":1}',
    ' \n\t{"a":1} \r\n ',
    "{}",
    '{"a":1,"a":2}',
    '{"a":{"b":[1,2,{"c":null}]}}',
    '{"a":123456789012345678901234567890}',
    '{"a":1e400}',
    '{"a":"}]"}',
    '{"a":[{"b":1}]}',
    '{"a":[{"b":1} ]}',
    '{"a":"x\\u00e9"}',
    '{"a":"Việt"}',
    '{"a":"\\"}"}',
]
FAULTY = [
    '[{"a":1}]',
    "5",
    "null",
    '"s"',
    "true",
    "",
    "   ",
    "None",
    '{"a":1} tail',
    '{"a":1} {"b":2}',
    '{"a":1},{"b":2}',
    '{"a":1},"x":2',
    '{"a":1}]',
    '{"a":1}] x',
    '{"a":1} ]}',
    '{"a":1}]}',
    '{"a":1}}',
    '{"a":1}}]',
    '{"a":[{"b":1}]}]',
    '{"a":[{"b":1}]},"y":1',
    '{"a":1',
    "{'a':1}",
    '{"a":1} // c',
    '1},{"a":1}',
    '﻿{"a":1}',
    '{"a":"x\ty"}',
    '{"a":01}',
    '{"a":1,}',
    '{a:1}',
]


@pytest.fixture(scope="module")
def faults(spark):
    rows = [(i, text.encode()) for i, text in enumerate(SOUND + FAULTY)]
    checked = judged(spark.createDataFrame(rows, "i int, value binary"))
    return {row.i: row.fault for row in checked.select("i", "fault").collect()}


@pytest.mark.parametrize("i", range(len(SOUND) + len(FAULTY)))
def test_fault_agrees_with_python(faults, i):
    text = (SOUND + FAULTY)[i]
    try:
        sound = isinstance(json.loads(text), dict)
    except ValueError:
        sound = False
    assert sound == (i < len(SOUND))
    assert (faults[i] is None) == sound, text


def test_not_a_number_is_set_aside(spark):
    df = spark.createDataFrame([(b'{"a":NaN}',)], "value binary")
    assert judged(df).first().fault == "not a JSON object"


def test_missing_and_undecodable_values(spark):
    df = spark.createDataFrame([(1, None), (2, b'\xff\xfe{"a":1}')], "i int, value binary")
    faults = {row.i: row.fault for row in judged(df).collect()}
    assert faults == {1: "no value", 2: "not UTF-8 text"}


def _messages(spark, values):
    rows = [
        (b"k", value, "t", 3, offset, [("h", b"1")] if offset == 0 else None)
        for offset, value in enumerate(values)
    ]
    return spark.createDataFrame(
        rows,
        "key binary, value binary, topic string, partition int, offset bigint, "
        "headers array<struct<key: string, value: binary>>",
    )


def test_last_of_repeated_keys_wins(spark):
    stored = to_documents(judged(_messages(spark, [b'{"a":1,"a":2}'])))
    assert stored.select(F.variant_get("document", "$.a", "int")).first()[0] == 2


def test_typed_documents(spark):
    schema = spark.createDataFrame([], "a int, b string").schema
    checked = judged(_messages(spark, [b'{"a":1,"c":2}', b"x"]), variant=False)
    assert "document" not in checked.columns
    assert to_documents(checked).columns == ["topic", "partition", "offset", "value"]
    rows = to_documents(checked, schema).collect()
    assert [row.asDict() for row in rows] == [
        {"topic": "t", "partition": 3, "offset": 0, "a": 1, "b": None}
    ]


def test_document_fields_may_not_hide_the_position(spark):
    schema = spark.createDataFrame([], "offset int").schema
    with pytest.raises(ValueError, match="offset"):
        to_documents(judged(_messages(spark, [b"{}"])), schema)


def test_dead_letters_keep_the_message(spark):
    long = b'{"a":' + b"1" * 1000
    dead = to_dead_letters(judged(_messages(spark, [b"x", b"{}", long, b"\xff\x00"])))
    rows = {row.value: row for row in dead.collect()}
    assert set(rows) == {b"x", long, b"\xff\x00"}
    assert set(dead.columns) == {"key", "value", "headers", "preview"}
    first = rows[b"x"]
    assert first.key == b"k"
    assert [(h.key, bytes(h.value)) for h in first.headers] == [
        ("h", b"1"),
        ("dlq-error", b"not a JSON object"),
        ("dlq-origin-topic", b"t"),
        ("dlq-origin-partition", b"3"),
        ("dlq-origin-offset", b"0"),
    ]
    assert rows[long].preview == long.decode()[:256]
    assert rows[b"\xff\x00"].preview == "FF00"


def test_header_text_takes_the_last_of_a_name(spark):
    df = spark.createDataFrame(
        [([("a", b"1"), ("b", b"2"), ("a", b"3")],), (None,)],
        "headers array<struct<key: string, value: binary>>",
    )
    found = df.select(
        header_text(F.col("headers"), "a").alias("a"), header_text(F.col("headers"), "z").alias("z")
    )
    assert sorted(map(tuple, found.collect()), key=repr) == [("3", None), (None, None)]


@pytest.mark.parametrize(
    "text",
    [
        '{"a":' + "9" * 1_100 + "}",
        '{"a":' + "[" * 1_200 + "]" * 1_200 + "}",
        '{"' + "k" * 60_000 + '":1}',
        '{"a":"' + "x" * 21_000_000 + '"}',
    ],
    ids=["digits", "levels", "key", "string"],
)
def test_sound_documents_beyond_the_parser_are_named(spark, text):
    df = spark.createDataFrame([(text.encode(),), (b"[1]",)], "value binary")
    faults = [row.fault for row in judged(df).select("fault").collect()]
    assert faults == ["beyond the limits of the JSON parser", "not a JSON object"]

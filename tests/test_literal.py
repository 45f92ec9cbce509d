import ast

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakework.sources.literal import decode_literals, literal_to_json, read_literals

SCHEMA = "a string, b boolean, c double"


def decode(spark, *texts, schema=SCHEMA):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [(r.record, r.decode_failed) for r in decode_literals(df, "t", schema).orderBy("i").collect()]


@pytest.mark.parametrize("document", [
    {"a": "x", "b": True, "c": None},
    {"a": None, "b": False, "c": 1e-05},
    {"a": "it's", "b": None, "c": 2.0},
    {"a": 'both " and \'', "b": True, "c": 0.0},
    {"a": "says: True, None", "b": False, "c": 1.5},
    {"a": "é ü 漢 😀", "b": True, "c": None},
    {"a": "line\nbreak\ttab\\slash\\x41", "b": True, "c": None},
    {"a": "\x00\x1f\xa0 ​", "b": True, "c": None},
    {"a": "\U000e0001 True", "b": True, "c": None},
    {"a": "", "b": True, "c": -3.25},
    {"a": "{'b': True}", "b": None, "c": None},
])
def test_round_trip(spark, document):
    record, failed = decode(spark, str(document))[0]
    assert not failed and record.asDict() == document


@given(st.lists(st.text(max_size=30).filter(lambda t: t.isprintable() or t.isascii()), min_size=1, max_size=20))
@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def test_any_text_survives(spark, texts):
    documents = [{"a": t, "b": None, "c": 1.0} for t in texts]
    results = decode(spark, *map(str, documents))
    assert [(r.a, failed) for r, failed in results] == [(t, False) for t in texts]


def test_rows_that_cannot_be_read_are_kept_and_flagged(spark):
    results = decode(
        spark, "{'a': 'x', 'b': True'}", "not a literal", "", None, "__import__('os').getcwd()",
        "{'a': 'fine'}",
    )
    assert [failed for _, failed in results] == [True, True, True, False, True, False]
    assert [record is None for record, _ in results] == [True, True, True, True, True, False]


def test_python_only_syntax_goes_through_the_evaluator(spark):
    results = decode(spark, "{'a': 'x' 'y', 'b': True, 'c': 1_000.0}", "{'a': '\\101', 'c': 2}")
    assert [tuple(r) for r, _ in results] == [("xy", True, 1000.0), ("A", None, 2.0)]


def test_nested_documents(spark):
    document = {"a": {"p": [1, 2], "q": {"x": True, "y": None}}}
    schema = "a struct<p:array<int>,q:struct<x:boolean,y:string>>"
    record, failed = decode(spark, str(document), schema=schema)[0]
    assert not failed and record.asDict(recursive=True) == document


def test_long_text_needs_no_evaluator(spark):
    text = "it's \"quoted\" True\n" * 40_000
    literal = str({"a": text, "b": True, "c": None})
    df = spark.createDataFrame([(literal,)], "t string")
    json_text = df.select(F.from_json(literal_to_json("t"), SCHEMA, {
        "allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}).alias("r"))
    assert json_text.first().r.a == text == ast.literal_eval(literal)["a"]


def test_files_carry_their_path_and_time(spark, tmp_path):
    (tmp_path / "kraken.json").write_text("{'a': 'x',\n 'b': True,\n 'c': 1.0}\n")
    (tmp_path / "stray.csv").write_text("a,b")
    row = read_literals(spark, str(tmp_path), SCHEMA).collect()
    assert len(row) == 1
    assert row[0].file_path.endswith("kraken.json") and row[0].datetime is not None
    assert row[0].record.a == "x"

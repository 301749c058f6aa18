"""Decoding every tag of the item fixture (FIXTURES.md)."""

import json

from pyspark.sql import functions as F

from tidemark.functions.attributes import item_from_columns, tagged
from tidemark.operators.flatten import discover_fields, field_names, field_needs, flatten_items
from tidemark.sources.items import items_of, read_items_json

ITEM = {
    "id": {"S": "a"},
    "n": {"N": "1.50"},
    "big": {"N": "12345678901234567890123456789012345678"},
    "b": {"BOOL": True},
    "l": {"L": [{"S": "x"}, {"N": "2"}]},
    "m": {"M": {"q": {"S": "r"}}},
    "z": {"NULL": True},
    "bin": {"B": "aGk="},
    "ss": {"SS": ["p", "q"]},
    "ns": {"NS": ["1", "2"]},
    "bs": {"BS": ["aGk="]},
    "u": {"ZZ": 5},
}
EXPECTED = {
    "id": "a",
    "n": "1.50",
    "big": "12345678901234567890123456789012345678",
    "b": "true",
    "l": '[{"S":"x"},{"N":"2"}]',
    "m": '{"q":{"S":"r"}}',
    "z": "null",
    "bin": "[binary data]",
    "ss": '["p","q"]',
    "ns": '["1","2"]',
    "bs": "[binary set data]",
    "u": '{"ZZ":5}',
}


def _write(tmp_path, items):
    p = tmp_path / "items.json"
    p.write_text("".join(json.dumps({"Item": it}, separators=(",", ":")) + "\n" for it in items))
    return str(p)


def test_every_tag(spark, tmp_path):
    other = {"id": {"S": "b"}}
    path = _write(tmp_path, [ITEM, other])
    flat = flatten_items(read_items_json(spark, path))
    assert flat.columns == sorted(EXPECTED)
    rows = {r["id"]: r.asDict() for r in flat.collect()}
    assert rows["a"] == EXPECTED
    # absent attribute -> SQL NULL, unlike the NULL tag -> text "null"
    assert rows["b"] == {k: ("b" if k == "id" else None) for k in EXPECTED}


def test_keep_binary_and_given_fields(spark, tmp_path):
    path = _write(tmp_path, [ITEM])
    flat = flatten_items(read_items_json(spark, path), fields=["bin", "id"], keep_binary=True)
    assert flat.columns == ["bin", "id"]
    assert flat.first().asDict() == {"bin": "hi", "id": "a"}


def test_first_tag_wins(spark, tmp_path):
    path = _write(tmp_path, [{"x": {"N": "7", "S": "s"}}, {"x": {"BOOL": False, "NULL": True}}])
    got = sorted(r["x"] for r in flatten_items(read_items_json(spark, path)).collect())
    assert got == ["false", "s"]


def test_discover_fields_counts(spark, tmp_path):
    path = _write(tmp_path, [{"a": {"S": "1"}}, {"a": {"S": "2"}, "b": {"N": "3"}}])
    items = read_items_json(spark, path)
    assert {r["field"]: r["n_items"] for r in discover_fields(items).collect()} == {"a": 2, "b": 1}
    assert field_names(items) == ["a", "b"]


def test_items_from_columns(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id long, s string")
    items = items_of(df.select(item_from_columns(
        {"id": tagged("N", F.col("id").cast("string")), "s": tagged("S", "s")}).alias("item")))
    got = sorted(tuple(r) for r in flatten_items(items).collect())
    assert got == [("1", "x"), ("2", None)]


def test_known_fields_skip_discovery_and_keep_unknown_tags(spark, tmp_path):
    path = _write(tmp_path, [ITEM])
    flat = flatten_items(read_items_json(spark, path), fields=sorted(EXPECTED))
    assert flat.first().asDict() == EXPECTED


def test_discovery_tells_which_fields_need_their_text(spark, tmp_path):
    path = _write(tmp_path, [{"a": {"S": "1"}, "b": {"ZZ": 1}, "c": "x", "d": {"N": "1"}, "e": None, "f": {"L": [{"S": "q"}]}},
                             {"a": {"BOOL": True}, "b": {"S": "y"}, "d": {"NULL": True}, "f": {"M": {"k": {"N": "1"}}}}])
    items = read_items_json(spark, path)
    assert field_needs(items) == {"a": False, "b": True, "c": True, "d": False, "e": False, "f": False}
    rows = sorted((r.asDict() for r in flatten_items(items).collect()), key=lambda r: r["a"])
    assert rows[0] == {"a": "1", "b": '{"ZZ":1}', "c": "x", "d": "1", "e": None, "f": '[{"S":"q"}]'}
    plan = flatten_items(items.drop("item")).select("a", "d")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1  # no second parse for fields that need none


def test_keep_binary_with_invalid_base64(spark, tmp_path):
    path = _write(tmp_path, [{"id": {"S": "a"}, "bin": {"B": "not base64!!"}}])
    row = flatten_items(read_items_json(spark, path), keep_binary=True).first()
    assert row["bin"] == "[binary data]"


def test_case_colliding_attribute_names(spark, tmp_path):
    import pytest
    path = _write(tmp_path, [{"id": {"S": "a"}, "Id": {"S": "b"}}])
    with pytest.raises(ValueError, match="differ only by case"):
        flatten_items(read_items_json(spark, path))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        row = flatten_items(read_items_json(spark, path)).first()
        assert (row["Id"], row["id"]) == ("b", "a")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")

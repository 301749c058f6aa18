import itertools
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import (
    ColumnCount, IsComplete, RowCount, check_rules, evaluate_rules, failed_rules,
)
from tidemark.operators.schema import (
    _kind, enforce_schema, infer_schema, schema_rows, unified_string_schema, validate_keys,
)


def test_unified_and_enforce(spark):
    a = spark.createDataFrame([(1, "x")], "b int, a string")
    b = spark.createDataFrame([(2.5,)], "c double")
    schema = unified_string_schema(a, b)
    assert [f.name for f in schema.fields] == ["a", "b", "c"]
    assert all(isinstance(f.dataType, T.StringType) and f.nullable for f in schema.fields)
    out = enforce_schema(a, schema)
    assert out.columns == ["a", "b", "c"]
    assert tuple(out.first()) == ("x", "1", None)
    assert schema_rows(schema)[0] == (1, "a", "string", True)


def test_enforce_typed_keys_and_bad_values(spark):
    df = spark.createDataFrame([(None, "12", "x"), ("k", "zz", "y")], "key string, n string, drop string")
    schema = T.StructType([T.StructField("key", T.StringType(), False),
                           T.StructField("n", T.IntegerType()),
                           T.StructField("extra", T.DateType())])
    rows = [tuple(r) for r in enforce_schema(df, schema, keys=["key"]).collect()]
    assert rows == [("NULL_key", 12, None), ("k", None, None)]


def test_infer_schema(spark):
    rows = [
        ("1", "true", "3000000000", "1.5", "2024-01-02", "2024-01-02 03:04:05", "a", None, " 7 ", "2024",
         "12345678901234567890123456789012345678", "1234567890123456789012345678901234567890"),
        ("2", "false", "-4", "2", "2024-02-03", "2024-01-02 03:04:05.5", "b", None, "8", "2025", "1", "2"),
    ]
    cols = "k b big d day ts s empty spaced year wide wider".split()
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols)).withColumn("native", F.lit(1))
    schema = infer_schema(df, "k")
    got = {f.name: (f.dataType.simpleString(), f.nullable) for f in schema.fields}
    assert schema.fields[0].name == "k" and got["k"] == ("int", False)
    assert got["b"][0] == "boolean"
    assert got["big"][0] == "bigint"
    assert got["d"][0] == "double"
    assert got["day"][0] == "date"
    assert got["ts"][0] == "timestamp"
    assert got["s"][0] == "string"
    assert got["empty"][0] == "string"
    assert got["spaced"][0] == "string"
    assert got["year"][0] == "int"
    assert got["native"] == ("int", True)
    assert got["wide"][0] == "decimal(38,0)"
    assert got["wider"][0] == "string"  # 40 digits fit no number type
    assert [f.name for f in schema.fields[1:]] == sorted(c for c in df.columns if c != "k")
    with pytest.raises(ValueError):
        infer_schema(df, "missing")


def test_validate_keys(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, j long")
    assert validate_keys(df, "j") == {"j": 0}
    with pytest.raises(ValueError):
        validate_keys(df, "k")
    with pytest.raises(ValueError):
        validate_keys(df, "k", check_data=False)
    with pytest.raises(ValueError):
        validate_keys(df, "zz")


def test_rules(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, j long")
    rules = [ColumnCount(">", 0), RowCount(">=", 3), IsComplete("k"), IsComplete("j")]
    got = {r["rule"]: (r["actual"], r["passed"]) for r in check_rules(df, rules).collect()}
    assert got == {"ColumnCount > 0": (2, True), "RowCount >= 3": (2, False),
                   'IsComplete "k"': (1, False), 'IsComplete "j"': (0, True)}
    assert sorted(failed_rules(check_rules(df, rules))) == ['IsComplete "k"', "RowCount >= 3"]
    assert evaluate_rules(df, [ColumnCount()]) == [("ColumnCount > 0", 2, True)]
    assert evaluate_rules(df, rules)[1] == ("RowCount >= 3", 2, False)


def test_infer_schema_keeps_every_digit(spark):
    rows = [("1" * 39, "9007199254740993", "00123", "5\n", "1.25", "1e5", "-0.50", "0.1234567890123456", "2024-13-40"),
            ("2", "1.5", "7", "6", "0.1", "2.5", "12", "123456789012345678901234", "2024-01-01")]
    cols = "wide mixed code newline double exp signed both date".split()
    df = spark.createDataFrame([("k", *r) for r in rows], ", ".join(f"{c} string" for c in ["k", *cols]))
    schema = infer_schema(df, "k")
    got = {f.name: f.dataType.simpleString() for f in schema.fields}
    assert got["wide"] == "string" and got["mixed"] == "decimal(17,1)" and got["code"] == "string"
    assert got["newline"] == "string" and got["double"] == "double" and got["exp"] == "double"
    assert got["signed"] == "double" and got["date"] == "string" and got["both"] == "string"
    typed = enforce_schema(df, schema)
    assert [str(r["mixed"]) for r in typed.select("mixed").collect()] == ["9007199254740993.0", "1.5"]
    wide = df.select("k", F.col("both").substr(1, 20).alias("both"))
    assert infer_schema(wide, "k")["both"].dataType.simpleString() == "decimal(36,16)"


def _kinds(spark, values):
    """value -> (bits, digits before the point, digits behind it, casts that hold), distinct values."""
    df = spark.createDataFrame([(v,) for v in sorted(set(values))], "v string")
    casts = [F.col("v").try_cast(t).isNotNull().alias(t) for t in ("int", "bigint", "date", "timestamp")]
    rows = df.select("v", _kind(F.col("v")).alias("k"), *casts).collect()
    return {r["v"]: (r["k"] & 0xFF, r["k"] >> 8 & 0xFFFFFF, r["k"] >> 32, r) for r in rows}


def test_whole_numbers_are_sorted_by_text_as_by_casts(spark):
    edges = [x + d for p in (9, 10, 15, 16, 31, 32, 63, 64) for x in (2 ** p, 10 ** min(p, 20)) for d in (-2, -1, 0, 1, 2)]
    values = [f"{sign}{abs(n)}" for n in [0, 7, *edges] for sign in ("", "-")]
    for v, (bits, before, behind, r) in _kinds(spark, values).items():
        assert bool(bits & 1) == r["int"] and bool(bits & 2) == r["bigint"], v
        assert bits & 4 and bool(bits & 8) == (len(v.lstrip("-")) <= 15) and before == len(v.lstrip("-")) and behind == 0


@pytest.mark.parametrize("value, bits, before, behind", [
    ("0.5", 12, 1, 1), ("-0.000000000000000000123", 12, 1, 21), ("0.1234567890123456", 4, 1, 16), ("1.50", 12, 1, 2),
    ("123456789012345.0", 4, 15, 1), ("1e5", 8, 0, 0), ("1.5E-300", 8, 0, 0), ("1234567890123456e2", 0, 0, 0),
    ("0.0000000000000000001e4", 8, 0, 0), ("01", 0, 0, 0), ("+1", 0, 0, 0), ("1.", 0, 0, 0), (".5", 0, 0, 0), ("-", 0, 0, 0),
    ("--1", 0, 0, 0), ("1-2", 0, 0, 0), ("", 0, 0, 0), ("true", 16, 0, 0), ("True", 0, 0, 0), ("truely", 0, 0, 0), ("true\n", 0, 0, 0),
    ("2024-01-02\n", 0, 0, 0), ("1\n", 0, 0, 0), ("٣", 0, 0, 0), ("NaN", 0, 0, 0)])
def test_other_values(spark, value, bits, before, behind):
    assert _kinds(spark, [value])[value][:3] == (bits, before, behind)


def test_days_and_times_are_those_that_casts_read(spark):
    rng = random.Random(5)
    years = ["2024", "2023", "1900", "2000", "0000", "0004", "2100", "0400"]
    days = [f"{y}-{m}-{d}" for y, m, d in itertools.product(years, ["00", "01", "02", "04", "06", "09", "11", "12", "13"],
                                                            ["00", "01", "28", "29", "30", "31", "32"])]
    times = ["", "3", "03", "23", "24", "03:04", "3:4", "03:60", "03:04:05", "03:04:5", "03:04:05.", "03:04:05.123456789", "03:04:", "1:2:3.4"]
    zones = ["", "", "", "Z", " Z", "z", "UTC", "GMT+1", "UTC+01:00", "+01:00", "+1:00", "+18:00", "+18:01", "+19:00", "+0100", "+01",
             "+01:0", "-00:30", "Europe/Paris", " Europe/Paris", "Foo/Bar", "PST", "EST", "+01:00:30", " +01:00", "UTC +1", "was a Monday"]
    values = days + [rng.choice(days) + rng.choice([" ", "T", " T", "  "]) + rng.choice(times) + rng.choice(zones) + rng.choice(["", "", "", " ", " x"])
                     for _ in range(8000)]
    seen = set()
    for v, (bits, _, _, r) in _kinds(spark, values).items():
        is_day, is_time = re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}", v), re.fullmatch(r"[0-9]{4}-[0-9]{2}-[0-9]{2}[ T].+", v)
        assert bits == (32 if is_day and r["date"] else 64 if is_time and r["timestamp"] else 0), v
        seen.add(bits)
    assert seen == {0, 32, 64}


def test_infer_wide_tables_without_casts(spark):
    n = 400
    df = spark.range(50).select(*[(F.col("id") * 10 ** (i % 17)).cast("string").alias(f"c{i:03d}") for i in range(n)])
    types = {f.name: f.dataType.simpleString() for f in infer_schema(df, "c000").fields}
    assert [types[f"c{i:03d}"] for i in (0, 7, 8, 9, 16)] == ["int", "int", "bigint", "bigint", "bigint"] and len(types) == n
    assert infer_schema(df.where("false"), "c000")["c001"].dataType == T.StringType()

"""Trees whose types changed between runs."""

import os
from datetime import timedelta
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from tests.test_landing import T1, cfg, frame
from tidemark.plans.landing import LandingError, land_table
from tidemark.plans.manifest import MANIFEST, landed_runs
from tidemark.plans.reconcile import by_schema, read_reconciled, widened

I, L, S, D, F4 = T.IntegerType(), T.LongType(), T.StringType(), T.DoubleType(), T.FloatType()


@pytest.mark.parametrize("types, want", [
    ([I, I], I), ([I, L], L), ([T.ByteType(), T.ShortType()], T.ShortType()), ([L, S], S), ([I, D], D), ([F4, I], D), ([L, D], S),
    ([T.DecimalType(10, 2), I], T.DecimalType(12, 2)), ([T.DecimalType(38, 0), T.DecimalType(5, 4)], S),
    ([T.DecimalType(5, 2), T.DecimalType(10, 0)], T.DecimalType(12, 2)), ([T.DateType(), T.TimestampType()], S), ([T.BooleanType(), I], S)])
def test_widened(types, want):
    assert widened(types) == want and widened(types[::-1]) == want


def _tree(spark, root, **kw):
    c = cfg(root, widen_types=True, **kw)
    sources = [frame(spark, [(1, 1), (2, 2)], "k int, v int"),
               frame(spark, [(2, 20), (3, 3 << 40)], "k long, v long"),
               frame(spark, [("3", None), ("x", "4.5")], "k string, v string"),
               frame(spark, [(Decimal("1"), "a"), (Decimal("7"), "b")], "k decimal(10,0), w string")]
    return [land_table(spark, c, T1 + timedelta(days=i), source=s) for i, s in enumerate(sources)]


@pytest.mark.parametrize("kw", [{}, {"key_index": True}, {"layout": "per_key"}])
def test_int_then_bigint_then_text(spark, root, kw):
    reports = _tree(spark, root, **kw)
    assert [(r.new_rows, r.error) for r in reports] == [(2, None), (1, None), (1, None), (1, None)]
    back = read_reconciled(spark, root)
    assert dict(back.dtypes)["k"] == "string" and dict(back.dtypes)["v"] == "string"
    rows = sorted((r["k"], r["v"], r["w"]) for r in back.collect())
    assert rows == [("1", "1", None), ("2", "2", None), ("3", str(3 << 40), None), ("7", None, "b"), ("x", "4.5", None)]
    assert sorted(r["k"] for r in read_reconciled(spark, root, ("k",)).collect()) == ["1", "2", "3", "7", "x"]


def test_declared_types(spark, root):
    _tree(spark, root)
    text = read_reconciled(spark, root, declared=T.StructType([T.StructField("v", T.DecimalType(20, 2))]))
    assert {r["k"]: r["v"] for r in text.collect()}["x"] == Decimal("4.50")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_reconciled(spark, root, declared=T.StructType([T.StructField("k", T.LongType())])).collect()


def test_runs_without_manifest_are_asked_for_footers(spark, root):
    _tree(spark, root)
    os.remove(os.path.join(root, "_tidemark", "runs.json"))
    for day in ("01", "03"):
        os.remove(os.path.join(root, f"2025/01/{day}/00-00-00", MANIFEST))
    known = landed_runs(spark, root)
    assert len(known.unmarked) == 2 and len(by_schema(spark, known)) == 4
    assert sorted(r["k"] for r in read_reconciled(spark, root, ("k",)).collect()) == ["1", "2", "3", "7", "x"]
    rep = land_table(spark, cfg(root, widen_types=True), T1 + timedelta(days=9), source=frame(spark, [("x", "v"), ("y", "v")]))
    assert rep.new_rows == 1


def test_one_schema_is_one_group_and_the_default_still_fails(spark, root):
    for i in range(3):
        land_table(spark, cfg(root), T1 + timedelta(days=i), source=frame(spark, [(str(i), "v")]))
    known = landed_runs(spark, root)
    (paths,) = by_schema(spark, known).values()
    assert len(paths) == 3 and len(os.listdir(os.path.join(root, "_tidemark", "schemas"))) in (1, 2)
    assert read_reconciled(spark, f"{root}-none") is None
    other = frame(spark, [(8, "v")], "k int, v string")
    land_table(spark, cfg(root), T1 + timedelta(days=3), source=other)
    with pytest.raises(LandingError):
        land_table(spark, cfg(root), T1 + timedelta(days=4), source=frame(spark, [("9", "v")]))
    assert land_table(spark, cfg(root, widen_types=True), T1 + timedelta(days=4), source=frame(spark, [("8", "v"), ("9", "v")])).new_rows == 1

"""Driver contract: entry() runs, and every query equals its oracle SQL on sf0.001."""

import importlib
import os
import sys

import pytest

from tests.oracle_check import digest, duck
from tests.conftest import SF_SMOKE
from tidemark.queries import QUERIES

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
entry = importlib.import_module("__spark_entry__")


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["conv_id", "turn", "role", "text", "processed_date", "processed_at"]
    assert len(rows) == 87


def test_every_library_query_has_oracle():
    assert set(QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, name):
    df = entry.queries()[name](spark, SF_SMOKE)
    got = digest(df.columns, [tuple(r) for r in df.collect()])
    cur = duck(SF_SMOKE).execute(entry.oracle_sql()[name])
    want = digest([c[0] for c in cur.description], cur.fetchall())
    assert got == want

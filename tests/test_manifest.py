"""Landed row counts from run manifests."""

import json
import os
import shutil
from datetime import timedelta

import pytest

from tests.test_landing import T1, cfg, frame
from tidemark.plans import landing
from tidemark.plans.landing import land_table
from tidemark.plans.manifest import MANIFEST, landed_rows, landed_runs

RUN = "2025/01/0{}/00-00-00"


@pytest.fixture
def tree(spark, root):
    for i in range(3):
        rep = land_table(spark, cfg(root), T1 + timedelta(days=i), source=frame(spark, [(f"{i}-{k}", "v") for k in range(i + 2)]))
        assert rep.error is None
    return root


def _rows(spark, root):
    return landed_rows(spark, landed_runs(spark, root))


def test_rows_without_a_job(spark, tree, monkeypatch):
    monkeypatch.setattr("tidemark.plans.manifest.read_paths", lambda spark, paths: pytest.fail("counted files") if paths else None)
    known = landed_runs(spark, tree)
    assert {r: e.rows for r, e in known.runs.items()} == {RUN.format(1): 2, RUN.format(2): 3, RUN.format(3): 4}
    assert known.unmarked == [] and _rows(spark, tree) == 9
    assert land_table(spark, cfg(tree), T1 + timedelta(days=9), source=frame(spark, [("0-0", "v")])).landed_rows == 9


def test_summary_lost_or_broken(spark, tree):
    path = os.path.join(tree, "_tidemark", "runs.json")
    for text in (None, "", "{", "[1]", '{"2025/01/01/00-00-00": 7}'):
        for f in (path, os.path.join(tree, "_tidemark", ".runs.json.crc")):
            if os.path.exists(f):
                os.remove(f)
        if text is not None:
            with open(path, "w") as f:
                f.write(text)
        assert _rows(spark, tree) == 9


def test_runs_without_manifest_are_counted(spark, tree):
    os.remove(os.path.join(tree, "_tidemark", "runs.json"))
    os.remove(os.path.join(tree, RUN.format(2), MANIFEST))
    known = landed_runs(spark, tree)
    assert sorted(known.runs) == [RUN.format(1), RUN.format(3)] and known.unmarked == [f"{tree}/{RUN.format(2)}"]
    assert landed_rows(spark, known) == 9
    rep = land_table(spark, cfg(tree), T1 + timedelta(days=9), source=frame(spark, [("1-0", "v"), ("new", "v")]))
    assert (rep.landed_rows, rep.new_rows) == (9, 1)


def test_data_elsewhere_and_removed_runs(spark, tree):
    frame(spark, [("x", "v")] * 5).write.parquet(os.path.join(tree, "old", "load"))
    frame(spark, [("y", "v")] * 2).write.mode("append").parquet(os.path.join(tree, "2025", "01"))
    frame(spark, [("z", "v")] * 4).write.parquet(os.path.join(tree, "_hidden"))
    assert _rows(spark, tree) == 9 + 7
    shutil.rmtree(os.path.join(tree, RUN.format(3)))
    assert _rows(spark, tree) == 5 + 7
    land_table(spark, cfg(tree), T1 + timedelta(days=9), source=frame(spark, [("2-0", "v"), ("x", "v")]))
    with open(os.path.join(tree, "_tidemark", "runs.json")) as f:
        assert sorted(json.load(f)) == [RUN.format(1), RUN.format(2), "2025/01/10/00-00-00"]


def test_a_manifest_that_cannot_be_written_is_reported(spark, root, monkeypatch):
    monkeypatch.setattr(landing, "record_run", lambda *a: 1 / 0)
    rep = land_table(spark, cfg(root), T1, source=frame(spark, [("1", "a")]))
    assert rep.status == "SUCCEEDED" and rep.new_rows == 1 and "without a manifest" in rep.error
    monkeypatch.undo()
    assert land_table(spark, cfg(root), T1 + timedelta(days=1), source=frame(spark, [("1", "a")])).landed_rows == 1


def test_counts_stay_with_the_per_key_layout(spark, root):
    c = cfg(root, layout="per_key")
    land_table(spark, c, T1, source=frame(spark, [(str(i), "v") for i in range(6)]))
    rep = land_table(spark, c, T1 + timedelta(days=1), source=frame(spark, [("5", "v"), ("6", "v")]))
    assert (rep.landed_rows, rep.new_rows) == (6, 1) and landed_runs(spark, root).unmarked == []

"""The landed-key index against the full anti-join, and what it reads."""

import os
import random
import shutil
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace
from datetime import timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.test_landing import T1, cfg, frame
from tidemark.operators.diff import new_records
from tidemark.plans import key_index, landing
from tidemark.plans.key_index import blocks_hit, index_run, landed_keys
from tidemark.plans.landing import land_table
from tidemark.plans.manifest import LandedRuns, landed_runs, record_run
from tidemark.sources.landed import read_landed

KEYS = ("a", "b")


def _source(spark, rng, n):
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, "", "x", "é", "x_y"]), f"v{i}") for i in range(n)]
    return frame(spark, rows, "a long, b string, v string")


@pytest.mark.parametrize("null_safe", [False, True])
def test_same_rows_as_the_full_join(spark, root, null_safe, monkeypatch):
    monkeypatch.setattr(key_index, "BLOCK_KEYS", 7)
    rng = random.Random(1)
    c = cfg(root, KEYS, null_safe=null_safe)
    for i in range(5):
        src = _source(spark, rng, 40)
        want = new_records(src, read_landed(spark, root, KEYS), KEYS, null_safe)
        want = sorted(map(str, (tuple(r) for r in want.collect())))
        rep = land_table(spark, replace(c, key_index=i not in (0, 3)), T1 + timedelta(days=i), source=src)
        assert rep.error is None and rep.new_rows == len(want)
        got = spark.read.parquet(rep.run_folder).select("a", "b", "v").collect() if want else []
        assert sorted(str(tuple(r)) for r in got) == want


def test_blocks_hold_their_keys_and_hits_name_them(spark, root, monkeypatch):
    monkeypatch.setattr(key_index, "BLOCK_KEYS", 10)
    rows = [(str(i % 90), "v") for i in range(100)]
    rep = land_table(spark, cfg(root, key_index=True), T1, source=frame(spark, rows))
    known = landed_runs(spark, root)
    (run, entry), = known.runs.items()
    assert (entry.rows, entry.blocks) == (100, 10)
    folder = Path(rep.run_folder, "_index", "keys")
    blocks = {int(p.name.split("=")[1]): [r["k"] for r in spark.read.parquet(str(p)).collect()] for p in folder.glob("block=*")}
    assert sorted(k for ks in blocks.values() for k in ks) == sorted({k for k, _ in rows})
    for block, ks in blocks.items():
        assert (run, block) in blocks_hit(spark, known, [run], frame(spark, [(ks[0], "x"), ("none", "x")]), ("k",))
    assert blocks_hit(spark, known, [run], frame(spark, [("none", "x"), (None, "x")]), ("k",)) == []
    assert read_landed(spark, root).count() == 100  # the index is no landed data


def test_other_types_and_removed_runs_fall_back(spark, root):
    land_table(spark, cfg(root, key_index=True), T1, source=frame(spark, [(1, "v"), (2, "v")], "k int, v string"))
    known = landed_runs(spark, root)
    same = frame(spark, [(1, "v"), (3, "v")], "k int, v string")
    assert [r["k"] for r in landed_keys(spark, known, same, ("k",)).collect()] in ([1], [1, 2], [2, 1])
    assert landed_keys(spark, known, same.selectExpr("CAST(k AS STRING) AS k"), ("k",)) is None
    assert landed_keys(spark, known, same.selectExpr("CAST(k AS DOUBLE) AS k"), ("k",)) is None
    text = frame(spark, [("1", "v"), ("x", "v")])
    rep = land_table(spark, cfg(root, key_index=True, layout="compact"), T1 + timedelta(days=1), source=text.where("k = '1'"))
    assert rep.new_rows == 0
    land_table(spark, cfg(root, key_index=True), T1 + timedelta(days=2), source=frame(spark, [(5, "v")], "k int, v string"))
    shutil.rmtree(Path(root, "2025", "01", "01"))
    assert land_table(spark, cfg(root, key_index=True), T1 + timedelta(days=3), source=same.unionByName(frame(spark, [(5, "v")], "k int, v string"))).new_rows == 2


def test_more_hits_than_paths(spark, root, monkeypatch):
    monkeypatch.setattr(key_index, "BLOCK_KEYS", 2)
    monkeypatch.setattr(key_index, "MAX_BLOCK_PATHS", 3)
    rows = [(str(i), "v") for i in range(40)]
    land_table(spark, cfg(root, key_index=True), T1, source=frame(spark, rows[:30]))
    assert land_table(spark, cfg(root, key_index=True), T1 + timedelta(days=1), source=frame(spark, rows)).new_rows == 10


def test_floating_keys_are_not_indexed(spark, root):
    src = frame(spark, [(-0.0, "v"), (float("nan"), "v")], "k double, v string")
    land_table(spark, cfg(root, key_index=True), T1, source=src)
    assert [e.blocks for e in landed_runs(spark, root).runs.values()] == [0]
    again = frame(spark, [(0.0, "v"), (float("nan"), "v"), (1.0, "v")], "k double, v string")
    assert land_table(spark, cfg(root, key_index=True), T1 + timedelta(days=1), source=again).new_rows == 1


def test_an_index_that_cannot_be_written_is_reported(spark, root, monkeypatch):
    monkeypatch.setattr(landing, "index_run", lambda *a: 1 / 0)
    rep = land_table(spark, cfg(root, key_index=True), T1, source=frame(spark, [("1", "a")]))
    assert rep.new_rows == 1 and "without a key index" in rep.error
    monkeypatch.undo()
    assert land_table(spark, cfg(root, key_index=True), T1 + timedelta(days=1), source=frame(spark, [("1", "a")])).new_rows == 0


def test_bytes_read_on_a_hundred_runs(spark, root):
    """A source of one run's size, 1% of it new: a tenth of the bytes of all landed keys at most."""
    runs, n = 100, 4000
    key = F.sha2(F.col("id").cast("string"), 256).substr(1, 36)  # as long as a UUID, and no shorter in Parquet
    tree = spark.range(0, runs * n, numPartitions=runs).select(key.alias("k"), F.col("id").alias("v"), F.floor(F.col("id") / n).alias("run"))
    tree.write.partitionBy("run").parquet(f"{root}-tmp")

    def add(i):
        folder = f"{root}/2025/01/01/00-{i // 60:02d}-{i % 60:02d}"
        shutil.copytree(f"{root}-tmp/run={i}", folder)
        return folder, index_run(spark, folder, ("k",), n)

    with ThreadPoolExecutor(8) as pool:
        done = {folder: entry for folder, entry in pool.map(add, range(runs))}
    first, *others = sorted(done)
    record_run(spark, LandedRuns(root, {f[len(root) + 1:]: done[f] for f in others}, []), first, done[first])
    known = landed_runs(spark, root)
    assert len(known.runs) == runs and not known.unmarked
    src = spark.range(7 * n + 40, 8 * n + 40).select(F.when(F.col("id") < 8 * n, key).otherwise(F.lit(str(uuid.uuid4()))).alias("k"))
    data = sum(pq.ParquetFile(f).metadata.row_group(0).column(0).total_compressed_size for f in Path(root).glob("2025/01/01/*/part-*.parquet"))
    prints = sum(os.path.getsize(f) for f in Path(root).glob("2025/01/01/*/_index/prints-*/part-*.parquet"))
    found = landed_keys(spark, known, src, ("k",))
    opened = sum(os.path.getsize(f.removeprefix("file:")) for f in found.inputFiles())
    assert src.join(found, "k", "left_anti").count() == 40
    assert data >= 36 * runs * n and (prints + opened) * 10 <= data, (data, prints, opened)

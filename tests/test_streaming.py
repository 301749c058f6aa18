"""Micro-batch landing: one run folder per batch, replays land nothing twice."""

import json
import os
from datetime import datetime

from tidemark.config import TableConfig
from tidemark.sources.landed import read_landed
from tidemark.streaming.landing import epoch_run_time, land_stream


def _export(folder, name, ids):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for i in ids:
            fh.write(json.dumps({"Item": {"id": {"N": str(i)}, "v": {"S": f"v{i}"}}},
                                separators=(",", ":")) + "\n")


def _run(query):
    query.awaitTermination()
    query.stop()


def test_epoch_run_time_is_stable_and_increasing(spark, tmp_path):
    ck = str(tmp_path / "ck")
    fixed = lambda: datetime(2025, 1, 1, 0, 0, 0)
    t0 = epoch_run_time(spark, ck, 0, fixed)
    t1 = epoch_run_time(spark, ck, 1, fixed)
    assert t0 == datetime(2025, 1, 1) and t1 == datetime(2025, 1, 1, 0, 0, 1)
    assert epoch_run_time(spark, ck, 0, fixed) == t0  # replay


def test_stream_lands_each_batch_once(spark, tmp_path):
    src, root, ck = str(tmp_path / "src"), str(tmp_path / "landed"), str(tmp_path / "ck")
    _export(src, "a.json", [1, 2, 3])
    _export(src, "b.json", [3, 4])  # key 3 again: not landed twice
    cfg = TableConfig("s", root, "id", src)
    _run(land_stream(spark, cfg, src, ck, max_files_per_trigger=1))
    ids = sorted(r["id"] for r in read_landed(spark, root).collect())
    assert ids == ["1", "2", "3", "4"]
    assert len({r["processed_at"] for r in read_landed(spark, root).collect()}) == 2

    # restart: only the new file is processed
    _export(src, "c.json", [5, 1])
    _run(land_stream(spark, cfg, src, ck, max_files_per_trigger=1))
    ids = sorted(r["id"] for r in read_landed(spark, root).collect())
    assert ids == ["1", "2", "3", "4", "5"]


def test_replayed_epoch_lands_nothing_twice(spark, tmp_path):
    src, root, ck = str(tmp_path / "src"), str(tmp_path / "landed"), str(tmp_path / "ck")
    _export(src, "a.json", [1, 2])
    cfg = TableConfig("r", root, "id", src)
    _run(land_stream(spark, cfg, src, ck))
    first = sorted((r["id"], r["processed_at"]) for r in read_landed(spark, root).collect())
    # forget that batch 0 was committed: the restart runs epoch 0 again
    for name in ("0", ".0.crc"):
        path = os.path.join(ck, "commits", name)
        if os.path.exists(path):
            os.remove(path)
    _run(land_stream(spark, cfg, src, ck))
    assert os.path.exists(os.path.join(ck, "commits", "0"))  # epoch 0 ran and committed again
    again = sorted((r["id"], r["processed_at"]) for r in read_landed(spark, root).collect())
    assert again == first


def test_a_folder_of_another_run_does_not_swallow_a_batch(spark, tmp_path):
    from tidemark.plans.landing import land_table

    src, root, ck = str(tmp_path / "src"), str(tmp_path / "landed"), str(tmp_path / "ck")
    at = datetime(2025, 1, 1)
    other = spark.createDataFrame([("99", "v")], "id string, v string")
    land_table(spark, TableConfig("s", root, "id", src), at, source=other)  # finished in the same second
    _export(src, "a.json", [1, 2, 3])
    query = land_stream(spark, TableConfig("s", root, "id", src), src, ck, clock=lambda: at)
    _run(query)
    assert query.exception() is None
    assert sorted(r["id"] for r in read_landed(spark, root).collect()) == ["1", "2", "3", "99"]


def test_unfinished_marker_is_not_read(spark, tmp_path):
    ck = str(tmp_path / "ck")
    fixed = lambda: datetime(2025, 1, 1, 0, 0, 0)
    os.makedirs(os.path.join(ck, "tidemark-runs"))
    open(os.path.join(ck, "tidemark-runs", "0"), "w").close()  # a crash left it empty
    assert epoch_run_time(spark, ck, 0, fixed) == fixed()
    for epoch in range(1, 6):
        epoch_run_time(spark, ck, epoch, fixed)
    left = {f for f in os.listdir(os.path.join(ck, "tidemark-runs")) if not f.startswith(".")}
    assert left == {"4", "5", "latest"}

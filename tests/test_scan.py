"""Segmented scan source with the offline paged client."""

import json
import os
from datetime import datetime

import pytest

from tidemark.operators.flatten import flatten_items
from tests.scan_clients import ExportFolderClient
from tidemark.config import TableConfig
from tidemark.plans.landing import land_table
from tidemark.session import checkpoint_root
from tidemark.sources.landed import read_landed
from tidemark.sources.scan import PageLog, read_items_scan, scan_options

FACTORY = "scan_clients:ExportFolderClient"
LOGGING = "scan_clients:LoggingExportFolderClient"


@pytest.fixture(autouse=True)
def shipped(spark):
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "scan_clients.py"))


@pytest.fixture
def export(tmp_path):
    folder = tmp_path / "export"
    folder.mkdir()
    n = 0
    for page in range(7):
        with open(folder / f"part-{page:03d}.json", "w") as fh:
            for _ in range(page + 1):
                fh.write(json.dumps({"Item": {"id": {"N": str(n)}, "p": {"S": f"page{page}"}}}) + "\n")
                n += 1
    (folder / "_SUCCESS").write_text("")
    return str(folder), n


@pytest.mark.parametrize("page_items", [1, 2, 500])
def test_client_pages(export, page_items):
    folder, n = export
    client = ExportFolderClient(folder, page_items)
    seen, start = [], None
    while True:
        kw = {"ExclusiveStartKey": start} if start else {}
        page = client.scan(TableName="t", Segment=1, TotalSegments=3, **kw)
        assert len(page["Items"]) <= page_items
        seen += page["Items"]
        start = page.get("LastEvaluatedKey")
        if not start:
            break
    assert sorted(i["p"]["S"] for i in seen) == ["page1"] * 2 + ["page4"] * 5


@pytest.mark.parametrize("segments", [1, 3, 10])
def test_all_segments_give_each_item_once(spark, export, segments):
    folder, n = export
    live = read_items_scan(spark, "t", FACTORY, segments=segments, stage=False, path=folder)
    assert live.rdd.getNumPartitions() == segments
    items = read_items_scan(spark, "t", FACTORY, segments=segments, path=folder)
    ids = sorted(int(r["id"]) for r in flatten_items(items).collect())
    assert ids == list(range(n))


def test_bad_factory(spark, export):
    folder, _ = export
    with pytest.raises(Exception):
        read_items_scan(spark, "t", "no_colon", segments=1, path=folder).collect()


def test_staged_scan_reads_the_table_once(spark, export, tmp_path):
    folder, n = export
    log = str(tmp_path / "calls.log")
    items = read_items_scan(spark, "t", LOGGING,
                            segments=3, path=folder, log=log)
    flat = flatten_items(items)          # field discovery pass
    assert flat.count() == n             # second pass over the items
    assert len(flat.collect()) == n      # third
    with open(log) as fh:
        calls = fh.read().split()
    assert len(calls) == 7 and len(set(calls)) == 7   # 7 pages, each served once


def test_unstaged_scan_reads_again_per_pass(spark, export, tmp_path):
    folder, n = export
    log = str(tmp_path / "calls.log")
    items = read_items_scan(spark, "t", LOGGING,
                            segments=3, stage=False, path=folder, log=log)
    assert flatten_items(items).count() == n   # discovery + count: two scans of the table
    with open(log) as fh:
        assert len(fh.read().split()) > 7


def _scans(folder):
    local = "/" + folder.removeprefix("file:").lstrip("/")
    return [d for d in os.listdir(local) if d.startswith("scan-")] if os.path.isdir(local) else []


def test_scan_as_a_configured_source(spark, export, tmp_path):
    """Lands a scanned table; the staged copy is gone afterwards and the table was read once."""
    folder, n = export
    log = str(tmp_path / "calls.log")
    c = TableConfig("t", str(tmp_path / "landed"), "id", "t", source_format="items_scan",
                    options={"client_factory": LOGGING, "segments": "3", "client.path": folder, "client.log": log})
    staged = os.path.join(checkpoint_root(spark), "tidemark")
    before = set(_scans(staged))
    assert land_table(spark, c).new_rows == n
    assert read_landed(spark, c.root).count() == n
    with open(log) as fh:
        assert len(fh.read().split()) == 7
    assert set(_scans(staged)) == before


def test_scan_options_are_checked():
    assert scan_options({"client_factory": "a:b", "segments": "2", "client.x": "y"}) == {"client_factory": "a:b", "segments": 2, "x": "y"}
    with pytest.raises(ValueError, match="segmnts"):
        scan_options({"client_factory": "a:b", "segmnts": "2"})
    with pytest.raises(ValueError, match="client_factory"):
        TableConfig("t", "/r", "id", "t", source_format="items_scan")


FAILING = "tidemark.sources.offline:FailingExportFolderClient"


def _failing(spark, folder, log, root=None, **kw):
    return TableConfig("t", root, "id", "t", source_format="items_scan", options={
        "client_factory": FAILING, "segments": "2", "client.path": folder, "client.log": log, "client.page_items": "2",
        "client.fail_page": "3", **kw})


def test_another_attempt_asks_for_later_pages_only(spark, export, tmp_path, root):
    folder, n = export
    log = str(tmp_path / "log")
    cfg = _failing(spark, folder, log, root, resume="true")
    run_at = datetime(2025, 1, 1)
    for _ in range(3):  # each segment fails once; local mode tries a task once
        try:
            report = land_table(spark, cfg, run_at)
            break
        except Exception as e:
            assert "the table is away" in str(e)
    assert report.new_rows == n
    asked = [line.strip() for line in open(log)]
    assert len(asked) == len(set(asked))  # no page twice, in any attempt
    progress = f"{checkpoint_root(spark).removeprefix('file:')}/tidemark/scan-progress"
    assert not os.path.exists(progress) or not os.listdir(progress)


def test_without_resume_the_segment_starts_again(spark, export, tmp_path, root):
    folder, n = export
    log = str(tmp_path / "log")
    for _ in range(3):
        try:
            assert land_table(spark, _failing(spark, folder, log, root), datetime(2025, 1, 1)).new_rows == n
            break
        except Exception as e:
            assert "the table is away" in str(e)
    asked = [line.strip() for line in open(log)]
    assert len(asked) > len(set(asked))


def test_pages_are_kept_once_and_used_on_their_own_path_only(tmp_path):
    log = PageLog(str(tmp_path / "p"), 0, 2)
    log.put(0, None, ["a", "é\n"], {"k": 1})
    log.put(0, None, ["other"], {"k": 2})
    assert log.get(0, None) == (["a", "é\n"], {"k": 1})
    assert log.get(0, {"k": 9}) is None and log.get(1, {"k": 1}) is None
    assert PageLog(f"file:{tmp_path}/p", 0, 2).get(0, None) == (["a", "é\n"], {"k": 1})
    assert PageLog(str(tmp_path / "p"), 0, 3).get(0, None) is None


def test_launcher_query_scans_with_every_core(spark, monkeypatch):
    """Before: four segments and four export files whatever the cluster, so the scan did not grow with it."""
    from tests.conftest import SF_SMOKE
    from tidemark import queries

    seen, plain = [], queries.config_from_entry

    def watched(entry, scheme):
        path = entry["options"]["client.path"].removeprefix("file:")
        seen.append((int(entry["options"]["segments"]), len([f for f in os.listdir(path) if f.startswith("part-")])))
        return plain(entry, scheme)

    monkeypatch.setattr(queries, "config_from_entry", watched)
    rows = queries.q_land_from_args(spark, SF_SMOKE).count()
    cores = spark.sparkContext.defaultParallelism
    assert cores > 4 and seen == [(cores, cores)] * 2
    assert rows == spark.read.parquet(f"{SF_SMOKE}/events.parquet").count()

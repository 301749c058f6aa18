"""The change feed of a live table: stops, restarts, ranges and refusals."""

import json
import os
from datetime import datetime

import pytest
from pyspark.errors import StreamingQueryException

from tidemark.config import TableConfig
from tidemark.sources.changes import ChangeFeedError, ItemChangesReader
from tidemark.sources.landed import read_landed
from tidemark.streaming.landing import land_changes

FACTORY = "tidemark.sources.offline:LoggingExportFolderClient"
NOW = lambda: datetime(2025, 1, 1)


def _add(folder, name, ids):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        for i in ids:
            fh.write(json.dumps({"Item": {"id": {"N": str(i)}, "v": {"S": f"v{i}"}}}) + "\n")


def _round(spark, tmp_path, **kw):
    src, root, ck, log = (str(tmp_path / x) for x in ("src", "landed", "ck", "log"))
    query = land_changes(spark, TableConfig("s", root, "id", src), "t", ck, FACTORY, segments=2,
                         client_options={"path": src, "log": log, "page_items": 3}, clock=NOW, **kw)
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return sorted(int(r["id"]) for r in read_landed(spark, root).collect())


def _asked(tmp_path):
    with open(tmp_path / "log") as f:
        return [tuple(map(int, line.split(":")[1:])) for line in f if line.startswith("changes")]


def test_each_change_lands_once_over_restarts(spark, tmp_path):
    _add(tmp_path / "src", "a.json", range(0, 10))
    _add(tmp_path / "src", "b.json", range(10, 17))
    assert _round(spark, tmp_path, range_items=4) == list(range(17))
    first = set(_asked(tmp_path))
    assert {(s, e) for g, s, e in first if g == 0} >= {(0, 4), (4, 8), (8, 10)}  # ranges of a backlog are tasks of their own
    _add(tmp_path / "src", "c.json", range(15, 25))  # 15 and 16 are landed already
    _add(tmp_path / "src", "d.json", [30])
    assert _round(spark, tmp_path) == [*range(25), 30]
    later = _asked(tmp_path)[len(first):]
    assert all(start >= 10 for g, start, _ in later if g == 0) and all(start >= 7 for g, start, _ in later if g == 1)
    before = len(_asked(tmp_path))
    assert _round(spark, tmp_path) == [*range(25), 30] and len(_asked(tmp_path)) == before


def test_a_stop_in_the_middle_of_a_batch(spark, tmp_path, monkeypatch):
    from tidemark.streaming import landing

    _add(tmp_path / "src", "a.json", range(20))
    plain, calls = landing.land_table, []

    def stopped(*a, **kw):
        calls.append(1)
        if len(calls) == 1:
            raise RuntimeError("stopped before landing")
        report = plain(*a, **kw)
        if len(calls) == 2:
            raise RuntimeError("stopped after landing")
        return report

    monkeypatch.setattr(landing, "land_table", stopped)
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            _round(spark, tmp_path)
        _add(tmp_path / "src", "b.json", range(20, 25))  # what comes meanwhile belongs to the next batch
    # the interrupted batch first, once; a run that ends with what is there may leave newer changes to the next one
    assert _round(spark, tmp_path) in (list(range(20)), list(range(25)))
    assert _round(spark, tmp_path) == list(range(25)) and len(calls) >= 3


def test_ranges_and_refusals():
    reader = ItemChangesReader({"table": "t", "segments": "2", "client_factory": FACTORY, "range_items": "5"})
    assert reader.initialOffset() == {"0": 0, "1": 0}
    parts = reader.partitions({"0": 0, "1": 4}, {"0": 12, "1": 4})
    assert [(p.segment, p.start, p.end) for p in parts] == [(0, 0, 5), (0, 5, 10), (0, 10, 12)]
    with pytest.raises(ChangeFeedError):
        reader.partitions({"0": 5, "1": 0}, {"0": 4, "1": 0})
    with pytest.raises(ChangeFeedError):
        reader.partitions({"0": 0}, {"0": 4})
    with pytest.raises(ValueError):
        ItemChangesReader({"table": "t", "segments": "0", "client_factory": FACTORY})


def test_reading_grows_with_the_changes(tmp_path, monkeypatch):
    """Every line is read about once by the ranges of a backlog, however many pages and ranges there are."""
    import builtins

    from tidemark.sources import offline

    monkeypatch.setattr(offline, "MARK_ITEMS", 7)
    _add(tmp_path / "src", "a.json", range(0, 150))
    _add(tmp_path / "src", "b.json", range(500, 503))
    (tmp_path / "src" / "c.json").write_text("\n \n" + "".join(json.dumps({"Item": {"id": {"N": str(i)}}}) + "\n\n" for i in range(150, 290)))
    reader = ItemChangesReader({"table": "t", "segments": "2", "client_factory": "tidemark.sources.offline:ExportFolderClient",
                                "range_items": "20", "client.path": str(tmp_path / "src"), "client.page_items": "3"})
    end, read = reader.latestOffset(), []
    assert end == {"0": 290, "1": 3}

    class Counting:
        def __init__(self, fh):
            self.fh = fh

        def __enter__(self):
            return self

        def __exit__(self, *a):
            self.fh.close()

        def __iter__(self):
            return iter(self.readline, b"")

        def readline(self):
            line = self.fh.readline()
            read.append(line)
            return line

        def __getattr__(self, name):
            return getattr(self.fh, name)

    monkeypatch.setattr(offline, "open", lambda *a: Counting(builtins.open(*a)), raising=False)
    got = {}
    for part in reader.partitions(reader.initialOffset(), end):
        got.setdefault(part.segment, []).extend(
            int(json.loads(x)["Item"]["id"]["N"]) for b in reader.read(part) for x in b.column(0).to_pylist())
    assert got == {0: list(range(290)), 1: [500, 501, 502]}
    assert len(read) < 2 * (290 + 145 + 3)  # before: the whole segment for every page, over 14,000 lines
    reader.asked = None  # a batch planned by an earlier process: tasks find their own places
    again = [json.loads(x)["Item"]["id"]["N"] for p in reader.partitions({"0": 147, "1": 0}, {"0": 153, "1": 0}) for b in reader.read(p) for x in b.column(0).to_pylist()]
    assert again == [str(i) for i in range(147, 153)]

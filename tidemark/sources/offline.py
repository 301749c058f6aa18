"""Offline paged clients for the scan and change sources: an export folder stands in for a live table."""

from __future__ import annotations

import json
import os
from functools import lru_cache

#: Items between two places of a file that are kept.
MARK_ITEMS = 10_000


def _items(path: str) -> tuple[int, list[int]]:
    """(items in a file, byte where every ``MARK_ITEMS``-th begins); read once by a process while the file is the same."""
    known = os.stat(path)
    return _count_items(path, known.st_size, known.st_mtime_ns)


@lru_cache(maxsize=4096)
def _count_items(path: str, size: int, changed: int) -> tuple[int, list[int]]:
    n, at, marks = 0, 0, []
    with open(path, "rb") as fh:
        for line in fh:
            if line.strip():
                if n % MARK_ITEMS == 0:
                    marks.append(at)
                n += 1
            at += len(line)
    return n, marks


class ExportFolderClient:
    """Paged client over a local folder of export files (one JSON item per line).

    Segment ``s`` of ``n`` owns the files ``i`` with ``i % n == s`` in name
    order. A page holds at most ``page_items`` items of one file; its key is
    the file and the byte it ends at. As a change feed, a segment's items are
    numbered in that order; files that come later must sort behind the others.
    ``places`` and ``NextPlace`` let a reader go on without counting from the first.
    """

    def __init__(self, path: str, page_items: int | str = 500):
        root = path[len("file:"):] if path.startswith("file:") else path
        root = "/" + root.lstrip("/")
        self.page_items = int(page_items)
        self.files = sorted(os.path.join(root, f) for f in os.listdir(root) if not f.startswith((".", "_")))

    def scan(self, TableName, Segment=0, TotalSegments=1, ExclusiveStartKey=None):
        mine = [i for i in range(len(self.files)) if i % TotalSegments == Segment]
        at, offset = (ExclusiveStartKey["file"], ExclusiveStartKey["offset"]) if ExclusiveStartKey else (mine[0] if mine else -1, 0)
        if at < 0:
            return {"Items": []}
        items, end = [], True
        with open(self.files[at], "rb") as fh:
            fh.seek(offset)
            for line in iter(fh.readline, b""):
                if line.strip():
                    items.append(json.loads(line)["Item"])
                if len(items) == self.page_items:
                    end = not fh.read(1)
                    break
            if not end:
                return {"Items": items, "LastEvaluatedKey": {"file": at, "offset": fh.tell() - 1}}
        later = [i for i in mine if i > at]
        out = {"Items": items}
        if later:
            out["LastEvaluatedKey"] = {"file": later[0], "offset": 0}
        return out

    def latest(self, TableName, Segment=0, TotalSegments=1):
        return sum(_items(self.files[i])[0] for i in range(Segment, len(self.files), TotalSegments))

    def places(self, TableName, Starts, Segment=0, TotalSegments=1):
        """(file, byte, changes to skip from there) where each of the ascending ``Starts`` is found."""
        out, mine, before = [], range(Segment, len(self.files), TotalSegments), 0
        at = iter(mine)
        file = next(at, None)
        for start in Starts:
            while file is not None and before + _items(self.files[file])[0] <= start:
                before += _items(self.files[file])[0]
                file = next(at, None)
            if file is None:
                out.append((len(self.files), 0, 0))
            else:
                mark, skip = divmod(start - before, MARK_ITEMS)
                out.append((file, _items(self.files[file])[1][mark], skip))
        return out

    def changes(self, TableName, Start, End, Segment=0, TotalSegments=1, Place=None):
        file, byte, skip = Place or self.places(TableName, [Start], Segment, TotalSegments)[0]
        items, most = [], min(End - Start, self.page_items)
        while file < len(self.files) and len(items) < most:
            with open(self.files[file], "rb") as fh:
                fh.seek(byte)
                for line in iter(fh.readline, b""):
                    if line.strip():
                        if skip:
                            skip -= 1
                            continue
                        items.append(json.loads(line)["Item"])
                        if len(items) == most:
                            byte = fh.tell()
                            break
                else:
                    file, byte = file + TotalSegments, 0
        return {"Items": items, "Next": Start + len(items), "NextPlace": (file, byte, 0)}


class LoggingExportFolderClient(ExportFolderClient):
    """ExportFolderClient that appends each page it serves to ``log`` (one line per call)."""

    def __init__(self, path: str, log: str, page_items: int | str = 500):
        super().__init__(path, page_items)
        self.log = log

    def _note(self, *parts) -> None:
        with open(self.log, "a", encoding="utf-8") as fh:
            fh.write(":".join(map(str, parts)) + "\n")

    def scan(self, **kwargs):
        page = super().scan(**kwargs)
        start = kwargs.get("ExclusiveStartKey") or {}
        self._note(kwargs.get("Segment"), start.get("file", -1), start.get("offset", 0))
        return page

    def changes(self, **kwargs):
        self._note("changes", kwargs.get("Segment"), kwargs["Start"], kwargs["End"])
        return super().changes(**kwargs)


class FailingExportFolderClient(LoggingExportFolderClient):
    """Logs as above, and fails once in each segment, at the page numbered ``fail_page`` of it (a file in ``log`` + folder tells)."""

    def __init__(self, path: str, log: str, page_items: int | str = 500, fail_page: int | str = 2):
        super().__init__(path, log, page_items)
        self.fail_page, self.served = int(fail_page), 0

    def scan(self, **kwargs):
        failed = f"{self.log}.failed-{kwargs.get('Segment')}"
        if self.served == self.fail_page and not os.path.exists(failed):
            open(failed, "w").close()
            raise ConnectionError("the table is away")
        self.served += 1
        return super().scan(**kwargs)

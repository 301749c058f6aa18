"""Parallel segmented scan of a key-value table as a Python Data Source.

Each scan segment is one input partition, read by one task that follows
the pages (``LastEvaluatedKey``) until the segment is done. Rows are the
export line text ``{"Item": {...}}``, parsed afterwards by
:func:`tidemark.sources.items.parse_items`.

The client is built on the executor from ``client_factory``
(``"module:callable"``) with the options prefixed ``client.`` as keyword
arguments; it must offer ``scan(TableName=, Segment=, TotalSegments=,
ExclusiveStartKey=)`` returning ``{"Items": [...], "LastEvaluatedKey": ...}``.
This module imports nothing else from the package, so it can be shipped to
workers by value.

With a ``progress`` folder every page is kept there until the scan is over:
a task that is tried again, or a whole run that is, takes the pages it has
from there and asks the table only for those after them.
"""

from __future__ import annotations

import base64
import importlib
import json
import uuid

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

FORMAT_NAME = "items_scan"


def _json_default(o):
    if isinstance(o, (bytes, bytearray)):
        return base64.b64encode(bytes(o)).decode("ascii")
    if isinstance(o, (set, frozenset)):
        return sorted(o)
    return str(o)


def _resolve(spec: str):
    module, _, attr = spec.partition(":")
    if not attr:
        raise ValueError(f"client_factory must look like 'module:callable', got {spec!r}")
    obj = importlib.import_module(module)
    for part in attr.split("."):
        obj = getattr(obj, part)
    return obj


class PageLog:
    """Pages of one segment in a shared folder, numbered from 0, each with the key it started from and the next one.

    A page is written aside and moved into place, once: a page that is there
    stays, and is used only by a scan that has come to the same key. The
    folder is any that pyarrow's file systems reach by URI or path.
    """

    def __init__(self, folder: str, segment: int, total: int):
        from pyarrow import fs

        if folder.startswith(("/", "file:")):
            folder = "file:///" + folder.removeprefix("file:").lstrip("/")
        self.fs, base = fs.FileSystem.from_uri(folder)
        self.folder = f"{base.rstrip('/')}/segment-{segment}-of-{total}"
        self.fs.create_dir(self.folder, recursive=True)
        self._is_file = lambda path: self.fs.get_file_info(path).type == fs.FileType.File

    def _path(self, page: int) -> str:
        return f"{self.folder}/page-{page:09d}.json"

    def get(self, page: int, start) -> tuple[list[str], object] | None:
        path = self._path(page)
        if not self._is_file(path):
            return None
        with self.fs.open_input_stream(path) as stream:
            kept = json.loads(stream.read())
        return (kept["lines"], kept["next"]) if kept["start"] == start else None

    def put(self, page: int, start, lines: list[str], following) -> None:
        path = self._path(page)
        if self._is_file(path):
            return
        aside = f"{path}.{uuid.uuid4().hex}.tmp"
        with self.fs.open_output_stream(aside) as stream:
            stream.write(json.dumps({"start": start, "next": following, "lines": lines}).encode())
        self.fs.move(aside, path)


class SegmentPartition(InputPartition):
    def __init__(self, segment: int, total: int):
        super().__init__(segment)
        self.segment = segment
        self.total = total


class ItemScanReader(DataSourceReader):
    def __init__(self, options: dict):
        opts = {k.lower(): v for k, v in options.items()}
        self.table = opts["table"]
        self.segments = int(opts.get("segments", "1"))
        if self.segments < 1:
            raise ValueError("segments must be >= 1")
        self.factory = opts["client_factory"]
        self.progress = opts.get("progress")
        self.client_kwargs = {k[len("client."):]: v for k, v in opts.items() if k.startswith("client.")}

    def partitions(self):
        return [SegmentPartition(i, self.segments) for i in range(self.segments)]

    def read(self, partition: SegmentPartition):
        """One Arrow record batch per page (no per-row conversion into the JVM)."""
        import pyarrow as pa

        client = None
        log = PageLog(self.progress, partition.segment, partition.total) if self.progress else None
        start, number = None, 0
        while True:
            kept = log.get(number, start) if log else None
            if kept is None:
                client = client or _resolve(self.factory)(**self.client_kwargs)
                kwargs = {"TableName": self.table, "Segment": partition.segment,
                          "TotalSegments": partition.total}
                if start:
                    kwargs["ExclusiveStartKey"] = start
                page = client.scan(**kwargs)
                lines = [json.dumps({"Item": item}, separators=(",", ":"), default=_json_default)
                         for item in page.get("Items", [])]
                following = page.get("LastEvaluatedKey")
                if log:
                    log.put(number, start, lines, following)
            else:
                lines, following = kept
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, type=pa.string())], names=["value"])
            start, number = following, number + 1
            if not start:
                return


class ItemScanDataSource(DataSource):
    """``spark.read.format("items_scan").option("table", ...).option("segments", n)
    .option("client_factory", "pkg.mod:make_client").option("client.region", ...).load()``"""

    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        return "value string"

    def reader(self, schema):
        return ItemScanReader(self.options)


def register(spark) -> None:
    """Make ``format("items_scan")`` available in this session (and the package in its workers)."""
    from tidemark.session import ship_package

    ship_package(spark)
    spark.dataSource.register(ItemScanDataSource)


#: Options of a scan besides those prefixed ``client.``.
SCAN_OPTIONS = ("client_factory", "segments", "resume")


def scan_options(options: dict) -> dict:
    """Keyword arguments of :func:`read_items_scan` from a table's options; unknown names raise."""
    client = {k[len("client."):]: v for k, v in options.items() if k.startswith("client.")}
    rest = {k: v for k, v in options.items() if not k.startswith("client.")}
    unknown = sorted(set(rest) - set(SCAN_OPTIONS))
    if unknown:
        raise ValueError(f"unknown scan options {unknown}; known: {sorted(SCAN_OPTIONS)} and client.*")
    if "segments" in rest:
        rest["segments"] = int(rest["segments"])
    rest.pop("resume", None)  # for land_table
    return {**rest, **client}


def read_items_scan(spark, table: str, client_factory: str, segments: int | None = None,
                    stage: bool = True, staging_folder: str | None = None, progress: str | None = None, **client_options):
    """Scan a table with ``segments`` parallel tasks; returns ``item``, ``raw`` like read_items_json.

    ``segments`` defaults to the session's default parallelism (one segment
    per available core).

    With ``stage`` (default) the scanned lines are written once to
    ``staging_folder`` (by default a new one under the session's shared
    checkpoint folder), so field discovery and landing read one consistent
    snapshot and the live table is scanned a single time. Who names the folder
    removes it; ``land_table`` does when the run ends. ``progress`` keeps the
    pages read so far (see :class:`PageLog`); start keys must be JSON values.
    The folder belongs to one scan: a later one with it reads the old pages.
    """
    from tidemark.session import scratch_folder
    from tidemark.sources.items import parse_items

    register(spark)
    if segments is None:
        segments = spark.sparkContext.defaultParallelism
    reader = (
        spark.read.format(FORMAT_NAME)
        .option("table", table)
        .option("segments", str(segments))
        .option("client_factory", client_factory)
    )
    if progress:
        reader = reader.option("progress", progress)
    for k, v in client_options.items():
        reader = reader.option(f"client.{k}", str(v))
    lines = reader.load()
    if stage:
        folder = staging_folder or scratch_folder(spark, "scan")
        lines.write.parquet(folder)
        lines = spark.read.schema(lines.schema).parquet(folder)
    return parse_items(lines)

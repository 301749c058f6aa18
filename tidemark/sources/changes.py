"""The change feed of a key-value table as a streaming Python Data Source.

A client built from ``client_factory`` (see :mod:`tidemark.sources.scan`)
offers, per segment, ``latest(TableName=, Segment=, TotalSegments=)``, the
number of changes so far, and ``changes(TableName=, Segment=, TotalSegments=,
Start=, End=)``, a page ``{"Items": [...], "Next": n}`` of the changes from
``Start`` on, never beyond ``End``. The same range must give the same items as
long as the stream may ask for it again. A page may hold ``NextPlace``, which
the following call gets back as ``Place=``, and a client may offer
``places(TableName=, Segment=, TotalSegments=, Starts=)``, the places where
numbers are found, so that no task has to count a feed from its beginning.

A stream offset holds one number per segment, so a batch is a range of each
segment. Ranges are cut into tasks of at most ``range_items`` changes: a
backlog is read in parallel, and a lost task reads its own range again.
"""

from __future__ import annotations

import json

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tidemark.sources.scan import _json_default, _resolve

FORMAT_NAME = "items_changes"
RANGE_ITEMS = 100_000


class ChangeRange(InputPartition):
    def __init__(self, segment: int, start: int, end: int, place=None):
        super().__init__((segment, start, end))
        self.segment, self.start, self.end, self.place = segment, start, end, place


class ChangeFeedError(RuntimeError):
    """The feed went backwards, stopped short of a range, or has other segments than the stream began with."""


class ItemChangesReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        opts = {k.lower(): v for k, v in options.items()}
        self.table = opts["table"]
        self.segments = int(opts.get("segments", "1"))
        self.range_items = int(opts.get("range_items", RANGE_ITEMS))
        if self.segments < 1 or self.range_items < 1:
            raise ValueError("segments and range_items must be >= 1")
        self.factory = opts["client_factory"]
        self.client_kwargs = {k[len("client."):]: v for k, v in opts.items() if k.startswith("client.")}
        self.asked = None  # stays with the driver

    def __getstate__(self):
        return {**self.__dict__, "asked": None}

    def _client(self):
        return _resolve(self.factory)(**self.client_kwargs)

    def initialOffset(self) -> dict:
        return {str(s): 0 for s in range(self.segments)}

    def latestOffset(self) -> dict:
        self.asked = client = self._client()
        return {str(s): int(client.latest(TableName=self.table, Segment=s, TotalSegments=self.segments)) for s in range(self.segments)}

    def partitions(self, start: dict, end: dict) -> list[ChangeRange]:
        if set(start) != set(end) or len(end) != self.segments:
            raise ChangeFeedError(f"the stream began with {len(start)} segments, not {self.segments}")
        for s in range(self.segments):
            if end[str(s)] < start[str(s)]:
                raise ChangeFeedError(f"segment {s} went back from {start[str(s)]} to {end[str(s)]} changes")
        out = []
        for s in range(self.segments):
            hi = end[str(s)]
            starts = list(range(start[str(s)], hi, self.range_items))
            out += [ChangeRange(s, a, min(a + self.range_items, hi), place) for a, place in zip(starts, self._places(s, starts))]
        return out

    def _places(self, segment: int, starts: list[int]) -> list:
        """Places of the starts by the client that gave the latest numbers; without one each task finds its own."""
        places = getattr(self.asked, "places", None) if starts else None
        if places is None:
            return [None] * len(starts)
        return places(TableName=self.table, Segment=segment, TotalSegments=self.segments, Starts=starts)

    def read(self, partition: ChangeRange):
        import pyarrow as pa

        client, at, place = self._client(), partition.start, partition.place
        while at < partition.end:
            known = {} if place is None else {"Place": place}
            page = client.changes(TableName=self.table, Segment=partition.segment, TotalSegments=self.segments, Start=at, End=partition.end, **known)
            following, place = int(page["Next"]), page.get("NextPlace")
            if not at < following <= partition.end:
                raise ChangeFeedError(f"segment {partition.segment} gave no changes from {at} up to {partition.end}")
            lines = [json.dumps({"Item": item}, separators=(",", ":"), default=_json_default) for item in page.get("Items", [])]
            if lines:
                yield pa.RecordBatch.from_arrays([pa.array(lines, type=pa.string())], names=["value"])
            at = following

    def commit(self, end: dict) -> None:
        pass


class ItemChangesDataSource(DataSource):
    """``spark.readStream.format("items_changes").option("table", ...).option("segments", n)
    .option("client_factory", "pkg.mod:make_client").option("client.region", ...).load()``"""

    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        return "value string"

    def streamReader(self, schema):
        return ItemChangesReader(self.options)


def read_items_changes(spark, table: str, client_factory: str, segments: int = 1, range_items: int = RANGE_ITEMS, **client_options):
    """A stream of the table's changes; returns ``item``, ``raw`` like read_items_json."""
    from tidemark.session import ship_package
    from tidemark.sources.items import parse_items

    ship_package(spark)
    spark.dataSource.register(ItemChangesDataSource)
    reader = spark.readStream.format(FORMAT_NAME).option("table", table).option("segments", str(segments)) \
        .option("range_items", str(range_items)).option("client_factory", client_factory)
    for k, v in client_options.items():
        reader = reader.option(f"client.{k}", str(v))
    return parse_items(reader.load())

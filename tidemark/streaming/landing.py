"""Continuous landing: each micro-batch of new export files is one landing run."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark import fs
from tidemark.config import TableConfig
from tidemark.functions.naming import RUN_TIME_FORMAT, run_folder
from tidemark.plans.landing import land_table
from tidemark.sources.changes import RANGE_ITEMS, read_items_changes
from tidemark.sources.items import RAW_COL, parse_items

_RUNS_DIR = "tidemark-runs"


def epoch_run_time(
    spark: SparkSession, checkpoint_location: str, epoch_id: int, clock: Callable[[], datetime],
    after: datetime | None = None,
) -> datetime:
    """The run time of a micro-batch, fixed at its first attempt.

    A replayed epoch gets the same run time (so the same run folder); a new
    epoch gets a time at least one second after the previous one, so two
    epochs never share a folder. ``after`` moves an epoch whose folder another
    run has finished to a later second. Markers of epochs before the last are
    removed.
    """
    base = f"{checkpoint_location.rstrip('/')}/{_RUNS_DIR}"
    known = fs.read_marker(spark, f"{base}/{epoch_id}")
    if known and after is None:
        return datetime.strptime(known, RUN_TIME_FORMAT)
    now = clock().replace(microsecond=0)
    last = fs.read_marker(spark, f"{base}/latest")
    for earlier in (last and datetime.strptime(last, RUN_TIME_FORMAT), after):
        if earlier:
            now = max(now, earlier + timedelta(seconds=1))
    text = now.strftime(RUN_TIME_FORMAT)
    fs.write_marker(spark, f"{base}/{epoch_id}", text)
    fs.write_marker(spark, f"{base}/latest", text)
    fs.delete(spark, f"{base}/{epoch_id - 2}")
    return now


def stream_identity(spark: SparkSession, checkpoint_location: str) -> str:
    """An id of this checkpoint, made once and kept in it."""
    path = f"{checkpoint_location.rstrip('/')}/{_RUNS_DIR}/id"
    known = fs.read_marker(spark, path)
    if known is None:
        known = uuid.uuid4().hex
        fs.write_marker(spark, path, known)
    return known


def land_stream(
    spark: SparkSession,
    config: TableConfig,
    source_path: str,
    checkpoint_location: str,
    max_files_per_trigger: int = 1000,
    available_now: bool = True,
    processing_time: str | None = None,
    clock: Callable[[], datetime] = datetime.now,
    **land_options,
) -> StreamingQuery:
    """Land export files as they arrive in ``source_path``; returns the running query.

    Each micro-batch is flattened, anti-joined with everything landed and
    written as one run folder by :func:`land_table`, marked with this
    checkpoint and the epoch. A replay that finds its own folder finished is
    skipped, so every batch lands once; a folder that any other run finished
    in the same second sends the batch to a later second. ``available_now``
    processes what is there and stops; otherwise ``processing_time`` sets the
    trigger interval. ``max_files_per_trigger`` bounds a batch.
    """
    if max_files_per_trigger < 1:
        raise ValueError("max_files_per_trigger must be 1 or more")
    reader = spark.readStream.format("text")
    reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    items = parse_items(reader.load(source_path))
    return _land_items(spark, config, items, checkpoint_location, available_now, processing_time, clock, land_options)


def land_changes(
    spark: SparkSession,
    config: TableConfig,
    table: str,
    checkpoint_location: str,
    client_factory: str,
    segments: int = 1,
    range_items: int = RANGE_ITEMS,
    client_options: dict | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    clock: Callable[[], datetime] = datetime.now,
    **land_options,
) -> StreamingQuery:
    """Land the changes of a live table as they come; returns the running query.

    Like :func:`land_stream`, with the table's change feed
    (:mod:`tidemark.sources.changes`) in place of export files: a batch is a
    range of changes of each segment, fixed in the checkpoint before it is
    read, so a stop or a crash in the middle neither loses nor repeats one.
    """
    items = read_items_changes(spark, table, client_factory, segments, range_items, **(client_options or {}))
    return _land_items(spark, config, items, checkpoint_location, available_now, processing_time, clock, land_options)


def _land_items(spark, config, items, checkpoint_location, available_now, processing_time, clock, land_options) -> StreamingQuery:
    each = replace(config, on_empty="skip")

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # Field discovery and the write read the batch: keep its lines once (bounded by the trigger limit;
        # lost blocks are recomputed from the source); each parses of them what it needs.
        # An empty one is known from the write's own count.
        lines = batch.select(RAW_COL).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            owner = f"{stream_identity(spark, checkpoint_location)}:{epoch_id}"
            run_at = epoch_run_time(spark, checkpoint_location, epoch_id, clock)
            while True:
                try:
                    land_table(spark, each, run_at, source=parse_items(lines, RAW_COL), owner=owner, **land_options)
                    return
                except FileExistsError:
                    if fs.folder_owner(spark, run_folder(config.root, run_at)) == owner:
                        return  # finished by an earlier attempt of this epoch
                    run_at = epoch_run_time(spark, checkpoint_location, epoch_id, clock, after=run_at)
        finally:
            lines.unpersist()

    writer = items.writeStream.foreachBatch(per_batch).option(
        "checkpointLocation", checkpoint_location
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()

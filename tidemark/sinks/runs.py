"""Write one run folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.config import LAYOUTS, parse_keys
from tidemark.functions.naming import key_name
from tidemark.sinks.key_files import file_name, write_key_files

FILE_KEY = "file_key"
# Fixed value: folder label for an empty key text (Spark would file it under
# its default partition name together with NULL).
EMPTY_KEY_TEXT = "EMPTY"


def file_key(keys: Sequence[str]):
    """Folder label of a key for the per-key layout."""
    name = key_name(*keys)
    return F.when(name == F.lit(""), F.lit(EMPTY_KEY_TEXT)).otherwise(name)


def write_run(
    df: DataFrame,
    folder: str,
    layout: str = "compact",
    keys: Sequence[str] | None = None,
    mode: str = "errorifexists",
    max_records_per_file: int | None = None,
    cluster: bool = False,
    options: dict | None = None,
) -> int:
    """Write ``df`` as Parquet under ``folder`` in one Spark job; returns the rows written.

    ``compact``: files straight from the producing tasks (after a shuffle
    join these are AQE-coalesced partitions). ``per_key``: one sub-folder
    ``file_key=<key name>`` per key combination, written from the producing
    tasks with Spark's local sort by label (no shuffle). After a shuffle
    join the rows of a key already share a task; otherwise a repeated key
    may get a file per task, and a hot key spreads over many files.
    ``cluster=True`` rebalances by label first (one extra shuffle; AQE splits
    a hot key over several files) for fewer files per folder. ``key_files``:
    one file per key combination, ``<key name>.parquet`` in the folder itself
    (see :mod:`tidemark.sinks.key_files`), in a new folder only. Key columns
    stay in the files. ``options`` go to the Parquet writer. The row count
    comes from an Observation evaluated in
    the writing (result) stage, so it is counted once per partition even
    when tasks are retried.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}")
    obs = Observation()
    if layout != "compact":
        if not keys:
            raise ValueError(f"{layout} layout needs keys")
        keys = parse_keys(keys)
        if FILE_KEY in df.columns:
            raise ValueError(f"column {FILE_KEY!r} is reserved for the per-key layouts")
        df = df.withColumn(FILE_KEY, file_key(keys))
    if layout == "key_files":
        if mode == "overwrite" or max_records_per_file or cluster:
            raise ValueError("key_files writes whole files to new folders")
        df = df.withColumn(FILE_KEY, file_name(F.col(FILE_KEY)))
        write_key_files(df.observe(obs, F.count(F.lit(1)).alias("rows")), folder, FILE_KEY, options)
        return int(obs.get["rows"])
    if layout == "per_key":
        if cluster:
            df = df.hint("rebalance", FILE_KEY)
    df = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = df.write.mode(mode).options(**(options or {}))
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_records_per_file))
    if layout == "per_key":
        writer = writer.partitionBy(FILE_KEY)
    writer.parquet(folder)
    return int(obs.get["rows"])

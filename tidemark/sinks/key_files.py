"""One Parquet file per key, named by it, as a Python Data Source writer.

Rows come partitioned by their file's name and in its order, so a task writes
its files one after another, some batches at a time, and a file is whole when
its name ends. A file is written aside and moved into place, which makes a repeated or
doubled task write the same files again. Nothing is moved, renamed or listed
by the driver: it marks the folder as finished, or removes the whole folder.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT_NAME = "key_files"
SUFFIX, SUCCESS_MARKER = ".parquet", "_SUCCESS"
#: Bytes of a name beyond which it is cut and made distinct by a digest; file systems take 255.
NAME_BYTES, NAME_KEPT = 200, 40
#: Rows that a task sorts by name; a file of more rows is written by a task of its own, which sorts nothing.
TASK_ROWS = 500_000
#: Bytes of batches that make up a row group.
GROUP_BYTES = 32 << 20
_HOT, _PLACE = "__hot_name", "__place"


def file_name(label: Column) -> Column:
    """Name of the file of a key label. Readers skip names that begin with ``_`` or ``.``, so these get a dash in front."""
    shown = F.when(label.startswith("_") | label.startswith("."), F.concat(F.lit("-"), label)).otherwise(label)
    digest = F.substring(F.sha2(shown, 256), 1, 32)
    cut = F.concat(F.substring(shown, 1, NAME_KEPT), F.lit("-"), digest)
    return F.concat(F.when(F.octet_length(shown) > NAME_BYTES, cut).otherwise(shown), F.lit(SUFFIX))


def _file_system(folder: str):
    from pyarrow import fs

    if folder.startswith(("/", "file:")):
        folder = "file:///" + folder.removeprefix("file:").lstrip("/")
    system, base = fs.FileSystem.from_uri(folder)
    return system, base.rstrip("/")


@dataclass
class FilesWritten(WriterCommitMessage):
    files: int
    rows: int


class KeyFilesWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        opts = {k.lower(): v for k, v in options.items()}
        self.folder, self.column = opts["folder"], opts["name_column"]
        self.compression = opts.get("compression", "snappy")

    def write(self, iterator) -> FilesWritten:
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        system, base = _file_system(self.folder)
        name, writer, aside, files, rows = None, None, None, 0, 0
        held, size = [], 0

        def write_held() -> None:
            nonlocal held, size
            if held:
                writer.write_table(pa.Table.from_batches(held))
                held, size = [], 0

        def finish() -> None:
            if writer is not None:
                write_held()
                writer.close()
                system.move(aside, f"{base}/{name}")

        try:
            for batch in iterator:
                names = batch.column(self.column)
                data = batch.drop_columns([self.column])
                ends = pc.run_end_encode(names)
                lo = 0
                for own, hi in zip(ends.values.to_pylist(), ends.run_ends.to_pylist()):
                    if own != name:
                        finish()
                        name, writer = own, None
                        aside = f"{base}/_temporary-{uuid.uuid4().hex}"
                        system.create_dir(base, recursive=True)
                        writer = pq.ParquetWriter(aside, data.schema, filesystem=system, compression=self.compression)
                        files += 1
                    held.append(data.slice(lo, hi - lo))
                    size += held[-1].nbytes
                    if size >= GROUP_BYTES:
                        write_held()
                    rows += hi - lo
                    lo = hi
            finish()
            writer = None
        finally:
            if writer is not None:  # the task failed in the middle of a file
                writer.close()
                from pyarrow import fs

                if system.get_file_info(aside).type == fs.FileType.File:
                    system.delete_file(aside)
        return FilesWritten(files, rows)

    def commit(self, messages) -> None:
        system, base = _file_system(self.folder)
        system.create_dir(base, recursive=True)
        with system.open_output_stream(f"{base}/{SUCCESS_MARKER}"):
            pass

    def abort(self, messages) -> None:
        from pyarrow import fs

        system, base = _file_system(self.folder)
        if system.get_file_info(base).type == fs.FileType.Directory:
            system.delete_dir(base)


class KeyFilesDataSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT_NAME

    def schema(self):
        raise NotImplementedError("key_files is a sink; its files are Parquet")

    def writer(self, schema, overwrite):
        if overwrite:
            raise ValueError("key_files writes new folders only")
        return KeyFilesWriter(self.options)


def _hot_names(rows: DataFrame, name_column: str) -> list[tuple[str, int]]:
    """(name, place) of the files of more than ``TASK_ROWS`` rows, numbered; there is one at most for that many rows."""
    counts = rows.groupBy(name_column).agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("n") > TASK_ROWS).orderBy(F.desc("n"), name_column).collect()
    return [(r[name_column], i) for i, r in enumerate(hot)]


def write_key_files(df: DataFrame, folder: str, name_column: str, options: dict | None = None) -> None:
    """Write ``df`` to a folder of its own, one file per value of ``name_column`` (see :func:`file_name`), without that column.

    The rows are staged first, so they are computed once, and counted by
    name. A file of more than ``TASK_ROWS`` rows has a task of its own, which
    passes its rows on unsorted, batch by batch, however many they are; the
    others are sorted by name in tasks of about ``TASK_ROWS`` rows. The folder must
    be reached by pyarrow's file systems (local, s3, gs, abfs, hdfs). It must
    not hold another run's files: an aborted write removes it.
    """
    from tidemark import fs
    from tidemark.session import scratch_folder, ship_package

    spark = df.sparkSession
    ship_package(spark)
    spark.dataSource.register(KeyFilesDataSource)
    staging = scratch_folder(spark, "key-files-rows")
    try:
        df.write.parquet(staging)
        rows = spark.read.schema(df.schema).parquet(staging)
        hot = _hot_names(rows, name_column)
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        places = spark.createDataFrame(hot, f"{_HOT} string, {_PLACE} int")
        met = rows.join(F.broadcast(places), F.col(name_column) == F.col(_HOT), "left")
        tasks = max(least, -(-rows.count() // TASK_ROWS))
        placed = met.where(F.col(_PLACE).isNull()).repartition(tasks, F.col(name_column)).sortWithinPartitions(F.col(name_column))
        if hot:
            placed = met.where(F.col(_PLACE).isNotNull()).repartitionById(len(hot), F.col(_PLACE)).unionByName(placed)
        writer = placed.drop(_HOT, _PLACE).write.format(FORMAT_NAME).mode("append") \
            .option("folder", folder.rstrip("/")).option("name_column", name_column)
        for k, v in (options or {}).items():
            writer = writer.option(k, str(v))
        writer.save()
    finally:
        fs.delete(spark, staging)

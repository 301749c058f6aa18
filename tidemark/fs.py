"""Hadoop FileSystem calls for run-folder housekeeping (metadata only, no rows)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

SUCCESS_MARKER = "_SUCCESS"
OWNER_MARKER = "_owner"
#: Folder under a landed root for what is kept about its runs; hidden from readers by its name.
HOUSEKEEPING = "_tidemark"


def _path_and_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path_and_fs(spark, path)
    return bool(fs.exists(p))


def is_committed(spark: SparkSession, folder: str) -> bool:
    """True when a Spark write to ``folder`` finished its job commit."""
    return exists(spark, folder.rstrip("/") + "/" + SUCCESS_MARKER)


def delete(spark: SparkSession, path: str) -> bool:
    p, fs = _path_and_fs(spark, path)
    return bool(fs.delete(p, True))


def remove_run_folder(spark: SparkSession, folder: str, root: str, drop_root: bool = False) -> None:
    """Delete ``folder`` and then each parent below ``root`` that is left empty.

    With ``drop_root`` a ``root`` without data goes too, and what is kept about
    its runs (when this run created it).
    """
    delete(spark, folder)
    root_p, fs = _path_and_fs(spark, root.rstrip("/"))
    root_q = fs.makeQualified(root_p)
    root_uri = root_q.toString().rstrip("/")
    p, _ = _path_and_fs(spark, folder.rstrip("/"))
    p = fs.makeQualified(p).getParent()
    while p is not None and p.toString().rstrip("/") != root_uri and p.toString().startswith(root_uri):
        if not fs.exists(p) or len(fs.listStatus(p)) > 0:
            return
        fs.delete(p, False)
        p = p.getParent()
    if drop_root:
        drop_unused_root(spark, root)


def drop_unused_root(spark: SparkSession, root: str) -> None:
    """Delete a root that holds nothing but what is kept about its runs."""
    if {name for name, *_ in children(spark, root)} <= {HOUSEKEEPING}:
        delete(spark, root)


def read_marker(spark: SparkSession, path: str) -> str | None:
    """Text of a small marker file, or None when it does not exist or was never finished."""
    p, fs = _path_and_fs(spark, path)
    if not fs.exists(p) or fs.getFileStatus(p).getLen() < 2:
        return None
    stream = fs.open(p)
    try:
        return stream.readUTF()
    finally:
        stream.close()


def write_marker(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a small marker file holding ``text``: written aside, then renamed."""
    p, fs = _path_and_fs(spark, path)
    aside, _ = _path_and_fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(aside, True)
    try:
        stream.writeUTF(text)
    finally:
        stream.close()
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"cannot write {path}")


def claim_folder(spark: SparkSession, folder: str, owner: str) -> None:
    """Mark a new run folder with its owner before any data is written to it."""
    write_marker(spark, f"{folder.rstrip('/')}/{OWNER_MARKER}", owner)


def folder_owner(spark: SparkSession, folder: str) -> str | None:
    """The owner a run folder was claimed by; None for folders without one."""
    return read_marker(spark, f"{folder.rstrip('/')}/{OWNER_MARKER}")


def _write(fs, p, text: str) -> None:
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()


def claim(spark: SparkSession, path: str, owner: str) -> bool:
    """Make the folder ``path`` for ``owner``; False if another one made it first.

    A folder that already names its owner is renamed into place. A store whose
    rename is atomic lets one claimant through: a local folder that is not
    empty cannot be replaced, and where a folder would be moved into the
    existing one, the owner found there tells.
    """
    p, fs = _path_and_fs(spark, path)
    name = f"{p.getName()}.{uuid.uuid4().hex}.tmp"
    aside, _ = _path_and_fs(spark, f"{p.getParent().toString()}/{name}")
    if fs.exists(p):
        return False
    _write(fs, _path_and_fs(spark, f"{aside.toString()}/{OWNER_MARKER}")[0], owner)
    try:
        fs.rename(aside, p)
    except Py4JJavaError:
        if not fs.exists(p):
            raise
    won = read_text(spark, f"{path.rstrip('/')}/{OWNER_MARKER}") == owner
    if not won:
        fs.delete(aside, True)
        fs.delete(_path_and_fs(spark, f"{path.rstrip('/')}/{name}")[0], True)
    return won


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a file holding ``text`` of any length: written aside, then renamed."""
    p, fs = _path_and_fs(spark, path)
    aside, _ = _path_and_fs(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    _write(fs, aside, text)
    if fs.exists(p):
        fs.delete(p, False)
    if not fs.rename(aside, p):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """Text of a file, or None when it does not exist."""
    p, fs = _path_and_fs(spark, path)
    if not fs.exists(p):  # far cheaper than an exception that crosses to Python
        return None
    try:
        stream = fs.open(p)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return None
        raise
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def children(spark: SparkSession, path: str) -> list[tuple[str, bool, int]]:
    """(name, is a folder, time of last change in ms) of what lies in a folder; empty if there is none."""
    p, fs = _path_and_fs(spark, path)
    if not fs.exists(p):
        return []
    try:
        found = list(fs.listStatus(p))
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileNotFoundException":
            return []
        raise
    return [(s.getPath().getName(), bool(s.isDirectory()), int(s.getModificationTime())) for s in found]


def move(spark: SparkSession, source: str, target: str) -> None:
    p, fs = _path_and_fs(spark, source)
    if not fs.rename(p, _path_and_fs(spark, target)[0]):
        raise OSError(f"cannot move {source} to {target}")

"""What is known about the runs under a root without opening their files: rows and key index of each."""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark import fs
from tidemark.sources.landed import NOTHING_LANDED

MANIFEST = "_manifest"
SUMMARY = "runs.json"
#: Folder names from the root down to a run.
_RUN_PARTS = (r"[0-9]{4}", r"[0-9]{2}", r"[0-9]{2}", r"[0-9]{2}-[0-9]{2}-[0-9]{2}")


@dataclass(frozen=True)
class RunEntry:
    """Rows of a run, the id of its schema and, if its keys are indexed, their schema, number of blocks and bits of a stored hash."""

    rows: int
    key_schema: str | None = None
    blocks: int = 0
    bits: int = 0
    schema: str | None = None


@dataclass(frozen=True)
class LandedRuns:
    """Runs with a manifest by their folder below the root, and all other paths that may hold data."""

    root: str
    runs: dict[str, RunEntry]
    unmarked: list[str]

    def path(self, run: str) -> str:
        return f"{self.root}/{run}"


def _hidden(name: str) -> bool:
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def _summary_path(root: str) -> str:
    return f"{root.rstrip('/')}/{fs.HOUSEKEEPING}/{SUMMARY}"


def _entries(text: str | None) -> dict[str, RunEntry]:
    """Entries of a summary; one that cannot be read counts as none, as every run holds its own manifest."""
    try:
        return {run: RunEntry(**entry) for run, entry in json.loads(text or "{}").items()}
    except (ValueError, TypeError, AttributeError):
        return {}


def landed_runs(spark: SparkSession, root: str) -> LandedRuns:
    """The runs that lie under ``root`` now.

    Folders are listed down to the runs, never inside one, so the cost grows
    with runs, not with files. The summary in the housekeeping folder saves
    reading the manifest of every run; a run it lacks is asked for its own.
    Runs without a manifest (written before there were any, or by a writer
    that was lost before its last step) and data outside of run folders are
    ``unmarked``.
    """
    root = root.rstrip("/")
    known = _entries(fs.read_text(spark, _summary_path(root)))
    runs, unmarked = {}, []

    def walk(below: str, depth: int) -> None:
        for name, is_folder, _ in sorted(fs.children(spark, f"{root}/{below}" if below else root)):
            if _hidden(name):
                continue
            path = f"{below}/{name}" if below else name
            if not is_folder or not re.fullmatch(_RUN_PARTS[depth], name):
                unmarked.append(f"{root}/{path}")
            elif depth + 1 < len(_RUN_PARTS):
                walk(path, depth + 1)
            else:
                entry = known.get(path) or _entries(fs.read_text(spark, f"{root}/{path}/{MANIFEST}")).get(path)
                if entry is None:
                    unmarked.append(f"{root}/{path}")
                else:
                    runs[path] = entry

    walk("", 0)
    return LandedRuns(root, runs, unmarked)


def record_run(spark: SparkSession, landed: LandedRuns, folder: str, entry: RunEntry) -> None:
    """Add a finished run: its own manifest first, then the summary (runs that are gone leave it)."""
    run = folder.rstrip("/")[len(landed.root) + 1:]
    fs.write_text(spark, f"{folder.rstrip('/')}/{MANIFEST}", json.dumps({run: asdict(entry)}))
    everything = {**landed.runs, run: entry}
    fs.write_text(spark, _summary_path(landed.root), json.dumps({r: asdict(e) for r, e in sorted(everything.items())}))


def read_paths(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    """All Parquet files below the paths, or None where there are none."""
    if not paths:
        return None
    try:
        return spark.read.option("recursiveFileLookup", "true").parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() in NOTHING_LANDED:
            return None
        raise


def landed_rows(spark: SparkSession, landed: LandedRuns) -> int:
    """Rows under the root: by manifest, and by a count (Parquet metadata) of what has none."""
    rest = read_paths(spark, landed.unmarked)
    return sum(e.rows for e in landed.runs.values()) + (0 if rest is None else rest.count())

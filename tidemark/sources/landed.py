"""Read what is already landed under a root."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tidemark.functions.columns import col

# Conditions Spark raises for a missing root and for a root without data files.
NOTHING_LANDED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_landed(
    spark: SparkSession,
    root: str,
    keys: Sequence[str] | None = None,
    merge_schema: bool | None = None,
) -> DataFrame | None:
    """All Parquet files under ``root`` (every run folder), or ``None`` if nothing is landed.

    With ``keys`` only the key columns are selected, so the scan's
    ReadSchema is pruned to them. ``merge_schema`` defaults to on when the
    payload is wanted (run folders may add columns) and off for keys.
    Only a missing or empty root means "nothing landed"; other errors raise.
    """
    if merge_schema is None:
        merge_schema = not keys
    try:
        df = (
            spark.read.option("recursiveFileLookup", "true")
            .option("mergeSchema", str(bool(merge_schema)).lower())
            .parquet(root)
        )
    except AnalysisException as e:
        if e.getCondition() in NOTHING_LANDED:
            return None
        raise
    if keys:
        missing = [k for k in keys if k not in df.columns]
        if missing:
            raise ValueError(f"landed data under {root!r} lacks key columns {missing}")
        return df.select(*[col(k) for k in keys])
    return df

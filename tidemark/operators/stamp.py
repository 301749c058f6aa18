"""Audit columns and row samples."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import DEFAULT_AUDIT_NAMES
from tidemark.functions.naming import audit_values


def check_audit_names(df: DataFrame, names: tuple[str, str]) -> None:
    """Raise ``ValueError`` if a column of ``df`` has an audit column's name, in any case."""
    taken = sorted(c for c in df.columns if c.lower() in {n.lower() for n in names})
    if taken:
        raise ValueError(f"source columns {taken} have the names of audit columns {names}; choose other audit_names")


def stamp_run(
    df: DataFrame, run_at: datetime, names: tuple[str, str] = DEFAULT_AUDIT_NAMES
) -> DataFrame:
    """Add the run date (``%Y-%m-%d``) and run time (``%Y-%m-%d %H:%M:%S``) as text columns.

    Raises if ``df`` has a column of such a name (in any case), which would be overwritten.
    """
    check_audit_names(df, names)
    day, moment = audit_values(run_at)
    return df.withColumns({names[0]: F.lit(day), names[1]: F.lit(moment)})


def sample_rows(df: DataFrame, n: int = 1000) -> DataFrame:
    """At most ``n`` rows, for inspection; which rows is not defined."""
    if n < 0:
        raise ValueError("n must be >= 0")
    return df.limit(n)

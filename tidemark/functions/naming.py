"""Run folders, audit values and key-derived names."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.columns import col

# Run folder and audit formats (Python strftime and the
# matching Spark datetime pattern).
RUN_FOLDER_FORMAT = "%Y/%m/%d/%H-%M-%S"
RUN_FOLDER_PATTERN = "yyyy/MM/dd/HH-mm-ss"
RUN_DATE_FORMAT = "%Y-%m-%d"
RUN_TIME_FORMAT = "%Y-%m-%d %H:%M:%S"

# Key-name rules. A NULL key part is written as "NULL", parts
# are joined by "_", and space, backslash and colon become "_".
NULL_KEY_TEXT = "NULL"
KEY_JOIN = "_"
KEY_UNSAFE_CHARS = " \\:"
KEY_SAFE_CHARS = "___"


def run_folder(root: str, run_at: datetime) -> str:
    """``root/YYYY/MM/DD/HH-MM-SS/`` for one run."""
    return f"{root.rstrip('/')}/{run_at.strftime(RUN_FOLDER_FORMAT)}/"


def run_folder_expr(ts: Column | str) -> Column:
    """The folder part of :func:`run_folder` for a timestamp column (session time zone)."""
    c = col(ts) if isinstance(ts, str) else ts
    return F.date_format(c, RUN_FOLDER_PATTERN)


def audit_values(run_at: datetime) -> tuple[str, str]:
    """Run date and run time texts stamped on every landed row."""
    return run_at.strftime(RUN_DATE_FORMAT), run_at.strftime(RUN_TIME_FORMAT)


def key_name(*cols: Column | str) -> Column:
    """File-safe text of a (composite) key: parts as text, NULL as ``"NULL"``, joined by ``_``.

    Distinct keys can share a name (``("a_b","c")`` and ``("a","b_c")``); the
    name only labels a folder and never decides which rows are kept.
    """
    parts = [
        F.coalesce((col(c) if isinstance(c, str) else c).cast("string"), F.lit(NULL_KEY_TEXT))
        for c in cols
    ]
    return F.translate(F.concat_ws(KEY_JOIN, *parts), KEY_UNSAFE_CHARS, KEY_SAFE_CHARS)

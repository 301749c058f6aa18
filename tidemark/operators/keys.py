"""Key combinations and key filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.config import parse_keys
from tidemark.functions.columns import col
from tidemark.operators.diff import keyed_join


def distinct_keys(df: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Distinct key combinations (partial aggregation before the shuffle)."""
    return df.select(*[col(k) for k in parse_keys(keys)]).distinct()


def filter_keys(
    df: DataFrame,
    keys: str | Sequence[str],
    key_rows: DataFrame | Sequence[Sequence],
    null_safe: bool = False,
    **join_options,
) -> DataFrame:
    """Rows of ``df`` whose key equals one of ``key_rows``.

    ``key_rows`` is a DataFrame with the key columns or a list of key tuples,
    which becomes one with the key columns' types; either is a semi join (see
    :func:`~tidemark.operators.diff.keyed_join`). With SQL equality a NULL key
    part matches nothing; ``null_safe`` matches NULL to NULL.
    """
    keys = parse_keys(keys)
    if isinstance(key_rows, DataFrame):
        return keyed_join(df, key_rows, keys, "left_semi", null_safe, **join_options)
    rows = [tuple(r) for r in key_rows]
    for r in rows:
        if len(r) != len(keys):
            raise ValueError(f"key combination {r!r} does not have {len(keys)} parts")
    if not rows:
        return df.limit(0)
    types = {f.name: f.dataType for f in df.schema.fields}
    schema = T.StructType([T.StructField(k, types[k], True) for k in keys])
    frame = df.sparkSession.createDataFrame(rows, schema)
    return keyed_join(df, frame, keys, "left_semi", null_safe, **join_options)

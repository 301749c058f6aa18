"""Landed trees whose types changed from run to run: read by schema, widened, and put together."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.functions.columns import col
from tidemark.plans.manifest import LandedRuns, landed_runs
from tidemark.sources.landed import NOTHING_LANDED

SCHEMAS = "schemas"
_WHOLE_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}
_WHOLE = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
_MOST_DIGITS = 38


def _schemas_folder(root: str) -> str:
    return f"{root.rstrip('/')}/{fs.HOUSEKEEPING}/{SCHEMAS}"


def _plain(schema: T.StructType) -> str:
    """A schema as text, as files give it back: all columns nullable, without metadata."""
    return T.StructType([T.StructField(f.name, f.dataType) for f in schema.fields]).json()


def keep_schema(spark: SparkSession, root: str, schema: T.StructType) -> str:
    """The id of a run's schema; its text is kept once under the root."""
    text = _plain(schema)
    name = hashlib.sha256(text.encode()).hexdigest()[:16]
    path = f"{_schemas_folder(root)}/{name}.json"
    if not fs.exists(spark, path):
        fs.write_text(spark, path, text)
    return name


def by_schema(spark: SparkSession, landed: LandedRuns) -> dict[str, list[str]]:
    """Schema text -> paths. Runs say theirs in the manifest; others are asked for their footers.

    Footers are read by one distributed job if the schemas of all such paths
    merge, else path by path.
    """
    known = {name: fs.read_text(spark, f"{_schemas_folder(landed.root)}/{name}.json")
             for name in {e.schema for e in landed.runs.values() if e.schema}}
    groups: dict[str, list[str]] = {}
    ask = list(landed.unmarked)
    for run, entry in sorted(landed.runs.items()):
        text = known.get(entry.schema) if entry.schema else None
        if text is None:
            ask.append(landed.path(run))
        else:
            groups.setdefault(text, []).append(landed.path(run))

    def footers(paths: list[str]) -> None:
        try:
            df = spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*paths)
        except AnalysisException as e:
            if e.getCondition() not in NOTHING_LANDED:
                raise
        else:
            groups.setdefault(_plain(df.schema), []).extend(paths)

    if ask:
        try:
            footers(ask)
        except (PySparkException, Py4JJavaError):
            if len(ask) == 1:
                raise
            for path in ask:
                footers([path])
    return groups


def widened(types: Sequence[T.DataType]) -> T.DataType:
    """One type that holds every value of all the types without loss; text where no other does."""
    kinds = {type(t) for t in types}
    if all(t == types[0] for t in types):
        return types[0]
    if kinds <= set(_WHOLE):
        return max(types, key=lambda t: _WHOLE.index(type(t)))
    if kinds <= {*_WHOLE, T.DecimalType}:
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in types)
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _WHOLE_DIGITS[type(t)] for t in types)
        return T.DecimalType(whole + scale, scale) if whole + scale <= _MOST_DIGITS else T.StringType()
    if kinds <= {T.FloatType, T.DoubleType, T.ByteType, T.ShortType, T.IntegerType}:
        return T.DoubleType()
    return T.StringType()


def common_schema(schemas: Sequence[T.StructType], declared: T.StructType | None = None) -> T.StructType:
    """All columns in the order they first came, each with its declared or widened type."""
    own = {f.name: f.dataType for f in (declared.fields if declared else [])}
    seen: dict[str, list[T.DataType]] = {}
    for s in schemas:
        for f in s.fields:
            seen.setdefault(f.name, []).append(f.dataType)
    return T.StructType([T.StructField(n, own.get(n) or widened(ts)) for n, ts in seen.items()])


def key_types_differ(groups: dict[str, list[str]], keys: Sequence[str]) -> bool:
    """Whether some key column has several types among the schemas."""
    schemas = [T.StructType.fromJson(json.loads(text)) for text in groups]
    return any(len({s[k].dataType.json() for s in schemas if k in s.names}) > 1 for k in keys)


def read_reconciled(spark: SparkSession, root: str, keys: Sequence[str] | None = None, declared: T.StructType | None = None,
                    groups: dict[str, list[str]] | None = None) -> DataFrame | None:
    """Everything landed under ``root``, whatever types its runs were written with; None if nothing is.

    Runs are read schema by schema, cast to one type per column and put
    together; a column that a run lacks is NULL there. The type is that of
    ``declared``, else the widest that loses nothing (see :func:`widened`),
    numbers becoming their usual text where one run has text. A value that a
    declared type cannot hold fails the read. With ``keys`` only these columns are read.
    """
    if groups is None:
        groups = by_schema(spark, landed_runs(spark, root))
    if not groups:
        return None
    schemas = {text: T.StructType.fromJson(json.loads(text)) for text in groups}
    if keys:
        missing = [k for k in keys if any(k not in s.names for s in schemas.values())]
        if missing:
            raise ValueError(f"landed data under {root!r} lacks key columns {missing}")
    common = common_schema(list(schemas.values()), declared)
    fields = [common[k] for k in keys] if keys else common.fields

    def part(text: str, paths: list[str]) -> DataFrame:
        df = spark.read.schema(schemas[text]).option("recursiveFileLookup", "true").parquet(*paths)
        return df.select(*[(col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields])

    return reduce(DataFrame.unionAll, [part(text, paths) for text, paths in groups.items()])

"""Records whose key is not landed yet: a keyed left anti-join."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import parse_keys
from tidemark.functions.columns import col

STRATEGIES = ("auto", "broadcast", "shuffle")
_DEFAULT_BROADCAST_MAX = 64 * 1024 * 1024
# Per-row upper bound of a broadcast hash relation entry beyond the key bytes:
# row header + null bits + one 8-byte slot and one 8-byte length rounding per
# key part, plus the hash-map pointer.
_ROW_OVERHEAD = 24
_PER_KEY_OVERHEAD = 16
#: Rows from which a key side's copies are reduced before the join, and the parts they are reduced in.
DEDUPE_ROWS = 10_000_000
_SALT, _SALTS = "__landed_key_part", 16


def _landed_key_name(i: int) -> str:
    return f"__landed_key_{i}"


def landed_key_bound(landed_keys: DataFrame) -> tuple[int, int]:
    """(rows, byte upper bound) of a key-only frame, from one aggregate pass.

    Only the key columns are read; fixed-width keys need no column data at
    all beyond the row count.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, f in enumerate(landed_keys.schema.fields):
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            aggs.append(F.coalesce(F.sum(F.octet_length(col(f.name))), F.lit(0)).alias(f"b{i}"))
    row = landed_keys.agg(*aggs).first()
    rows = int(row["rows"])
    var_bytes = sum(int(row[k]) for k in row.asDict() if k != "rows")
    n = len(landed_keys.columns)
    return rows, rows * (_ROW_OVERHEAD + _PER_KEY_OVERHEAD * n) + var_bytes


def _key_width(dt: T.DataType) -> int | None:
    """Bytes a key part adds beyond the per-key slot: 0 fixed, 16 wide decimal, None variable."""
    if isinstance(dt, T.DecimalType):
        return 0 if dt.precision <= 18 else 16
    if isinstance(dt, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
                       T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return 0
    return None


def provably_small(raw_keys: DataFrame, keys: DataFrame, limit: int, rows: int | None = None) -> bool:
    """True only if the key frame is proven to take at most ``limit`` bytes.

    ``raw_keys`` is the key projection before NULL filtering; its row count
    needs no column data on Parquet (row-group metadata), so a large history
    is turned down without reading a key value. Fixed-width keys are then
    bounded by that count alone; text keys of a small tree get the exact
    byte pass of :func:`landed_key_bound`. Nested key types are never
    claimed small. ``rows`` is the row count of ``raw_keys`` if already known.
    """
    fields = keys.schema.fields
    if any(_key_width(f.dataType) is None and not isinstance(f.dataType, (T.StringType, T.BinaryType))
           for f in fields):
        return False
    per_row = _ROW_OVERHEAD + sum(_PER_KEY_OVERHEAD + (_key_width(f.dataType) or 0) for f in fields)
    rows_upper = raw_keys.count() if rows is None else rows
    if rows_upper * per_row > limit:
        return False
    if all(_key_width(f.dataType) is not None for f in fields):
        return True
    _rows, bound = landed_key_bound(keys)
    return bound + rows_upper * sum(_key_width(f.dataType) or 0 for f in fields) <= limit


_SIZE_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
               "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def _parse_size(text: str) -> int:
    t = str(text).strip().lower()
    num = t.rstrip("kmgtb")
    return int(float(num) * _SIZE_UNITS[t[len(num):]])


def _broadcast_limit(spark, explicit: int | None) -> int:
    """Byte limit for broadcasting keys; 0 disables (threshold -1 means the user turned it off)."""
    if explicit is not None:
        return max(int(explicit), 0)
    conf = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", None)
    try:
        value = _parse_size(conf) if conf is not None else _DEFAULT_BROADCAST_MAX
    except (ValueError, KeyError):
        value = _DEFAULT_BROADCAST_MAX
    return max(value, 0)


_FLOATS = (T.FloatType, T.DoubleType)
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def _number_text(c: Column, dt: T.DataType) -> Column:
    """A number as text that is the same for equal numbers of any type: ``1``, ``1.0`` and ``1.00`` are ``1``."""
    if isinstance(dt, _WHOLE):
        return c.cast("string")
    if isinstance(dt, T.DecimalType):
        text = c.cast("string")
        return F.when(F.instr(text, ".") > 0, F.regexp_replace(text, r"\.?0+\z", "")).otherwise(text)
    whole = (F.floor(c) == c) & (F.abs(c) < F.lit(2.0 ** 63))
    return F.when(whole, F.when(whole, c).cast("bigint").cast("string")).otherwise(c.cast("string"))


def _comparable(c: Column, own: T.DataType, other: T.DataType) -> Column:
    """A key part in the form both sides are compared in.

    Equal types, and types Spark brings to a common type without loss, stay
    as they are. With text on one side both are compared as text; a floating
    number meets other numbers as canonical text, since the common type would
    be double and could make different whole numbers equal.
    """
    if own == other:
        return c
    if isinstance(own, T.StringType) or isinstance(other, T.StringType):
        return c.cast("string")
    if isinstance(own, T.NumericType) and isinstance(other, T.NumericType):
        if isinstance(own, _FLOATS) != isinstance(other, _FLOATS):
            return _number_text(c, own)
        return c
    if isinstance(own, T.DatetimeType) and isinstance(other, T.DatetimeType):
        return c
    return c.cast("string")


def keyed_join(
    source: DataFrame,
    other: DataFrame,
    keys: str | Sequence[str],
    how: str,
    null_safe: bool = False,
    strategy: str = "auto",
    broadcast_max_bytes: int | None = None,
    other_rows: int | None = None,
) -> DataFrame:
    """``source`` rows kept (``left_semi``) or dropped (``left_anti``) by key presence in ``other``.

    Only ``source``'s columns come back and its duplicates are kept. Key parts
    of different types are compared by value where both are numbers or both
    are times, as text otherwise (see :func:`_comparable`).
    ``strategy="auto"`` leaves the join to Spark: a broadcast under
    ``spark.sql.autoBroadcastJoinThreshold`` by its own sizes, at planning or
    at run time, else a sort-merge join, whose exchanges sit right below the
    sorts, so AQE splits a hot source key (or the NULL-key group). No job runs
    while the plan is built. ``"broadcast"`` asks for a broadcast and gets it
    if the keys are proven (by counting them) to take at most
    ``broadcast_max_bytes``, by default that threshold. ``"shuffle"`` never
    asks for one.

    Of a key side that is large (``other_rows``) or shuffled on request, the
    copies of a key are first reduced to one per part of a salted aggregate,
    so a key that was landed many times is no hot key either.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    if how not in ("left_anti", "left_semi"):
        raise ValueError("how must be left_anti or left_semi")
    keys = parse_keys(keys)
    for side_df, label in ((source, "source"), (other, "key side")):
        missing = [k for k in keys if k not in side_df.columns]
        if missing:
            raise ValueError(f"{label} lacks key columns {missing}")

    reserved = [c for c in source.columns if c.startswith(_landed_key_name(0)[:-1])]
    if reserved:
        raise ValueError(f"source columns {reserved} use a name reserved for the key side")

    src_types = {f.name: f.dataType for f in source.schema.fields}
    other_types = {f.name: f.dataType for f in other.schema.fields}
    def side(c: Column, own: dict, opposite: dict, k: str) -> Column:
        return _comparable(c, own[k], opposite[k])

    # Fresh names: the key side may share lineage with the source.
    right = other.select(
        *[side(col(k), other_types, src_types, k).alias(_landed_key_name(i)) for i, k in enumerate(keys)]
    )
    if not null_safe:
        right = right.where(
            reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in right.columns])
        )
    cond = reduce(
        lambda a, b: a & b,
        [
            side(col(k), src_types, other_types, k).eqNullSafe(F.col(_landed_key_name(i)))
            if null_safe
            else side(col(k), src_types, other_types, k) == F.col(_landed_key_name(i))
            for i, k in enumerate(keys)
        ],
    )

    if strategy == "broadcast":
        limit = _broadcast_limit(source.sparkSession, broadcast_max_bytes)
        raw = other.select(*[col(k) for k in keys])
        if limit > 0 and provably_small(raw, right, limit, other_rows):
            return source.join(F.broadcast(right), on=cond, how=how)
    if strategy == "shuffle" or (other_rows or 0) > DEDUPE_ROWS:
        names = list(right.columns)
        salted = right.withColumn(_SALT, F.pmod(F.spark_partition_id(), F.lit(_SALTS)))
        right = salted.groupBy(*names, _SALT).agg(F.lit(True).alias("__some")).select(*names)
    if strategy == "shuffle":
        right = right.hint("merge")
    return source.join(right, on=cond, how=how)


def new_records(
    source: DataFrame,
    landed: DataFrame | None,
    keys: str | Sequence[str],
    null_safe: bool = False,
    strategy: str = "auto",
    broadcast_max_bytes: int | None = None,
    landed_rows: int | None = None,
) -> DataFrame:
    """Rows of ``source`` whose key does not occur in ``landed`` (all rows if ``landed`` is None).

    ``null_safe=False`` (SQL equality): a NULL key part never matches, so
    such rows are always new. ``null_safe=True`` matches NULL to NULL. A
    large NULL-key group is one hot shuffle partition that AQE's skew-join
    handling splits. See :func:`keyed_join` for the join strategy.
    """
    keys = parse_keys(keys)
    if landed is None:
        return source
    return keyed_join(source, landed, keys, "left_anti", null_safe, strategy, broadcast_max_bytes,
                      landed_rows)

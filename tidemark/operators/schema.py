"""Schemas: unified text schema, enforcement, typed inference and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import parse_keys
from tidemark.functions.columns import col

# Text patterns a value must match before a type is considered
# (Spark's casts accept more, e.g. ' 7 ' as int or '2024' as date). Numbers
# with a leading zero are codes, not numbers. ``\z`` is the very end: ``$``
# would let a final line end pass.
BOOLEANS = ("true", "false")
PLAIN_NUMBER = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?\z"
FLOAT_NUMBER = r"^-?(0|[1-9][0-9]*)([.][0-9]+)?[eE][-+]?[0-9]+\z"
# Days of the calendar: by length of month, and 29 February of leap years.
_DAY = (r"([0-9]{4}-((0[13578]|1[02])-(0[1-9]|[12][0-9]|3[01])|(0[469]|11)-(0[1-9]|[12][0-9]|30)|02-(0[1-9]|1[0-9]|2[0-8]))"
        r"|([0-9]{2}(0[48]|[2468][048]|[13579][26])|([02468][048]|[13579][26])00)-02-29)")
DATE = rf"^{_DAY}\z"
# Times Spark reads: parts of one digit, missing minutes or seconds; a zone only behind seconds.
_HOUR, _SIXTY = r"([01]?[0-9]|2[0-3])", r"[0-5]?[0-9]"
_SECONDS = rf"{_HOUR}:{_SIXTY}:{_SIXTY}([.][0-9]*)?"
_ZONE = r"Z|UTC|GMT|UT|[+-](0[0-9]|1[0-7]):[0-5][0-9]"
TIMESTAMP = rf"^{_DAY}([ T]({_HOUR}(:{_SIXTY})?|{_SECONDS} *({_ZONE})?)| ) *\z"
# Names and rarer spellings of zones are the one part that no text pattern decides: only these values are cast.
ODD_ZONE = rf"^{_DAY}[ T]{_SECONDS} *[A-Za-z+-][A-Za-z0-9_+:/-]* *\z"
# Digits of the largest and the smallest whole numbers of a type.
INT_BOUNDS = ("2147483647", "2147483648")
BIGINT_BOUNDS = ("9223372036854775807", "9223372036854775808")
#: Significant digits every one of which a double keeps; digits of the widest decimal.
DOUBLE_DIGITS, DECIMAL_DIGITS = 15, 38
# Bits of the types a value fits, tried in this order for a column.
_INT, _BIGINT, _NUMBER, _DOUBLE, _BOOLEAN, _DATE, _TIMESTAMP = (1 << i for i in range(7))
_NULL_KEY_PREFIX = "NULL_"


def unified_string_schema(*dfs: DataFrame) -> T.StructType:
    """Sorted union of column names over the frames, all nullable strings (metadata only)."""
    names = sorted({c for df in dfs for c in df.columns})
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def schema_rows(schema: T.StructType) -> list[tuple[int, str, str, bool]]:
    """``(pos, field, type, nullable)`` per field, 1-based."""
    return [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema.fields)]


def enforce_schema(
    df: DataFrame, schema: T.StructType, keys: Sequence[str] | None = None
) -> DataFrame:
    """One projection to ``schema``: cast present columns, add missing as NULL, drop the rest.

    Text targets use ``cast``; other targets use ``try_cast`` so a bad value
    becomes NULL instead of failing the job (ANSI mode). String ``keys``
    that are NULL become ``NULL_<name>``; keys of other types stay NULL.
    """
    key_set = set(parse_keys(keys)) if keys else set()
    present = set(df.columns)
    cols: list[Column] = []
    for f in schema.fields:
        if f.name in present:
            src = col(f.name)
            if isinstance(f.dataType, T.StringType):
                c = src.cast(T.StringType())
            else:
                c = src.try_cast(f.dataType)
        else:
            c = F.lit(None).cast(f.dataType)
        if f.name in key_set and isinstance(f.dataType, T.StringType):
            c = F.coalesce(c, F.lit(_NULL_KEY_PREFIX + f.name))
        cols.append(c.alias(f.name))
    return df.select(*cols)


_DIGIT_BITS = 24
_MOST_DIGITS = (1 << _DIGIT_BITS) - 1
_MINUS, _ZERO, _NINE = (ord(c) for c in "-09")


def _within(body: Column, negative: Column, bounds: tuple[str, str]) -> Column:
    """A whole number without leading zeros lies in a type's range: fewer digits, or as many and not larger as text."""
    most = F.when(negative, bounds[1]).otherwise(bounds[0])
    width = len(bounds[0])
    return (F.length(body) < width) | ((F.length(body) == width) & (body <= most))


def _kind(v: Column) -> Column:
    """What one text value fits, as a long: bits of types, digits before the point, digits behind it.

    Decided by the text alone: a cast that fails costs an exception per
    value. The first character sends most values past all patterns.
    """
    first = F.ascii(v)
    negative = first == _MINUS
    body = F.when(negative, F.substring(v, 2, _MOST_DIGITS)).otherwise(v)
    mantissa = F.substring_index(F.translate(body, "E", "e"), "e", 1)

    def double(m: Column) -> Column:
        # significant digits; only a zero before the point is not counted, nor are zeros that follow it
        tiny = F.length(F.ltrim(F.substring(m, 3, _MOST_DIGITS), F.lit("0")))
        digits = F.when(m.startswith("0."), tiny).otherwise(F.length(F.replace(m, F.lit("."), F.lit(""))))
        return F.when(F.length(m) <= DOUBLE_DIGITS, _DOUBLE).when(digits <= DOUBLE_DIGITS, _DOUBLE).otherwise(0)

    point = F.instr(body, ".")
    whole = F.when(_within(body, negative, INT_BOUNDS), _INT | _BIGINT | _NUMBER) \
        .when(_within(body, negative, BIGINT_BOUNDS), _BIGINT | _NUMBER).otherwise(_NUMBER)
    type_bits = F.when(point == 0, whole).otherwise(_NUMBER).bitwiseOR(double(body)).cast("long")
    before = F.least(F.when(point > 0, point - 1).otherwise(F.length(body)), F.lit(_MOST_DIGITS)).cast("long")
    behind = F.least(F.when(point > 0, F.length(body) - point).otherwise(0), F.lit(_MOST_DIGITS)).cast("long")
    number = type_bits.bitwiseOR(F.shiftleft(before, 8)).bitwiseOR(F.shiftleft(behind, 8 + _DIGIT_BITS))
    time = (
        F.when((F.length(v) == 10) & v.rlike(DATE), _DATE).when((F.length(v) > 11) & v.rlike(TIMESTAMP), _TIMESTAMP)
        .when(v.rlike(ODD_ZONE), F.when(v.try_cast("timestamp").isNotNull(), _TIMESTAMP).otherwise(0)).otherwise(0)
    )
    return (
        F.when(v.isNull(), None)
        .when(negative | first.between(_ZERO, _NINE),
              F.when(v.rlike(PLAIN_NUMBER), number)
              .when(v.rlike(FLOAT_NUMBER), double(mantissa).cast("long"))
              .when(F.substring(v, 5, 1) == "-", time.cast("long")).otherwise(0))
        .when(v.isin(*BOOLEANS), _BOOLEAN).otherwise(0)
    )


def _chosen(bits: int, integer_digits: int, fraction_digits: int) -> T.DataType:
    """The type of a column whose values all fit ``bits``; numbers never lose a digit."""
    if bits & _INT:
        return T.IntegerType()
    if bits & _BIGINT:
        return T.LongType()
    if bits & _NUMBER and not fraction_digits:
        return T.DecimalType(DECIMAL_DIGITS, 0) if integer_digits <= DECIMAL_DIGITS else T.StringType()
    if bits & _DOUBLE:
        return T.DoubleType()
    if bits & _NUMBER and integer_digits + fraction_digits <= DECIMAL_DIGITS:
        return T.DecimalType(integer_digits + fraction_digits, fraction_digits)
    for bit, chosen in ((_BOOLEAN, T.BooleanType()), (_DATE, T.DateType()), (_TIMESTAMP, T.TimestampType())):
        if bits & bit:
            return chosen
    return T.StringType()


def infer_schema(df: DataFrame, keys: str | Sequence[str]) -> T.StructType:
    """Typed schema from all rows in one aggregate pass.

    Each value is classified once and a column's type fits all its non-NULL
    values: int, bigint, ``decimal(38,0)`` for wider integers; double where
    every number has at most 15 significant digits, so nothing is lost, else
    the decimal wide enough for all; boolean, date, timestamp; string for
    everything else (all NULL, too many digits, leading zeros, mixtures).
    Non-text columns keep their type. Keys come first and are non-nullable, the other fields
    follow sorted and nullable. Raises if a key column is absent.
    """
    keys = parse_keys(keys)
    absent = [k for k in keys if k not in df.columns]
    if absent:
        raise ValueError(f"key columns {absent} not found")
    text_cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    found = {}
    if text_cols:
        # One expression over all columns: as many copies of it would make a method too large to be compiled.
        kinds = df.select(F.posexplode(F.transform(F.array(*[col(n) for n in text_cols]), _kind)).alias("i", "v"))
        v = F.col("v")
        found = {r["i"]: r for r in kinds.groupBy("i").agg(
            F.bit_and(v.bitwiseAND(0xFF)).alias("bits"), F.max(F.shiftright(v, 8).bitwiseAND(_MOST_DIGITS)).alias("before"),
            F.max(F.shiftright(v, 8 + _DIGIT_BITS)).alias("behind")).collect()}

    types: dict[str, T.DataType] = {f.name: f.dataType for f in df.schema.fields}
    for i, name in enumerate(text_cols):
        r = found.get(i)
        types[name] = T.StringType() if r is None or r["bits"] is None else _chosen(r["bits"], r["before"], r["behind"])
    ordered = list(keys) + sorted(c for c in df.columns if c not in keys)
    return T.StructType(
        [T.StructField(c, types[c], c not in keys) for c in ordered]
    )


def validate_keys(df: DataFrame, keys: str | Sequence[str], check_data: bool = True) -> dict:
    """Keys exist and are declared non-nullable, or (with ``check_data``) hold no NULL.

    Returns ``{key: null_count}``; raises ``ValueError`` on a violation.
    """
    keys = parse_keys(keys)
    fields = {f.name: f for f in df.schema.fields}
    absent = [k for k in keys if k not in fields]
    if absent:
        raise ValueError(f"key columns {absent} not found")
    if not check_data:
        nullable = [k for k in keys if fields[k].nullable]
        if nullable:
            raise ValueError(f"key columns {nullable} are nullable")
        return {k: 0 for k in keys}
    row = df.agg(*[F.count_if(col(k).isNull()).alias(f"k{i}") for i, k in enumerate(keys)]).first()
    nulls = {k: int(row[f"k{i}"]) for i, k in enumerate(keys)}
    bad = {k: n for k, n in nulls.items() if n}
    if bad:
        raise ValueError(f"NULL values in key columns: {bad}")
    return nulls

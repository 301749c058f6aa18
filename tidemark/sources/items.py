"""Items from export files: one JSON object ``{"Item": {...}}`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.attributes import ATTRIBUTE_TYPE, ITEM_TYPE, RAW_ITEM_TYPE

ITEM_COL = "item"
RAW_COL = "raw"

_LINE_TYPED = T.StructType([T.StructField("Item", ITEM_TYPE, True)])
_LINE_RAW = T.StructType([T.StructField("Item", RAW_ITEM_TYPE, True)])


def parse_items(lines: DataFrame, text_col: str = "value") -> DataFrame:
    """Parse export lines to ``item`` (typed map); keep the line text as ``raw``.

    Each line is parsed once. The line is parsed a second time (see
    :func:`raw_attribute`) only for an attribute whose tag is unknown.
    Blank lines are not items and are skipped; a malformed line, or one
    without ``Item``, gives a NULL ``item`` (``land_table`` refuses those).
    """
    text = F.col(text_col)
    return lines.where(F.trim(text) != "").select(
        F.from_json(text, _LINE_TYPED)["Item"].alias(ITEM_COL),
        text.alias(RAW_COL),
    )


def raw_attribute(raw_line: Column, name: str) -> Column:
    """The JSON text of attribute ``name`` as written in the export line."""
    return F.try_element_at(raw_attributes(raw_line), F.lit(name))


def raw_attributes(raw_line: Column) -> Column:
    """``map<string,string>``: every attribute of an export line with its JSON text."""
    return F.from_json(raw_line, _LINE_RAW)["Item"]


def read_items_json(spark: SparkSession, path: str, **options) -> DataFrame:
    """Read item export lines (optionally compressed) as ``item``, ``raw``.

    Splittable text input: Spark spreads the lines over tasks by file split.
    """
    return parse_items(spark.read.options(**options).text(path))


def items_of(df: DataFrame, item: str | Column = ITEM_COL) -> DataFrame:
    """Frame with an item map column (no export line) in the shape the flatteners expect."""
    c = F.col(item) if isinstance(item, str) else item
    return df.select(c.cast(T.MapType(T.StringType(), ATTRIBUTE_TYPE)).alias(ITEM_COL))


def line_struct(fields: list[str] | tuple[str, ...]) -> T.StructType:
    """Schema parsing an export line straight into one typed attribute per known field."""
    return T.StructType([T.StructField(
        "Item", T.StructType([T.StructField(f, ATTRIBUTE_TYPE, True) for f in fields]), True)])

"""Typed item attributes: schema, decoding to text, and building from columns.

An item is a map ``attribute name -> {type tag: value}``, the layout of
key-value table exports. All functions return Columns, so decoding runs
inside whole-stage codegen next to the scan.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Attribute type tags, in the order they are tried when
# decoding (first present tag wins).
TAGS = ("S", "N", "BOOL", "L", "M", "NULL", "B", "SS", "NS", "BS")

# The text written for NULL, binary and binary-set attributes.
NULL_TEXT = "null"
BINARY_TEXT = "[binary data]"
BINARY_SET_TEXT = "[binary set data]"

_TAG_TYPES = {
    "S": T.StringType(),
    "N": T.StringType(),  # numbers stay text: 38 digits do not fit a double
    "BOOL": T.BooleanType(),
    "L": T.StringType(),  # raw JSON text, element tags kept
    "M": T.StringType(),  # raw JSON text, member tags kept
    "NULL": T.BooleanType(),
    "B": T.StringType(),  # base64
    "SS": T.ArrayType(T.StringType()),
    "NS": T.ArrayType(T.StringType()),
    "BS": T.ArrayType(T.StringType()),
}

#: JSON text of an attribute that the struct parse keeps whole: a known tag with its kind of value.
TAGGED_TEXT = (r'^\{"(?:(?:S|N|B)":"|(?:BOOL|NULL)":(?:true|false)\}|M":\{|(?:L|SS|NS|BS)":\[)')

ATTRIBUTE_TYPE = T.StructType([T.StructField(t, _TAG_TYPES[t], True) for t in TAGS])
ITEM_TYPE = T.MapType(T.StringType(), ATTRIBUTE_TYPE, True)
RAW_ITEM_TYPE = T.MapType(T.StringType(), T.StringType(), True)


def decode_attribute(attr: Column, raw: Column | None = None, keep_binary: bool = False) -> Column:
    """Text form of one typed attribute; SQL NULL when the attribute is absent.

    ``raw`` is the attribute's own JSON text, used for tags outside ``TAGS``
    and for values without any tag (the struct parse drops those); NULL where
    the attribute is absent. ``keep_binary`` decodes ``B`` from base64
    to its bytes read as UTF-8 instead of the placeholder text (which stays
    for a value that is not valid base64, rather than failing the job).
    """
    binary = (
        F.coalesce(F.try_to_binary(attr["B"], F.lit("base64")).cast("string"), F.lit(BINARY_TEXT))
        if keep_binary
        else F.lit(BINARY_TEXT)
    )
    unknown = raw if raw is not None else F.lit(None).cast("string")
    return (
        F.when(attr.isNull(), unknown)
        .when(attr["S"].isNotNull(), attr["S"])
        .when(attr["N"].isNotNull(), attr["N"])
        .when(attr["BOOL"].isNotNull(), attr["BOOL"].cast("string"))
        .when(attr["L"].isNotNull(), attr["L"])
        .when(attr["M"].isNotNull(), attr["M"])
        .when(attr["NULL"].isNotNull(), F.lit(NULL_TEXT))
        .when(attr["B"].isNotNull(), binary)
        .when(attr["SS"].isNotNull(), F.to_json(attr["SS"]))
        .when(attr["NS"].isNotNull(), F.to_json(attr["NS"]))
        .when(attr["BS"].isNotNull(), F.lit(BINARY_SET_TEXT))
        .otherwise(unknown)
    )


def tagged(tag: str, value: Column | str) -> Column:
    """A typed attribute with one tag set; NULL when ``value`` is NULL.

    Used to turn relational columns into items, e.g. ``tagged("N", col("id"))``.
    """
    if tag not in _TAG_TYPES:
        raise ValueError(f"unknown tag {tag!r}")
    v = F.col(value) if isinstance(value, str) else value
    fields = [
        (v.cast(_TAG_TYPES[t]) if t == tag else F.lit(None).cast(_TAG_TYPES[t])).alias(t)
        for t in TAGS
    ]
    return F.when(v.isNotNull(), F.struct(*fields))


def item_from_columns(attrs: dict[str, Column]) -> Column:
    """``map<string, attribute>`` from named attribute Columns; NULL ones are left out."""
    pairs = []
    for name, attr in attrs.items():
        pairs += [F.lit(name), attr]
    return F.map_filter(F.create_map(*pairs), lambda _k, v: v.isNotNull())


def item_json(item: Column) -> Column:
    """One export line ``{"Item": {...}}`` for an item map."""
    return F.to_json(F.struct(item.alias("Item")))

"""Items (typed maps) to a flat table of nullable text columns."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.attributes import TAGGED_TEXT, decode_attribute
from tidemark.functions.columns import col
from tidemark.sources.items import ITEM_COL, RAW_COL, line_struct, raw_attribute, raw_attributes


def discover_fields(items: DataFrame, item_col: str = ITEM_COL, raw_col: str | None = RAW_COL) -> DataFrame:
    """``(field, n_items)``: every attribute name in the items and how many items carry it.

    Map-side partial aggregation means each task ships only its distinct
    names, so the shuffle is as wide as the schema, not the table. Export
    lines are read for names and JSON texts alone, not for typed values.
    """
    return _profile(items, item_col, raw_col).select("field", "n_items")


def _profile(items: DataFrame, item_col: str, raw_col: str | None) -> DataFrame:
    """``(field, n_items, needs_raw)``; ``needs_raw``: some value has no known tag, so its text is wanted."""
    if raw_col is not None and raw_col in items.columns:
        entries = items.select(F.explode(raw_attributes(F.col(raw_col))).alias("field", "text"))
        odd = F.coalesce(~F.col("text").rlike(TAGGED_TEXT), F.lit(False))
    else:
        entries = items.select(F.explode(F.map_keys(F.col(item_col))).alias("field"))
        odd = F.lit(False)
    return entries.groupBy("field").agg(F.count(F.lit(1)).alias("n_items"), F.bool_or(odd).alias("needs_raw"))


def field_names(items: DataFrame, item_col: str = ITEM_COL) -> list[str]:
    """Sorted attribute names (one row per name reaches the driver, never item rows)."""
    return sorted(r["field"] for r in discover_fields(items, item_col).select("field").collect())


def field_needs(items: DataFrame, item_col: str = ITEM_COL, raw_col: str | None = RAW_COL) -> dict[str, bool]:
    """Attribute names, and whether any value of one is outside the known tags (one row per name)."""
    return {r["field"]: r["needs_raw"] for r in _profile(items, item_col, raw_col).collect()}


def _check_case_collisions(items: DataFrame, names: Sequence[str]) -> None:
    """Attribute names may differ only by case; Spark columns may not unless case-sensitive."""
    conf = items.sparkSession.conf.get("spark.sql.caseSensitive", "false")
    if str(conf).lower() == "true":
        return
    seen: dict[str, str] = {}
    for n in names:
        other = seen.setdefault(n.lower(), n)
        if other != n:
            raise ValueError(
                f"attributes {other!r} and {n!r} differ only by case; "
                "set spark.sql.caseSensitive=true to land both"
            )


def flatten_items(
    items: DataFrame,
    fields: Sequence[str] | None = None,
    item_col: str = ITEM_COL,
    raw_col: str | None = RAW_COL,
    keep: Sequence[str] = (),
    keep_binary: bool = False,
    malformed_col: str | None = None,
    raw_fields: Collection[str] | None = None,
) -> DataFrame:
    """One nullable string column per field, sorted by name; absent attribute -> NULL.

    ``fields`` skips the discovery pass when the caller knows them. ``keep``
    carries extra columns of ``items`` through unchanged (first).

    When the export line is present (``raw_col``), it is parsed once straight
    into a struct of the known fields, so each field is a direct lookup
    (looking fields up in the parsed map scans its keys, which grows with
    width); a repeated attribute name then keeps its last value. A value with
    an unknown tag, or none, is kept as its JSON text: its line is parsed again
    (a conditional branch). That branch is built only for ``raw_fields``: by
    default the fields in which discovery met such a value, or all of them
    when ``fields`` is given, so the other columns decode in generated code.
    Frames without the line text decode from the item map.
    ``malformed_col`` adds a boolean column marking rows whose line or item
    did not parse.
    """
    if fields is None:
        needs = field_needs(items, item_col, raw_col)
        names = sorted(needs)
        raw_fields = {f for f, odd in needs.items() if odd} if raw_fields is None else raw_fields
    else:
        names = sorted(fields)
        raw_fields = set(names) if raw_fields is None else raw_fields
    _check_case_collisions(items, names)
    has_raw = raw_col is not None and raw_col in items.columns
    if has_raw:
        # own projection: the parse is computed once, then every field reads it
        parsed = items.select(
            *[col(c) for c in keep],
            F.col(raw_col).alias("__line"),
            F.from_json(F.col(raw_col), line_struct(names))["Item"].alias("__item"),
        )
        cols = [col(c) for c in keep]
        for name in names:
            attr = F.col("__item").getField(name)
            raw = raw_attribute(F.col("__line"), name) if name in raw_fields else None
            cols.append(decode_attribute(attr, raw, keep_binary).alias(name))
        if malformed_col:
            cols.append(F.col("__item").isNull().alias(malformed_col))
        return parsed.select(*cols)
    # own projection: each field is looked up in the map once, then decoded
    item = F.col(item_col)
    looked_up = [F.try_element_at(item, F.lit(n)).alias(f"__a{i}") for i, n in enumerate(names)]
    found = items.select(*[col(c) for c in keep], *looked_up, item.isNull().alias("__none"))
    cols = [col(c) for c in keep]
    cols += [decode_attribute(F.col(f"__a{i}"), None, keep_binary).alias(n) for i, n in enumerate(names)]
    if malformed_col:
        cols.append(F.col("__none").alias(malformed_col))
    return found.select(*cols)

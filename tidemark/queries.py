"""Query catalogue: every operator run over the driver tables, with a DuckDB oracle each.

Queries that land data write into fresh folders under the session's shared
checkpoint folder (``spark.checkpoint.dir``). Run times are fixed:
2025-01-01 00:00:00 for run 1 and 2025-01-02 00:00:00 for run 2.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import fs
from tidemark.config import TableConfig, config_from_entry
from tidemark.functions.attributes import item_from_columns, tagged
from tidemark.functions.naming import key_name, run_folder_expr
from tidemark.operators.diff import STRATEGIES, new_records
from tidemark.operators.flatten import discover_fields, flatten_items
from tidemark.operators.keys import distinct_keys, filter_keys
from tidemark.operators.quality import ColumnCount, IsComplete, RowCount, check_rules
from tidemark.operators.schema import enforce_schema, infer_schema, unified_string_schema, validate_keys
from tidemark.operators.stamp import sample_rows, stamp_run
from tidemark.plans.landing import land_table, land_tables
from tidemark.plans.partitioning import ensure_parallelism
from tidemark.plans.reconcile import read_reconciled
from tidemark.session import scratch_folder
from tidemark.sinks.runs import FILE_KEY, write_run
from tidemark.sources.items import items_of, read_items_json
from tidemark.sources.landed import read_landed
from tidemark.sources.scan import read_items_scan
from tidemark.streaming.landing import land_changes, land_stream

RUN_1 = datetime(2025, 1, 1, 0, 0, 0)
RUN_2 = datetime(2025, 1, 2, 0, 0, 0)


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --------------------------------------------------------------------------
# items made from events
# --------------------------------------------------------------------------

def _event_item_attrs() -> dict[str, Column]:
    """One attribute per tag, from events columns."""
    et = F.col("event_type")
    return {
        "event_id": tagged("N", F.col("event_id").cast("string")),
        "event_type": tagged("S", et),
        "is_big": tagged("BOOL", F.col("value") > 100),
        "props": tagged("M", F.concat(F.lit('{"k":{"N":"'),
                                      F.get_json_object("props", "$.k"), F.lit('"}}'))),
        "tags": tagged("L", F.concat(F.lit('[{"S":"'), et, F.lit('"}]'))),
        "nothing": tagged("NULL", F.lit(True)),
        "bin": tagged("B", F.base64(F.encode(et, "UTF-8"))),
        "kinds": tagged("SS", F.array(et)),
        "nums": tagged("NS", F.array(F.col("user_id").cast("string"))),
        "bins": tagged("BS", F.array(F.base64(F.encode(et, "UTF-8")))),
    }


def _event_items(events: DataFrame) -> DataFrame:
    # building items is CPU work per row: spread a single-split input first
    return items_of(ensure_parallelism(events).select(item_from_columns(_event_item_attrs()).alias("item")))


def _sparse_event_items(events: DataFrame) -> DataFrame:
    """user_id missing on signups; note (tag NULL) only on errors."""
    et = F.col("event_type")
    attrs = {
        "event_id": tagged("N", F.col("event_id").cast("string")),
        "user_id": F.when(et != "signup", tagged("N", F.col("user_id").cast("string"))),
        "note": F.when(et == "error", tagged("NULL", F.lit(True))),
    }
    return items_of(ensure_parallelism(events).select(item_from_columns(attrs).alias("item")))


def _attr_json(tag: str, value: Column, nested: bool = False) -> Column:
    """JSON text of one attribute; nested L/M values are written as JSON, not strings."""
    if nested:
        return F.concat(F.lit(f'{{"{tag}":'), value, F.lit("}"))
    return F.to_json(F.struct(value.alias(tag)))


def _event_export_lines(events: DataFrame) -> DataFrame:
    """Export lines ``{"Item": {...}}`` with every tag plus an unknown tag ``u``."""
    et = F.col("event_type")
    attrs = [
        ("event_id", _attr_json("N", F.col("event_id").cast("string"))),
        ("event_type", _attr_json("S", et)),
        ("is_big", _attr_json("BOOL", F.col("value") > 100)),
        ("props", _attr_json("M", F.concat(F.lit('{"k":{"N":"'),
                                           F.get_json_object("props", "$.k"), F.lit('"}}')), True)),
        ("tags", _attr_json("L", F.concat(F.lit('[{"S":"'), et, F.lit('"}]')), True)),
        ("nothing", _attr_json("NULL", F.lit(True))),
        ("bin", _attr_json("B", F.base64(F.encode(et, "UTF-8")))),
        ("kinds", _attr_json("SS", F.array(et))),
        ("nums", _attr_json("NS", F.array(F.col("user_id").cast("string")))),
        ("bins", _attr_json("BS", F.array(F.base64(F.encode(et, "UTF-8"))))),
        ("u", F.concat(F.lit('{"ZZ":'), F.col("user_id").cast("string"), F.lit("}"))),
    ]
    members = [F.concat(F.lit(f'"{name}":'), js) for name, js in attrs]
    line = F.concat(F.lit('{"Item":{'), F.concat_ws(",", *members), F.lit("}}"))
    return events.select(line.alias("value"))


def _write_export(spark: SparkSession, events: DataFrame, label: str, files: int | None = None) -> str:
    """Write events as export lines (``files`` text files when given)."""
    folder = scratch_folder(spark, label)
    lines = _event_export_lines(events)
    lines = lines.repartition(files) if files else ensure_parallelism(lines)
    lines.write.text(folder)
    return folder


def _readers(spark: SparkSession) -> int:
    """Files and scan segments of an export: one for every core, four at least."""
    return max(4, spark.sparkContext.defaultParallelism)


def _append_files(spark: SparkSession, source: str, target: str) -> None:
    """Move the export files of one folder into another, behind those that are there by name."""
    for name, is_folder, _ in fs.children(spark, source):
        if not is_folder and not name.startswith((".", "_")):
            fs.move(spark, f"{source}/{name}", f"{target}/z-{name}")


_EVENT_FLAT_SQL_COLUMNS = """CAST(event_id AS VARCHAR) AS event_id, event_type,
  lower(CAST(value > 100 AS VARCHAR)) AS is_big,
  concat('{"k":{"N":"', props->>'k', '"}}') AS props,
  concat('[{"S":"', event_type, '"}]') AS tags,
  'null' AS nothing, '[binary data]' AS bin, concat('["', event_type, '"]') AS kinds,
  concat('["', CAST(user_id AS VARCHAR), '"]') AS nums, '[binary set data]' AS bins"""


# --------------------------------------------------------------------------
# anti-joins
# --------------------------------------------------------------------------

def q_anti_join_single(spark, sf):
    orders = _t(spark, sf, "orders")
    landed = (_t(spark, sf, "lineitem").where(F.col("l_shipdate") < _ts("1997-01-01"))
              .select(F.col("l_orderkey").alias("o_orderkey")))
    return new_records(orders, landed, "o_orderkey")


def q_anti_join_composite(spark, sf):
    conv = _t(spark, sf, "conversations").select("conv_id", "turn", "role")
    landed = conv.where(F.col("turn") < 3)
    return new_records(conv, landed, "conv_id,turn")


def q_anti_join_duplicates(spark, sf):
    li = _t(spark, sf, "lineitem")
    landed = li.where(F.col("l_returnflag") == "R")
    keys = ["l_orderkey", "l_linenumber"]
    return new_records(li, landed, keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))


def _null_key_events(spark, sf):
    ev = _t(spark, sf, "events")
    return ev.select(
        "event_id", "ts",
        F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("user_id")).alias("k"),
    )


NULL_KEY_CUTOFF = "2024-01-01 12:00:00"


def q_anti_join_null_keys(spark, sf):
    s = _null_key_events(spark, sf)
    landed = s.where(F.col("ts") < _ts(NULL_KEY_CUTOFF))
    return new_records(s, landed, "k").select("event_id", "k")


def q_anti_join_null_safe(spark, sf):
    s = _null_key_events(spark, sf)
    landed = s.where(F.col("ts") < _ts(NULL_KEY_CUTOFF))
    return new_records(s, landed, "k", null_safe=True).select("event_id", "k")


def q_anti_join_hot_key(spark, sf):
    """A third of the rows share one text key, another sixth have none; the landed side is a Parquet tree."""
    li = _t(spark, sf, "lineitem")
    key = (F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).when(F.col("l_orderkey") % 6 == 1, F.lit(None))
           .otherwise(F.col("l_orderkey").cast("string")))
    folder = scratch_folder(spark, "hot-landed")
    _t(spark, sf, "orders").where(F.col("o_orderkey") % 2 == 0).select(F.col("o_orderkey").cast("string").alias("k")).write.parquet(folder)
    return new_records(li.withColumn("k", key), read_landed(spark, folder, keys=["k"]), "k", strategy="shuffle")


def q_anti_join_mixed_types(spark, sf):
    """Double keys of the source against decimal and whole-number keys of the landed side."""
    o = _t(spark, sf, "orders").select("o_orderkey", F.col("o_orderkey").cast("double").alias("a"),
                                       F.col("o_custkey").cast("decimal(12,2)").alias("b"))
    landed = _t(spark, sf, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").cast("decimal(18,1)").alias("a"), F.col("o_custkey").cast("decimal(10,0)").alias("b"))
    return new_records(o, landed, "a,b").select("o_orderkey")


def q_anti_join_shuffle(spark, sf):
    """J1 forced onto the shuffle (sort-merge) path, as for landed trees too big to broadcast."""
    orders = _t(spark, sf, "orders")
    landed = (_t(spark, sf, "lineitem").where(F.col("l_shipdate") < _ts("1997-01-01"))
              .select(F.col("l_orderkey").alias("o_orderkey")))
    return new_records(orders, landed, "o_orderkey", strategy="shuffle")


# --------------------------------------------------------------------------
# items, fields, schemas
# --------------------------------------------------------------------------

def q_flatten_items(spark, sf):
    return flatten_items(_event_items(_t(spark, sf, "events")))


def q_flatten_missing(spark, sf):
    return flatten_items(_sparse_event_items(_t(spark, sf, "events")))


def q_discover_fields(spark, sf):
    return discover_fields(_sparse_event_items(_t(spark, sf, "events")))


def q_items_json(spark, sf):
    folder = _write_export(spark, _t(spark, sf, "events"), "items-json")
    return flatten_items(read_items_json(spark, folder))


EVENT_FIELDS = ("event_id", "event_type", "is_big", "props", "tags", "nothing", "bin", "kinds", "nums", "bins", "u")


def q_items_json_typed(spark, sf):
    """Same export with known fields: no discovery pass, and unknown tags keep their JSON text."""
    folder = _write_export(spark, _t(spark, sf, "events"), "items-json-typed")
    return flatten_items(read_items_json(spark, folder), fields=EVENT_FIELDS, raw_fields={"u"})


def _scan_client(spark) -> str:
    """Factory of the offline client that stands in for a live table; shipped to the workers."""
    return "tidemark.sources.offline:ExportFolderClient"


def q_scan_items(spark, sf):
    folder = _write_export(spark, _t(spark, sf, "events"), "items-scan", files=16)
    return flatten_items(read_items_scan(spark, "events", _scan_client(spark), path=folder))


def q_unified_schema(spark, sf):
    region, nation = _t(spark, sf, "region"), _t(spark, sf, "nation")
    schema = unified_string_schema(region, nation)
    both = enforce_schema(region, schema).unionByName(enforce_schema(nation, schema))
    counts = both.agg(*[F.count(F.col(f.name)).alias(f.name) for f in schema.fields])
    rows = [
        F.struct(F.lit(i + 1).alias("pos"), F.lit(f.name).alias("field"),
                 F.lit(f.dataType.simpleString()).alias("type"), F.col(f.name).alias("n_values"))
        for i, f in enumerate(schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def q_enforce_unified(spark, sf):
    region, nation = _t(spark, sf, "region"), _t(spark, sf, "nation")
    return enforce_schema(nation, unified_string_schema(region, nation))


def _events_as_text(spark, sf):
    ev = _t(spark, sf, "events")
    ts = F.col("ts").cast("string")
    return ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.substring(ts, 1, 10).alias("day"),
        ts.alias("ts"),
        F.col("event_type"),
        F.col("value").cast("string").alias("value"),
        (F.col("value") > 100).cast("string").alias("is_big"),
    )


def q_infer_schema(spark, sf):
    schema = infer_schema(ensure_parallelism(_events_as_text(spark, sf)), "event_id")
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in schema.fields]
    return spark.createDataFrame(rows, "field string, type string, nullable boolean")


def q_infer_schema_wide(spark, sf):
    """Texts that look like numbers but must not lose a digit."""
    key = F.col("o_orderkey").cast("string")
    df = _t(spark, sf, "orders").select(
        key.alias("k"), F.concat(F.lit("00"), key).alias("code"), F.concat(key, F.lit("\n")).alias("line"),
        F.concat(F.lit("9007199254740993"), key).alias("whole"),
        F.concat(F.lit("9007199254740993"), key, F.lit(".5")).alias("exact"),
        F.rpad(key, 40, "7").alias("too_wide"), F.concat(key, F.lit(".25")).alias("short"))
    rows = [(f.name, f.dataType.simpleString(), f.nullable) for f in infer_schema(ensure_parallelism(df), "k").fields]
    return spark.createDataFrame(rows, "field string, type string, nullable boolean")


def q_validate_keys(spark, sf):
    """NULL counts of keys that hold, and the refusal of one that does not."""
    ev = _null_key_events(spark, sf)
    counts = validate_keys(ev, "event_id,ts")
    try:
        validate_keys(ev, "k")
        refused = False
    except ValueError:
        refused = True
    rows = [(k, n, False) for k, n in counts.items()] + [("k", None, refused)]
    return spark.createDataFrame(rows, "key string, nulls long, refused boolean")


def q_enforce_typed(spark, sf):
    ev = _t(spark, sf, "events")
    df = ev.select(
        F.when(F.col("event_type") == "signup", F.lit(None)).otherwise(F.col("event_type")).alias("k"),
        F.when(F.col("event_type").isin("view", "click"), F.col("event_id").cast("string"))
        .otherwise(F.concat(F.lit("x"), F.col("event_id").cast("string"))).alias("n"),
    )
    schema = T.StructType([T.StructField("k", T.StringType(), False),
                           T.StructField("n", T.IntegerType(), True)])
    return enforce_schema(df, schema, keys=["k"])


# --------------------------------------------------------------------------
# projections, keys, filters, samples, rules
# --------------------------------------------------------------------------

def q_stamp_run(spark, sf):
    return stamp_run(_t(spark, sf, "orders"), RUN_2)


def q_run_folder(spark, sf):
    o = _t(spark, sf, "orders")
    return o.select("o_orderkey", run_folder_expr("o_orderdate").alias("folder"))


def q_key_name(spark, sf):
    c = _t(spark, sf, "conversations")
    odd = F.when(F.col("turn") != 1, F.concat(F.col("role"), F.lit(" a:b\\c")))
    return c.select("conv_id", "turn", key_name(F.col("conv_id"), odd).alias("file_key"))


def q_distinct_keys(spark, sf):
    return distinct_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_filter_keys(spark, sf):
    li = _t(spark, sf, "lineitem")
    wanted = (_t(spark, sf, "orders").where(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_orderkey").alias("l_orderkey"), F.lit(1).alias("l_linenumber")))
    return filter_keys(li, ["l_orderkey", "l_linenumber"], wanted)


def q_sample_rows(spark, sf):
    return sample_rows(_t(spark, sf, "orders"), 1000).agg(F.count(F.lit(1)).alias("n_rows"))


def q_check_rules(spark, sf):
    return check_rules(_t(spark, sf, "orders"),
                       [ColumnCount(">", 0), RowCount(">", 0), IsComplete("o_orderkey")])


# --------------------------------------------------------------------------
# landing runs (write, read back)
# --------------------------------------------------------------------------

def _config(spark, sf, name, keys, **kw) -> TableConfig:
    """Config landing driver table ``name`` (read from ``sf``) into a fresh root."""
    return TableConfig(name=name, root=scratch_folder(spark, f"landed-{name}"), keys=keys,
                       source=lambda s: _t(s, sf, name), source_format="parquet", **kw)


def q_read_landed(spark, sf):
    orders = _t(spark, sf, "orders")
    cfg = _config(spark, sf, "orders", "o_orderkey")
    early = orders.where(F.col("o_orderdate") < _ts("1998-01-01")).drop("o_orderpriority")
    land_table(spark, cfg, RUN_1, source=early)
    land_table(spark, cfg, RUN_2, source=orders)
    return read_landed(spark, cfg.root).select(*orders.columns)


def q_land_as_text(spark, sf):
    """Landing with the unified text schema (every column text, sorted by name)."""
    cfg = _config(spark, sf, "orders", "o_orderkey", as_text=True)
    land_table(spark, cfg, RUN_1, source=_t(spark, sf, "orders"))
    return read_landed(spark, cfg.root)


def q_write_per_key(spark, sf):
    li = _t(spark, sf, "lineitem")
    folder = scratch_folder(spark, "per-key")
    write_run(li, folder, layout="per_key", keys=["l_returnflag", "l_linestatus"])
    return spark.read.schema(li.schema.add(FILE_KEY, T.StringType())).parquet(folder)


def q_write_key_files(spark, sf):
    """One file per key combination, named by it; the rows and the file they lie in."""
    li = _t(spark, sf, "lineitem")
    folder = scratch_folder(spark, "key-files")
    write_run(li, folder, layout="key_files", keys=["l_returnflag", "l_linestatus"])
    return spark.read.parquet(folder).select("l_orderkey", "l_linenumber", "l_shipdate", F.col("_metadata.file_name").alias("file"))


def q_read_widened(spark, sf):
    """A key that was int, then bigint, then text: each run lands what is new, and all read back as bigint."""
    orders = _t(spark, sf, "orders")
    cfg = _config(spark, sf, "orders", "o_orderkey", widen_types=True)
    for i, type_ in enumerate(("int", "bigint", "string")):
        land_table(spark, cfg, RUN_1 + timedelta(days=i), source=orders.where(F.pmod("o_orderkey", F.lit(3)).between(i - 1, i))
                   .withColumn("o_orderkey", F.col("o_orderkey").cast(type_)))
    declared = T.StructType([T.StructField("o_orderkey", T.LongType())])
    return read_reconciled(spark, cfg.root, declared=declared).select("o_orderkey", "o_custkey", "processed_date")


def q_write_overwrite(spark, sf):
    """The same folder written twice: the second write replaces the first."""
    orders = _t(spark, sf, "orders")
    folder = scratch_folder(spark, "overwrite")
    write_run(orders, folder)
    n = write_run(orders.where(F.col("o_orderstatus") == "F"), folder, mode="overwrite")
    return spark.read.parquet(folder).withColumn("n_written", F.lit(n).cast("bigint"))


def q_first_full_load(spark, sf):
    cfg = _config(spark, sf, "conversations", "conv_id,turn")
    land_table(spark, cfg, RUN_1, source=_t(spark, sf, "conversations"))
    return read_landed(spark, cfg.root)


def q_incremental_extract(spark, sf):
    conv = _t(spark, sf, "conversations")
    cfg = _config(spark, sf, "conversations", "conv_id,turn")
    land_table(spark, cfg, RUN_1, source=conv.where(F.col("turn") < 3))
    land_table(spark, cfg, RUN_2, source=conv)
    return read_landed(spark, cfg.root)


def q_anti_join_indexed(spark, sf):
    """Four runs, each with the rows of the run before and new ones; all but the first keep and use a key index."""
    orders = _t(spark, sf, "orders")
    cfg = _config(spark, sf, "orders", "o_orderkey,o_orderpriority")
    for i in range(4):
        land_table(spark, replace(cfg, key_index=i > 0), RUN_1 + timedelta(days=i),
                   source=orders.where(F.pmod("o_orderkey", F.lit(4)).between(i - 1, i)))
    return read_landed(spark, cfg.root).select("o_orderkey", "o_orderpriority", "o_totalprice", "processed_date")


def q_empty_source(spark, sf):
    """A run without source rows over a landed tree, by every join strategy: skipped, nothing left behind."""
    orders = _t(spark, sf, "orders")
    rows = []
    for strategy in STRATEGIES:
        cfg = _config(spark, sf, "orders", "o_orderkey", on_empty="skip", join_strategy=strategy)
        land_table(spark, cfg, RUN_1, source=orders)
        rep = land_table(spark, cfg, RUN_2, source=orders.where(F.col("o_orderkey") < 0))
        rows.append((strategy, rep.status, rep.mode, rep.source_rows, rep.new_rows,
                     fs.exists(spark, rep.run_folder), read_landed(spark, cfg.root).count()))
    return spark.createDataFrame(rows, "strategy string, status string, mode string, source_rows long, "
                                       "new_rows long, left_behind boolean, landed_rows long")


def q_incremental_rerun(spark, sf):
    orders = _t(spark, sf, "orders")
    cfg = _config(spark, sf, "orders", "o_orderkey")
    land_table(spark, cfg, RUN_1, source=orders)
    rep = land_table(spark, cfg, RUN_2, source=orders)
    return read_landed(spark, cfg.root).agg(
        F.lit(rep.source_rows).cast("bigint").alias("source_rows"),
        F.count(F.lit(1)).alias("existing_rows"),
        F.lit(rep.new_rows).cast("bigint").alias("new_rows"),
    )


def q_land_items(spark, sf):
    """Export items -> flatten -> anti-join -> run folders, in two runs (the full reference flow)."""
    events = _t(spark, sf, "events")
    early = _write_export(spark, events.where(F.col("ts") < _ts("2024-01-15")), "items-run1")
    full = _write_export(spark, events, "items-run2")
    root = scratch_folder(spark, "landed-items")
    land_table(spark, TableConfig("events", root, "event_id", early), RUN_1)
    land_table(spark, TableConfig("events", root, "event_id", full), RUN_2)
    return read_landed(spark, root)


def q_stream_landing(spark, sf):
    """Export files arrive one per micro-batch; each batch lands as its own run folder."""
    events = _t(spark, sf, "events")
    source = _write_export(spark, events, "stream-source", files=4)
    root = scratch_folder(spark, "landed-stream")
    query = land_stream(spark, TableConfig("events", root, "event_id", source), source,
                        checkpoint_location=scratch_folder(spark, "stream-checkpoint"),
                        max_files_per_trigger=1, clock=lambda: RUN_1)
    query.awaitTermination()
    query.stop()
    return read_landed(spark, root).drop("processed_at")  # the order of files among batches is not fixed


def q_stream_changes(spark, sf):
    """A change feed landed in two rounds of one stream: the second takes up where the first stopped."""
    events = _t(spark, sf, "events")
    feed = _write_export(spark, events.where(F.col("ts") < _ts("2024-01-15")), "feed", files=_readers(spark))
    later = _write_export(spark, events.where(F.col("ts") >= _ts("2024-01-15")), "feed-later", files=_readers(spark))
    root, checkpoint = scratch_folder(spark, "landed-changes"), scratch_folder(spark, "changes-checkpoint")
    for run_at in (RUN_1, RUN_2):
        query = land_changes(spark, TableConfig("events", root, "event_id", feed), "events", checkpoint, _scan_client(spark),
                             segments=4, client_options={"path": feed}, clock=lambda: run_at)
        query.awaitTermination()
        query.stop()
        if run_at == RUN_1:
            _append_files(spark, later, feed)
    return read_landed(spark, root).drop("processed_at")


def q_land_tables(spark, sf):
    configs = [
        _config(spark, sf, "conversations", "conv_id,turn"),
        _config(spark, sf, "orders", "o_orderkey"),
    ]
    return land_tables(spark, configs, RUN_1).select(
        "table_name", "key_kind", "status", "source_rows", "new_rows")


def q_land_tables_failures(spark, sf):
    """Failing tables among good ones: a missing export is tried again, a wrong key name is not."""
    configs = [
        _config(spark, sf, "orders", "o_orderkey"),
        TableConfig("absent", scratch_folder(spark, "landed-absent"), "id", scratch_folder(spark, "no-export")),
        _config(spark, sf, "conversations", "conv_id,no_such_column"),
        _config(spark, sf, "events", "event_id", rules=["RowCount < 1"], fail_on_violation=True),
        _config(spark, sf, "nation", "n_nationkey", rules=["RowCount < 1"]),
    ]
    return land_tables(spark, configs, RUN_1, max_attempts=2).select(
        "table_name", "status", "attempts", "new_rows", "rules_failed", F.col("error").isNotNull().alias("has_error"))


def q_land_from_args(spark, sf):
    """Launcher arguments and table options, for a scanned table landed in two runs."""
    events = _t(spark, sf, "events")
    root = scratch_folder(spark, "landed-args")
    scheme, _, path = root.rpartition("://")
    bucket, _, folder = path.strip("/").rpartition("/")
    factory = _scan_client(spark)
    for run_at, rows in ((RUN_1, events.where(F.col("ts") < _ts("2024-01-15"))), (RUN_2, events)):
        export = _write_export(spark, rows, "args-export", files=_readers(spark))
        entry = {"--bucket_name": bucket, "--folder_name": folder, "--primary_key": "event_id",
                 "--primary_key_is_composite": "false", "--dynamo_table_name": "events", "source": "events",
                 "source_format": "items_scan", "null_safe": "true", "rules": 'RowCount > 0; IsComplete "event_id"',
                 "fail_on_violation": "true", "audit_names": "run_day,run_time",
                 "options": {"client_factory": factory, "segments": str(_readers(spark)), "client.path": export}}
        land_tables(spark, [config_from_entry(entry, scheme or "file")], run_at)
    return read_landed(spark, root)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "anti_join_single": q_anti_join_single,
    "anti_join_composite": q_anti_join_composite,
    "anti_join_duplicates": q_anti_join_duplicates,
    "anti_join_null_keys": q_anti_join_null_keys,
    "anti_join_null_safe": q_anti_join_null_safe,
    "anti_join_shuffle": q_anti_join_shuffle,
    "anti_join_hot_key": q_anti_join_hot_key,
    "anti_join_mixed_types": q_anti_join_mixed_types,
    "flatten_items": q_flatten_items,
    "flatten_missing": q_flatten_missing,
    "discover_fields": q_discover_fields,
    "items_json": q_items_json,
    "items_json_typed": q_items_json_typed,
    "scan_items": q_scan_items,
    "unified_schema": q_unified_schema,
    "enforce_unified": q_enforce_unified,
    "infer_schema": q_infer_schema,
    "infer_schema_wide": q_infer_schema_wide,
    "enforce_typed": q_enforce_typed,
    "validate_keys": q_validate_keys,
    "stamp_run": q_stamp_run,
    "run_folder": q_run_folder,
    "key_name": q_key_name,
    "distinct_keys": q_distinct_keys,
    "filter_keys": q_filter_keys,
    "sample_rows": q_sample_rows,
    "check_rules": q_check_rules,
    "read_landed": q_read_landed,
    "land_as_text": q_land_as_text,
    "write_per_key": q_write_per_key,
    "read_widened": q_read_widened,
    "write_key_files": q_write_key_files,
    "write_overwrite": q_write_overwrite,
    "first_full_load": q_first_full_load,
    "incremental_extract": q_incremental_extract,
    "incremental_rerun": q_incremental_rerun,
    "anti_join_indexed": q_anti_join_indexed,
    "empty_source": q_empty_source,
    "land_items": q_land_items,
    "stream_landing": q_stream_landing,
    "stream_changes": q_stream_changes,
    "land_tables": q_land_tables,
    "land_tables_failures": q_land_tables_failures,
    "land_from_args": q_land_from_args,
}


_NULL_KEY_CTE = """WITH s AS (SELECT event_id, ts,
  CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS k FROM events)"""

_INFER_SQL = """SELECT field, CASE
  WHEN count(*) FILTER (WHERE regexp_full_match(v, '(true|false)')) = count(v) AND count(v) > 0 THEN 'boolean'
  WHEN count(*) FILTER (WHERE regexp_full_match(v, '-?[0-9]+') AND TRY_CAST(v AS INTEGER) IS NOT NULL) = count(v) AND count(v) > 0 THEN 'int'
  WHEN count(*) FILTER (WHERE regexp_full_match(v, '-?[0-9]+') AND TRY_CAST(v AS BIGINT) IS NOT NULL) = count(v) AND count(v) > 0 THEN 'bigint'
  WHEN count(*) FILTER (WHERE regexp_full_match(v, '-?[0-9]+') AND TRY_CAST(v AS DECIMAL(38,0)) IS NOT NULL) = count(v) AND count(v) > 0 THEN 'decimal(38,0)'
  WHEN count(*) FILTER (WHERE regexp_full_match(v, '-?[0-9]+([.][0-9]+)?([eE][-+]?[0-9]+)?')) = count(v) AND count(v) > 0 THEN 'double'
  WHEN count(*) FILTER (WHERE regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}') AND TRY_CAST(v AS DATE) IS NOT NULL) = count(v) AND count(v) > 0 THEN 'date'
  WHEN count(*) FILTER (WHERE regexp_full_match(v, '[0-9]{4}-[0-9]{2}-[0-9]{2}[ T].+') AND TRY_CAST(v AS TIMESTAMP) IS NOT NULL) = count(v) AND count(v) > 0 THEN 'timestamp'
  ELSE 'string' END AS type, field <> 'event_id' AS nullable
FROM (SELECT 'event_id' AS field, CAST(event_id AS VARCHAR) AS v FROM events
  UNION ALL SELECT 'user_id', CAST(user_id AS VARCHAR) FROM events
  UNION ALL SELECT 'day', substr(CAST(ts AS VARCHAR), 1, 10) FROM events
  UNION ALL SELECT 'ts', CAST(ts AS VARCHAR) FROM events
  UNION ALL SELECT 'event_type', event_type FROM events
  UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM events
  UNION ALL SELECT 'is_big', lower(CAST(value > 100 AS VARCHAR)) FROM events) t
GROUP BY field"""


_UNKNOWN_SQL = """concat('{"ZZ":', CAST(user_id AS VARCHAR), '}') AS u"""
_RUN_DAY_SQL = "CASE WHEN ts < TIMESTAMP '2024-01-15' THEN '2025-01-01' ELSE '2025-01-02' END"

ORACLE_SQL: dict[str, str] = {
    "anti_join_single": """SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l
  WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate < TIMESTAMP '1997-01-01')""",
    "anti_join_composite": """SELECT c.conv_id, c.turn, c.role FROM conversations c WHERE NOT EXISTS
  (SELECT 1 FROM conversations e WHERE e.conv_id = c.conv_id AND e.turn = c.turn AND e.turn < 3)""",
    "anti_join_duplicates": """SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem s
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = s.l_orderkey
  AND l.l_linenumber = s.l_linenumber AND l.l_returnflag = 'R')
GROUP BY l_orderkey, l_linenumber""",
    "anti_join_null_keys": _NULL_KEY_CTE + """
SELECT event_id, k FROM s a WHERE NOT EXISTS
  (SELECT 1 FROM s b WHERE b.ts < TIMESTAMP '2024-01-01 12:00:00' AND a.k = b.k)""",
    "anti_join_null_safe": _NULL_KEY_CTE + """
SELECT event_id, k FROM s a WHERE NOT EXISTS
  (SELECT 1 FROM s b WHERE b.ts < TIMESTAMP '2024-01-01 12:00:00' AND a.k IS NOT DISTINCT FROM b.k)""",
    "anti_join_shuffle": """SELECT * FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l
  WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate < TIMESTAMP '1997-01-01')""",
    "anti_join_hot_key": """WITH s AS (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 'hot' WHEN l_orderkey % 6 = 1 THEN NULL
  ELSE CAST(l_orderkey AS VARCHAR) END AS k FROM lineitem)
SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey % 2 = 0 AND CAST(o.o_orderkey AS VARCHAR) = s.k)""",
    "anti_join_mixed_types": """SELECT o_orderkey FROM orders a WHERE NOT EXISTS
  (SELECT 1 FROM orders b WHERE b.o_orderstatus = 'F' AND b.o_orderkey = a.o_orderkey AND b.o_custkey = a.o_custkey)""",
    "infer_schema_wide": """WITH t AS (SELECT max(length(CAST(o_orderkey AS VARCHAR))) AS n, max(o_orderkey) AS m FROM orders)
SELECT 'k' AS field, CASE WHEN m < 2147483648 THEN 'int' ELSE 'bigint' END AS type, false AS nullable FROM t
UNION ALL SELECT 'code', 'string', true
UNION ALL SELECT 'line', 'string', true
UNION ALL SELECT 'whole', CASE WHEN 16 + n <= 18 THEN 'bigint' ELSE 'decimal(38,0)' END, true FROM t
UNION ALL SELECT 'exact', concat('decimal(', 16 + n + 1, ',1)'), true FROM t
UNION ALL SELECT 'too_wide', 'string', true
UNION ALL SELECT 'short', 'double', true""",
    "validate_keys": """SELECT 'event_id' AS key, count(*) FILTER (WHERE event_id IS NULL) AS nulls, false AS refused FROM events
UNION ALL SELECT 'ts', count(*) FILTER (WHERE ts IS NULL), false FROM events
UNION ALL SELECT 'k', NULL, count(*) FILTER (WHERE event_type = 'signup') > 0 FROM events""",
    "flatten_items": f"SELECT {_EVENT_FLAT_SQL_COLUMNS} FROM events",
    "flatten_missing": """SELECT CAST(event_id AS VARCHAR) AS event_id,
  CASE WHEN event_type <> 'signup' THEN CAST(user_id AS VARCHAR) END AS user_id,
  CASE WHEN event_type = 'error' THEN 'null' END AS note FROM events""",
    "discover_fields": """SELECT field, count(*) AS n_items FROM (
  SELECT 'event_id' AS field FROM events
  UNION ALL SELECT 'user_id' FROM events WHERE event_type <> 'signup'
  UNION ALL SELECT 'note' FROM events WHERE event_type = 'error') t GROUP BY field""",
    "items_json": f"""SELECT {_EVENT_FLAT_SQL_COLUMNS},
  concat('{{"ZZ":', CAST(user_id AS VARCHAR), '}}') AS u FROM events""",
    "items_json_typed": f"""SELECT {_EVENT_FLAT_SQL_COLUMNS},
  concat('{{"ZZ":', CAST(user_id AS VARCHAR), '}}') AS u FROM events""",
    "scan_items": f"""SELECT {_EVENT_FLAT_SQL_COLUMNS},
  concat('{{"ZZ":', CAST(user_id AS VARCHAR), '}}') AS u FROM events""",
    "unified_schema": """SELECT CAST(row_number() OVER (ORDER BY field) AS INTEGER) AS pos, field,
  'string' AS type, n_values FROM (
  SELECT 'r_regionkey' AS field, count(r_regionkey) AS n_values FROM region
  UNION ALL SELECT 'r_name', count(r_name) FROM region
  UNION ALL SELECT 'n_nationkey', count(n_nationkey) FROM nation
  UNION ALL SELECT 'n_name', count(n_name) FROM nation
  UNION ALL SELECT 'n_regionkey', count(n_regionkey) FROM nation) t""",
    "enforce_unified": """SELECT n_name, CAST(n_nationkey AS VARCHAR) AS n_nationkey,
  CAST(n_regionkey AS VARCHAR) AS n_regionkey,
  CAST(NULL AS VARCHAR) AS r_name, CAST(NULL AS VARCHAR) AS r_regionkey FROM nation""",
    "infer_schema": _INFER_SQL,
    "enforce_typed": """SELECT coalesce(CASE WHEN event_type = 'signup' THEN NULL ELSE event_type END, 'NULL_k') AS k,
  TRY_CAST(CASE WHEN event_type IN ('view', 'click') THEN CAST(event_id AS VARCHAR)
    ELSE concat('x', CAST(event_id AS VARCHAR)) END AS INTEGER) AS n FROM events""",
    "stamp_run": """SELECT *, '2025-01-02' AS processed_date, '2025-01-02 00:00:00' AS processed_at
FROM orders""",
    "run_folder": """SELECT o_orderkey, strftime(o_orderdate, '%Y/%m/%d/%H-%M-%S') AS folder FROM orders""",
    "key_name": """SELECT conv_id, turn, replace(replace(replace(concat_ws('_', CAST(conv_id AS VARCHAR),
  coalesce(CASE WHEN turn <> 1 THEN concat(role, ' a:b', chr(92), 'c') END, 'NULL')),
  ' ', '_'), chr(92), '_'), ':', '_') AS file_key FROM conversations""",
    "distinct_keys": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "filter_keys": """SELECT * FROM lineitem WHERE l_linenumber = 1
  AND l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
    "sample_rows": "SELECT least(1000, count(*)) AS n_rows FROM orders",
    "check_rules": """SELECT 'ColumnCount > 0' AS rule, CAST(6 AS BIGINT) AS actual, true AS passed
UNION ALL SELECT 'RowCount > 0', count(*), count(*) > 0 FROM orders
UNION ALL SELECT 'IsComplete "o_orderkey"', count(*) FILTER (WHERE o_orderkey IS NULL),
  count(*) FILTER (WHERE o_orderkey IS NULL) = 0 FROM orders""",
    "read_landed": """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
  CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders""",
    "land_as_text": """SELECT CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
  CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, o_orderstatus,
  CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  '2025-01-01' AS processed_date, '2025-01-01 00:00:00' AS processed_at FROM orders""",
    "write_per_key": "SELECT *, concat(l_returnflag, '_', l_linestatus) AS file_key FROM lineitem",
    "read_widened": """SELECT o_orderkey, o_custkey, concat('2025-01-0', CAST(o_orderkey % 3 + 1 AS VARCHAR)) AS processed_date FROM orders""",
    "write_key_files": """SELECT l_orderkey, l_linenumber, l_shipdate,
  concat(l_returnflag, '_', l_linestatus, '.parquet') AS file FROM lineitem""",
    "write_overwrite": """SELECT *, (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS n_written
FROM orders WHERE o_orderstatus = 'F'""",
    "first_full_load": """SELECT *, '2025-01-01' AS processed_date, '2025-01-01 00:00:00' AS processed_at
FROM conversations""",
    "incremental_extract": """SELECT *, CASE WHEN turn < 3 THEN '2025-01-01' ELSE '2025-01-02' END AS processed_date,
  CASE WHEN turn < 3 THEN '2025-01-01 00:00:00' ELSE '2025-01-02 00:00:00' END AS processed_at FROM conversations""",
    "anti_join_indexed": """SELECT o_orderkey, o_orderpriority, o_totalprice,
  concat('2025-01-0', CAST(o_orderkey % 4 + 1 AS VARCHAR)) AS processed_date FROM orders""",
    "empty_source": """SELECT strategy, 'SUCCEEDED' AS status, 'skipped' AS mode, CAST(0 AS BIGINT) AS source_rows,
  CAST(0 AS BIGINT) AS new_rows, false AS left_behind, (SELECT count(*) FROM orders) AS landed_rows
FROM (VALUES ('auto'), ('broadcast'), ('shuffle')) t(strategy)""",
    "incremental_rerun": """SELECT count(*) AS source_rows, count(*) AS existing_rows,
  CAST(0 AS BIGINT) AS new_rows FROM orders""",
    "land_items": f"""SELECT {_EVENT_FLAT_SQL_COLUMNS}, {_UNKNOWN_SQL}, {_RUN_DAY_SQL} AS processed_date,
  concat({_RUN_DAY_SQL}, ' 00:00:00') AS processed_at FROM events""",
    "stream_landing": f"""SELECT {_EVENT_FLAT_SQL_COLUMNS}, {_UNKNOWN_SQL}, '2025-01-01' AS processed_date
FROM events""",
    "stream_changes": f"""SELECT {_EVENT_FLAT_SQL_COLUMNS}, {_UNKNOWN_SQL}, {_RUN_DAY_SQL} AS processed_date FROM events""",
    "land_from_args": f"""SELECT {_EVENT_FLAT_SQL_COLUMNS}, {_UNKNOWN_SQL}, {_RUN_DAY_SQL} AS run_day,
  concat({_RUN_DAY_SQL}, ' 00:00:00') AS run_time FROM events""",
    "land_tables_failures": """SELECT 'orders' AS table_name, 'SUCCEEDED' AS status, 1 AS attempts,
  (SELECT count(*) FROM orders) AS new_rows, CAST(NULL AS VARCHAR) AS rules_failed, false AS has_error
UNION ALL SELECT 'absent', 'FAILED', 2, NULL, NULL, true
UNION ALL SELECT 'conversations', 'FAILED', 1, NULL, NULL, true
UNION ALL SELECT 'events', 'FAILED', 1, NULL, NULL, true
UNION ALL SELECT 'nation', 'SUCCEEDED', 1, (SELECT count(*) FROM nation), 'RowCount < 1', false""",
    "land_tables": """SELECT 'conversations' AS table_name, 'composite' AS key_kind, 'SUCCEEDED' AS status,
  count(*) AS source_rows, count(*) AS new_rows FROM conversations
UNION ALL SELECT 'orders', 'single', 'SUCCEEDED', count(*), count(*) FROM orders""",
}

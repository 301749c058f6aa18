"""Incremental landing of key-value and other tables as Parquet run folders, on Spark."""

from tidemark.config import TableConfig, config_from_job_args, parse_keys
from tidemark.functions import decode_attribute, key_name, run_folder, tagged
from tidemark.operators import (
    ColumnCount, IsComplete, RowCount, check_rules, discover_fields, distinct_keys,
    enforce_schema, filter_keys, flatten_items, infer_schema, new_records, sample_rows, stamp_run,
    unified_string_schema, validate_keys,
)
from tidemark.plans import (
    EmptySourceError, LandingError, RuleViolation, RunReport, land_table, land_tables,
)
from tidemark.sinks import write_run
from tidemark.sources import read_items_json, read_landed
from tidemark.sources.scan import read_items_scan
from tidemark.streaming import land_stream

__all__ = [
    "TableConfig", "config_from_job_args", "parse_keys", "decode_attribute", "key_name",
    "run_folder", "tagged", "ColumnCount", "IsComplete", "RowCount", "check_rules",
    "discover_fields", "distinct_keys", "enforce_schema", "filter_keys", "flatten_items",
    "infer_schema", "new_records", "sample_rows", "stamp_run", "unified_string_schema",
    "validate_keys", "EmptySourceError", "LandingError", "RuleViolation", "RunReport",
    "land_table", "land_tables", "write_run", "read_items_json", "read_landed",
    "read_items_scan", "land_stream",
]

from tidemark.operators.diff import keyed_join, landed_key_bound, new_records
from tidemark.operators.flatten import discover_fields, field_names, flatten_items
from tidemark.operators.keys import distinct_keys, filter_keys
from tidemark.operators.quality import (
    ColumnCount, IsComplete, RowCount, check_rules, evaluate_rules, failed_rules,
)
from tidemark.operators.schema import (
    enforce_schema, infer_schema, schema_rows, unified_string_schema, validate_keys,
)
from tidemark.operators.stamp import sample_rows, stamp_run

__all__ = [
    "keyed_join", "landed_key_bound", "new_records", "discover_fields", "field_names",
    "flatten_items", "distinct_keys", "filter_keys", "ColumnCount", "IsComplete", "RowCount",
    "check_rules", "evaluate_rules", "failed_rules", "enforce_schema", "infer_schema",
    "schema_rows", "unified_string_schema", "validate_keys", "sample_rows", "stamp_run",
]

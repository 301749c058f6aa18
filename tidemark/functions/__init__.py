from tidemark.functions.attributes import (
    ATTRIBUTE_TYPE, ITEM_TYPE, TAGS, decode_attribute, item_from_columns, item_json, tagged,
)
from tidemark.functions.naming import audit_values, key_name, run_folder, run_folder_expr

__all__ = [
    "ATTRIBUTE_TYPE", "ITEM_TYPE", "TAGS", "decode_attribute", "item_from_columns", "item_json",
    "tagged", "audit_values", "key_name", "run_folder", "run_folder_expr",
]

from tidemark.sources.items import items_of, parse_items, read_items_json
from tidemark.sources.landed import read_landed

__all__ = ["items_of", "parse_items", "read_items_json", "read_landed"]

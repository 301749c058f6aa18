"""Table configuration for a landing run."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from dataclasses import fields as dataclass_fields
from typing import Union

from pyspark.sql import DataFrame, SparkSession

DEFAULT_AUDIT_NAMES = ("processed_date", "processed_at")

SOURCE_FORMATS = ("items_json", "items_scan", "parquet")
LAYOUTS = ("compact", "per_key", "key_files")
ON_EMPTY = ("error", "skip")
JOIN_STRATEGIES = ("auto", "broadcast", "shuffle")

SourceSpec = Union[str, Callable[[SparkSession], DataFrame]]


def parse_keys(keys: str | Sequence[str]) -> tuple[str, ...]:
    """Key column names from ``"a, b"`` or a sequence; trimmed, no blanks, no repeats."""
    parts = keys.split(",") if isinstance(keys, str) else list(keys)
    names = tuple(p.strip() for p in parts)
    if not names or any(not n for n in names):
        raise ValueError(f"empty key name in {keys!r}")
    if len(set(names)) != len(names):
        raise ValueError(f"repeated key name in {keys!r}")
    return names


def parse_rule(rule):
    """A quality rule from its text (``ColumnCount > 0``, ``RowCount >= 1``, ``IsComplete "id"``); rules pass through."""
    from tidemark.operators.quality import ColumnCount, IsComplete, RowCount

    if not isinstance(rule, str):
        return rule
    counted = re.fullmatch(r"\s*(ColumnCount|RowCount)\s*(>=|<=|>|<|=)\s*([0-9]+)\s*", rule)
    if counted:
        return {"ColumnCount": ColumnCount, "RowCount": RowCount}[counted[1]](counted[2], int(counted[3]))
    complete = re.fullmatch(r'\s*IsComplete\s+"(.+)"\s*', rule)
    if complete:
        return IsComplete(complete[1])
    raise ValueError(f"unknown rule {rule!r}")


@dataclass(frozen=True)
class TableConfig:
    """One table to land.

    ``source`` is a path (read as ``source_format``), the name of a table to
    scan (``items_scan``) or a callable that builds the source DataFrame from
    the session. ``root`` is the landed
    folder; every run writes a new ``root/YYYY/MM/DD/HH-MM-SS/`` folder.
    ``as_text`` lands every column as text, sorted by name (the unified
    schema items always get). ``options`` go to the source reader (for a scan:
    ``client_factory``, ``segments``, ``resume`` and ``client.`` options for the
    client; ``resume="true"`` keeps the pages of a scan in the shared checkpoint
    folder until the run has landed, so that another attempt of the run asks
    the table only for the pages it lacks),
    ``write_options`` to the Parquet writer (e.g. ``{"compression": "zstd"}``).
    ``rules`` are the table's quality rules, as rules or their texts;
    ``fail_on_violation`` checks them before anything is written.

    ``key_index`` keeps an index of the landed keys beside every run, so that
    a run reads only the blocks of them that its source may hit (see
    :mod:`tidemark.plans.key_index`); it pays where the landed history is much
    larger than one source. ``widen_types`` compares with runs whose key types
    differ by one type that holds them all, where otherwise such a tree fails
    the run (see :mod:`tidemark.plans.reconcile`). One landing at a time holds a root: others wait
    up to ``lease_wait_seconds``, and a holder that is silent for
    ``lease_seconds`` loses it (0: no lease, the caller keeps writers apart).
    """

    name: str
    root: str
    keys: tuple[str, ...]
    source: SourceSpec
    source_format: str = "items_json"
    fields: tuple[str, ...] | None = None
    layout: str = "compact"
    null_safe: bool = False
    on_empty: str = "error"
    audit_names: tuple[str, str] = DEFAULT_AUDIT_NAMES
    broadcast_max_bytes: int | None = None
    join_strategy: str = "auto"
    as_text: bool = False
    cluster_per_key: bool = False
    rules: tuple | None = None
    fail_on_violation: bool = False
    key_index: bool = False
    widen_types: bool = False
    lease_seconds: float = 120.0
    lease_wait_seconds: float = 3600.0
    catalog_database: str | None = None
    catalog_table: str | None = None
    options: dict = field(default_factory=dict, hash=False, compare=False)
    write_options: dict = field(default_factory=dict, hash=False, compare=False)

    def __post_init__(self):
        object.__setattr__(self, "keys", parse_keys(self.keys))
        if self.source_format not in SOURCE_FORMATS:
            raise ValueError(f"source_format must be one of {SOURCE_FORMATS}")
        if self.layout not in LAYOUTS:
            raise ValueError(f"layout must be one of {LAYOUTS}")
        if self.join_strategy not in JOIN_STRATEGIES:
            raise ValueError(f"join_strategy must be one of {JOIN_STRATEGIES}")
        if self.on_empty not in ON_EMPTY:
            raise ValueError(f"on_empty must be one of {ON_EMPTY}")
        if self.lease_seconds < 0 or self.lease_wait_seconds < 0:
            raise ValueError("lease times must not be negative")
        if len(self.audit_names) != 2 or len(set(self.audit_names)) != 2:
            raise ValueError("audit_names needs two distinct names")
        object.__setattr__(self, "audit_names", tuple(self.audit_names))
        if self.fields is not None:
            object.__setattr__(self, "fields", tuple(self.fields))
        if self.rules is not None:
            object.__setattr__(self, "rules", tuple(parse_rule(r) for r in self.rules))
        if self.source_format == "items_scan" and not callable(self.source) and "client_factory" not in self.options:
            raise ValueError("items_scan needs the option client_factory")

    @property
    def key_kind(self) -> str:
        return "composite" if len(self.keys) > 1 else "single"


def normal_root(root: str) -> str:
    """A root in one spelling: no trailing or doubled slashes, ``file:///q`` and ``file:/q`` as ``/q``."""
    scheme, sep, rest = root.partition(":")
    if sep and "/" not in scheme and rest.startswith("/"):
        host = ""
        if rest.startswith("//"):
            host, _, rest = rest[2:].partition("/")
        scheme = scheme.lower()
    else:
        scheme, host, rest = "file", "", root
    parts = [p for p in rest.split("/") if p not in ("", ".")]
    prefix = "" if scheme == "file" else f"{scheme}://{host.lower()}"
    return prefix + "/" + "/".join(parts)


def check_configs(configs: Sequence[TableConfig]) -> None:
    """Reject config lists in which one table's landed root is, or lies inside, another's."""
    roots = sorted((normal_root(cfg.root).rstrip("/") + "/", cfg.name, cfg.root) for cfg in configs)
    for (a, name_a, root_a), (b, name_b, root_b) in zip(roots, roots[1:]):
        if b.startswith(a):
            raise ValueError(f"tables {name_a!r} and {name_b!r} share landed data: roots {root_a!r} and {root_b!r}")


# Launcher argument names accepted by config_from_job_args
# (a leading "--" is optional).
JOB_ARG_BUCKET = "bucket_name"
JOB_ARG_FOLDER = "folder_name"
JOB_ARG_KEYS = "primary_key"
JOB_ARG_COMPOSITE = "primary_key_is_composite"
JOB_ARG_TABLE = "dynamo_table_name"
JOB_ARG_CATALOG_DB = "catalog_database"
JOB_ARG_CATALOG_TABLE = "catalog_table_name"


#: Names of JOB_ARG_* that a table entry may hold.
JOB_ARGS = (JOB_ARG_BUCKET, JOB_ARG_FOLDER, JOB_ARG_KEYS, JOB_ARG_COMPOSITE, JOB_ARG_TABLE,
            JOB_ARG_CATALOG_DB, JOB_ARG_CATALOG_TABLE)
_BOOLS = ("null_safe", "as_text", "cluster_per_key", "fail_on_violation", "key_index", "widen_types")
_SECONDS = ("lease_seconds", "lease_wait_seconds")
_LISTS = ("fields", "audit_names")
_DICTS = ("options", "write_options")
_OWN = ("name", "root", "keys", "source", "catalog_database", "catalog_table")


def parse_options(values: dict) -> dict:
    """TableConfig fields from texts: booleans, comma lists, JSON objects, rules separated by semicolons.

    Values that already have their type pass through. Unknown names raise.
    """
    known = {f.name for f in dataclass_fields(TableConfig)} - set(_OWN)
    unknown = sorted(set(values) - known)
    if unknown:
        raise ValueError(f"unknown table options {unknown}; known: {sorted(known)}")
    out = {}
    for name, v in values.items():
        if v is None:
            continue
        if isinstance(v, str):
            if name in _BOOLS:
                if v.strip().lower() not in ("true", "false"):
                    raise ValueError(f"{name} must be true or false, not {v!r}")
                v = v.strip().lower() == "true"
            elif name in _LISTS:
                v = tuple(x.strip() for x in v.split(",") if x.strip())
            elif name in _DICTS:
                v = json.loads(v)
            elif name == "rules":
                v = tuple(x.strip() for x in v.split(";") if x.strip())
            elif name in _SECONDS:
                v = float(v)
            elif name == "broadcast_max_bytes":
                v = int(v)
        out[name] = v
    return out


def config_from_entry(entry: dict, scheme: str = "s3a") -> TableConfig:
    """A TableConfig from a flat entry: launcher arguments, ``source`` and any TableConfig option.

    Names may carry a leading ``--``; unknown ones are errors.
    """
    named = {k.lstrip("-"): v for k, v in entry.items()}
    if not named.get("source"):
        raise ValueError("every table needs a source")
    args = {k: named.pop(k) for k in JOB_ARGS if k in named}
    return config_from_job_args(args, named.pop("source"), scheme, **parse_options(named))


def config_from_job_args(
    args: dict, source: SourceSpec, scheme: str = "s3a", **overrides
) -> TableConfig:
    """A TableConfig from launcher-style arguments (names above).

    The landed root is ``{scheme}://{bucket}/{folder}``. A composite flag that
    disagrees with the number of key names is an error.
    """
    a = {k.lstrip("-"): v for k, v in args.items()}
    unknown = sorted(set(a) - set(JOB_ARGS))
    if unknown:
        raise ValueError(f"unknown job arguments {unknown}; known: {sorted(JOB_ARGS)}")
    missing = [k for k in (JOB_ARG_BUCKET, JOB_ARG_FOLDER, JOB_ARG_KEYS) if not a.get(k)]
    if missing:
        raise ValueError(f"missing job arguments {missing}")
    keys = parse_keys(a[JOB_ARG_KEYS])
    flag = str(a.get(JOB_ARG_COMPOSITE, "false")).strip().lower() == "true"
    if flag != (len(keys) > 1):
        raise ValueError(f"{JOB_ARG_COMPOSITE}={a.get(JOB_ARG_COMPOSITE)!r} does not match keys {keys}")
    bucket = a[JOB_ARG_BUCKET].strip("/")
    if scheme == "file":  # a local "bucket" is an absolute folder
        bucket = "/" + bucket
    root = f"{scheme}://{bucket}/{a[JOB_ARG_FOLDER].strip('/')}"
    return TableConfig(
        name=a.get(JOB_ARG_TABLE) or a[JOB_ARG_FOLDER],
        root=root,
        keys=keys,
        source=source,
        catalog_database=a.get(JOB_ARG_CATALOG_DB),
        catalog_table=a.get(JOB_ARG_CATALOG_TABLE),
        **overrides,
    )

"""Command line: land one table from job arguments, or a list of tables from a JSON file.

    python -m tidemark --bucket_name b --folder_name t --primary_key id \\
        --dynamo_table_name t --source s3a://b/exports/t/
    spark-submit --py-files tidemark.zip tidemark/__main__.py --configs tables.json

``tables.json`` holds a list of argument objects (the same names, each with
a ``source``); unknown names are errors. Prints one JSON report line per table; exits 1 if any failed.
"""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import fields

from pyspark.sql import SparkSession

from tidemark.config import JOB_ARGS, TableConfig, config_from_entry
from tidemark.plans.landing import land_tables

#: Options of a table, settable by argument or in the JSON list.
_OPTIONS = tuple(f.name for f in fields(TableConfig) if f.name not in
                 ("name", "root", "keys", "source", "catalog_database", "catalog_table"))


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__.splitlines()[0])
    p.add_argument("--configs", help="JSON file with a list of table argument objects")
    for name in JOB_ARGS:
        p.add_argument(f"--{name}")
    p.add_argument("--source", help="item export folder, Parquet folder, or table to scan, by --source_format")
    for name in _OPTIONS:
        p.add_argument(f"--{name}", help="see TableConfig; lists by comma, rules by semicolon, options as JSON")
    p.add_argument("--scheme", default="s3a", help="URI scheme of the landed root")
    p.add_argument("--max_attempts", type=int, default=3)
    p.add_argument("--JOB_NAME", help="accepted and ignored")
    return p


def _entries(ns: argparse.Namespace) -> list[dict]:
    if ns.configs:
        with open(ns.configs, encoding="utf-8") as fh:
            return json.load(fh)
    given = {k: getattr(ns, k) for k in (*JOB_ARGS, "source", *_OPTIONS)}
    return [{k: v for k, v in given.items() if v is not None}]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ns = _parser().parse_args(argv)
    configs = [config_from_entry(entry, ns.scheme) for entry in _entries(ns)]
    spark = spark or SparkSession.builder.appName("tidemark").getOrCreate()
    failed = 0
    for row in land_tables(spark, configs, max_attempts=ns.max_attempts).collect():
        print(json.dumps(row.asDict(), default=str))
        failed += row["status"] != "SUCCEEDED"
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())

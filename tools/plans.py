"""Write PLANS.md: formatted physical plans of the main operators at one scale factor.

Usage: python tools/plans.py [sf_dir]  (default /root/testdata/sf0.1)
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from tidemark.config import TableConfig  # noqa: E402
from tidemark.operators.diff import new_records  # noqa: E402
from tidemark.operators.flatten import flatten_items  # noqa: E402
from tidemark.plans.landing import land_table  # noqa: E402
from tidemark.queries import QUERIES, _t, _write_export  # noqa: E402
from tidemark.session import local_session, scratch_folder  # noqa: E402
from tidemark.sources.items import read_items_json  # noqa: E402
from tidemark.sources.landed import read_landed  # noqa: E402


def formatted(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().strip()


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    events = _t(spark, sf, "events")
    export = _write_export(spark, events, "plans-export")
    root = scratch_folder(spark, "plans-landed")
    land_table(spark, TableConfig("events", root, "event_id", export), datetime(2025, 1, 1))
    items = flatten_items(read_items_json(spark, export))
    landed = read_landed(spark, root, keys=["event_id"])
    sections = [
        ("Anti-join, the join left to Spark (anti_join_single)",
         QUERIES["anti_join_single"](spark, sf)),
        ("Anti-join over landed history, shuffle path: copies of keys reduced in salted parts, then one exchange per side",
         new_records(items, landed, "event_id", strategy="shuffle")),
        ("Flatten export lines: one parse projection and one decode projection over the text scan",
         items),
        ("Key filter as a semi join (filter_keys)",
         QUERIES["filter_keys"](spark, sf)),
        ("Field discovery: partial aggregation before a schema-wide shuffle (discover_fields)",
         QUERIES["discover_fields"](spark, sf)),
    ]
    out = [f"# PLANS\n\nFormatted physical plans at `{sf}` (AQE initial plans; `tools/plans.py`). "
           "The test tables are single-row-group files, so their scans are one split; a "
           "RoundRobinPartitioning exchange appears only where item lines are spread before "
           "parsing (`ensure_parallelism`), and not on multi-split inputs.\n"]
    for title, df in sections:
        out.append(f"## {title}\n\n```\n{formatted(df)}\n```\n")
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w", encoding="utf-8") as fh:
        fh.write("\n".join(out))
    spark.stop()
    print(path)


if __name__ == "__main__":
    main()

"""Run by test_retries.py in its own process: landing while first task attempts fail."""

import json
import os
import sys
import tempfile
from datetime import datetime

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark import TaskContext  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql.types import StringType  # noqa: E402

from tidemark.config import TableConfig  # noqa: E402
from tidemark.plans.landing import land_table  # noqa: E402
from tidemark.sources.landed import read_landed  # noqa: E402


@F.udf(StringType())
def flaky(v):
    ctx = TaskContext.get()
    if ctx.attemptNumber() == 0 and ctx.partitionId() % 2 == 0:
        raise RuntimeError("injected task failure")
    return v


def main():
    spark = (SparkSession.builder.master("local[4,3]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "4").config("spark.sql.autoBroadcastJoinThreshold", "-1")
             .getOrCreate())
    spark.sparkContext.setLogLevel("OFF")
    root = tempfile.mkdtemp(prefix="tidemark-retry-")
    src = spark.range(0, 20000, 1, 8).select(F.col("id").cast("string").alias("k"),
                                             flaky(F.col("id").cast("string")).alias("v"))
    cfg = TableConfig("r", root, "k", "unused", source_format="parquet", join_strategy="shuffle")
    r1 = land_table(spark, cfg, datetime(2025, 1, 1), source=src.where("id < 10000"))
    r2 = land_table(spark, cfg, datetime(2025, 1, 2), source=src)
    landed = read_landed(spark, root)
    out = {"r1": [r1.source_rows, r1.new_rows], "r2": [r2.source_rows, r2.new_rows, r2.landed_rows],
           "landed": landed.count(), "distinct": landed.select("k").distinct().count()}
    print("RESULT " + json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()

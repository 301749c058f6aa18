"""One file per key, named by it."""

import os
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_landing import T1, cfg, frame
from tidemark.plans.landing import LandingError, land_table
from tidemark.sinks.runs import write_run
from tidemark.sources.landed import read_landed

LONG = "k" * 300


def _files(folder):
    return {f: None for f in os.listdir(folder) if f.endswith(".parquet")}


def test_a_file_for_every_key_and_none_twice(spark, root):
    rows = [(k, f"v{i}") for i in range(400) for k in ("a", "b:c", "é 1", "_h", ".d", "", None, LONG, f"n{i % 50}")]
    df = frame(spark, rows).repartition(5)
    folder = f"{root}/run"
    assert write_run(df, folder, layout="key_files", keys=["k"]) == len(rows)
    back = spark.read.parquet(folder).withColumn("file", F.col("_metadata.file_name"))
    assert sorted(map(str, ((r["k"], r["v"]) for r in back.collect()))) == sorted(map(str, rows))
    named = {r["k"]: r["file"] for r in back.select("k", "file").distinct().collect()}
    assert len(named) == len(_files(folder)) == 58
    assert named["a"] == "a.parquet" and named[""] == "EMPTY.parquet" and named[None] == "NULL.parquet" and named["n7"] == "n7.parquet"
    assert named["_h"].startswith("-_h") and named[".d"].startswith("-.d") and len(named[LONG]) < 100
    assert os.path.exists(f"{folder}/_SUCCESS") and not [f for f in os.listdir(folder) if f.startswith("_temporary")]


def test_hot_key_over_many_batches(spark, root):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 < 2, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 5)).alias("k"), "id")
    write_run(df, f"{root}/run", layout="key_files", keys=["k"], options={"compression": "zstd"})
    assert set(_files(f"{root}/run")) == {"hot.parquet", *(f"k{i}.parquet" for i in range(5))}
    assert spark.read.parquet(f"{root}/run/hot.parquet").count() == 40_000


def test_large_files_have_tasks_of_their_own_and_sort_nothing(spark, root, monkeypatch):
    """What a task sorts stays within some rows, whatever the rows of one file (before: all rows of a file)."""
    from tidemark.sinks import key_files

    monkeypatch.setattr(key_files, "TASK_ROWS", 1000)
    monkeypatch.setattr(key_files, "GROUP_BYTES", 1 << 16)
    own_type = type(spark.range(1))
    sorted_rows, plain = [], own_type.sortWithinPartitions

    def watched(self, *cols):
        sorted_rows.append([r["n"] for r in self.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()])
        return plain(self, *cols)

    monkeypatch.setattr(own_type, "sortWithinPartitions", watched)
    name = F.when(F.col("id") % 2 < 1, "hot").when(F.col("id") % 4 < 2, "warm").otherwise(F.concat(F.lit("k"), F.col("id") % 97))
    df = spark.range(40_000).select(name.alias("k"), "id", F.lit(None).cast("long").alias("place"), F.lit("x").alias("hot_name"))
    assert write_run(df, f"{root}/run", layout="key_files", keys=["k"]) == 40_000
    assert max(sorted_rows[0]) < 4000 and sum(sorted_rows[0]) == 10_000
    assert len(_files(f"{root}/run")) == 99
    back = spark.read.parquet(f"{root}/run").withColumn("file", F.col("_metadata.file_name"))
    assert back.columns == ["k", "id", "place", "hot_name", "file"]
    assert back.where(F.concat("k", F.lit(".parquet")) != F.col("file")).count() == 0
    assert back.select("id").distinct().count() == back.count() == 40_000


def test_failed_tasks_leave_nothing(spark, root):
    df = spark.range(2000, numPartitions=4).select((F.col("id") % 20).cast("string").alias("k"), F.col("id").alias("v"))
    bad = df.withColumn("v", F.when(F.col("v") == 1999, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("v")))
    with pytest.raises(Exception, match="broken row"):
        write_run(bad, f"{root}/run", layout="key_files", keys=["k"])
    assert not os.path.exists(f"{root}/run") or not os.listdir(f"{root}/run")
    with pytest.raises(LandingError):
        land_table(spark, cfg(root, layout="key_files"), T1, source=bad)
    assert not os.path.exists(root) or not [f for f in os.listdir(root) if not f.startswith("_")]


def test_landing_with_types_kept(spark, root):
    src = spark.sql("SELECT 'a' k, CAST(1.50 AS DECIMAL(10,2)) d, DATE'2024-01-02' day, TIMESTAMP_NTZ'2024-01-02 03:04:05' n, "
                    "TIMESTAMP'2024-01-02 03:04:05' t, X'00FF' b, ARRAY(1, 2) l, CAST(NULL AS INT) e UNION ALL "
                    "SELECT 'b', 2.25, NULL, NULL, NULL, NULL, NULL, 3")
    c = cfg(root, layout="key_files")
    assert land_table(spark, c, T1, source=src).new_rows == 2
    rep = land_table(spark, c, T1 + timedelta(days=1), source=src.unionByName(src.where("k = 'b'").withColumn("k", F.lit("c"))))
    assert (rep.landed_rows, rep.new_rows) == (2, 1) and list(_files(rep.run_folder)) == ["c.parquet"]
    back = read_landed(spark, root)
    assert [f for f in back.dtypes if f[0] in src.columns] == src.dtypes
    want = sorted(map(str, (tuple(r) for r in src.collect())))
    assert sorted(map(str, (tuple(r) for r in back.where("k < 'c'").select(*src.columns).collect()))) == want
    assert land_table(spark, c, T1 + timedelta(days=2), source=src).mode == "none"
    assert not os.path.exists(f"{root}/2025/01/03")


def test_refusals(spark, root):
    df = frame(spark, [("1", "a")])
    for kw in ({"mode": "overwrite"}, {"cluster": True}, {"max_records_per_file": 5}):
        with pytest.raises(ValueError):
            write_run(df, f"{root}/x", layout="key_files", keys=["k"], **kw)
    with pytest.raises(ValueError):
        write_run(df, f"{root}/x", layout="key_files")

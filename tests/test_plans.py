"""Physical-plan properties the landing relies on at scale."""

import os
from datetime import datetime

from pyspark.sql import functions as F

from tidemark.config import TableConfig
from tidemark.operators.diff import new_records
from tidemark.operators.flatten import flatten_items
from tidemark.plans.landing import land_table
from tidemark.sources.items import read_items_json
from tidemark.sources.landed import read_landed


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _landed_root(spark, tmp_path, n=2000):
    root = str(tmp_path / "landed")
    src = spark.range(n).select(F.col("id").cast("string").alias("k"),
                                F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    cfg = TableConfig("t", root, "k", "unused", source_format="parquet")
    land_table(spark, cfg, datetime(2025, 1, 1), source=src.where("id < 1000"))
    return root, src


def test_landed_side_reads_only_keys(spark, tmp_path):
    root, src = _landed_root(spark, tmp_path)
    landed = read_landed(spark, root, keys=["k"])
    plan = _plan(new_records(src, landed, "k", strategy="shuffle"))
    scans = [ln for ln in plan.splitlines() if "FileScan parquet" in ln]
    assert len(scans) == 1
    assert "ReadSchema: struct<k:string>" in scans[0]
    assert "IsNotNull(k)" in scans[0]


def test_shuffle_path_one_exchange_per_side(spark, tmp_path):
    root, src = _landed_root(spark, tmp_path)
    out = new_records(src, read_landed(spark, root, keys=["k"]), "k", strategy="shuffle")
    out.write.format("noop").mode("overwrite").save()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    # one for the source, two for the keys alone: copies are reduced in salted parts, then dealt by key
    final = plan.split("+- == Initial Plan ==")[0]
    assert final.count("Exchange hashpartitioning") == 3
    assert "Exchange hashpartitioning(k#" in final and "__landed_key_part" in final


def test_small_landed_keys_are_broadcast(spark, tmp_path):
    root, src = _landed_root(spark, tmp_path)
    plan = _plan(new_records(src, read_landed(spark, root, keys=["k"]), "k"))
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_flatten_is_one_projection_over_the_scan(spark, tmp_path):
    p = tmp_path / "items.json"
    p.write_text('{"Item":{"id":{"S":"a"},"n":{"N":"1"}}}\n')
    flat = flatten_items(read_items_json(spark, str(p)), fields=["id", "n"])
    plan = _plan(flat)
    assert "Exchange" not in plan
    assert "FileScan text" in plan


def test_per_key_write_clusters_only_on_request(spark, tmp_path):
    from tidemark.sinks.runs import FILE_KEY, write_run
    df = spark.range(0, 8000, 1, 8).select((F.col("id") % 7).cast("string").alias("k"), F.col("id").alias("v"))

    def files_per_folder(folder):
        return [len([f for f in os.listdir(os.path.join(folder, d)) if f.endswith(".parquet")])
                for d in os.listdir(folder) if d.startswith(FILE_KEY)]

    plain, clustered = str(tmp_path / "plain"), str(tmp_path / "clustered")
    write_run(df, plain, layout="per_key", keys=["k"])                 # no shuffle: a file per task
    write_run(df, clustered, layout="per_key", keys=["k"], cluster=True)
    assert max(files_per_folder(plain)) == 8
    assert max(files_per_folder(clustered)) < 8

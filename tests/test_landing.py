"""Landing scenarios in a temp folder: first load, reruns, new columns, NULL keys, retries."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.config import TableConfig
from tidemark.plans.landing import EmptySourceError, RuleViolation, land_table, land_tables
from tidemark.operators.quality import IsComplete, RowCount
from tidemark.sinks.runs import FILE_KEY, write_run
from tidemark.sources.landed import read_landed

T1 = datetime(2025, 1, 1, 0, 0, 0)
T2 = datetime(2025, 1, 2, 0, 0, 0)
T3 = datetime(2025, 1, 3, 12, 30, 5)


def cfg(root, keys="k", **kw):
    return TableConfig(name=kw.pop("name", "t"), root=root, keys=keys,
                       source=kw.pop("source", "unused"), source_format="parquet", **kw)


def frame(spark, rows, schema="k string, v string"):
    return spark.createDataFrame(rows, schema)


def test_first_load_then_increments(spark, root):
    c = cfg(root)
    r1 = land_table(spark, c, T1, source=frame(spark, [("1", "a"), ("2", "b")]))
    assert (r1.mode, r1.source_rows, r1.new_rows) == ("full", 2, 2)
    assert os.path.exists(os.path.join(root, "2025/01/01/00-00-00/_SUCCESS"))

    r2 = land_table(spark, c, T2, source=frame(spark, [("1", "a"), ("2", "b")]))
    assert (r2.mode, r2.new_rows) == ("none", 0)
    assert not os.path.exists(os.path.join(root, "2025/01/02"))  # no folder for nothing new

    r3 = land_table(spark, c, T3, source=frame(spark, [("1", "a"), ("2", "b"), ("3", "c")]))
    assert (r3.mode, r3.source_rows, r3.new_rows) == ("incremental", 3, 1)
    assert (r1.landed_rows, r3.landed_rows) == (0, 2)
    landed = read_landed(spark, root)
    got = sorted((r["k"], r["processed_date"], r["processed_at"]) for r in landed.collect())
    assert got == [("1", "2025-01-01", "2025-01-01 00:00:00"), ("2", "2025-01-01", "2025-01-01 00:00:00"),
                   ("3", "2025-01-03", "2025-01-03 12:30:05")]


def test_added_column_between_runs(spark, root):
    c = cfg(root)
    land_table(spark, c, T1, source=frame(spark, [("1", "a")]))
    land_table(spark, c, T2, source=frame(spark, [("1", "a", "x"), ("2", "b", "y")],
                                          "k string, v string, w string"))
    got = sorted(tuple(r) for r in read_landed(spark, root).select("k", "w").collect())
    assert got == [("1", None), ("2", "y")]


def test_null_keys_land_every_run(spark, root):
    c = cfg(root)
    src = frame(spark, [(None, "n"), ("1", "a")])
    land_table(spark, c, T1, source=src)
    r2 = land_table(spark, c, T2, source=src)
    assert r2.new_rows == 1
    r3 = land_table(spark, cfg(root, null_safe=True), T3, source=src)
    assert r3.new_rows == 0


def test_duplicate_keys_kept(spark, root):
    r = land_table(spark, cfg(root), T1, source=frame(spark, [("2", "d"), ("2", "d2")]))
    assert r.new_rows == 2


def test_unfinished_run_is_replaced(spark, root):
    c = cfg(root)
    land_table(spark, c, T1, source=frame(spark, [("1", "a")]))
    # a crashed attempt of run 2 left files but no _SUCCESS
    partial = os.path.join(root, "2025/01/02/00-00-00")
    frame(spark, [("2", "b")]).write.parquet(partial)
    os.remove(os.path.join(partial, "_SUCCESS"))
    r = land_table(spark, c, T2, source=frame(spark, [("1", "a"), ("2", "b"), ("3", "c")]))
    assert r.new_rows == 2  # "2" was not taken as landed
    assert sorted(x["k"] for x in read_landed(spark, root).collect()) == ["1", "2", "3"]


def test_finished_run_is_never_rewritten(spark, root):
    c = cfg(root)
    land_table(spark, c, T1, source=frame(spark, [("1", "a")]))
    with pytest.raises(FileExistsError):
        land_table(spark, c, T1, source=frame(spark, [("2", "b")]))


def test_empty_source(spark, root):
    empty = frame(spark, [], "k string, v string")
    with pytest.raises(EmptySourceError):
        land_table(spark, cfg(root), T1, source=empty)
    r = land_table(spark, cfg(root, on_empty="skip"), T1, source=empty)
    assert (r.mode, r.new_rows) == ("skipped", 0)
    assert not os.path.exists(root)


@pytest.mark.parametrize("strategy", ["auto", "broadcast", "shuffle"])
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_empty_source_over_a_landed_tree(spark, root, strategy, threshold):
    """The outcome depends neither on the join Spark picks nor on the size of the history."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        some = spark.range(2000).selectExpr("CAST(id AS STRING) AS k", "'v' AS v")
        land_table(spark, cfg(root), T1, source=some)
        empty = some.where("k = 'x'")
        c = cfg(root, on_empty="skip", join_strategy=strategy)
        r = land_table(spark, c, T2, source=empty, rules=[IsComplete("k"), RowCount(">", 0)])
        assert (r.status, r.mode, r.source_rows, r.new_rows) == ("SUCCEEDED", "skipped", 0, 0)
        assert r.rules_failed == "RowCount > 0"
        with pytest.raises(EmptySourceError):
            land_table(spark, cfg(root, join_strategy=strategy), T2, source=empty)
        assert not os.path.exists(os.path.join(root, "2025/01/02"))
        rep = land_tables(spark, [cfg(root, source=lambda s: empty, join_strategy=strategy)], T2).collect()[0]
        assert (rep["status"], rep["attempts"]) == ("FAILED", 1) and "EmptySourceError" in rep["error"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_hot_key_of_a_landing_run_is_split(spark, root):
    """A third of the rows on one NULL or text key, against a Parquet history."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 200_000
        src = spark.range(n).selectExpr("IF(id % 3 = 0, NULL, CAST(id AS STRING)) AS k", "sha2(CAST(id AS STRING), 256) AS v")
        land_table(spark, cfg(root), T1, source=src.where("k IS NOT NULL AND CAST(k AS INT) % 2 = 0"))
        r = land_table(spark, cfg(root), T2, source=src)
        assert r.new_rows == src.where("k IS NULL OR CAST(k AS INT) % 2 = 1").count()
        sizes = sorted(os.path.getsize(os.path.join(root, "2025/01/02/00-00-00", f))
                       for f in os.listdir(os.path.join(root, "2025/01/02/00-00-00")) if f.endswith(".parquet"))
        assert sizes[-1] < 4 * sizes[len(sizes) // 2]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rules_report_and_block(spark, root):
    src = frame(spark, [(None, "n"), ("1", "a")])
    r = land_table(spark, cfg(root), T1, source=src, rules=[IsComplete("k")])
    assert r.rules_failed == 'IsComplete "k"' and r.new_rows == 2
    with pytest.raises(RuleViolation):
        land_table(spark, cfg(root), T2, source=src, rules=[IsComplete("k")], fail_on_violation=True)
    assert not os.path.exists(os.path.join(root, "2025/01/02"))
    own = cfg(root, rules=['IsComplete "k"'], fail_on_violation=True)  # as the table's own settings
    with pytest.raises(RuleViolation):
        land_table(spark, own, T2, source=src)
    assert land_table(spark, own, T2, source=src.where("k IS NOT NULL")).new_rows == 0


def test_landed_int_key_vs_text_source(spark, root):
    spark.createDataFrame([(1,), (2,)], "k int").write.parquet(os.path.join(root, "old"))
    r = land_table(spark, cfg(root), T1, source=frame(spark, [("1", "a"), ("abc", "b"), ("3", "c")]))
    assert r.new_rows == 2


def test_custom_audit_names(spark, root):
    c = cfg(root, audit_names=("fecha_procesamiento", "timestamp_procesamiento"))
    land_table(spark, c, T1, source=frame(spark, [("1", "a")]))
    assert "fecha_procesamiento" in read_landed(spark, root).columns


def test_per_key_layout(spark, tmp_path):
    df = frame(spark, [("a/b", "1"), ("a:b", "2"), ("", "3"), (None, "4"), ("x y", "5"), ("x y", "6")])
    folder = str(tmp_path / "run")
    assert write_run(df, folder, layout="per_key", keys=["k"]) == 6
    labels = sorted(d for d in os.listdir(folder) if d.startswith(FILE_KEY))
    assert len(labels) == 5
    back = spark.read.option("recursiveFileLookup", "true").parquet(folder)
    assert sorted((r["k"], r["v"]) for r in back.collect() if r["k"] is not None) == \
        [("", "3"), ("a/b", "1"), ("a:b", "2"), ("x y", "5"), ("x y", "6")]


def test_land_per_key_incremental(spark, root):
    c = cfg(root, keys="k,j", layout="per_key")
    s1 = frame(spark, [("a", "1", "x")], "k string, j string, v string")
    s2 = frame(spark, [("a", "1", "x"), ("a", "2", "y")], "k string, j string, v string")
    land_table(spark, c, T1, source=s1)
    assert land_table(spark, c, T2, source=s2).new_rows == 1


def test_land_items_json(spark, tmp_path, root):
    import json
    p = tmp_path / "items.json"
    items = [{"id": {"S": "a"}, "n": {"N": "1"}}, {"id": {"S": "b"}, "m": {"M": {"q": {"S": "r"}}}}]
    p.write_text("".join(json.dumps({"Item": it}, separators=(",", ":")) + "\n" for it in items))
    c = TableConfig("items", root, "id", str(p))
    r = land_table(spark, c, T1)
    assert r.new_rows == 2
    back = read_landed(spark, root)
    assert sorted(c for c in back.columns) == ["id", "m", "n", "processed_at", "processed_date"]
    assert land_table(spark, c, T2).new_rows == 0


def test_land_tables_report(spark, tmp_path):
    good = cfg(str(tmp_path / "a"), name="good", source=lambda s: frame(s, [("1", "a")]))
    bad = cfg(str(tmp_path / "b"), name="bad", keys="missing", source=lambda s: frame(s, [("1", "a")]))
    pair = cfg(str(tmp_path / "c"), name="pair", keys="k,v", source=lambda s: frame(s, [("1", "a")]))
    rep = {r["table_name"]: r for r in land_tables(spark, [good, bad, pair], T1).collect()}
    assert rep["good"]["status"] == "SUCCEEDED" and rep["good"]["new_rows"] == 1
    assert rep["good"]["key_kind"] == "single" and rep["pair"]["key_kind"] == "composite"
    assert rep["bad"]["status"] == "FAILED" and rep["bad"]["attempts"] == 1  # a wrong name stays wrong
    assert "missing" in rep["bad"]["error"]
    rep2 = land_tables(spark, [good, pair], T2, max_parallel_tables=2).collect()
    assert all(r["status"] == "SUCCEEDED" and r["new_rows"] == 0 for r in rep2)


def test_per_key_hot_key_is_split_over_files(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        n = 300_000
        df = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"))
        for cluster in (False, True):
            folder = str(tmp_path / f"run-{cluster}")
            assert write_run(df, folder, layout="per_key", keys=["k"], cluster=cluster) == n
            hot = os.path.join(folder, f"{FILE_KEY}=hot")
            assert len([f for f in os.listdir(hot) if f.endswith(".parquet")]) > 1
            assert spark.read.parquet(hot).count() == n // 3
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def _jobs_of(spark, group, fn):
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        fn()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_jobs_per_run_do_not_grow_with_rows(spark, tmp_path):
    counts = []
    for n in (100, 50_000):
        root = str(tmp_path / f"n{n}")
        c = cfg(root)
        src = spark.range(n).select(F.col("id").cast("string").alias("k"), F.lit("v").alias("v"))
        first = _jobs_of(spark, f"first-{n}", lambda: land_table(spark, c, T1, source=src.where("id % 2 = 0")))
        second = _jobs_of(spark, f"second-{n}", lambda: land_table(spark, c, T2, source=src))
        counts.append((first, second))
    assert counts[0] == counts[1]
    # landed schema 1, row count 1, key bytes <= 2, write with AQE stages <= 3
    assert max(counts[0]) <= 7


def test_awkward_attribute_names(spark, tmp_path, root):
    import json
    p = tmp_path / "items.json"
    items = [{"user.id": {"S": "u1"}, "a b": {"N": "1"}, "x`y": {"S": "q"}},
             {"user.id": {"S": "u2"}, "a b": {"N": "2"}}]
    p.write_text("".join(json.dumps({"Item": it}) + "\n" for it in items))
    c = TableConfig("awk", root, "user.id", str(p), layout="per_key")
    r = land_table(spark, c, T1, rules=[IsComplete("a b"), IsComplete("x`y")])
    assert r.new_rows == 2 and r.rules_failed == 'IsComplete "x`y"'
    assert land_table(spark, c, T2).new_rows == 0
    back = read_landed(spark, root)
    assert sorted(back.columns) == sorted(["user.id", "a b", "x`y", "processed_date", "processed_at"])


def test_mixed_key_types_inside_tree_fail_clearly(spark, root):
    from tidemark.plans.landing import LandingError
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(os.path.join(root, "2025/01/01/00-00-00"))
    spark.createDataFrame([("x", "b")], "k string, v string").write.parquet(os.path.join(root, "2025/01/02/00-00-00"))
    with pytest.raises(LandingError) as info:
        land_table(spark, cfg(root), T3, source=frame(spark, [("1", "a"), ("y", "c")]))
    assert root in str(info.value)
    assert not os.path.exists(os.path.join(root, "2025/01/03"))  # nothing written, not a full load


def test_as_text_lands_unified_text_schema(spark, root):
    src = spark.createDataFrame([(2, 1.5, "b")], "z long, a double, k string")
    land_table(spark, cfg(root, as_text=True), T1, source=src)
    back = read_landed(spark, root)
    assert back.columns == ["a", "k", "z", "processed_date", "processed_at"]
    assert all(t == "string" for _, t in back.dtypes)
    assert tuple(back.first())[:3] == ("1.5", "b", "2")
    # a later run of the same table keeps matching on the text key
    assert land_table(spark, cfg(root, as_text=True), T2, source=src).new_rows == 0


def test_malformed_export_lines_fail_the_run(spark, tmp_path, root):
    from tidemark.plans.landing import LandingError
    p = tmp_path / "items.json"
    p.write_text('{"Item":{"id":{"S":"a"}}}\n\n{broken\n{"Item":{"id":{"S":"b"}}}\n')
    with pytest.raises(LandingError, match="malformed"):
        land_table(spark, TableConfig("m", root, "id", str(p)), T1)
    assert not os.path.exists(root)
    ok = tmp_path / "ok.json"
    ok.write_text('{"Item":{"id":{"S":"a"}}}\n\n{"Item":{"id":{"S":"b"}}}\n')   # blank line is fine
    assert land_table(spark, TableConfig("m", root, "id", str(ok)), T1).new_rows == 2


def test_write_options_reach_the_writer(spark, root):
    import glob
    land_table(spark, cfg(root, write_options={"compression": "zstd"}), T1, source=frame(spark, [("1", "a")]))
    files = glob.glob(os.path.join(root, "**", "*.parquet"), recursive=True)
    assert files and all(".zstd." in f for f in files)


def test_land_tables_tags_jobs_per_table(spark, tmp_path):
    a = cfg(str(tmp_path / "ja"), name="ja", source=lambda s: frame(s, [("1", "a")]))
    land_tables(spark, [a], T1, job_group_prefix="grp-")
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("grp-ja")) > 0
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None


def test_malformed_lines_with_data_rules(spark, tmp_path, root):
    from tidemark.plans.landing import LandingError
    p = tmp_path / "items.json"
    p.write_text('{"Item":{"id":{"S":"a"}}}\n{broken\n{"nope":1}\n')
    with pytest.raises(LandingError, match="malformed"):
        land_table(spark, TableConfig("m", root, "id", str(p)), T1, rules=[RowCount(">", 0)])
    assert not os.path.exists(root)


def test_land_tables_from_config_frame(spark, tmp_path):
    import json as _json
    src = tmp_path / "items.json"
    src.write_text(_json.dumps({"Item": {"id": {"S": "1"}, "g": {"S": "x"}}}) + "\n")
    rows = [(str(tmp_path), "a", "id", "false", str(src)), (str(tmp_path), "b", "id,g", "true", str(src))]
    frame_ = spark.createDataFrame(rows, "bucket_name string, folder_name string, primary_key string, "
                                         "primary_key_is_composite string, source string")
    from tidemark.plans.landing import configs_from_frame
    cfgs = configs_from_frame(frame_, scheme="file")
    assert [c.key_kind for c in cfgs] == ["single", "composite"]
    rep = land_tables(spark, cfgs, T1)
    assert [r["new_rows"] for r in rep.collect()] == [1, 1]


def test_audit_name_collision_is_refused(spark, root):
    src = frame(spark, [("1", "keep me")], "k string, Processed_At string")
    with pytest.raises(ValueError, match="Processed_At"):
        land_table(spark, cfg(root), T1, source=src)
    assert not os.path.exists(root)
    land_table(spark, cfg(root, audit_names=("run_day", "run_time")), T1, source=src)
    assert read_landed(spark, root).first()["Processed_At"] == "keep me"


def test_nested_and_respelled_roots_are_refused(spark, tmp_path):
    a = cfg(str(tmp_path / "n"), name="a", source=lambda s: frame(s, [("1", "a")]))
    for other in (str(tmp_path / "n" / "sub"), f"file://{tmp_path}/n/", f"file:{tmp_path}//n", str(tmp_path / "." / "n" / "x")):
        with pytest.raises(ValueError, match="share"):
            land_tables(spark, [a, cfg(other, name="b")], T1)


def test_untagged_and_unknown_values_keep_their_text(spark, tmp_path, root):
    p = tmp_path / "items.json"
    p.write_text('{"Item":{"id":{"S":"a"},"z":"plain","u":{"ZZ":7},"__malformed":{"S":"m"},"n":null}}\n'
                 '{"Item":{"id":{"S":"b"},"z":{"S":"tagged"}}}\n')
    assert land_table(spark, TableConfig("t", root, "id", str(p)), T1).new_rows == 2
    got = {r["id"]: r for r in read_landed(spark, root).collect()}
    assert (got["a"]["z"], got["a"]["u"], got["a"]["__malformed"], got["a"]["n"]) == ("plain", '{"ZZ":7}', "m", None)
    assert (got["b"]["z"], got["b"]["u"]) == ("tagged", None)


def test_errors_are_reported_whole_and_only_mendable_ones_retried(spark, tmp_path):
    calls = []

    def broken(s):
        calls.append(1)
        raise RuntimeError("x" * 5000)

    rep = land_tables(spark, [cfg(str(tmp_path / "a"), source=broken)], T1, max_attempts=2).collect()[0]
    assert rep["attempts"] == 2 == len(calls) and rep["error"] == "RuntimeError: " + "x" * 5000
    done = cfg(str(tmp_path / "b"), source=lambda s: frame(s, [("1", "a")]))
    assert land_tables(spark, [done], T1).collect()[0]["status"] == "SUCCEEDED"
    again = land_tables(spark, [done], T1).collect()[0]
    assert (again["status"], again["attempts"]) == ("FAILED", 1) and "FileExistsError" in again["error"]


def test_an_error_after_the_commit_is_no_failed_run(spark, root, monkeypatch):
    from tidemark.plans import landing

    def write_then_break(*args, **kwargs):
        write_run(*args, **kwargs)
        raise OSError("lost the answer")

    monkeypatch.setattr(landing, "write_run", write_then_break)
    c = cfg(root, source=lambda s: frame(s, [("1", "a")]))
    rep = land_tables(spark, [c], T1).collect()[0]
    assert (rep["status"], rep["attempts"]) == ("SUCCEEDED", 1) and "lost the answer" in rep["error"]
    assert read_landed(spark, root).count() == 1

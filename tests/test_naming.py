from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions.naming import audit_values, key_name, run_folder, run_folder_expr


def test_run_folder_and_audit():
    t = datetime(2025, 3, 4, 5, 6, 7)
    assert run_folder("s3a://b/folder/", t) == "s3a://b/folder/2025/03/04/05-06-07/"
    assert audit_values(t) == ("2025-03-04", "2025-03-04 05:06:07")


def test_run_folder_expr(spark):
    df = spark.createDataFrame([(datetime(2025, 3, 4, 5, 6, 7),)], "ts timestamp_ntz")
    assert df.select(run_folder_expr("ts")).first()[0] == "2025/03/04/05-06-07"


def test_key_name_awkward(spark):
    df = spark.createDataFrame(
        [("a:b\\c d/e", "x"), (None, "y"), ("", "z"), ("a_b", "c"), ("a", "b_c")], "k string, j string"
    )
    single = [r[0] for r in df.select(key_name("k")).collect()]
    assert single == ["a_b_c_d/e", "NULL", "", "a_b", "a"]
    pair = [r[0] for r in df.select(key_name("k", F.col("j"))).collect()]
    # distinct keys may share a name; the name only labels a folder
    assert pair[3] == pair[4] == "a_b_c"
    assert pair[1] == "NULL_y"

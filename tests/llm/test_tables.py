from pyspark.sql import functions as F

from tidemark.llm import lm, tables


def test_hash_sample_is_bounded_and_independent_of_partitions(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    a = {r["k"] for r in tables.hash_sample(df, "k", 50).collect()}
    assert len(a) == 50 and a == {r["k"] for r in tables.hash_sample(df.repartition(13), "k", 50).collect()}
    twice = tables.hash_sample(df.union(df), "k", 50)
    assert twice.count() == 100  # repeated rows come and go together
    assert tables.hash_sample(df.where("k < 3").union(spark.sql("SELECT CAST(NULL AS BIGINT), 1L")), "k", 50).count() == 3


def test_arrow_batches_keep_the_sessions_own_number(spark):
    conf = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(conf)
    try:
        spark.conf.set(conf, "77")
        tables.ready_workers(spark)
        assert spark.conf.get(conf) == "77"
        spark.conf.set(conf, "10000")
        tables.ready_workers(spark)
        assert spark.conf.get(conf) == str(tables.ARROW_ROWS)
    finally:
        spark.conf.set(conf, old)


def test_most_frequent_words_keep_to_the_bound(spark):
    counts = spark.range(1, 2001).select(F.col("id").alias("key"), (F.lit(100000) / F.col("id")).cast("long").alias("n"))
    n = {r["key"]: r["n"] for r in counts.collect()}
    for most in (1, 10, 300, 5000):
        got = {r["key"] for r in lm.most_frequent(counts, most).collect()}
        assert len(got) <= most
        assert not got or min(n[k] for k in got) >= max([0, *(n[k] for k in n if k not in got)])
    assert len({r["key"] for r in lm.most_frequent(counts, 5000).collect()}) == 2000
    assert lm.most_frequent(counts.limit(0), 10).count() == 0

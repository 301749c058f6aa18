"""Small helpers shared by the operators: reading tables, staging frames, bounded samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_folder, ship_package

#: Words are maximal runs of characters other than these six white-space characters.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Rows of an Arrow batch between Spark and Python workers; rows here hold whole texts.
ARROW_ROWS = 1000
_ARROW_CONF, _ARROW_DEFAULT = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"


def ready_workers(spark: SparkSession) -> None:
    """Ship the package to Python workers, and keep Arrow batches of texts small.

    Spark's default of 10,000 rows a batch is lowered to ``ARROW_ROWS`` for the
    session; a number that the session sets itself stays.
    """
    ship_package(spark)
    if spark.conf.get(_ARROW_CONF, _ARROW_DEFAULT) == _ARROW_DEFAULT:
        spark.conf.set(_ARROW_CONF, str(ARROW_ROWS))


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs a reread of the written files, not
    a recomputation, and several readers share one computation.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def hash_sample(df: DataFrame, key: str, rows: int, seed: int = 0) -> DataFrame:
    """The rows of ``df`` whose ``key`` is among the ``rows`` smallest by seeded hash.

    Only the key column is ordered; the chosen keys (at most ``rows`` of
    them, the documented bound) are broadcast. The choice depends on keys
    alone, so it is the same at every partitioning.
    """
    k = F.col(key)
    picked = (
        df.where(k.isNotNull()).select(k.alias("__picked")).distinct()
        .orderBy(F.xxhash64("__picked", F.lit(seed)), "__picked").limit(rows)
    )
    return df.join(F.broadcast(picked), k == F.col("__picked"), "left_semi")

"""Input parallelism guard."""

from __future__ import annotations

from pyspark.sql import DataFrame


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Spread ``df`` over at least ``min_partitions`` tasks (default: the cluster's default parallelism).

    Only acts when the input has fewer partitions than that, e.g. one
    unsplittable file or row group feeding CPU-heavy parsing; large inputs
    already have many splits and pass through unchanged (no shuffle).
    Spark sorts before a round-robin repartition, so retried tasks see the
    same rows. Meant for plain file scans feeding per-row CPU work (parsing,
    building items): reading the partition count of a frame that contains a
    shuffle would run that shuffle under AQE, and a later semi/anti join is
    pushed below a repartition, so join inputs gain nothing from it.
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= n:
        return df
    return df.repartition(n)

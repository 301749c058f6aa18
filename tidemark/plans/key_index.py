"""Landed-key index: a run opens only the blocks of landed keys that its source may hit.

Beside its data every run keeps its distinct keys, sorted by a hash and cut
into blocks of equal hash ranges, and the sorted hashes alone, shortened to
``SPARE_BITS`` more than the run has keys. Sorted numbers take two to three
bytes each in Parquet's delta encoding, a fraction of the keys. A run joins the hashes of its source with
these; a hash found says which block of which run to open, and the exact
anti-join then reads these blocks only. A key that no hash announces is not
landed, so the result is that of the join with everything.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.columns import col
from tidemark.plans.manifest import LandedRuns, RunEntry, read_paths

#: A key that a run does not hold seems to be in it once in 2**SPARE_BITS; keys of a block; bits of a whole hash.
SPARE_BITS, BLOCK_KEYS, HASH_BITS = 20, 50_000, 62
#: Blocks that are opened by name; a source that hits more reads the key files of the runs it hits whole.
MAX_BLOCK_PATHS = 10_000
_PRINT, _BLOCK = "__key_print", "block"
#: Types whose equal values always have equal hashes (a floating -0.0 or NaN need not).
_HASHED = (T.StringType, T.BinaryType, T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType,
           T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType)


def key_schema(df: DataFrame, keys: Sequence[str]) -> str | None:
    """Names and types of the key columns as one text, or None if a type cannot be indexed."""
    fields = [df.schema[k] for k in keys]
    if not all(type(f.dataType) in _HASHED for f in fields):
        return None
    return T.StructType([T.StructField(f.name, f.dataType) for f in fields]).json()


def _struct(schema: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(schema))


def _hash(keys: Sequence[str]) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*[col(k) for k in keys]), 64 - HASH_BITS)


def _prints_folder(folder: str, entry: RunEntry) -> str:
    return f"{folder}/_index/prints-{entry.blocks}-{entry.bits}"


def _keys_folder(folder: str) -> str:
    return f"{folder}/_index/keys"


def index_run(spark: SparkSession, folder: str, keys: Sequence[str], rows: int) -> RunEntry:
    """Write the key index of a finished run from its own files; two jobs over its keys alone."""
    folder = folder.rstrip("/")
    landed = read_paths(spark, [folder])
    schema = None if landed is None else key_schema(landed, keys)
    if schema is None:
        return RunEntry(rows)
    blocks = max(1, -(-rows // BLOCK_KEYS))
    entry = RunEntry(rows, schema, blocks, min(rows.bit_length() + SPARE_BITS, HASH_BITS - blocks.bit_length()))

    def printed(df: DataFrame) -> DataFrame:
        return df.withColumn(_PRINT, F.shiftright(_hash(keys), HASH_BITS - entry.bits))

    own = printed(landed.select(*[col(k) for k in keys]).distinct()).withColumn(_BLOCK, F.shiftright(F.col(_PRINT) * blocks, entry.bits))
    own.repartition(_BLOCK).sortWithinPartitions(_BLOCK, _PRINT).drop(_PRINT).write.partitionBy(_BLOCK).parquet(_keys_folder(folder))
    prints = printed(read_keys(spark, [_keys_folder(folder)], schema)).select(_PRINT).sortWithinPartitions(_PRINT)
    prints.write.option("compression", "zstd").option("parquet.writer.version", "v2").option("parquet.enable.dictionary", "false").parquet(_prints_folder(folder, entry))
    return entry


def read_keys(spark: SparkSession, paths: Sequence[str], schema: str) -> DataFrame:
    return spark.read.schema(_struct(schema)).option("recursiveFileLookup", "true").parquet(*paths)


def blocks_hit(spark: SparkSession, landed: LandedRuns, runs: Sequence[str], source: DataFrame, keys: Sequence[str]) -> list[tuple[str, int]]:
    """(run, block) pairs that may hold a key of ``source``.

    The join is on numbers; Spark broadcasts the source's if they are few,
    so that the stored ones are only scanned. The source's hashes come once
    for each length that runs have stored. What comes to the driver is at
    most one row for ``BLOCK_KEYS`` landed keys.
    """
    prints = spark.read.schema(f"{_PRINT} long").parquet(*[_prints_folder(landed.path(r), landed.runs[r]) for r in runs])

    def of_path(group: int) -> Column:
        pattern = r"([0-9]{4}/[0-9]{2}/[0-9]{2}/[0-9-]{8})/_index/prints-([0-9]+)-([0-9]+)/[^/]*$"
        return F.regexp_extract(F.col("_metadata.file_path"), pattern, group)

    stored = prints.select(_PRINT, of_path(1).alias("run"), of_path(2).cast("long").alias("blocks"), of_path(3).cast("int").alias("bits")) \
        .select(_PRINT, "run", "bits", F.expr(f"shiftright({_PRINT} * blocks, bits)").alias(_BLOCK))
    lengths = sorted({landed.runs[r].bits for r in runs})
    wanted = source.select(_hash(keys).alias("h")).distinct().select("h", F.explode(F.array(*map(F.lit, lengths))).alias("bits")) \
        .select("bits", F.expr(f"shiftright(h, {HASH_BITS} - bits)").alias(_PRINT))
    hits = stored.join(wanted, ["bits", _PRINT], "left_semi")
    return sorted((r["run"], int(r[_BLOCK])) for r in hits.select("run", _BLOCK).distinct().collect())


def landed_keys(spark: SparkSession, landed: LandedRuns, source: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Landed keys that hold at least all those of ``source``; None where the index does not apply.

    Runs whose keys are indexed with the source's own types give the blocks
    that may be hit, all others their key columns whole.
    """
    schema = key_schema(source, keys)
    indexed = [r for r, e in landed.runs.items() if e.key_schema == schema] if schema else []
    if not indexed:
        return None
    hits = blocks_hit(spark, landed, indexed, source, keys)
    if len(hits) <= MAX_BLOCK_PATHS:
        paths = [f"{_keys_folder(landed.path(run))}/{_BLOCK}={block}" for run, block in hits]
    else:
        paths = [_keys_folder(landed.path(run)) for run in sorted({run for run, _ in hits})]
    found = read_keys(spark, paths, schema) if paths else spark.createDataFrame([], _struct(schema))
    rest = read_paths(spark, [landed.path(r) for r in landed.runs if r not in set(indexed)] + landed.unmarked)
    if rest is not None:
        rest = rest.select(*[col(k) for k in keys])
        if rest.dtypes != found.dtypes:
            return None  # other types are compared by the full join's own rules
        found = found.unionByName(rest)
    return found

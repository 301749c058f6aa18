"""SimHash near-duplicates with a hierarchical index over Gray-ordered fingerprints.

Fingerprints are the bitwise majorities of shingle hashes. Links within
``max_distance`` bits are searched in groups that share a masked bit pattern:
with ``d + 1`` blocks of bits, two fingerprints at most ``d`` bits apart agree
in one block at least. Such a pattern is the upper node of an index whose
fingerprints are sorted by Gray rank; windows of neighbours factor the bits
they share into nodes, and a search adds up differences on the way down and
leaves a whole node out as soon as they exceed ``d``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.components import connected_components
from tidemark.llm.tables import ready_workers, staged, table, text_or_empty

SHINGLE_WORDS = 3
MAX_DISTANCE = 2
SEED = 42
_ALL = (1 << 64) - 1
#: Most fingerprints of one search group; larger groups are divided by further blocks.
GROUP_ROWS = 1024
_WINDOW = 8
_HASHES_AT_ONCE = 1 << 16


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit majority of the XXH64 hashes of all shingles of a text; 0 without words."""
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle_words, len(words))
    n = len(words) - k + 1
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, _HASHES_AT_ONCE):
        hi = min(n, lo + _HASHES_AT_ONCE)
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo:hi].tolist(), ends[lo + k - 1:hi + k - 1].tolist())], "<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int32)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist()))


def fingerprints(docs: DataFrame, text: str = "text", shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` plus ``fp``: the fingerprint as a signed long."""
    ready_workers(docs.sparkSession)

    @F.pandas_udf("long")
    def of_texts(texts: pd.Series) -> pd.Series:
        codes = np.array([fingerprint(t, shingle_words) for t in texts], np.uint64)
        return pd.Series(codes.view(np.int64))

    return docs.withColumn("fp", of_texts(F.col(text)))


# ---------------------------------------------------------------- index

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in the reflected Gray sequence."""
    out = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(shift)
    return out


class GrayIndex:
    """Levels of nodes over codes sorted by (group, Gray rank).

    A node covers up to eight consecutive nodes of the level below, holds the
    bits they share (``mask`` and ``value``) and ends at leaf ``stop``. Every
    group has one top node.
    """

    def __init__(self, codes: np.ndarray, group: np.ndarray):
        self.codes = codes
        mask = np.full(len(codes), _ALL, np.uint64)
        value, stop, owner = codes, np.arange(1, len(codes) + 1), group
        self.levels = [(mask, value, stop, None)]
        while len(owner) > len(np.unique(owner)):
            new_group = np.r_[True, owner[1:] != owner[:-1]]
            first_of_group = np.maximum.accumulate(np.where(new_group, np.arange(len(owner)), 0))
            first = np.flatnonzero((np.arange(len(owner)) - first_of_group) % _WINDOW == 0)
            size = np.diff(np.r_[first, len(owner)])
            differing = np.bitwise_or.reduceat(value ^ np.repeat(value[first], size), first)
            mask = np.bitwise_and.reduceat(mask, first) & ~differing
            value, stop, owner = value[first] & mask, stop[first + size - 1], owner[first]
            self.levels.append((mask, value, stop, (first, size)))
        self.top = np.searchsorted(owner, group)

    def pairs(self, lo: int, hi: int, distance: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, later code) index pairs of one group within ``distance`` bits, for queries lo..hi."""
        query = np.arange(lo, hi)
        node = self.top[lo:hi]
        seen = np.zeros(hi - lo, np.uint64)  # bits compared above
        differences = np.zeros(hi - lo, np.uint8)
        for depth in range(len(self.levels) - 1, -1, -1):
            mask, value, stop, below = self.levels[depth]
            differences = differences + np.bitwise_count((self.codes[query] ^ value[node]) & mask[node] & ~seen)
            keep = (differences <= distance) & (stop[node] > query + 1)
            query, node, differences = query[keep], node[keep], differences[keep]
            if not depth:
                break
            first, size = below
            n = size[node]
            start = np.cumsum(n) - n
            seen = np.repeat(mask[node], n)
            children = np.repeat(first[node] - start, n) + np.arange(n.sum())
            query, differences, node = np.repeat(query, n), np.repeat(differences, n), children
        return query, node


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index linked to each of ``n`` items."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _link(mask: np.ndarray, value: np.ndarray, codes: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Star edges (code, root's code) of the links within each (mask, value) group."""
    order = np.lexsort((gray_rank(codes), value, mask))
    mask, value, codes = mask[order], value[order], codes[order]
    new = np.r_[True, (mask[1:] != mask[:-1]) | (value[1:] != value[:-1])]
    group = np.cumsum(new) - 1
    pairs = np.bincount(group)[group] > 1
    codes, group = codes[pairs], group[pairs]
    if not len(codes):
        return codes, codes
    index = GrayIndex(codes, group)
    found = [index.pairs(i, min(i + 4096, len(codes)), distance) for i in range(0, len(codes), 4096)]
    a, b = (np.concatenate(x) for x in zip(*found))
    root = _roots(len(codes), a, b)
    moved = np.flatnonzero(root != np.arange(len(codes)))
    return codes[moved], codes[root[moved]]


def _link_batches(batches: Iterator[pa.RecordBatch], distance: int) -> Iterator[pa.RecordBatch]:
    """Runs over rows sorted by (mask, value); a group cut by a batch end is carried on."""
    held = [np.empty(0, np.int64)] * 3

    def edges(parts):
        a, b = _link(*(np.ascontiguousarray(p).view(np.uint64) for p in parts), distance)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    for batch in batches:
        parts = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
        mask, value, _ = parts
        if not len(mask):
            continue
        same = (mask == mask[-1]) & (value == value[-1])
        cut = len(mask) - int(same.sum())
        if cut:
            yield edges([p[:cut] for p in parts])
        held = [p[cut:] for p in parts]
    if len(held[0]):
        yield edges(held)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _blocks(free: list[int], parts: int) -> list[int]:
    """``parts`` masks that divide the ``free`` bit positions."""
    cuts = [len(free) * i // parts for i in range(parts + 1)]
    return [sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:])]


def link_fingerprints(codes: DataFrame, distance: int = MAX_DISTANCE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Edges (a, b) that connect all distinct ``fp`` of ``codes`` at most ``distance`` bits apart.

    Not all pairs come back, but every pair within the distance is connected
    by edges within the distance. Groups of over ``group_rows`` fingerprints
    are divided by the blocks of the bits they do not share, again and again,
    so no task holds an unbounded group and none is cut short.
    """
    ready_workers(codes.sparkSession)

    def divided(rows: DataFrame, fixed: int) -> list[tuple[int, DataFrame]]:
        free = [b for b in range(64) if not fixed >> b & 1]
        masks = [fixed | m for m in _blocks(free, min(distance + 1, len(free)))]
        return [(m, rows.select(F.lit(_signed(m)).alias("mask"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("value"), "fp")) for m in masks]

    found = None
    todo = divided(codes.select("fp").distinct(), 0)
    while todo:
        rows = todo[0][1]
        for _, more in todo[1:]:
            rows = rows.unionByName(more)
        sizes = rows.groupBy("mask", "value").agg(F.count(F.lit(1)).alias("n"))
        big = staged(sizes.where(F.col("n") > group_rows), "simhash-groups")
        masks = [r["mask"] for r in big.select("mask").distinct().collect()]
        small = rows.join(big, ["mask", "value"], "left_anti") if masks else rows
        linked = small.repartition("mask", "value").sortWithinPartitions("mask", "value") \
            .select("mask", "value", "fp").mapInArrow(lambda it: _link_batches(it, distance), "a long, b long")
        found = linked if found is None else found.unionByName(linked)
        by_mask = {_signed(m): (m, r) for m, r in todo}
        todo = []
        for signed in masks:
            m, own = by_mask[signed]
            hot = staged(own.join(big.drop("n"), ["mask", "value"], "left_semi"), "simhash-hot")
            if 64 - m.bit_count() <= distance:  # all of a group are within the distance
                low = hot.groupBy("mask", "value").agg(F.min("fp").alias("b"))
                found = found.unionByName(hot.join(low, ["mask", "value"]).select(F.col("fp").alias("a"), "b"))
            else:
                todo += divided(hot, m)
    return found


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id",
                    shingle_words: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """(doc_id, text_hash, fp, component_id), one row per input row.

    ``component_id`` is the smallest ``doc_id`` among all rows linked,
    directly or through others; null only where no linked row has an id.
    Null and empty texts have fingerprint zero and are linked like any other.
    Copies share a fingerprint and are never paired with one another. Other
    input columns are ignored.
    """
    light = fingerprints(docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_or_empty(text)).alias("text_hash"),
                                     F.col(text).alias("__text")), "__text", shingle_words).drop("__text")
    light = staged(light, "simhash")
    codes = staged(light.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash")
    root = connected_components(staged(link_fingerprints(codes, distance), "simhash-links"))
    nodes = codes.join(root.withColumnRenamed("node", "fp"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"), "first")
    nodes = staged(nodes, "simhash")
    least = staged(nodes.groupBy("root").agg(F.min("first").alias("component_id")), "simhash")
    of_code = staged(nodes.join(least, "root").select("fp", "component_id"), "simhash")
    return light.join(of_code, "fp").select("doc_id", "text_hash", "fp", "component_id")


def keep_first(docs: DataFrame, **parameters) -> DataFrame:
    """``docs`` with one row of each group: the smallest ``doc_id`` (nulls last), then by text hash."""
    found = near_duplicates(docs, **parameters)
    # rows without ids are a group's only if its component has no id
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp"), F.col("fp").cast("string")))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("best")
    kept = staged(found.groupBy(group.alias("group")).agg(best).select(
        F.col("best.doc_id").alias("__id"), F.col("best.text_hash").alias("__hash")), "simhash-kept")
    marked = docs.withColumn("__hash", F.xxhash64(text_or_empty()))
    chosen = marked.join(kept.withColumnRenamed("__hash", "__kept"),
                         F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__hash") == F.col("__kept")), "left_semi")
    return chosen.dropDuplicates(["doc_id", "__hash"]).select(*docs.columns)


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt to shards of bounded size by hash. Each shard's
graph is held in flat arrays: one row of neighbour numbers per node and level,
padded with -1. Queries descend from the top level and widen a beam at the
bottom; the best of all shards are merged, and scores are recomputed in double
precision on the original vectors.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import ready_workers, staged, table

TOP = 5
#: Distinct vectors of one shard, neighbours per node (twice as many at the bottom), beam widths.
SHARD_ROWS, LINKS, BUILD_BEAM, SEARCH_BEAM = 4096, 12, 48, 96


class Graph:
    """A navigable small-world hierarchy over unit vectors."""

    def __init__(self, vectors: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM, seed: int = 0):
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(self.x)
        self.links, self.beam = links, beam
        draw = np.random.default_rng(seed).random(n)
        self.level = np.minimum(np.floor(-np.log(np.maximum(draw, 1e-12)) / math.log(links)), 31).astype(np.int64)
        top = int(self.level.max()) if n else -1
        #: neighbour numbers by level; rows of level 0 are twice as wide
        self.flat = [np.full((n, links * (2 if k == 0 else 1)), -1, np.int32) for k in range(top + 1)]
        self.degree = [np.zeros(n, np.int32) for _ in range(top + 1)]
        self.seen = np.zeros(n, np.int64)
        self.mark = 0
        self.entry = -1
        for i in range(n):
            self._insert(i)

    def _beam(self, q: np.ndarray, start: list[tuple[float, int]], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest nodes found from ``start``: (similarity, node), in no order."""
        self.mark += 1
        mark, seen, flat, degree, x = self.mark, self.seen, self.flat[level], self.degree[level], self.x
        best = list(start)
        heapq.heapify(best)
        todo = [(-s, i) for s, i in start]
        heapq.heapify(todo)
        for _, i in start:
            seen[i] = mark
        while todo:
            s, i = heapq.heappop(todo)
            if -s < best[0][0] and len(best) >= width:
                break
            near = flat[i, :degree[i]]
            near = near[seen[near] != mark]
            if not len(near):
                continue
            seen[near] = mark
            sims = x[near] @ q
            if len(best) >= width:
                better = sims > best[0][0]
                near, sims = near[better], sims[better]
            for s, j in zip(sims.tolist(), near.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (s, j))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, j))
                else:
                    continue
                heapq.heappush(todo, (-s, j))
        return best

    def _descend(self, q: np.ndarray, to: int) -> list[tuple[float, int]]:
        at = self.entry
        best = (float(self.x[at] @ q), at)
        for level in range(int(self.level[at]), to, -1):
            while True:
                near = self.flat[level][best[1], :self.degree[level][best[1]]]
                if not len(near):
                    break
                sims = self.x[near] @ q
                k = int(sims.argmax())
                if sims[k] <= best[0]:
                    break
                best = (float(sims[k]), int(near[k]))
        return [best]

    def _choose(self, found: list[tuple[float, int]], most: int) -> list[int]:
        """Nearest first, leaving out nodes nearer to one already chosen; the rest fills up."""
        found = sorted(found, reverse=True)
        ids = np.array([i for _, i in found])
        among = self.x[ids] @ self.x[ids].T
        chosen, passed = [], []
        for k, (s, _) in enumerate(found):
            if len(chosen) == most:
                break
            (passed if chosen and among[k, chosen].max() > s else chosen).append(k)
        return ids[(chosen + passed)[:most]].tolist()

    def _link(self, i: int, to: list[int], level: int) -> None:
        flat, degree = self.flat[level], self.degree[level]
        width = flat.shape[1]
        flat[i, :len(to)] = to
        degree[i] = len(to)
        for j in to:
            if degree[j] < width:
                flat[j, degree[j]] = i
                degree[j] += 1
            else:
                near = np.r_[flat[j], np.int32(i)]
                sims = self.x[near] @ self.x[j]
                keep = self._choose(list(zip(sims.tolist(), near.tolist())), width)
                flat[j, :len(keep)] = keep
                flat[j, len(keep):] = -1
                degree[j] = len(keep)

    def _insert(self, i: int) -> None:
        if self.entry < 0:
            self.entry = i
            return
        q, own = self.x[i], int(self.level[i])
        top = int(self.level[self.entry])
        found = self._descend(q, own)
        for level in range(min(own, top), -1, -1):
            found = self._beam(q, found, self.beam, level)
            self._link(i, self._choose(found, self.links), level)
        if own > top:
            self.entry = i

    def search(self, q: np.ndarray, k: int, beam: int) -> list[int]:
        """The ``k`` nearest nodes found, nearest first."""
        if self.entry < 0:
            return []
        q = np.asarray(q, np.float32)
        found = self._beam(q, self._descend(q, 0), max(k, beam), 0)
        return [i for _, i in sorted(found, key=lambda f: (-f[0], f[1]))[:k]]


# ---------------------------------------------------------------- Spark

def usable(vector: Column) -> Column:
    """True for vectors without null or non-finite components that are not zero."""
    d = vector.cast("array<double>")
    sound = F.forall(d, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(sound & F.exists(d, lambda v: v != 0.0), F.lit(False))


def _distinct_vectors(rows: DataFrame, keep: int, salts: int = 64) -> DataFrame:
    """(v, ids): each distinct vector with its ``keep`` smallest ids, ascending.

    Copies of a vector are reduced twice, first within salted parts, so that
    a vector that a third of all rows share is never gathered.
    """
    salted = rows.select("v", "id", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt"))
    part = Window.partitionBy("v", "salt").orderBy("id")
    some = salted.withColumn("r", F.row_number().over(part)).where(F.col("r") <= keep)
    return some.groupBy("v").agg(F.slice(F.sort_array(F.collect_list("id")), 1, keep).alias("ids"))


def _search_batches(batches: Iterator[pa.RecordBatch], k: int, beam: int) -> Iterator[pa.RecordBatch]:
    """Rows (shard, query, vec, v, dim) by (shard, dim), index rows (query null) first: build, then answer."""
    shard, ids, vectors, graph = None, [], [], None
    for batch in batches:
        shards = list(zip(batch.column(0).to_pylist(), batch.column(4).to_pylist()))
        is_index = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        queries = batch.column(1).fill_null(0).to_numpy(zero_copy_only=False)
        vec = batch.column(2).fill_null(0).to_numpy(zero_copy_only=False)
        lists = batch.column(3)
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        size = lists.value_lengths().to_numpy(zero_copy_only=False)
        end = np.cumsum(size)
        q_out, v_out = [], []
        for i in range(len(shards)):
            if shards[i] != shard:
                shard, ids, vectors, graph = shards[i], [], [], None
            x = flat[end[i] - size[i]:end[i]]
            if is_index[i]:
                ids.append(vec[i])
                vectors.append(x)
                continue
            if graph is None:
                graph = Graph(np.stack(vectors)) if vectors else Graph(np.empty((0, len(x)), np.float32))
            found = graph.search(x, k, beam)
            q_out += [queries[i]] * len(found)
            v_out += [ids[j] for j in found]
        yield pa.RecordBatch.from_arrays([pa.array(q_out, pa.int64()), pa.array(v_out, pa.int64())], ["query", "vec"])


def _unit(v: Column) -> Column:
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: (x / norm).cast("float"))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of doubles, summed in order."""
    def dot(x, y):
        return F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)

    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def nearest(rows: DataFrame, queries: Column, top: int = TOP, shard_rows: int = SHARD_ROWS, beam: int = SEARCH_BEAM,
            vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``top`` nearest rows found of every row that ``queries`` selects.

    Candidates are all other rows with a sound vector of the query's length;
    null ids and null, zero or non-finite vectors take no part. Ties go to
    the smaller id. Copies of a vector share a node, and answers name the
    smallest ids of the copies. Rows that repeat an id with one vector are one
    row; an id with several vectors asks with each and gets the best of all. Other input columns are ignored.
    """
    spark = rows.sparkSession
    ready_workers(spark)
    picked = F.coalesce(queries, F.lit(False))
    sound = rows.where(usable(F.col(vector)) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), picked.alias("is_query"))
    sound = staged(sound.groupBy("id", "v").agg(F.max("is_query").alias("is_query")), "neighbours")
    nodes = staged(_distinct_vectors(sound, top + 1), "neighbours-nodes")
    n = nodes.count()
    shards = max(1, -(-n // shard_rows))
    first = F.element_at("ids", 1)
    index = nodes.select((F.pmod(F.xxhash64(first), F.lit(shards))).cast("int").alias("shard"),
                         F.lit(None).cast("long").alias("query"), first.alias("vec"), _unit(F.col("v")).alias("v"))
    asked = sound.where("is_query").select("id", "v")
    ask = asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.col("id").alias("query"),
                       F.lit(None).cast("long").alias("vec"), _unit(F.col("v")).alias("v"))
    both = index.unionByName(ask).withColumn("dim", F.size("v")).repartitionByRange(max(shards, 2), "shard", "dim") \
        .sortWithinPartitions("shard", "dim", F.col("query").asc_nulls_first(), "vec")
    found = both.mapInArrow(lambda it: _search_batches(it, top + 1, beam), "query long, vec long")
    # the nodes' copies, exact scores, and the best of all shards
    copies = nodes.select(F.element_at("ids", 1).alias("vec"), "ids", F.col("v").alias("found_v"))
    scored = found.distinct().join(copies, "vec").join(asked.select(F.col("id").alias("query"), F.col("v").alias("query_v")), "query")
    scored = scored.where(F.size("found_v") == F.size("query_v")).select(
        "query", cosine(F.col("query_v"), F.col("found_v")).alias("score"), F.explode("ids").alias("vec"))

    def best_of(rows_: DataFrame, *by: str) -> DataFrame:
        some = F.slice(F.array_sort(F.collect_set(F.struct("cost", "vec"))), 1, top)
        return rows_.groupBy(*by).agg(some.alias("best"))

    # first among parts of the answers, so that no query gathers the answers of all shards at once
    parts = scored.where("vec <> query").select("query", (-F.col("score")).alias("cost"), "vec", F.pmod(F.xxhash64("vec"), F.lit(64)).alias("part"))
    best = best_of(best_of(parts, "query", "part").select("query", F.explode("best").alias("x")).select("query", "x.*"), "query")
    return best.select("query", F.posexplode("best")).select(
        F.col("query").alias("query_id"), (F.col("pos") + 1).cast("int").alias("rank"),
        F.col("col.vec").alias("vec_id"), (-F.col("col.cost")).alias("score"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)

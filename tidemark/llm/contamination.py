"""Benchmark decontamination by Wu-Manber search for windows of benchmark words.

The strings sought are all windows of consecutive words of the benchmark's
items. A shift table tells for a block of words how far the end of any window
must be at least, so positions in between are skipped; a block with shift zero
ends some window, a bucket by its hash selects these, their first block is
compared by hash, and the words themselves are compared byte by byte. Many
cursors run side by side, one for each stretch of a text.

The benchmark is searched in blocks of bounded size, one pass over the
documents for each (one block up to some megabytes of benchmark text).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import hashing
from tidemark.llm.tables import ready_workers, staged, table, text_or_empty

WINDOW_WORDS = 10
#: Words of a block of the shift table (fewer in shorter strings).
BLOCK_WORDS = 3
#: Benchmark text bytes searched in one pass; words of one part of a longer item.
PASS_BYTES, PART_WORDS = 2 << 20, 5000
#: Text bytes that are searched together (or one text), word ends of one cursor, and pairs compared at once.
_GROUP_BYTES, _STRETCH, _PAIRS = 4 << 20, 512, 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_NOT_WORD = np.ones(256, bool)
_NOT_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(128, 256)]] = False
_ODD = np.uint64(0x9FB21C651E98DF25)


def _split(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, end) of the words of lower-cased bytes."""
    out, at = [[np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]], 0
    for piece in hashing.pieces(raw):
        h, start, end = hashing.words(np.frombuffer(piece, np.uint8), _NOT_WORD)
        for column, x in zip(out, (h, start + at, end + at)):
            column.append(x)
        at += len(piece)
    return tuple(np.concatenate(x) for x in out)


def _ramp(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for ``size[0]`` values, and so on."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)


def _block(h: np.ndarray, last: np.ndarray, words: int) -> np.ndarray:
    """Hash of the ``words`` words that end with word ``last``."""
    out = h[last - words + 1]
    for k in range(words - 2, -1, -1):
        out = hashing.mix(out * _ODD + h[last - k])
    return out


class Strings:
    """All windows of one length: shift table, suffix buckets and the words to compare with."""

    def __init__(self, words: int, h: np.ndarray, first: np.ndarray):
        self.words, self.block, self.first, self.h = words, min(BLOCK_WORDS, words), first, h
        self.bits = max(10, (8 * len(first)).bit_length())
        furthest = words - self.block + 1
        self.shift = np.full(1 << self.bits, furthest, np.uint8)
        for ahead in range(furthest):
            block = _block(h, first + words - 1 - ahead, self.block)
            np.minimum.at(self.shift, self._slot(block), ahead)
        suffix = _block(h, first + words - 1, self.block)
        self.by_suffix = np.argsort(suffix, kind="stable")
        keys, at, size = np.unique(suffix[self.by_suffix], return_index=True, return_counts=True)
        self.buckets = hashing.HashTable(keys, np.stack([at, size], axis=1))
        self.prefix = _block(h, first + self.block - 1, self.block)

    def _slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(last word, string) pairs to compare in the texts of words ``lo[i]`` up to ``hi[i]``."""
        at = lo + self.words - 1
        count = -(-np.maximum(hi - at, 0) // _STRETCH)
        text = np.repeat(np.arange(len(lo)), count)
        cursor = _ramp(np.zeros(len(count), np.int64), count) * _STRETCH + at[text]
        stop = np.minimum(cursor + _STRETCH, hi[text])
        ends = [np.empty(0, np.int64)]
        while len(cursor):
            shift = self.shift[self._slot(_block(h, cursor, self.block))].astype(np.int64)
            ends.append(cursor[shift == 0])
            cursor = cursor + np.maximum(shift, 1)
            some = cursor < stop
            cursor, stop = cursor[some], stop[some]
        ends = np.concatenate(ends)
        bucket = self.buckets.get(_block(h, ends, self.block), np.array([0, 0]))
        string = self.by_suffix[_ramp(bucket[:, 0], bucket[:, 1])]
        ends = np.repeat(ends, bucket[:, 1])
        same = _block(h, ends - self.words + self.block, self.block) == self.prefix[string]
        return ends[same], string[same]


class Benchmark:
    """One block of benchmark items, ready to be searched for."""

    def __init__(self, items: list[tuple[str | None, str]]):
        self.ids = sorted({i for i, _ in items if i is not None})
        number = {x: i for i, x in enumerate(self.ids)}
        raw = "\n".join(t for _, t in items).encode("utf-8", "surrogatepass")
        self.data = np.frombuffer(raw, np.uint8)
        h, self.start, self.end = _split(raw)
        ends = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for _, t in items], dtype=np.int64)
        item = np.searchsorted(ends, self.start, side="right")
        size = np.bincount(item, minlength=len(items))
        at = np.cumsum(size) - size
        owners: dict[bytes, tuple[int, int, set[int]]] = {}
        for (name, _), a, n in zip(items, at.tolist(), size.tolist()):
            words = min(n, WINDOW_WORDS)
            for w in range(a, a + n - words + 1) if n else ():
                key = raw[self.start[w]:self.end[w + words - 1]]
                owners.setdefault(key, (words, w, set()))[2].update(() if name is None else (number[name],))
        self.classes = []
        for words in sorted({x[0] for x in owners.values()}):
            mine = [(w, sorted(who)) for k, w, who in owners.values() if k == words]
            owner_size = np.array([len(who) for _, who in mine])
            self.classes.append((Strings(words, h, np.array([w for w, _ in mine])),
                                 np.cumsum(owner_size) - owner_size, owner_size,
                                 np.array([i for _, who in mine for i in who], np.int64)))

    def _equal(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, words: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which of the pairs of first words (in the texts, in the benchmark) begin ``words`` words of equal bytes."""
        out = np.zeros(len(a), bool)
        for lo in range(0, len(a), _PAIRS):
            x = (a[lo:lo + _PAIRS, None] + np.arange(words)).ravel()
            y = (b[lo:lo + _PAIRS, None] + np.arange(words)).ravel()
            size = end[x] - start[x]
            same = (size == self.end[y] - self.start[y]).reshape(-1, words).all(axis=1)
            some = np.repeat(same, words)
            x, y, size = x[some], y[some], size[some]
            differs = data[_ramp(start[x], size)] != self.data[_ramp(self.start[y], size)]
            of = np.repeat(np.repeat(np.flatnonzero(same), words), size)
            same[of[differs]] = False
            out[lo:lo + _PAIRS] = same
        return out

    def search(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words of each text; text, first word and words of every occurrence, its row's items as (text, item) pairs)."""
        raw = b"\n".join(texts).lower()
        data = np.frombuffer(raw, np.uint8)
        h, start, end = _split(raw)
        bound = np.cumsum([0, *(len(t) + 1 for t in texts)])
        word = np.searchsorted(start, bound)
        lo, hi = word[:-1], word[1:]
        found, pairs = [np.empty((0, 3), np.int64)], [np.empty((0, 2), np.int64)]
        for strings, owner, owners, items in self.classes:
            last, string = strings.candidates(h, lo, hi)
            first = last - strings.words + 1
            same = self._equal(data, start, end, strings.words, first, strings.first[string])
            first, string = first[same], string[same]
            text = np.searchsorted(hi, first, side="right")
            found.append(np.stack([text, first - lo[text], np.full(len(first), strings.words)], axis=1))
            seen = np.unique(np.stack([text, string], axis=1), axis=0)
            pairs.append(np.stack([np.repeat(seen[:, 0], owners[seen[:, 1]]),
                                   items[_ramp(owner[seen[:, 1]], owners[seen[:, 1]])]], axis=1))
        return hi - lo, np.concatenate(found), np.unique(np.concatenate(pairs), axis=0)


def _cover(size: np.ndarray, text: np.ndarray, first: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the maximal runs of covered words, in order."""
    base = np.cumsum(size + 1) - (size + 1)
    depth = np.zeros(int((size + 1).sum()) + 1, np.int64)
    np.add.at(depth, base[text] + first, 1)
    np.add.at(depth, base[text] + first + words, -1)
    edge = np.flatnonzero(np.diff(np.r_[False, np.cumsum(depth) > 0]))
    start, end = edge[::2], edge[1::2]
    of = np.searchsorted(base, start, side="right") - 1
    return of, start - base[of], end - base[of]


# ---------------------------------------------------------------- Spark

_SPANS = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
RESULTS = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", _SPANS),
           T.StructField("items", T.ArrayType(T.StringType()))]


def _groups(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    lo, size = 0, 0
    for i, t in enumerate(texts):
        if i > lo and size + len(t) > _GROUP_BYTES:
            yield lo, i
            lo, size = i, 0
        size += len(t) + 1
    if len(texts) > lo:
        yield lo, len(texts)


def _searched(batches: Iterator[pa.RecordBatch], bench: Benchmark, kept: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [x.as_py().encode("utf-8", "surrogatepass") for x in batch.column("text")]
        for lo, hi in _groups(texts):
            part = batch.slice(lo, hi - lo)
            size, found, pairs = bench.search(texts[lo:hi])
            before = part.column("hit_spans")
            count = before.value_lengths().to_numpy(zero_copy_only=False)
            old = before.flatten()
            s, e = (old.field(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            text, start, end = _cover(size, np.r_[found[:, 0], np.repeat(np.arange(hi - lo), count)],
                                      np.r_[found[:, 1], s], np.r_[found[:, 2], e - s])
            spans = pa.ListArray.from_arrays(
                pa.array(np.searchsorted(text, np.arange(hi - lo + 1)), pa.int32()),
                pa.StructArray.from_arrays([pa.array(start, pa.int64()), pa.array(end, pa.int64())], ["start", "end"]))
            items = part.column("items").to_pylist()
            for t, i in pairs.tolist():
                items[t].append(bench.ids[i])
            yield pa.RecordBatch.from_arrays([
                *(part.column(c) for c in kept), pa.array(size, pa.int64()), spans.cast(schema.field("hit_spans").type),
                pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())).cast(schema.field("items").type)], schema=schema)


def _passes(benchmark: DataFrame, item_id: str, text: str) -> tuple[DataFrame, int]:
    """(item, words, pass) parts of the items with words, and the number of passes."""
    w = F.regexp_extract_all(F.translate(text_or_empty(text), UPPER, LOWER), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.col(item_id).cast("string").alias("item"), w.alias("w")).where(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - WINDOW_WORDS, F.lit(0)), F.lit(PART_WORDS)))
    parts = items.withColumn("at", at).select("item", F.array_join(F.slice("w", F.col("at") + 1, PART_WORDS + WINDOW_WORDS - 1), " ").alias("words")).distinct()
    parts = staged(parts, "benchmark")
    size = parts.agg(F.coalesce(F.sum(F.octet_length("words")), F.lit(0)).alias("bytes")).first()["bytes"]
    n = max(1, -(-size // PASS_BYTES))
    return parts.withColumn("pass", F.pmod(F.xxhash64("item", "words"), F.lit(n))), n


def contaminated(docs: DataFrame, benchmark: DataFrame, keep: Sequence[str] = ("doc_id",),
                 text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``keep`` columns of every document with ``n_words``, ``hit_spans`` and ``items``.

    A word is hit inside any occurrence of a window: ``WINDOW_WORDS``
    consecutive words of an item, or all words of a shorter one. Spans count
    words, end exclusive, maximal. ``items`` are the ids of items with
    occurring windows, sorted. A null text has no words; an item without words
    has no window; an item with a null id marks words but is not listed;
    repeated rows and ids are one item; documents come back as often as they
    come. A ``keep`` column named like a result or the text is refused.
    Memory grows with the words of the longest text (about five times its bytes).

    The benchmark is searched in passes of about ``PASS_BYTES`` each (longer
    items in parts that share windows' words), so that what is broadcast is
    bounded; between passes the documents are staged with what was found.
    """
    clash = sorted(set(keep) & {"text", *(f.name for f in RESULTS)})
    if clash:
        raise ValueError(f"columns {clash} are results or the text and cannot be kept")
    spark = docs.sparkSession
    ready_workers(spark)
    parts, n = _passes(benchmark, item_id, item_text)
    rows = docs.select(*keep, text_or_empty(text).alias("text"), F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("hit_spans"),
                       F.lit(None).cast("array<string>").alias("items"))
    rows = rows.withColumn("hit_spans", F.coalesce("hit_spans", F.array().cast(_SPANS))).withColumn("items", F.coalesce("items", F.array().cast("array<string>")))
    for i in range(n):
        last = i == n - 1
        kept = list(keep) if last else [*keep, "text"]
        out = T.StructType([rows.schema[c] for c in kept] + RESULTS)
        schema = spark.createDataFrame([], out).toArrow().schema
        bench = spark.sparkContext.broadcast(Benchmark([tuple(r) for r in parts.where(F.col("pass") == i).select("item", "words").collect()]))
        rows = rows.mapInArrow(lambda it, b=bench, k=kept, s=schema: _searched(it, b.value, k, s), out)
        if not last:
            rows = staged(rows, "benchmark-pass")
            bench.unpersist()
    return rows


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
                        (n_hit > 0).alias("contaminated"))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
item_starts AS (
  SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0),
windows AS (SELECT DISTINCT item_id, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS win FROM item_starts),
doc_starts AS (
  SELECT row, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m),
occurrences AS (
  SELECT d.row, d.i, d.m, x.item_id FROM (SELECT row, i, m, array_to_string(list_slice(w, i, i + m - 1), ' ') AS win FROM doc_starts) d
  JOIN windows x ON x.m = d.m AND x.win = d.win),
words_hit AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + m)) AS p FROM occurrences) GROUP BY row),
items_hit AS (
  SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY encode(item)) AS ids
  FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM occurrences WHERE item_id IS NOT NULL) GROUP BY row)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(h.n_hit, 0)::BIGINT AS n_hit, coalesce(t.n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(t.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN words_hit h ON h.row = d.row LEFT JOIN items_hit t ON t.row = d.row
"""

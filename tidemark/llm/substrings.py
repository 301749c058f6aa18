"""Exact removal of repeated byte strings by longest-previous-factor arrays.

A byte goes when a string of ``LENGTH`` bytes covers it that also starts
earlier in the corpus. Two equal strings have equal anchors: the smallest of
their hashed ``GRAM``-byte grams, the leftmost of equals. A document is a
sequence of runs of string starts that share an anchor, and a run's bytes are
a segment. Segments meet by the anchor's hash:

1. equal segments: all strings of all but the first are repeated;
2. different segments of one anchor: their suffixes are ranked by prefix
   doubling, and previous and next smaller positions in suffix order tell
   which strings start earlier elsewhere (longest previous factor >= LENGTH).

Anchors that meet in more than ``GROUP_SEGMENTS`` different segments (the end
of a passage that a third of all documents share) are taken string by string,
spread by the hash of the string. Documents are ordered by ``doc_id`` (null
first), rows of one ``doc_id`` by text hash; equal rows are one document and
get equal results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.tables import ready_workers, staged, table, text_or_empty

LENGTH = 100
GRAM = 32
GROUP_SEGMENTS = 2000
_POSITION_BITS = 21
_BUFFER = 1 << 20  # bytes hashed at once; below 2 ** _POSITION_BITS
_RANKED = 1 << 21  # bytes ranked at once
_REDUCED = 1 << 25  # bytes of texts whose repetitions are judged together before the shuffle
_KEYS = ["g", "s", "d", "row", "at"]
_MARK = -1


# ---------------------------------------------------------------- anchors

def _buffers(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (document, offset, bytes) of bounded size; long texts in pieces that overlap by length - 1."""
    group, size = [], 0
    for i, t in enumerate(texts):
        for lo in range(0, max(1, len(t) - length + 1), _BUFFER):
            piece = t[lo:lo + _BUFFER + length - 1]
            if len(piece) < length:
                continue
            if size + len(piece) > _BUFFER and group:
                yield group
                group, size = [], 0
            group.append((i, lo, piece))
            size += len(piece)
    if group:
        yield group


def segments(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(document, first start, starts, anchor hash, segment hash) of all runs of equal anchor."""
    import xxhash

    out = [[np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)] * 2]
    low = np.uint64((1 << _POSITION_BITS) - 1)
    for group in _buffers(texts, length):
        raw = b"".join(p for _, _, p in group)
        data = np.frombuffer(raw, np.uint8)
        size = np.array([len(p) for _, _, p in group])
        base = np.cumsum(size) - size
        p = hashing.prefix(data)
        _, down = hashing.powers(len(data))
        n = len(data) - gram + 1
        grams = hashing.mix((p[gram:] - p[:n]) * down[:n])
        low_key = (grams & ~low) | np.arange(n, dtype=np.uint64)
        span, want = 1, length - gram + 1
        while span * 2 <= want:
            low_key = np.minimum(low_key[:-span], low_key[span:])
            span *= 2
        if span < want:
            low_key = np.minimum(low_key[:len(low_key) - (want - span)], low_key[want - span:])
        anchor = (low_key & low).astype(np.int64)
        valid = np.zeros(len(data), bool)
        for b, k in zip(base.tolist(), size.tolist()):
            valid[b:b + k - length + 1] = True
        starts = np.flatnonzero(valid)
        anchor = anchor[starts]
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)]
        first = np.flatnonzero(new)
        count = np.diff(np.r_[first, len(starts)])
        a = starts[first]
        piece = np.searchsorted(base, a, side="right") - 1
        digest, view = xxhash.xxh3_64_intdigest, memoryview(raw)
        s = np.array([digest(view[x:y]) for x, y in zip(a.tolist(), (a + count + length - 1).tolist())], np.uint64)
        doc = np.array([i for i, _, _ in group])[piece]
        out.append([doc, a - base[piece] + np.array([lo for _, lo, _ in group])[piece], count, grams[anchor[first]], s])
    return tuple(np.concatenate(x) for x in zip(*out))


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of intervals, touching ones joined."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > end[:-1]]
    last = np.r_[np.flatnonzero(new)[1:] - 1, len(end) - 1]
    return start[new], end[last]


def _merge_rows(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Union of intervals of each row."""
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    out = []
    for lo, hi in zip(*(lambda c: (c, np.r_[c[1:], len(row)]))(np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.empty(0, int))):
        a, b = merge(start[lo:hi], end[lo:hi])
        out.append((np.full(len(a), row[lo]), a, b))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (row, start, end)


def _keep_first(g, s, d, row, at, end):
    """Rows ordered by place -> (kept rows, marks): of equal (g, s) all but the first become marks.

    Rows at the first's own place come from equal documents: they are dropped, not marked.
    """
    place = np.lexsort((at, row, d))
    g, s, d, row, at, end = (x[place] for x in (g, s, d, row, at, end))
    order = np.lexsort((s, g))
    repeated = np.zeros(len(g), bool)
    repeated[order[1:]] = (g[order[1:]] == g[order[:-1]]) & (s[order[1:]] == s[order[:-1]])
    first = np.empty(len(g), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(repeated[order], 0, np.arange(len(g))))]
    later = repeated & ((d != d[first]) | (row != row[first]) | (at != at[first]))
    marks = _merge_rows(row[later], at[later], end[later])
    return tuple(x[~repeated] for x in (g, s, d, row, at, end)), marks


_CLASS_SCHEMA = "g long, s long, d long, row long, at long, end long"


def _class_rows(kept, marks) -> pa.RecordBatch:
    """Rows for the shuffle by (g, s); a mark travels with its row's hash as key and s = d = _MARK."""
    m_row, m_at, m_end = marks
    none = np.full(len(m_row), _MARK, np.int64)
    mark_cols = (m_row, none, none, m_row, m_at, -m_end)
    cols = [np.concatenate([np.asarray(a).view(np.int64), b]) for a, b in zip(kept, mark_cols)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["g", "s", "d", "row", "at", "end"])


def _anchor_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Runs of all texts; repetitions within about ``_REDUCED`` bytes of texts are judged before the shuffle."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for batch in batches:
        d = batch.column(0).to_numpy(zero_copy_only=False)
        row = batch.column(1).to_numpy(zero_copy_only=False)
        texts = [t.encode("utf-8", "surrogatepass") for t in batch.column(2).to_pylist()]
        doc, at, count, g, s = segments(texts, length)
        held.append((g, s, d[doc], row[doc], at, at + count + length - 1))
        size += sum(map(len, texts))
        if size >= _REDUCED:
            yield _class_rows(*_keep_first(*(np.concatenate(x) for x in zip(*held))))
            held, size = [], 0
    if held:
        yield _class_rows(*_keep_first(*(np.concatenate(x) for x in zip(*held))))


# ---------------------------------------------------------------- equal segments

_OUT_SCHEMA = "kind int, g long, d long, row long, at long, end long"


def _out(kind: int, g, d, row, at, end) -> pa.RecordBatch:
    cols = [np.full(len(row), kind, np.int32), *(np.asarray(x, np.int64) for x in (g, d, row, at, end))]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["kind", "g", "d", "row", "at", "end"])


def _judge_classes(batches: Iterator[pa.RecordBatch], compare: bool) -> Iterator[pa.RecordBatch]:
    """Sorted by (g, s, place): kind 0 marks for all but the first of a class; kind 1: firsts of anchors with several classes.

    Rows at the place of their class's first come from equal documents and are
    dropped. Only the last class's first row is held between batches, so a
    group of any size streams through.
    """
    held = None  # (g, s, d, row, at, end) of the last first, and whether it was given out
    given = True
    for batch in batches:
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(6)]
        if not len(cols[0]):
            continue
        is_mark = cols[5] < 0
        if is_mark.any():
            m = [c[is_mark] for c in cols]
            yield _out(0, m[0], m[2], m[3], m[4], -m[5])
            cols = [c[~is_mark] for c in cols]
        g, s, d, row, at, end = cols
        if not len(g):
            continue
        before_g, before_s = np.r_[held[0] if held else 0, g[:-1]], np.r_[held[1] if held else 0, s[:-1]]
        same_g, same = g == before_g, (g == before_g) & (s == before_s)
        if held is None:
            same_g[0] = same[0] = False
        lead = np.maximum.accumulate(np.where(same, 0, np.arange(1, len(g) + 1)))  # 0: the held row leads the class
        of_first = [np.r_[held[i] if held else 0, c][lead] for i, c in ((2, d), (3, row), (4, at))]
        later = same & ((d != of_first[0]) | (row != of_first[1]) | (at != of_first[2]))
        if later.any():
            marks = _merge_rows(row[later], at[later], end[later])
            yield _out(0, np.zeros(len(marks[0])), np.zeros(len(marks[0])), *marks)
        first = np.flatnonzero(~same)
        if compare and len(first):
            fg = g[first]
            follows = same_g[first]  # an earlier class of its anchor exists
            leads = np.r_[fg[1:] == fg[:-1], False]
            if held and follows[0] and not given:
                yield _out(1, *([x] for x in (held[0], held[2], held[3], held[4], held[5])))
            ask = first[follows | leads]
            if len(ask):
                yield _out(1, g[ask], d[ask], row[ask], at[ask], end[ask])
            given = bool((follows | leads)[-1])
        if len(first):
            held = tuple(int(c[first[-1]]) for c in cols)


# ---------------------------------------------------------------- suffix order

def suffix_ranks(data: np.ndarray, stop: np.ndarray, length: int) -> np.ndarray:
    """Rank in suffix order of the first ``length`` bytes from every position; -1 if they pass ``stop``.

    Prefix doubling: eight bytes are ranked as numbers, then pairs of ranks.
    """
    n = len(data)
    padded = np.r_[data, np.zeros(8, np.uint8)]
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i:i + n]
    at = np.arange(n)
    ok = at + 8 <= stop
    rank = np.full(n, -1, np.int64)
    rank[ok] = np.unique(key[ok], return_inverse=True)[1]
    have = 8
    while have < length:
        step = min(have, length - have)
        ok = np.flatnonzero(at + have + step <= stop)
        pair = rank[ok] * np.int64(n + 1) + rank[ok + step]
        rank = np.full(n, -1, np.int64)
        rank[ok] = np.unique(pair, return_inverse=True)[1]
        have += step
    return rank


def repeated_starts(data: np.ndarray, stop: np.ndarray, length: int) -> np.ndarray:
    """Positions whose longest previous factor reaches ``length``.

    Positions are in corpus order. In suffix order, neighbours with a common
    prefix of ``length`` form a run; the factor reaches it if the previous or
    the next smaller position of the run exists.
    """
    rank = suffix_ranks(data, stop, length)
    at = np.flatnonzero(rank >= 0)
    order = at[np.argsort(rank[at], kind="stable")]
    if not len(order):
        return order
    # the stable sort leaves a run's positions ascending: the previous smaller position is the
    # neighbour before, the next smaller one does not exist, and only a run's first has neither
    run = rank[order]
    in_run = np.r_[False, run[1:] == run[:-1]]
    return np.sort(order[in_run])


def _rank_group(g, d, row, at, raw: list[bytes], length: int) -> pa.RecordBatch:
    """Marks of the repeated strings among different segments, by suffix order."""
    place = np.lexsort((at, row, d))
    place = place[np.r_[True, (row[place[1:]] != row[place[:-1]]) | (at[place[1:]] != at[place[:-1]])]]  # equal documents once
    raw = [raw[i] for i in place]
    row, at = row[place], at[place]
    size = np.array([len(r) for r in raw])
    base = np.cumsum(size) - size
    data = np.frombuffer(b"".join(raw), np.uint8)
    found = repeated_starts(data, np.repeat(base + size, size), length)
    seg = np.searchsorted(base, found, side="right") - 1
    start = at[seg] + found - base[seg]
    marks = _merge_rows(row[seg], start, start + length)
    return _out(0, np.zeros(len(marks[0])), np.zeros(len(marks[0])), *marks)


def _rank_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (g, d, row, at, raw) sorted by g; whole anchors are ranked together, many at once."""
    held: list[np.ndarray] = [np.empty(0, np.int64)] * 4
    held_raw: list[bytes] = []
    for batch in batches:
        cols = [np.concatenate([h, batch.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held)]
        raw = held_raw + batch.column(4).to_pylist()
        g = cols[0]
        if not len(g):
            continue
        total = np.cumsum([len(r) for r in raw])
        ends = np.flatnonzero(g[1:] != g[:-1]) + 1  # anchors end here; the last one may go on
        lo = 0
        while len(ends) and lo < ends[-1]:
            done = total[lo - 1] if lo else 0
            hi = int(ends[max(np.searchsorted(ends, lo, side="right"), np.searchsorted(total[ends - 1], done + _RANKED, side="right") - 1)]) \
                if total[ends[-1] - 1] - done > _RANKED else int(ends[-1])
            yield _rank_group(*(c[lo:hi] for c in cols), raw[lo:hi], length)
            lo = hi
        held, held_raw = [c[lo:] for c in cols], raw[lo:]
    if held_raw:
        yield _rank_group(*held, held_raw, length)


# ---------------------------------------------------------------- strings of crowded anchors

def _string_batches(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Rows (g, d, row, at, raw) -> every string of a segment, keyed by 128 bits of hash."""
    import xxhash

    for batch in batches:
        d, row, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
        raw = batch.column(4).to_pylist()
        for lo in range(0, len(raw), 4096):
            part = raw[lo:lo + 4096]
            seg = np.repeat(np.arange(lo, lo + len(part)), [len(r) - length + 1 for r in part])
            offset = np.concatenate([np.arange(len(r) - length + 1) for r in part])
            both = b"".join(xxhash.xxh3_128_digest(r[i:i + length]) for r in part for i in range(len(r) - length + 1))
            h = np.frombuffer(both, "<u8").reshape(-1, 2)
            start = at[seg] + offset
            yield _class_rows(*_keep_first(h[:, 0].copy(), h[:, 1].copy(), d[seg], row[seg], start, start + length))


# ---------------------------------------------------------------- operator

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, asked: list of (g, d, row, at, end)) -> (g, d, row, at, raw), once for a task's equal documents."""
    seen: set[int] = set()
    for batch in batches:
        keys = pa.compute.list_element(batch.column(1), 0).field("row").to_pylist()
        new = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
        batch = batch.take(pa.array(new, pa.int64()))
        texts, asked = batch.column(0).to_pylist(), batch.column(1)
        fields = [asked.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(5)]
        n = asked.value_lengths().to_numpy(zero_copy_only=False)
        raw, k = [], 0
        for t, c in zip(texts, n.tolist()):
            b = t.encode("utf-8", "surrogatepass")
            raw += [b[x:y] for x, y in zip(fields[3][k:k + c].tolist(), fields[4][k:k + c].tolist())]
            k += c
        yield pa.RecordBatch.from_arrays([*(pa.array(f) for f in fields[:4]), pa.array(raw, pa.binary())], ["g", "d", "row", "at", "raw"])


def repeated_spans(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", length: int = LENGTH,
                   group_segments: int = GROUP_SEGMENTS) -> DataFrame:
    """``docs`` plus ``spans``: the byte intervals (start, end) that repeat earlier strings, merged and ascending.

    Every row comes back once. A null or empty text, and one shorter than
    ``length`` bytes, has no spans. An input column ``spans`` is replaced.
    """
    if length <= GRAM + 1:
        raise ValueError(f"length must exceed {GRAM + 1} bytes")
    ready_workers(docs.sparkSession)
    kept = [c for c in docs.columns if c != "spans"]
    place = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63)))
    keyed = docs.select(*kept, place.alias("__d"), F.xxhash64(place, text_or_empty(text)).alias("__row"),
                        text_or_empty(text).alias("__text"))
    anchors = keyed.select("__d", "__row", "__text").mapInArrow(lambda it: _anchor_batches(it, length), _CLASS_SCHEMA)

    def judged(rows: DataFrame, compare: bool) -> DataFrame:
        dealt = rows.repartition("g").sortWithinPartitions("g", "s", "d", "row", "at")
        return dealt.mapInArrow(lambda it: _judge_classes(it, compare), _OUT_SCHEMA)

    found = staged(judged(anchors, True), "substrings")
    asked = found.where("kind = 1")
    crowded = staged(asked.groupBy("g").count().where(F.col("count") > group_segments).select("g"), "substrings-crowded")
    by_row = keyed.repartition("__row")
    wanted = asked.groupBy("row").agg(F.collect_list(F.struct("g", "d", "row", "at", "end")).alias("asked"))
    raw = by_row.join(wanted, by_row["__row"] == wanted["row"]).select("__text", "asked") \
        .mapInArrow(_cut, "g long, d long, row long, at long, raw binary")
    marks = found.where("kind = 0").select("row", "at", "end")
    if crowded.isEmpty():
        few = raw
    else:
        raw = staged(raw, "substrings-raw")
        few = raw.join(crowded, "g", "left_anti").select("g", "d", "row", "at", "raw")
        strings = raw.join(crowded, "g", "left_semi").select("g", "d", "row", "at", "raw") \
            .mapInArrow(lambda it: _string_batches(it, length), _CLASS_SCHEMA)
        marks = marks.unionByName(judged(strings, False).select("row", "at", "end"))
    ranked = few.repartition("g").sortWithinPartitions("g").mapInArrow(lambda it: _rank_batches(it, length), _OUT_SCHEMA)
    marks = marks.unionByName(ranked.select("row", "at", "end"))
    by_doc = marks.groupBy(F.col("row").alias("__mark_row")).agg(
        F.collect_set(F.struct(F.col("at").alias("start"), "end")).alias("__marks"))

    @F.pandas_udf("array<struct<start:long,end:long>>")
    def merged(rows: pd.Series) -> pd.Series:
        out = []
        for r in rows:
            r = [] if r is None else list(r)
            a, b = merge(np.array([x["start"] for x in r], np.int64), np.array([x["end"] for x in r], np.int64))
            out.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
        return pd.Series(out)

    joined = by_row.join(by_doc, F.col("__row") == F.col("__mark_row"), "left")
    return joined.select(*kept, merged("__marks").alias("spans"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))

    @F.pandas_udf("struct<n_bytes:long,n_removed:long,n_spans:long,kept_sha256:string>")
    def digest(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for t, cuts in zip(texts, spans):
            raw = (t or "").encode("utf-8", "surrogatepass")
            h, at, removed = hashlib.sha256(), 0, 0
            for c in cuts:
                h.update(raw[at:c["start"]])
                at, removed = c["end"], removed + c["end"] - c["start"]
            h.update(raw[at:])
            rows.append((len(raw), removed, len(cuts), h.hexdigest()))
        return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return found.select("doc_id", digest("text", "spans").alias("x")).select("doc_id", "x.*")


#: DuckDB SQL of the query over ``documents``: every string by definition, then islands of repeated ones.
ORACLE = """
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
starts AS (SELECT doc_id, unnest(r) AS p, unnest(list_transform(r, lambda i: b[i + 1 : i + 100])) AS t
  FROM (SELECT *, range(0, greatest(octet_length(b) - 99, 0)) AS r FROM d)),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY t ORDER BY doc_id, p) AS k FROM starts),
hits AS (SELECT doc_id, p, coalesce(p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) > 100, true) AS apart FROM ranked WHERE k > 1),
islands AS (SELECT *, sum(apart::INTEGER) OVER (PARTITION BY doc_id ORDER BY p) AS island FROM hits),
spans AS (SELECT doc_id, min(p) AS s, max(p) + 100 AS e FROM islands GROUP BY doc_id, island),
cuts AS (SELECT doc_id, s, e FROM spans UNION ALL SELECT doc_id, octet_length(b), octet_length(b) FROM d),
pieces AS (SELECT c.doc_id, s, e, hex(b[coalesce(lag(e) OVER (PARTITION BY c.doc_id ORDER BY s, e), 0) + 1 : s]) AS piece
  FROM cuts c JOIN d USING (doc_id))
SELECT doc_id, max(e) AS n_bytes, sum(e - s)::BIGINT AS n_removed, count(*) - 1 AS n_spans,
  sha256(unhex(string_agg(piece, '' ORDER BY s, e))) AS kept_sha256
FROM pieces GROUP BY doc_id
"""

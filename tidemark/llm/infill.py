"""Fill-in-middle: documents cut in three and put together in another order.

Cuts are ranks in tokens and lengths in code points. An indexable skip list
over a text's tokens answers both: every link of every lane carries how many
tokens and how many code points (and bytes) it passes, and a search goes down
from the highest lane, along as many links as fit into the rank, adding up
what they carry. The lists of many texts lie side by side in flat arrays, lane
by lane, and all cuts are searched together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm import hashing
from tidemark.llm.tables import ready_workers, table, text_or_empty

SEED = 42
#: Hundredths of the texts that are transformed, and of these that are put suffix first.
FIM_PERCENT, SPM_PERCENT = 50, 80
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Text bytes whose lists are built together (or one text).
_GROUP_BYTES = 4 << 20


def tokens(raw: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, code points of each token, tokens of each text) of texts of ``size`` bytes, each followed by one byte more.

    A token is white space and the word behind it; white space at the end of a text is one of its own.
    """
    data = np.frombuffer(raw, np.uint8)
    start = np.cumsum(size + 1) - (size + 1)
    inside = ~hashing.SPACES[data]
    inside[start + size] = False
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[(start + size - 1)[size > 0]] = True
    end = np.flatnonzero(last) + 1
    bound = np.searchsorted(end, start, side="right")
    count = np.diff(np.r_[bound, len(end)])
    begin = np.r_[0, end[:-1]]
    begin[bound[count > 0]] = start[count > 0]
    points = np.cumsum(np.r_[0, (data & 0xC0) != 0x80])
    return end - begin, points[end] - points[begin], count


class Lane:
    """Links of one level: ``widths`` (units, code points, bytes) from the node before to each node, and the node below it."""

    def __init__(self, widths: np.ndarray, bound: np.ndarray, below: np.ndarray | None):
        self.widths, self.bound, self.below = widths, bound, below


class SkipLists:
    """One indexable skip list for each text, over tokens of given bytes and code points."""

    def __init__(self, width: np.ndarray, points: np.ndarray, count: np.ndarray):
        bound = np.cumsum(np.r_[0, count])
        widths = np.stack([np.ones(len(width), np.int64), points, width], axis=1)
        self.lanes = [Lane(widths, bound, None)]
        place = np.arange(len(width)) - np.repeat(bound[:-1], count)
        height = hashing.mix(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED))
        while len(height):
            tall = (height & np.uint64(3)) == 0  # a quarter of a lane's nodes reach the next one
            node = np.flatnonzero(tall)
            upper = np.searchsorted(node, bound)
            if not len(node):
                break
            total = np.cumsum(widths, axis=0)
            at = total[node]
            before = np.r_[np.zeros((1, 3), np.int64), at[:-1]]
            head = upper[:-1][np.diff(upper) > 0]
            before[head] = np.r_[np.zeros((1, 3), np.int64), total][bound[:-1][np.diff(upper) > 0]]
            widths, bound, height = at - before, upper, height[node] >> np.uint64(2)
            self.lanes.append(Lane(widths, bound, node))

    def seek(self, text: np.ndarray, rank: np.ndarray) -> np.ndarray:
        """(units, code points, bytes) before the token of each rank in each text; ranks up to the number of tokens."""
        done = np.zeros((len(text), 3), np.int64)
        link = self.lanes[-1].bound[text]
        for level in range(len(self.lanes) - 1, -1, -1):
            lane = self.lanes[level]
            stop = lane.bound[text + 1]
            go = np.arange(len(text))
            while len(go):
                go = go[link[go] < stop[go]]
                go = go[done[go, 0] + lane.widths[link[go], 0] <= rank[go]]
                done[go] += lane.widths[link[go]]
                link[go] += 1
            if level:
                # behind the node last reached, or still at the head of the list
                moved = link > lane.bound[text]
                link = np.where(moved, lane.below[np.maximum(link - 1, 0)] + 1, self.lanes[level - 1].bound[text])
        return done


def draws(doc_id: object, seed: int = SEED) -> tuple[int, ...]:
    """Four whole numbers below 2**32 that depend on the id (null: empty) and the seed alone."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i:i + 4], "big") for i in range(0, 16, 4))


def transform(ids: Sequence, texts: Sequence[str], seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> list[tuple]:
    """(tokens, form, code points of prefix and middle, output) of each text."""
    raws = [t.encode("utf-8", "surrogatepass") for t in texts]
    size = np.array([len(r) for r in raws])
    width, points, count = tokens(b"\n".join(raws) + b"\n", size)
    h = np.array([draws(i, seed) for i in ids], np.int64)
    cuts = np.sort(h[:, :2] % (count + 1)[:, None], axis=1)
    lists = SkipLists(width, points, count)
    text = np.arange(len(texts))
    first, second = lists.seek(text, cuts[:, 0]), lists.seek(text, cuts[:, 1])
    assert (first[:, 0] == cuts[:, 0]).all() and (second[:, 0] == cuts[:, 1]).all()
    out = []
    for t, n, (_, _, h3, h4), (_, p, _), (_, q, _) in zip(texts, count.tolist(), h.tolist(), first.tolist(), second.tolist()):
        if not t or h3 % 100 >= fim_percent or PREFIX in t or SUFFIX in t or MIDDLE in t:
            out.append((n, "plain", None, None, t))
        elif h4 % 100 < spm_percent:
            out.append((n, "spm", p, q - p, f"{SUFFIX}{t[q:]}{PREFIX}{t[:p]}{MIDDLE}{t[p:q]}"))
        else:
            out.append((n, "psm", p, q - p, f"{PREFIX}{t[:p]}{SUFFIX}{t[q:]}{MIDDLE}{t[p:q]}"))
    return out


# ---------------------------------------------------------------- Spark

RESULTS = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
           T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]


def _transformed(batches: Iterator[pa.RecordBatch], kept: list[str], schema: pa.Schema, options: dict) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, ids = batch.column("__text").to_pylist(), batch.column("__id").to_pylist()
        lo = 0
        while lo < len(texts):
            hi, size = lo + 1, len(texts[lo])
            while hi < len(texts) and size + len(texts[hi]) <= _GROUP_BYTES:
                size += len(texts[hi])
                hi += 1
            columns = zip(*transform(ids[lo:hi], texts[lo:hi], **options))
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([
                *(part.column(c) for c in kept),
                *(pa.array(c, schema.field(f.name).type) for c, f in zip(columns, RESULTS))], schema=schema)
            lo = hi


def infill(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text", doc_id: str = "doc_id", seed: int = SEED,
           fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """The ``keep`` columns of every document with ``n`` (tokens), ``form``, ``prefix_chars``, ``middle_chars`` and ``output``.

    Both cuts and the form depend on the id and the seed alone, so repeated
    rows come out alike. A null text is empty; empty texts, texts that hold a
    marker and those not picked stay as they are (``plain``, no lengths). A
    null id draws like an empty one. An empty table gives an empty table. A
    ``keep`` column named like a result is refused. Memory grows with the
    longest text.
    """
    clash = sorted(set(keep) & {"__text", "__id", *(f.name for f in RESULTS)})
    if clash:
        raise ValueError(f"columns {clash} are results and cannot be kept")
    spark = docs.sparkSession
    ready_workers(spark)
    rows = docs.select(*keep, text_or_empty(text).alias("__text"), F.col(doc_id).cast("string").alias("__id"))
    out = T.StructType([rows.schema[c] for c in keep] + RESULTS)
    schema = spark.createDataFrame([], out).toArrow().schema
    options = {"seed": seed, "fim_percent": fim_percent, "spm_percent": spm_percent}
    return rows.mapInArrow(partial(_transformed, kept=list(keep), schema=schema, options=options), out)


def restored(output: Column | str = "output", form: Column | str = "form") -> Column:
    """The text that an output and its form were made of."""
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    part = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    return F.when(form == "psm", F.concat(part[1], part[3], part[2])) \
        .when(form == "spm", F.concat(part[2], part[3], part[1])).otherwise(output)


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = infill(table(spark, sf_dir, "documents"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(), 256).alias("restored_sha256"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
    regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens FROM documents),
drawn AS (
  SELECT *, len(tokens) AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM t),
formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS p, greatest(h1 % (n + 1), h2 % (n + 1)) AS q,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
pieces AS (
  SELECT *, coalesce(array_to_string(list_slice(tokens, 1, p), ''), '') AS prefix,
    coalesce(array_to_string(list_slice(tokens, p + 1, q), ''), '') AS middle,
    coalesce(array_to_string(list_slice(tokens, q + 1, n), ''), '') AS suffix FROM formed)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
    ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM pieces
"""

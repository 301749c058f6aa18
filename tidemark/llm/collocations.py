"""Collocations: phrases mined with one FM-index over word ids per shard of the corpus.

A shard is some megabytes of text. Its words become local ids, words that are
rare in the whole corpus become breaks, and the rest is indexed in both
directions. Suffixes are ordered by their first ``max_words`` words only,
which is all that patterns of that length need. A phrase is a pair of
intervals, one in each direction; one step extends all phrases of a level by
every word to the left and by every word to the right. A phrase one word
longer counts only where both steps lead to it, i.e. where its beginning and
its end are frequent in the corpus.

Shards add up level by level: each sends its phrases' 128-bit keys and counts,
cut into key ranges; a range adds them up and answers every shard with one bit
a phrase. Shards lie in a table bucketed by shard, so answers come to them
and the shards themselves are never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import hashing
from tidemark.llm.tables import ready_workers, staged, table, text_or_empty
from tidemark.session import scratch_folder

MAX_WORDS = 4
MIN_COUNT = 30
TOP = 2000
#: A candidate goes if a longer one around it has this share (in hundredths) of its occurrences.
ABSORBED_PERCENT = 80
SCORE_SCALE = 2_000_000
NO_LANG = "und"
#: Text bytes of a shard, of a buffer that is split into words at once, and behind one key range.
SHARD_BYTES, BUFFER_BYTES, RANGE_BYTES = 4 << 20, 1 << 20, 8 << 20
_PIECE_ENDS = np.zeros(256, bool)
_PIECE_ENDS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_WORD_ENDS = _PIECE_ENDS.copy()
_WORD_ENDS[[32, 9]] = True
_SECOND = hashing.mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
_ODD = np.uint64(0x9FB21C651E98DF25)


# ---------------------------------------------------------------- words of a shard

def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Keys (two 64-bit hashes each) of ordered pairs of keys."""
    return hashing.mix(hashing.mix(a) * _ODD + b[..., ::-1] + np.array([1, 2], np.uint64))


def _word_keys(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(keys, start, end) of the words of a buffer."""
    first, start, end = hashing.words(data, _WORD_ENDS)
    up, down = hashing.powers(len(data))
    p = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_SECOND[data] * up[:len(data)], out=p[1:])
    second = hashing.mix((p[end] - p[start]) * down[start] + (end - start).astype(np.uint64) * _ODD)
    return np.stack([first, second], axis=1), start, end


def _sorted(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, keys in order); sorted together with their places where both fit into 64 bits, which is faster."""
    bits = len(key).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 64:
        order = np.argsort(key)
        return order, key[order]
    both = np.sort((key.astype(np.uint64) << np.uint64(bits)) | np.arange(len(key), dtype=np.uint64))
    return (both & np.uint64((1 << bits) - 1)).astype(np.int64), both >> np.uint64(bits)


def _heads(key: np.ndarray) -> np.ndarray:
    """Where a new value starts in sorted keys."""
    new = np.ones(len(key), bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    return np.flatnonzero(new)


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a row of each distinct key, by key; number of its key for each row)."""
    order = np.argsort(keys[:, 0])
    first, second = keys[order, 0], keys[order, 1]
    new = np.ones(len(order), bool)
    new[1:] = first[1:] != first[:-1]
    if (~new[1:] & (second[1:] != second[:-1])).any():  # equal first halves of different keys
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        new[1:] = (keys[order[1:]] != keys[order[:-1]]).any(axis=1)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number


def _parts(raw: bytes, most: int = BUFFER_BYTES) -> Iterator[bytes]:
    """A text cut behind ends of pieces into parts of about ``most`` bytes."""
    at = 0
    while len(raw) - at > most:
        ends = np.flatnonzero(_PIECE_ENDS[np.frombuffer(raw, np.uint8, offset=at + most)])
        if not len(ends):
            break
        cut = at + most + int(ends[0]) + 1
        yield raw[at:cut]
        at = cut
    yield raw[at:]


def _buffers(parts: list[tuple[str, bytes]]) -> Iterator[list[tuple[str, bytes]]]:
    group, size = [], 0
    for part in parts:
        if group and size + len(part[1]) > BUFFER_BYTES:
            yield group
            group, size = [], 0
        group.append(part)
        size += len(part[1]) + 1
    if group:
        yield group


SHARD_SCHEMA = ("shard long, langs array<string>, lang_words array<long>, words binary, "
                "vocab_keys binary, vocab_counts binary, vocab_langs binary, vocab_text array<binary>")


def _shard_row(shard: int, parts: list[tuple[str, bytes]]) -> dict:
    """One row of the shard table from (lang, text) parts; 0 among the words is a break."""
    import xxhash

    langs = sorted({lang for lang, _ in parts})
    number_of = {lang: i for i, lang in enumerate(langs)}
    lang_keys = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in langs), "<u8").reshape(-1, 2)
    raws, found = [], []
    for group in _buffers(parts):
        raw = b"\n".join(t for _, t in group) + b"\n"
        data = np.frombuffer(raw, np.uint8)
        keys, start, end = _word_keys(data)
        doc = np.searchsorted(np.cumsum([len(t) + 1 for _, t in group]), start, side="right")
        code = np.array([number_of[lang] for lang, _ in group])[doc]
        ends = np.cumsum(_PIECE_ENDS[data])
        gap = np.ones(len(start), bool)
        gap[1:] = ends[start[1:]] != ends[end[:-1] - 1]
        base = sum(map(len, raws))
        raws.append(raw)
        found.append((_pair(lang_keys[code], keys), start + base, end + base, code, gap))
    keys, start, end, code, gap = (np.concatenate(x) for x in zip(*found))
    first, number = _distinct(keys)
    words = np.zeros(len(number) + int(gap.sum()), np.uint32)
    words[np.arange(len(number)) + np.cumsum(gap)] = number + 1
    raw = b"".join(raws)
    return {
        "shard": shard, "langs": langs, "lang_words": np.bincount(code, minlength=len(langs)).tolist(),
        "words": words.tobytes(), "vocab_keys": np.ascontiguousarray(keys[first]).tobytes(),
        "vocab_counts": np.bincount(number, minlength=len(first)).astype(np.uint32).tobytes(),
        "vocab_langs": code[first].astype(np.uint32).tobytes(),
        "vocab_text": [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())],
    }


def _shards(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows (lang, text) in, one row a shard out; a shard's number holds its task and its place in it."""
    task, made, parts, size = TaskContext.get().partitionId(), 0, [], 0

    def row():
        return pa.RecordBatch.from_pylist([_shard_row((task << 32) + made, parts)], schema)

    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for part in _parts(text.as_py().encode("utf-8", "surrogatepass").lower()):
                parts.append((lang, part))
                size += len(part) + 1
                if size >= SHARD_BYTES:
                    yield row()
                    made, parts, size = made + 1, [], 0
    if parts:
        yield row()


# ---------------------------------------------------------------- the index of a shard

class Direction:
    """Suffixes of a text of word ids in the order of their first words, and the step to the word before.

    ``order`` sorts the suffixes by ``depth`` words, ``before`` is the word
    before each of them (the transform), and ``step`` the row of the suffix
    that starts there. All rows of a pattern of up to ``depth`` words are one
    interval, and the rows before which one word stands step onto one
    interval: that of the pattern with this word in front.
    """

    def __init__(self, words: np.ndarray, depth: int):
        rank, span, n = words.astype(np.int64), 1, len(words)
        self.order, in_order = _sorted(rank)
        while span < depth:
            if span > 1:
                new = np.zeros(n, np.int64)
                new[_heads(in_order)[1:]] = 1
                rank[self.order] = np.cumsum(new)
            key = rank * (int(rank.max(initial=0)) + 1)
            key[:n - span] += rank[span:]
            self.order, in_order = _sorted(key)
            span *= 2
        del rank, in_order
        small = np.int32 if n < 1 << 31 else np.int64
        row = np.empty(n, small)
        row[self.order] = np.arange(n, dtype=small)
        self.before = words[self.order - 1]
        self.step = row[self.order - 1]
        self.order = self.order.astype(small)

    def extend(self, lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """(pattern, new start, count, rows of smaller words, word) of every word before every pattern."""
        start = np.cumsum(size) - size
        pattern = np.repeat(np.arange(len(lo)), size)
        rows = np.arange(len(pattern)) + (lo - start)[pattern]
        word = self.before[rows].astype(np.int64)
        words = int(word.max(initial=0)) + 1
        order, key = _sorted(pattern * words + word)
        head = _heads(key)
        count = np.diff(np.r_[head, len(key)])
        first = np.minimum.reduceat(self.step[rows[order]], head).astype(np.int64) if len(head) else head
        pattern, word = np.divmod(key[head].astype(np.int64), words)
        some = word > 0
        return tuple(x[some] for x in (pattern, first, count, head - start[pattern], word))


class Phrases:
    """The phrases of one length in a shard: intervals in both directions, counts and keys, in key order."""

    def __init__(self, lo, back, count, keys):
        order = np.argsort(keys[:, 0], kind="stable")
        self.lo, self.back, self.count, self.keys = lo[order], back[order], count[order], keys[order]

    def keep(self, mask: np.ndarray) -> Phrases:
        return Phrases(self.lo[mask], self.back[mask], self.count[mask], self.keys[mask])


class Index:
    """Both directions of one text of word ids (0: break, first and last)."""

    def __init__(self, words: np.ndarray, depth: int):
        self.words = words
        self.forward, self.backward = Direction(words, depth), Direction(words[::-1], depth)

    def single(self, keys: np.ndarray) -> Phrases:
        """The words themselves; ``keys[i]`` belongs to word ``i + 1``."""
        count = np.bincount(self.words, minlength=len(keys) + 1)
        lo = (np.cumsum(count) - count)[1:]
        return Phrases(lo, lo, count[1:], keys)

    def longer(self, p: Phrases) -> Phrases:
        """All phrases one word longer whose beginning and whose end are among ``p``."""
        end, lo, count, smaller, _ = self.forward.extend(p.lo, p.count)
        back = p.back[end] + smaller
        begin, back_too, _, smaller, _ = self.backward.extend(p.back, p.count)
        lo_too = p.lo[begin] + smaller
        _, a, b = np.intersect1d(lo, lo_too, assume_unique=True, return_indices=True)
        assert (back[a] == back_too[b]).all()
        return Phrases(lo[a], back[a], count[a], _pair(p.keys[begin[b]], p.keys[end[a]]))

    def phrase(self, lo: np.ndarray, size: int) -> np.ndarray:
        """The words of phrases of ``size`` words by their starts, one row each."""
        return self.words[self.forward.order[lo][:, None] + np.arange(size)]


# ---------------------------------------------------------------- adding up

def _edges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Bounds of the 2**bits key ranges in keys that are in order."""
    if not bits:
        return np.array([0, len(keys)])
    return np.searchsorted(keys[:, 0] >> np.uint64(64 - bits), np.arange((1 << bits) + 1))


_BLOBS = "range int, shard long, keys binary, counts binary"
_ANSWERS = "shard long, level int, range int, frequent binary, totals binary"


def _blobs(shard: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pa.RecordBatch:
    edges = _edges(keys, bits)
    some = np.flatnonzero(np.diff(edges))
    spans = [(int(edges[r]), int(edges[r + 1])) for r in some]
    return pa.RecordBatch.from_arrays([
        pa.array(some, pa.int32()), pa.array([shard] * len(some), pa.int64()),
        pa.array([np.ascontiguousarray(keys[a:b]).tobytes() for a, b in spans], pa.binary()),
        pa.array([counts[a:b].astype(np.uint32).tobytes() for a, b in spans], pa.binary()),
    ], ["range", "shard", "keys", "counts"])


def _adder(level: int, min_count: int):
    def add_up(rows: pa.Table) -> pa.Table:
        return _add_up(rows, level, min_count)

    return add_up


def _add_up(rows: pa.Table, level: int, min_count: int) -> pa.Table:
    """Answers of one key range: which phrases of each shard are frequent; one shard of each gets its total too."""
    names = ["shard", "level", "range", "frequent", "totals"]
    raw = rows["keys"].to_pylist()
    size = np.array([len(x) // 16 for x in raw])
    keys = np.frombuffer(b"".join(raw), np.uint64).reshape(-1, 2)
    counts = np.frombuffer(b"".join(rows["counts"].to_pylist()), np.uint32)
    one, number = _distinct(keys)
    total = np.bincount(number, weights=counts, minlength=len(one)).astype(np.int64)
    kept = total >= min_count
    frequent, totals = kept[number], np.zeros(len(keys), np.int64)
    totals[one[kept]] = total[kept]
    out = []
    for shard, r, b, n in zip(rows["shard"].to_pylist(), rows["range"].to_pylist(), np.cumsum(size).tolist(), size.tolist()):
        mine = frequent[b - n:b]
        if mine.any():
            out.append((shard, level, r, np.packbits(mine).tobytes(), totals[b - n:b][mine].tobytes()))
    columns = list(zip(*out)) or [[]] * len(names)
    types = [pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)


def _answered(answers: list[dict], level: int, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frequent or not, total where this shard speaks for the phrase) of a level's phrases, in key order."""
    frequent, totals = np.zeros(int(edges[-1]), bool), np.zeros(int(edges[-1]), np.int64)
    for a in answers:
        if a["level"] == level:
            lo, hi = int(edges[a["range"]]), int(edges[a["range"] + 1])
            frequent[lo:hi] = np.unpackbits(np.frombuffer(a["frequent"], np.uint8), count=hi - lo)
            totals[lo:hi][frequent[lo:hi]] = np.frombuffer(a["totals"], np.int64)
    return frequent, totals


def _first_level(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for shard, keys, counts in zip(*(c.to_pylist() for c in batch.columns)):
            yield _blobs(shard, np.frombuffer(keys, np.uint64).reshape(-1, 2), np.frombuffer(counts, np.uint32), bits)


def _levels(row: dict, depth: int, bits: int) -> Iterator[tuple[int, Index, np.ndarray, Phrases, np.ndarray | None]]:
    """(words, index, vocabulary numbers, phrases, totals) of each level of a shard; no totals where none are answered yet."""
    vocab = np.frombuffer(row["vocab_keys"], np.uint64).reshape(-1, 2)
    frequent, totals = _answered(row["answers"], 1, _edges(vocab, bits))
    number = np.flatnonzero(frequent)
    local = np.zeros(len(vocab) + 1, np.int32)
    local[number + 1] = np.arange(1, len(number) + 1)
    words = np.r_[local[np.frombuffer(row["words"], np.uint32)], np.int32(0)]
    words = words[np.r_[True, (words[1:] != 0) | (words[:-1] != 0)]]
    index = Index(words, depth)
    phrases, totals = index.single(vocab[number]), totals[number]
    for level in range(1, depth + 1):
        yield level, index, number, phrases, totals
        if level == depth or totals is None:
            return
        phrases = index.longer(phrases)
        if any(a["level"] > level for a in row["answers"]):
            frequent, totals = _answered(row["answers"], level + 1, _edges(phrases.keys, bits))
            phrases, totals = phrases.keep(frequent), totals[frequent]
        else:
            totals = None


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: batch.column(n)[i].as_py() for n in batch.schema.names}


def _next_level(batches: Iterator[pa.RecordBatch], depth: int, bits: int) -> Iterator[pa.RecordBatch]:
    """Keys and counts of the first level that has no answers yet."""
    for row in _rows(batches):
        *_, (_, _, _, phrases, totals) = _levels(row, depth, bits)
        if totals is None and len(phrases.count):
            yield _blobs(row["shard"], phrases.keys, phrases.count, bits)


def _spell(batches: Iterator[pa.RecordBatch], depth: int, bits: int) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, words, a) of the frequent phrases this shard speaks for."""
    for row in _rows(batches):
        text, langs = row["vocab_text"], row["langs"]
        lang_of = np.frombuffer(row["vocab_langs"], np.uint32)
        for level, index, number, phrases, totals in _levels(row, depth, bits):
            mine = np.flatnonzero(totals) if totals is not None else []
            if not len(mine):
                continue
            spelled = number[index.phrase(phrases.lo[mine], level) - 1]
            yield pa.RecordBatch.from_arrays([
                pa.array([langs[i] for i in lang_of[spelled[:, 0]]], pa.string()),
                pa.array([b" ".join([text[i] for i in w]) for w in spelled.tolist()], pa.binary()).cast(pa.string()),
                pa.array([level] * len(mine), pa.int32()), pa.array(totals[mine], pa.int64()),
            ], ["lang", "phrase", "words", "a"])


# ---------------------------------------------------------------- Spark

def _bucketed(df: DataFrame, by: str, buckets: int) -> tuple[DataFrame, str]:
    """``df`` staged in the shared scratch folder as a table bucketed by one column, and the table's name."""
    spark, name = df.sparkSession, f"tidemark_{uuid.uuid4().hex}"
    df.write.option("path", scratch_folder(spark, "collocations")).option("compression", "zstd") \
        .bucketBy(buckets, by).saveAsTable(name)
    return spark.table(name), name


def frequent_phrases(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT,
                     text: str = "text", lang: str = "lang") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, words, a) of all phrases of up to ``max_words`` words that occur ``min_count`` times; (lang, n)).

    ``a`` counts all contiguous occurrences within pieces, overlaps included,
    ``n`` all words of a language. A null text is empty, a null language is
    ``und``; other columns are ignored; repeated rows count as often as they
    come; an empty table gives empty tables. A text is cut at ends of pieces,
    so memory grows with a shard or with the longest piece, not the text.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    rows = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANG)).alias("lang"), text_or_empty(text).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text") + 1), F.lit(0)).alias("bytes")).first()["bytes"]
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = max(0, (-(-size // RANGE_BYTES) - 1).bit_length())
    schema = spark.createDataFrame([], SHARD_SCHEMA).toArrow().schema
    shards, name = _bucketed(rows.mapInArrow(lambda it: _shards(it, schema), SHARD_SCHEMA),
                             "shard", max(least, -(-size // SHARD_BYTES)))
    langs = staged(shards.select(F.explode(F.arrays_zip("langs", "lang_words")).alias("x"))
                   .groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.lang_words").alias("n")), "collocations")
    answers = spark.createDataFrame([], _ANSWERS)

    def with_answers(*columns: str) -> DataFrame:
        by_shard = answers.groupBy("shard").agg(F.collect_list(F.struct("level", "range", "frequent", "totals")).alias("answers"))
        return shards.select("shard", *columns).join(by_shard.hint("shuffle_hash"), "shard")

    for level in range(1, max_words + 1):
        if level == 1:
            sent = shards.select("shard", "vocab_keys", "vocab_counts").mapInArrow(partial(_first_level, bits=bits), _BLOBS)
        else:
            sent = with_answers("words", "vocab_keys").mapInArrow(partial(_next_level, depth=max_words, bits=bits), _BLOBS)
        answers = answers.union(staged(sent.groupBy("range").applyInArrow(_adder(level, min_count), _ANSWERS), "collocations"))
    found = staged(with_answers("words", "vocab_keys", "vocab_langs", "vocab_text", "langs").mapInArrow(
        partial(_spell, depth=max_words, bits=bits), "lang string, phrase string, words int, a long"), "collocations")
    spark.sql(f"DROP TABLE {name}")
    return found, langs


def _exact(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(28,0)")


def _sub_phrase(start: Column | int, size: Column) -> Column:
    return F.array_join(F.slice("w", start, size), " ")


def collocations(docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
                 absorbed_percent: int = ABSORBED_PERCENT, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` phrases of each language by cohesion.

    A phrase of two or more words scores by its weakest cut: its count against
    the sum of the counts of the two parts, as a whole number of
    1/``SCORE_SCALE``. Phrases that mostly occur within one longer phrase go.
    Input rules are those of :func:`frequent_phrases`; ties go to the larger
    count, then to the smaller phrase by bytes. Products are decimals.
    """
    grams, langs = frequent_phrases(docs, max_words, min_count, text, lang)
    many = grams.where("words > 1").withColumn("w", F.split("phrase", " "))
    cuts = many.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut")) \
        .select("lang", "phrase", "a", "cut", _sub_phrase(1, F.col("cut")).alias("head"),
                _sub_phrase(F.col("cut") + 1, F.col("words") - F.col("cut")).alias("rest"))
    heads = grams.select("lang", F.col("phrase").alias("head"), F.col("a").alias("l"))
    rests = grams.select("lang", F.col("phrase").alias("rest"), F.col("a").alias("r"))
    score = F.expr(f"CAST(a AS DECIMAL(20,0)) * {SCORE_SCALE} DIV (CAST(l AS DECIMAL(20,0)) + r)")
    weakest = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", score) \
        .groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("x")) \
        .select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    inside = many.where("words > 2").select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")) \
        .select("lang", "a", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at")) \
        .groupBy("lang", _sub_phrase(F.col("at"), F.col("size")).alias("phrase")).agg(F.max("a").alias("around"))
    absorbed = F.coalesce(_exact("around") * 100 >= _exact("a") * absorbed_percent, F.lit(False))
    kept = weakest.join(inside, ["lang", "phrase"], "left").where(~absorbed)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # first within parts, so that no task orders all phrases of a language
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    best = kept.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(langs, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS doc,
    unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
split AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, sum(len(w)) AS n FROM split GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM split),
spans AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM starts),
grams AS (
  SELECT lang, k, list_slice(w, i, i + k - 1) AS g, array_to_string(list_slice(w, i, i + k - 1), ' ') AS phrase, count(*) AS a
  FROM spans GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, k, g, phrase, a, unnest(range(1, k)) AS cut FROM grams WHERE k > 1),
scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, h.a AS l, t.a AS r, c.cut, (2000000::HUGEINT * c.a) // (h.a + t.a) AS score
  FROM cuts c JOIN grams h ON h.lang = c.lang AND h.phrase = array_to_string(list_slice(c.g, 1, c.cut), ' ')
  JOIN grams t ON t.lang = c.lang AND t.phrase = array_to_string(list_slice(c.g, c.cut + 1, c.k), ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
sizes_in AS (SELECT lang, k, g, a, unnest(range(2, k)) AS m FROM grams WHERE k > 2),
places_in AS (SELECT lang, k, g, a, m, unnest(range(1, k - m + 2)) AS i FROM sizes_in),
inside AS (SELECT lang, array_to_string(list_slice(g, i, i + m - 1), ' ') AS phrase, max(a) AS around FROM places_in GROUP BY ALL),
kept AS (
  SELECT w.* FROM weakest w LEFT JOIN inside s ON s.lang = w.lang AND s.phrase = w.phrase
  WHERE s.around IS NULL OR 100::HUGEINT * s.around < 80::HUGEINT * w.a),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM kept QUALIFY rank <= 2000)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, s.n::BIGINT AS n, r.score::BIGINT AS score
FROM ranked r JOIN sizes s ON s.lang = r.lang
"""

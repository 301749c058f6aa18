"""Language-model scores of texts: an attention model over subwords joined with corpus word counts.

A text is lower-cased (A-Z) and split into words, then one end. The attention
model of :mod:`tidemark.llm.attention` reads subword ids of a fixed tokenizer
and gives every word a probability: its subwords', and that the next word (or
the end) begins after them. It also gives the class of the word's first
subword, and within a class words are as frequent as in the training corpus.
The score mixes the two, so it adds up to a probability of the whole text:

    p(word) = COUNT_WEIGHT * p(class) * c(word) / c(class) + (1 - COUNT_WEIGHT) * p(subwords)

Everything is learned from all training texts. One pass gathers word counts, the
counts and company of subwords, which give the classes, and the subword ids of
every text. The weights start from a fit on a bounded sample; then every task
goes on through all of its texts, and the mean over the tasks is the model.
c(class) is the exact sum over all words of the class.
The most frequent words, at most ``HEAD_WORDS``, are broadcast (a fixed bound);
every other occurrence meets its count in a shuffled join, with nothing left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import attention, hashing
from tidemark.llm.sentencepiece import MARK, Codec, default_model
from tidemark.llm.tables import hash_sample, ready_workers, staged, table
from tidemark.llm.toxicity import remainder

#: Training documents, by hashed id, and steps that give the weights from which all texts are learned.
SAMPLE_DOCS, STEPS = 1200, 2000
#: Learning rate of the pass over all training texts.
RATE = 0.003
HEAD_WORDS = 1 << 17
COUNT_WEIGHT = 0.6
#: Key of the end of a text among the word hashes.
END = np.uint64(0x2545F4914F6CDD1D)
_CHUNK = 1 << 19
_LOG10 = float(np.log(10.0))


def _chunks(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(first, texts lower-cased in ASCII) of ranges of texts of bounded size, one text at least."""
    held: list[bytes] = []
    size = lo = 0
    for i, t in enumerate(texts):
        raw = (t or "").encode("utf-8", "surrogatepass").lower()
        if held and size + len(raw) > _CHUNK:
            yield lo, held
            held, size, lo = [], 0, i
        held.append(raw)
        size += len(raw)
    if held:
        yield lo, held


def _words(texts: list[str | None]) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, word hash, start, end, text of the word) by chunk."""
    for lo, part in _chunks(texts):
        raw = b"\n".join(part)
        h, start, end = hashing.words(np.frombuffer(raw, np.uint8))
        ends = np.cumsum([len(t) + 1 for t in part])
        yield lo, lo + len(part), raw, h, start, end, np.searchsorted(ends, start, side="right")


def _longer(x: np.ndarray, size: int) -> np.ndarray:
    """``x`` with room for ``size`` values at least; room doubles, so that adding stays cheap."""
    return x if len(x) >= size else np.r_[x, np.zeros(max(size, 2 * len(x)) - len(x), x.dtype)]


class Subwords:
    """Subword ids of words. Words met have places, found by word hash; :meth:`forget` when there are over ``cached``."""

    def __init__(self, path: str, cached: int = 1 << 19):
        self.codec = Codec(path, check=False, cached_chunks=1)
        self.is_start = np.array([p.startswith(MARK) for p, _, _ in self.codec.model.pieces])
        self.size = len(self.is_start)
        self.narrow = np.uint16 if self.size <= 1 << 16 else np.int32
        self.cached = cached
        self.forget()

    def forget(self) -> None:
        self.n = self.ids = 0
        self.keys, self.first = np.zeros(1 << 10, np.uint64), np.zeros(1 << 10, np.int64)  # ids of a place end where the next one's begin
        self.flat = np.zeros(1 << 12, self.narrow)
        self._make_slots(12)

    @property
    def full(self) -> bool:
        return self.n > self.cached

    def _make_slots(self, bits: int) -> None:
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.slots = np.full(1 << bits, -1, np.int32)
        self._put(0, self.n)

    def _put(self, lo: int, hi: int) -> None:
        """Places from ``lo`` to ``hi`` each into the first free slot from the one of its hash on."""
        todo = np.arange(lo, hi, dtype=np.int32)
        slot = (self.keys[lo:hi] >> self.shift).astype(np.int64)
        while len(todo):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = todo[free]
            left = self.slots[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & self.last

    def _find(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys >> self.shift).astype(np.int64)
        at = self.slots[slot]
        todo = np.flatnonzero((at >= 0) & (self.keys[at] != keys))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & self.last
            place = self.slots[slot[todo]]
            at[todo] = place
            todo = todo[(place >= 0) & (self.keys[place] != keys[todo])]
        return at

    def of(self, keys: np.ndarray, raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Places of words given by hash and place in ``raw``; new ones are encoded."""
        at = self._find(keys)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new, where = np.unique(keys[missing], return_index=True)
            where = missing[where]
            ids = self.codec.encode_raw([raw[a:b] for a, b in zip(start[where].tolist(), end[where].tolist())])
            length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            lo, hi, ends = self.n, self.n + len(new), self.ids + int(length.sum())
            self.keys, self.first, self.flat = (_longer(x, size) for x, size in ((self.keys, hi), (self.first, hi + 1), (self.flat, ends)))
            self.keys[lo:hi], self.first[lo + 1:hi + 1] = new, self.ids + np.cumsum(length)
            self.flat[self.ids:ends] = np.frombuffer(b"".join(ids), np.int32)
            self.n, self.ids = hi, ends
            if 2 * hi > len(self.slots):
                self._make_slots(int(4 * hi).bit_length())
            else:
                self._put(lo, hi)
            at[missing] = self._find(keys[missing])
        return at

    def ids_of(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, number of ids of each) of words by place."""
        first = self.first[at]
        n = self.first[at + 1] - first
        return self.flat[np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].astype(np.int64), n


@lru_cache(maxsize=1)
def _subwords(path: str) -> Subwords:
    """The subwords a Python worker keeps from one task to the next."""
    return Subwords(path)


def _streams(texts: list[str | None], sub: Subwords) -> Iterator[tuple[np.ndarray, ...]]:
    """(places of words, ids of the texts end to end, ids of each text) by chunk."""
    for lo, hi, raw, h, start, end, doc in _words(texts):
        at = sub.of(h, raw, start, end)
        ids, n = sub.ids_of(at)
        yield at, ids, np.bincount(doc, weights=n, minlength=hi - lo).astype(np.int64)


_PARTS = "kind int, key long, n long, first int, data binary, sizes binary"
#: Kinds of rows: a word with its count and first id; an id with its count and company; ids of texts.
_WORD, _NEAR, _IDS = range(3)
#: Ids a row of texts holds, about; batches of rows go to Python workers, so rows are small.
_IDS_A_ROW = 1 << 15


def _part(kind: int, key: list | np.ndarray, n: list | np.ndarray, first: np.ndarray | None = None,
          data: list[bytes] | None = None, sizes: list[bytes] | None = None) -> pa.RecordBatch:
    rows = len(key)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(rows, kind, np.int32)), pa.array(key, pa.int64()), pa.array(n, pa.int64()),
        pa.nulls(rows, pa.int32()) if first is None else pa.array(first, pa.int32()),
        *(pa.nulls(rows, pa.binary()) if x is None else pa.array(x, pa.binary()) for x in (data, sizes)),
    ], ["kind", "key", "n", "first", "data", "sizes"])


def _statistics_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """Rows of ``_PARTS``; words are counted by place until those known are forgotten, the company over the task."""
    sub = _subwords(path)
    met = attention.Company(sub.size)
    count = np.zeros(sub.n, np.int64)
    ends = 0

    def summed() -> Iterator[pa.RecordBatch]:
        yield _part(_WORD, END.view(np.int64)[None], [ends], np.array([sub.size], np.int32))
        met = np.flatnonzero(count)
        for lo in range(0, len(met), 1 << 16):
            own = met[lo:lo + (1 << 16)]
            yield _part(_WORD, sub.keys[own].view(np.int64), count[own], sub.flat[sub.first[own]].astype(np.int32))

    for batch in batches:
        texts = batch.column(0).to_pylist()
        ends += len(texts)
        for at, ids, size in _streams(texts, sub):
            met.add(ids, size)
            count = _longer(count, sub.n)
            np.add.at(count, at, 1)
            ends_at = np.r_[0, np.cumsum(size)]
            for own in np.array_split(np.arange(len(size)), min(len(size), 1 + len(ids) // _IDS_A_ROW)):
                a, b = own[0], own[-1] + 1
                yield _part(_IDS, [0], [b - a], None, [ids[ends_at[a]:ends_at[b]].astype(sub.narrow).tobytes()], [size[a:b].tobytes()])
            if sub.full:
                yield from summed()
                sub.forget()
                count, ends = np.zeros(0, np.int64), 0
    if ends or count.any():
        yield from summed()
    seen = np.flatnonzero(met.count)
    near = met.near.reshape(-1, attention.NEAR)
    for lo in range(0, len(seen), 4096):
        own = seen[lo:lo + 4096]
        yield _part(_NEAR, own, met.count[own], None, [near[i].tobytes() for i in own])


def text_statistics(docs: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Word counts, company of subwords and subword ids of all texts: rows of ``_PARTS``, by task."""
    ready_workers(docs.sparkSession)
    return docs.select(text).mapInArrow(lambda it: _statistics_batches(it, path), _PARTS)


def word_counts(parts: DataFrame) -> DataFrame:
    """(key, n, first): occurrences of every word of all texts by 64-bit hash, and of the end of texts.

    ``first`` is the word's first subword id, that of the end the number of ids.
    """
    return parts.where(F.col("kind") == _WORD).groupBy("key").agg(F.sum("n").alias("n"), F.max("first").alias("first"))


def _sum_company(group: pa.Table) -> pa.Table:
    key, at = np.unique(group["key"].to_numpy(), return_inverse=True)
    n, near = np.zeros(len(key), np.int64), np.zeros((len(key), attention.NEAR), np.int64)
    np.add.at(n, at, group["n"].to_numpy())
    for i, data in zip(at.tolist(), group["data"].to_pylist()):
        near[i] += np.frombuffer(data, np.int32)
    return pa.table({"key": key, "n": n, "data": pa.array([x.astype(np.float32).tobytes() for x in near], pa.binary())})


def train_vocabulary(parts: DataFrame, path: str) -> attention.Vocabulary:
    """Classes and shares of subwords from the counts and the company of all texts."""
    sub = _subwords(path)
    summed = parts.where(F.col("kind") == _NEAR).select("key", "n", "data").groupBy(F.pmod("key", F.lit(256))) \
        .applyInArrow(_sum_company, "key long, n long, data binary").toArrow().sort_by("key")
    count, near = np.zeros(sub.size, np.int64), np.zeros((sub.size, attention.NEAR), np.float32)
    key = summed["key"].to_numpy()
    count[key] = summed["n"].to_numpy()
    if len(key):
        near[key] = np.frombuffer(b"".join(summed["data"].to_pylist()), np.float32).reshape(-1, attention.NEAR)
    texts = parts.where((F.col("kind") == _WORD) & (F.col("key") == int(END.view(np.int64)))).agg(F.sum("n")).first()[0]
    return attention.vocabulary(count, near, int(texts or 0), sub.is_start)


#: Pieces that weights travel in.
_PIECES = 32


def _learn_batches(batches: Iterator[pa.RecordBatch], start: attention.Weights, v: attention.Vocabulary,
                   path: str) -> Iterator[pa.RecordBatch]:
    """The weights after all texts of the task, in pieces, and the number of tokens they were fitted on."""
    learner = attention.Learner(start, v)
    narrow, tokens = _subwords(path).narrow, 0
    for batch in batches:
        for ids, size in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            ids, size = np.frombuffer(ids, narrow).astype(np.int64), np.frombuffer(size, np.int64)
            learner.learn(ids, size, RATE)
            tokens += len(ids) + len(size)
    learner.end(RATE)
    if tokens:
        flat = np.concatenate([w.ravel() for w in learner.weights().all()])
        yield pa.RecordBatch.from_arrays([
            pa.array(np.arange(_PIECES, dtype=np.int32)), pa.array(np.full(_PIECES, TaskContext.get().partitionId(), np.int32)),
            pa.array(np.full(_PIECES, tokens, np.int64)),
            pa.array([x.tobytes() for x in np.array_split(flat, _PIECES)], pa.binary())], ["piece", "task", "n", "data"])


def _mean_piece(group: pa.Table) -> pa.Table:
    group = group.sort_by("task")
    n = group["n"].to_numpy().astype(float)
    total = 0.0
    for weight, data in zip(n / n.sum(), group["data"].to_pylist()):
        total = total + weight * np.frombuffer(data, np.float32).astype(float)
    return pa.table({"piece": group["piece"][:1], "data": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def learn_texts(parts: DataFrame, start: attention.Weights, v: attention.Vocabulary, path: str) -> attention.Weights:
    """Weights fitted on all texts: every task goes on from ``start`` through all of its own, and their mean by tokens is taken.

    Tasks follow the partitions, so that the weights depend on them a little.
    """
    shared = parts.sparkSession.sparkContext.broadcast((start, v))
    fitted = parts.where(F.col("kind") == _IDS).select("data", "sizes") \
        .mapInArrow(lambda it: _learn_batches(it, *shared.value, path), "piece int, task int, n long, data binary")
    pieces = fitted.groupBy("piece").applyInArrow(_mean_piece, "piece int, data binary").toArrow().sort_by("piece")
    if not pieces.num_rows:
        return start
    flat = np.frombuffer(b"".join(pieces["data"].to_pylist()), np.float32)
    ends = np.cumsum([w.size for w in start.all()])[:-1]
    return attention.Weights(*(x.reshape(w.shape).copy() for x, w in zip(np.split(flat, ends), start.all())))


class Scorer:
    """Everything a task needs: the attention model, the head words' counts, class totals."""

    def __init__(self, model: attention.Model, path: str, head: hashing.HashTable, class_total: np.ndarray, denominator: float):
        self.model, self.path, self.head = model, path, head
        self.class_log = np.log(np.maximum(class_total, 1.0))
        self.denominator = denominator
        self.subwords: Subwords | None = None

    def __getstate__(self):
        return {**self.__dict__, "subwords": None}

    def words(self, texts: list[str | None]) -> Iterator[tuple[np.ndarray, ...]]:
        """(text, word hash, log p(subwords), log p(class) / c(class)) of all words and ends, by chunk."""
        if self.subwords is None:
            self.subwords = _subwords(self.path)
        v = self.model.v
        for lo, hi, raw, h, start, end, doc in _words(texts):
            at = self.subwords.of(h, raw, start, end)
            ids, n = self.subwords.ids_of(at)
            begin = np.cumsum(n) - n
            per_text = np.bincount(doc, weights=n, minlength=hi - lo).astype(np.int64)
            token, start_log = self.model.token_logs(ids, per_text)
            # place of every word's and end's first token; texts are longer by their ends
            words_of = np.bincount(doc, minlength=hi - lo)
            place = np.empty(len(h) + hi - lo, np.int64)
            is_end = np.zeros(len(place), bool)
            is_end[np.cumsum(words_of + 1) - 1] = True
            place[~is_end] = begin + doc
            place[is_end] = np.cumsum(per_text + 1) - 1
            whole = (token + start_log).astype(np.float64)
            whole[place] = token[place]
            per = np.add.reduceat(whole, place)
            follow = np.flatnonzero(~is_end)
            per[follow] += start_log[place[follow + 1]]
            first_id = np.full(len(place), v.end)
            first_id[~is_end] = ids[begin]
            by_class = token[place].astype(np.float64) - v.share[first_id] - self.class_log[v.cls[first_id]]
            text = np.empty(len(place), np.int64)
            text[~is_end], text[is_end] = doc, np.arange(hi - lo)
            key = np.full(len(place), END)
            key[~is_end] = h
            yield lo + text, key, per, by_class
            if self.subwords.full:
                self.subwords.forget()


def _mix(per: np.ndarray, by_class: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Common logarithm of the mixture; words without a count have the subwords' part alone."""
    b = per + np.log(1 - COUNT_WEIGHT)
    a = np.where(count > 0, by_class + np.log(np.maximum(count, 1) * COUNT_WEIGHT), -np.inf)
    return np.logaddexp(a, b) / _LOG10


_ROWS = "key long, row long, doc_id long, n long, known long, x double, y double"


def _score_batches(batches: Iterator[pa.RecordBatch], scorer: Scorer) -> Iterator[pa.RecordBatch]:
    """Sums over the ends and head words of every text (n > 0), and a row for each other word (n = 0)."""
    for batch in batches:
        row = batch.column(0).to_numpy(zero_copy_only=False)
        ids, texts = batch.column(1), batch.column(2).to_pylist()
        for text, key, per, by_class in scorer.words(texts):
            count = scorer.head.get(key, 0)
            head = count > 0
            lo, hi = int(text[0]), int(text[-1]) + 1
            at = text[head] - lo
            base = np.log10((count[head] + 1) / scorer.denominator)
            sums = [np.bincount(at, weights=x, minlength=hi - lo) for x in (base, _mix(per[head], by_class[head], count[head]))]
            tail = ~head
            n_tail = int(tail.sum())
            zero = np.zeros(n_tail, np.int64)
            own = row[lo:hi]
            spread = hashing.mix(own.view(np.uint64))  # sums travel to tasks spread by row
            yield pa.RecordBatch.from_arrays([
                pa.array(np.r_[spread.view(np.int64), key[tail].view(np.int64)]),
                pa.array(np.r_[own, row[text[tail]]]),
                pa.concat_arrays([ids.slice(lo, hi - lo), pa.nulls(n_tail, pa.int64())]),
                pa.array(np.r_[np.bincount(text - lo, minlength=hi - lo), zero]),
                pa.array(np.r_[np.bincount(at, minlength=hi - lo), zero]),
                pa.array(np.r_[sums[0], per[tail].astype(np.float32)]),
                pa.array(np.r_[sums[1], by_class[tail].astype(np.float32)]),
            ], ["key", "row", "doc_id", "n", "known", "x", "y"])


def first_weights(sample: list[str | None], v: attention.Vocabulary, path: str, steps: int = STEPS) -> attention.Weights:
    """Weights to start from, fitted on a bounded sample of texts."""
    streams = [x for *_, ids, size in _streams(sample, _subwords(path)) for x in np.split(ids, np.cumsum(size)[:-1])]
    return attention.train(streams, v, steps)


def _class_totals(counts: DataFrame, v: attention.Vocabulary) -> np.ndarray:
    """Training occurrences of each class, over all words; the ends are a class of their own."""
    out = np.zeros(v.classes)
    for r in counts.groupBy("first").agg(F.sum("n").alias("n")).collect():  # one row for each subword at most
        out[v.cls[r["first"]]] += r["n"]
    return out


def most_frequent(counts: DataFrame, most: int) -> DataFrame:
    """The words from a count upwards that are ``most`` at the most: whole steps of a logarithmic histogram."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 16)
    sizes = counts.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect()
    taken, lowest = 0, None
    for r in sizes:
        taken += r["count"]
        if taken > most:
            break
        lowest = r["step"]
    return counts.where(step >= lowest) if lowest is not None else counts.limit(0)


def score_texts(docs: DataFrame, train: DataFrame, path: str | None = None, sample_docs: int = SAMPLE_DOCS,
                steps: int = STEPS, head_words: int = HEAD_WORDS) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``.

    ``train`` (doc_id, text) are the texts learned from. ``base_score`` is the
    add-one unigram model's common logarithm over all tokens, ``score`` that of
    the mixture above. ``sample_docs`` and ``steps`` bound the fit the weights
    start from, not what is learned. A null text is empty: its only token is the end. Every
    row comes back once, repeated rows too; other columns are ignored. With
    no training texts no word is known and the attention model is untrained.
    """
    spark = docs.sparkSession
    ready_workers(spark)
    path = path or default_model()
    sample = [r["text"] for r in hash_sample(train, "doc_id", sample_docs).orderBy("doc_id", "text").select("text").collect()]
    parts = staged(text_statistics(train, path), "lm-texts")
    counts = staged(word_counts(parts), "lm-counts")
    v = train_vocabulary(parts, path)
    model = attention.Model(v, learn_texts(parts, first_weights(sample, v, path, steps), v, path))
    size = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, kinds = int(size["n"]), int(size["v"])
    totals = _class_totals(counts, v)
    top = most_frequent(counts, head_words).select("key", "n").toPandas()
    denominator = float(total + kinds + 1)
    head = hashing.HashTable(top["key"].to_numpy(np.int64).view(np.uint64), top["n"].to_numpy(np.int64))
    shared = spark.sparkContext.broadcast(Scorer(model, path, head, totals, denominator))
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = rows.mapInArrow(lambda it: _score_batches(it, shared.value), _ROWS)
    c = F.coalesce(F.col("c"), F.lit(0)).cast("double")
    by_count = F.col("y") + F.log(F.greatest(c, F.lit(1.0)) * COUNT_WEIGHT)
    by_subwords = F.col("x") + float(np.log(1 - COUNT_WEIGHT))
    mixed = F.when(c > 0, F.greatest(by_count, by_subwords) + F.log1p(F.exp(-F.abs(by_count - by_subwords)))).otherwise(by_subwords)
    is_sum = F.col("n") > 0
    met = scored.join(counts.select("key", F.col("n").alias("c")), "key", "left").select(
        "row", "doc_id", "n", F.when(is_sum, F.col("known")).otherwise((c > 0).cast("long")).alias("known"),
        F.when(is_sum, F.col("x")).otherwise(F.log10((c + 1) / denominator)).alias("base"),
        F.when(is_sum, F.col("y")).otherwise(mixed / _LOG10).alias("score"))
    return met.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.sum("n").alias("n_tokens"), F.sum("known").alias("n_known"),
        F.sum("base").alias("base_score"), F.sum("score").alias("score"),
    ).select("doc_id", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 7) == 2
    scored = score_texts(docs, docs.where(~held_out))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")

"""SentencePiece encoding and decoding on the ``tokenizers`` library.

The model file's protobuf is read here: pieces with scores and types, the
model kind, byte fallback and the normaliser's settings. From these the same
tokenizer is rebuilt (unigram scores, or merges ordered by score for BPE
models), with a metaspace marker for spaces and byte fallback. Encoding
splits a text at marker runs, which no piece crosses, so each worker encodes a
chunk of text once and keeps its ids; new chunks are encoded in multithreaded
batches and compared with the original library as they come.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import ready_workers, table

MARK = "▁"
_MARK_BYTES = MARK.encode()
# fixed values of the model format: piece types, model kinds
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


# ---------------------------------------------------------------- protobuf

def _varint(raw: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        b = raw[at]
        value |= (b & 127) << shift
        at, shift = at + 1, shift + 7
        if b < 128:
            return value, at


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields."""
    at = 0
    while at < len(raw):
        key, at = _varint(raw, at)
        kind = key & 7
        if kind == 0:
            value, at = _varint(raw, at)
        elif kind == 2:
            n, at = _varint(raw, at)
            value, at = raw[at:at + n], at + n
        elif kind in (1, 5):
            n = 8 if kind == 1 else 4
            value, at = raw[at:at + n], at + n
        else:
            raise ValueError(f"wire type {kind} in a model file")
        yield key >> 3, value


@dataclass
class Model:
    """What a model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    unknown: int = 0
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_extra_spaces: bool = True
    escape_spaces: bool = True


def read_model(path: str) -> Model:
    with open(path, "rb") as f:
        raw = f.read()
    m = Model()
    for number, value in _fields(raw):
        if number == 1:
            text, score, kind = "", 0.0, NORMAL
            for n, v in _fields(value):
                if n == 1:
                    text = v.decode("utf-8")
                elif n == 2:
                    score = struct.unpack("<f", v)[0]
                elif n == 3:
                    kind = v
            m.pieces.append((text, score, kind))
        elif number == 2:
            for n, v in _fields(value):
                if n == 3:
                    m.kind = v
                elif n == 35:
                    m.byte_fallback = bool(v)
                elif n == 40:
                    m.unknown = v
        elif number == 3:
            for n, v in _fields(value):
                if n == 2:
                    m.charsmap = v
                elif n == 3:
                    m.dummy_prefix = bool(v)
                elif n == 4:
                    m.remove_extra_spaces = bool(v)
                elif n == 5:
                    m.escape_spaces = bool(v)
    return m


# ---------------------------------------------------------------- tokenizer

def build_tokenizer(m: Model):
    """The ``tokenizers`` equivalent of a model."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers, pre_tokenizers

    unknown = m.pieces[m.unknown][0]
    if m.kind == UNIGRAM:
        core = models.Unigram([(p, s) for p, s, _ in m.pieces], unk_id=m.unknown, byte_fallback=m.byte_fallback)
    elif m.kind == BPE:
        vocab = {p: i for i, (p, _, _) in enumerate(m.pieces)}
        usable = {p for p, _, k in m.pieces if k in (NORMAL, USER_DEFINED)}
        merges = []
        for p, score, k in m.pieces:
            if k == NORMAL:
                halves = [(p[:i], p[i:]) for i in range(1, len(p)) if p[:i] in usable and p[i:] in usable]
                merges += [(-score, vocab[a], vocab[b], a, b) for a, b in halves]
        merges.sort()
        core = models.BPE(vocab, [(a, b) for *_, a, b in merges], unk_token=unknown, fuse_unk=True, byte_fallback=m.byte_fallback)
    else:
        raise ValueError(f"model kind {m.kind} is neither unigram nor BPE")
    out = Tokenizer(core)
    steps = [normalizers.Precompiled(m.charsmap)] if m.charsmap else []
    if m.remove_extra_spaces:
        steps += [normalizers.Replace(Regex(" {2,}"), " "), normalizers.Strip()]
    mark = MARK if m.escape_spaces else " "
    if m.dummy_prefix:
        steps.append(normalizers.Prepend(mark))
    if m.escape_spaces:
        steps.append(normalizers.Replace(" ", MARK))
    out.normalizer = normalizers.Sequence(steps)
    out.pre_tokenizer = pre_tokenizers.Split(Regex(f"{mark}+[^{mark}]*"), "isolated")
    after = [decoders.Replace(MARK, " ")] if m.escape_spaces else []
    after += [decoders.ByteFallback(), decoders.Fuse()] + ([decoders.Strip(" ", 1, 0)] if m.dummy_prefix else [])
    out.decoder = decoders.Sequence(after)
    return out


class ParityError(ValueError):
    """The rebuilt tokenizer and the original library disagree."""


class Codec:
    """Encodes and decodes with one model file, keeping the ids of chunks met before."""

    def __init__(self, path: str, check: bool = True, cached_chunks: int = 40_000):
        self.model = read_model(path)
        self._tokenizer = None
        self.original = None
        if check:
            import sentencepiece

            self.original = sentencepiece.SentencePieceProcessor(model_file=path)
        self.cached_chunks = cached_chunks
        self.known: dict[str, bytes] = {}
        # chunks can be encoded apart only if no piece holds a marker after another character
        m = self.model
        self.by_chunk = m.escape_spaces and m.dummy_prefix and not m.charsmap and not m.remove_extra_spaces and \
            not any(MARK in p.lstrip(MARK) for p, _, k in m.pieces if k != CONTROL)
        self.begins = np.array([p.startswith(MARK) for p, _, _ in m.pieces])
        self.lossy: set[str] = set()  # chunks that decoding does not give back
        self.words = build_tokenizer(m)
        if not self.by_chunk:
            self._tokenizer = self.words
        else:  # single markers need no pattern
            from tokenizers import pre_tokenizers

            self.words.pre_tokenizer = pre_tokenizers.Metaspace(replacement=MARK, prepend_scheme="never", split=True)

    @property
    def tokenizer(self):
        """The tokenizer of any text; built only when a text needs more than its chunks."""
        if self._tokenizer is None:
            self._tokenizer = build_tokenizer(self.model)
        return self._tokenizer

    def _direct(self, texts: list[str], tokenizer=None) -> list[bytes]:
        encoded = (tokenizer or self.tokenizer).encode_batch_fast(texts, add_special_tokens=False)
        got = [np.array(e.ids, np.int32) for e in encoded]
        if self.original is not None:
            for t, a, b in zip(texts, got, self.original.encode(texts, num_threads=1)):
                if a.tolist() != b:
                    raise ParityError(f"ids differ for {t!r}: {a.tolist()} and {b}")
        return [g.tobytes() for g in got]

    def encode_words(self, words: list[str], back: bool = False, together: int = 500) -> list[bytes]:
        """Ids (int32 bytes) of chunks without spaces, many to a call; each begins with its only marked piece.

        With ``back`` they are decoded again, and chunks that do not come back are noted as lossy.
        """
        out: list[bytes] = [b""] * len(words)
        plain = [i for i, w in enumerate(words) if self.by_chunk and w and MARK not in w]
        odd = sorted(set(range(len(words))) - set(plain))
        for i, ids in zip(odd, self._direct([words[i] for i in odd]) if odd else []):
            out[i] = ids
        joined = [" ".join(words[i] for i in plain[at:at + together]) for at in range(0, len(plain), together)]
        parts = self._direct(joined, self.words) if joined else []
        raw = b"".join(parts)
        first = (np.flatnonzero(self.begins[np.frombuffer(raw, np.int32)]) * 4).tolist()
        if len(first) != len(plain):
            raise ParityError("a chunk does not begin with one marked piece")
        for i, lo, hi in zip(plain, first, [*first[1:], len(raw)]):
            out[i] = raw[lo:hi]
        if back:
            again = self.decode([np.frombuffer(p, np.int32).tolist() for p in parts])
            doubtful = [i for k, (a, b) in enumerate(zip(joined, again)) if a != b for i in plain[k * together:(k + 1) * together]] + odd
            again = self.decode([np.frombuffer(out[i], np.int32).tolist() for i in doubtful])
            self.lossy.update(words[i] for i, b in zip(doubtful, again) if b != words[i])
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of every text; a null text has none."""
        return self.encode_back(texts)[0]

    def encode_raw(self, words: list[bytes], together: int = 500) -> list[bytes]:
        """:meth:`encode_words` of UTF-8 words, without a text object for each."""
        out: list[bytes] = []
        for at in range(0, len(words), together):
            part = words[at:at + together]
            joined = b" ".join(part)
            if not self.by_chunk or _MARK_BYTES in joined or b"" in part:
                out += self.encode_words([w.decode("utf-8", "surrogatepass") for w in part])
                continue
            raw = self._direct([joined.decode("utf-8", "surrogatepass")], self.words)[0]
            first = (np.flatnonzero(self.begins[np.frombuffer(raw, np.int32)]) * 4).tolist()
            if len(first) != len(part):
                raise ParityError("a chunk does not begin with one marked piece")
            out += [raw[lo:hi] for lo, hi in zip(first, [*first[1:], len(raw)])]
        return out

    def encode_back(self, texts: list[str | None]) -> tuple[list[np.ndarray], list[bool]]:
        """(ids, whether decoding gives the text back). Chunks decode apart, since each begins with a marked piece."""
        out: list[bytes] = [b""] * len(texts)
        same = [True] * len(texts)
        chunked, direct = [], []
        for i, t in enumerate(texts):
            if not t:
                continue
            odd = not self.by_chunk or "  " in t or MARK in t or t[0] == " " or t[-1] == " "
            (direct if odd else chunked).append(i)
        if direct:
            ids = self._direct([texts[i] for i in direct])
            back = self.decode([np.frombuffer(x, np.int32).tolist() for x in ids])
            for i, x, b in zip(direct, ids, back):
                out[i], same[i] = x, b == texts[i]
        words = {i: texts[i].split(" ") for i in chunked}
        used = set().union(*words.values())
        if len(self.known) + len(used) > self.cached_chunks:  # what is in use stays
            self.known = {w: self.known[w] for w in used if w in self.known}
            self.lossy &= used
        new = [w for w in used if w not in self.known]
        self.known.update(zip(new, self.encode_words(new, back=True)))
        for i in chunked:
            out[i] = b"".join(map(self.known.__getitem__, words[i]))
            same[i] = not self.lossy or self.lossy.isdisjoint(words[i])
        return [np.frombuffer(x, np.int32) for x in out], same

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.words.decode_batch(ids, skip_special_tokens=False)


@lru_cache(maxsize=2)
def _codec(path: str, check: bool, threads: int) -> Codec:
    os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
    os.environ["RAYON_NUM_THREADS"] = str(threads)
    return Codec(path, check)


def _texts_at_once(texts: list[str | None], most: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded total length (one text at least)."""
    lo = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > lo and size + n > most:
            yield lo, i
            lo, size = i, 0
        size += n
    if lo < len(texts):
        yield lo, len(texts)


def encode(docs: DataFrame, text: str = "text", path: str | None = None, check: bool = True, threads: int = 2) -> DataFrame:
    """``docs`` plus ``ids`` (array of int) and ``round_trip``.

    ``round_trip`` tells whether decoding the ids gives the text back (true for
    every text of a model without a normaliser, unless the text holds the
    marker itself). A null or empty text has no ids and true. Every chunk a
    worker has not met is checked against the original library when ``check``
    is set; a difference fails the job. Rows stay where they are (no shuffle)
    and input columns of the two names are replaced.
    """
    ready_workers(docs.sparkSession)
    path = path or default_model()
    kept = [c for c in docs.columns if c not in ("ids", "round_trip")]
    kind = "struct<ids:array<int>,round_trip:boolean>"

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        codec = _codec(path, check, threads)
        for texts in batches:
            values = texts.tolist()
            for lo, hi in _texts_at_once(values):  # small results, so that neither side holds many ids at once
                ids, ok = codec.encode_back(values[lo:hi])
                yield pd.DataFrame({"ids": ids, "round_trip": ok})

    return docs.select(*kept, run(F.col(text)).alias("__coded")).select(*kept, "__coded.ids", "__coded.round_trip")


def decode(docs: DataFrame, ids: str = "ids", path: str | None = None, threads: int = 2) -> DataFrame:
    """``docs`` plus ``decoded``: the text of an id array; null ids give null. Replaces such a column."""
    ready_workers(docs.sparkSession)
    path = path or default_model()

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        codec = _codec(path, False, threads)
        return pd.Series([None if r is None else codec.decode([list(map(int, r))])[0] for r in rows])

    return docs.withColumn("decoded", run(F.col(ids)))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")

"""Collocations against plain counting, and the index against plain scans."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS
from tidemark.llm import collocations
from tidemark.llm.collocations import Index

DOCS = DOC_SCHEMA


def _lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def brute(rows, min_count, top, max_words=4):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    some = {g: a for g, a in f.items() if a >= min_count}
    around = {}
    for (lang, w), a in some.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                part = (lang, w[i:i + k])
                around[part] = max(around.get(part, 0), a)
    out = {}
    for (lang, w), a in some.items():
        if len(w) < 2 or 100 * around.get((lang, w), 0) >= 80 * a:
            continue
        s, _, le, r = min((2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out.setdefault(lang, []).append((-s, -a, " ".join(w).encode(), le, r))
    return sorted((lang, i + 1, p.decode(), -a, le, r, n[lang], -s)
                  for lang, found in out.items() for i, (s, a, p, le, r) in enumerate(sorted(found)[:top]))


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _texts(seed, docs, words, length):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abé") for _ in range(rng.randint(1, 3))) for _ in range(words)]
    ends = [" ", "  ", " \t", ", ", ". ", "\n", "!? ", "  "]
    return [("".join(rng.choice(vocab).title() + rng.choices(ends, [20, 2, 1, 2, 2, 1, 1, 1])[0] for _ in range(rng.randint(0, length))),
             rng.choice(["en", "de", None, ""])) for _ in range(docs)]


@pytest.mark.parametrize("shard_bytes, range_bytes, parts", [(8 << 20, 16 << 20, 1), (600, 400, 5)])
def test_against_plain_counts(spark, monkeypatch, shard_bytes, range_bytes, parts):
    monkeypatch.setattr(collocations, "SHARD_BYTES", shard_bytes)
    monkeypatch.setattr(collocations, "RANGE_BYTES", range_bytes)
    rows = _texts(3, 60, 9, 80) + [(None, "en"), ("", None), (" \t", "en")] + [("Same old words here again", "en")] * 7
    df = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    for min_count, top in ((3, 2000), (5, 4)):
        assert _rows(collocations.collocations(df, min_count=min_count, top=top)) == brute(rows, min_count, top)


def test_shorter_phrases_only(spark):
    rows = _texts(5, 30, 6, 60)
    df = spark.createDataFrame(rows, "text string, lang string")
    assert _rows(collocations.collocations(df, max_words=3, min_count=4)) == brute(rows, 4, 2000, max_words=3)


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD_DOCS, DOCS).selectExpr("*", "'x' AS phrase", "1 AS a", "2 AS words", "3 AS shard")
    rows = [(r[1], r[2]) for r in ODD_DOCS]
    assert _rows(collocations.collocations(df, min_count=2)) == brute(rows, 2, 2000)
    assert _rows(collocations.collocations(df.where("false"))) == []
    assert _rows(collocations.collocations(df.where("text IS NULL OR trim(text) = ''"), min_count=1)) == []


def test_text_longer_than_buffers(spark):
    rng = random.Random(8)
    long = " ".join(rng.choice(["red", "green", "blue"]) + rng.choice(["", "", "", ","]) for _ in range(400_000))
    rows = [(long, "en"), ("red green", "en")]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert _rows(collocations.collocations(df, min_count=1000)) == brute(rows, 1000, 2000)


def test_index_intervals_are_counts():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 5, 400).astype(np.int32)
    words[0] = words[-1] = 0
    index = Index(words, 4)
    phrases = index.single(np.arange(1, 9, dtype=np.uint64).reshape(4, 2))
    for size in range(1, 5):
        plain = Counter(tuple(words[i:i + size].tolist()) for i in range(len(words) - size + 1) if words[i:i + size].all())
        spelled = [tuple(w) for w in index.phrase(phrases.lo, size).tolist()]
        assert dict(zip(spelled, phrases.count.tolist())) == plain and len(spelled) == len(plain)
        back = [tuple(words[::-1][index.backward.order[b] + np.arange(size)][::-1].tolist()) for b in phrases.back]
        assert back == spelled
        if size < 4:
            phrases = index.longer(phrases)


def test_equal_first_halves_of_keys_are_told_apart():
    keys = np.array([[5, 1], [5, 2], [5, 1], [3, 9]], np.uint64)
    first, number = collocations._distinct(keys)
    assert [tuple(k) for k in keys[first][number].tolist()] == [tuple(k) for k in keys.tolist()] and len(first) == 3


def test_counts_beyond_64_bits(spark, monkeypatch):
    big = 6 * 10 ** 14
    grams = spark.createDataFrame([("en", "a", 1, big), ("en", "b", 1, big + 1), ("en", "a b", 2, big - 1)], "lang string, phrase string, words int, a long")
    langs = spark.createDataFrame([("en", 3 * big)], "lang string, n long")
    monkeypatch.setattr(collocations, "frequent_phrases", lambda *a, **k: (grams, langs))
    row = collocations.collocations(grams).first()
    assert row["score"] == 2_000_000 * (big - 1) // (2 * big + 1) and row["n"] == 3 * big


def test_an_index_holds_twelve_bytes_a_word_and_direction():
    """Before: twenty, and shards of 8 MB."""
    words = np.r_[0, np.random.default_rng(1).integers(1, 50, 5000), 0].astype(np.int32)
    index = Index(words, 4)
    for d in (index.forward, index.backward):
        assert sum(x.nbytes for x in (d.order, d.before, d.step)) <= 12 * len(words)
    assert collocations.SHARD_BYTES <= 4 << 20 and collocations.RANGE_BYTES <= 8 << 20

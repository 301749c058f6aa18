"""One text of millions of characters beside short ones: every operator takes it whole."""

import hashlib
import random

import pytest

from tests.llm.brute import base_spans
from tests.llm.test_simhash import _fingerprint
from tidemark.llm import fingerprints, langid, lm, secrets, sentencepiece, simhash, substrings, toxicity


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(4)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    long = " ".join(rng.choice(words) for _ in range(120_000)) + " secret=0123456789abcdef01234567"
    rows = [(1, "short text here", "en", "src1", 15), (2, long, "en", "src1", len(long)), (3, long[-150_000:], "en", "src1", 150_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df, {r[0]: r[1] for r in rows}


def test_text_operators(docs):
    df, texts = docs
    found = secrets.scan_secrets(df, [0.0] * len(secrets.ALPHABET) ** 2, min_total=1.0).collect()
    assert all([(s["start"], s["kind"], s["end"]) for s in r["base_spans"]] == base_spans(r["text"]) for r in found)
    prints = fingerprints.fingerprint_edits(df).collect()
    assert {r["doc_id"]: r["n_chars"] for r in prints} == {d: len(t) for d, t in texts.items()}
    k = len(texts[2]) // 4
    edited = texts[2][: len(texts[2]) - k] + texts[3][:k]
    assert next(r for r in prints if r["doc_id"] == 2)["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
    codes = {r["doc_id"]: r["fp"] % 2 ** 64 for r in simhash.near_duplicates(df).collect()}
    assert codes == {d: _fingerprint(t) for d, t in texts.items()}


def test_models(docs, spark):
    df, texts = docs
    model = langid.train_text_model(df.where("doc_id = 1"), "text", "lang")
    found = {r["doc_id"]: r["n_trigrams"] for r in langid.identify_documents(df, model).collect()}
    assert found[2] == sum(c.isalpha() for c in texts[2])
    labels = spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int")
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(df, toxicity.train(df, labels)).collect())
    rows = {r["doc_id"]: r for r in lm.score_texts(df, df.where("doc_id <> 2"), sample_docs=1, steps=5).collect()}
    assert rows[2]["n_tokens"] == len(texts[2].split()) + 1
    ids = {r["doc_id"]: r for r in sentencepiece.encode(df).collect()}
    assert all(r["round_trip"] for r in ids.values()) and len(ids[2]["ids"]) > 120_000


def test_repeated_bytes(docs):
    df, texts = docs
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in substrings.repeated_spans(df).collect()}
    assert spans[3] == [(0, 150_000)] and spans[1] == [] and spans[2] == []

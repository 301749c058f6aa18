import math
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF
from tidemark.llm import attention, lm


def _words(t):
    return (t or "").encode("utf-8", "surrogatepass").lower().split()


def _base(train, texts):
    """{text: (n_tokens, n_known, N, base)} by a plain counter."""
    c = Counter()
    for t in train:
        c.update(_words(t))
    n, v = sum(c.values()) + len(train), len(c) + (len(train) > 0)
    out = {}
    for t in texts:
        counts = [c[w] for w in _words(t)] + [len(train)]
        out[t] = len(counts), sum(x > 0 for x in counts), n, sum(math.log10((x + 1) / (n + v + 1)) for x in counts)
    return out


def _check(rows, train, texts):
    want = _base(train, texts.values())
    for r in rows:
        a, b, n, base = want[texts[r["doc_id"]]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (a, b, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and math.isfinite(r["score"]) and r["score"] <= 0


def test_query(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = lm.op1_lm_scoring(spark, SF).collect()
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in docs}
    assert len(rows) == len(docs) and all(r["held_out"] == held[r["doc_id"]] for r in rows)
    _check(rows, [t for d, t in docs.items() if not held[d]], docs)


def test_held_out_texts_are_likelier_than_by_counts(spark):
    rows = [r for r in lm.op1_lm_scoring(spark, "/root/testdata/sf0.1").collect() if r["held_out"]]
    tokens, base, score = (sum(r[k] for r in rows) for k in ("n_tokens", "base_score", "score"))
    assert score / tokens > base / tokens + 0.1


def test_few_head_words_give_the_same_scores(spark):
    """Words beyond the broadcast ones meet their counts in the join."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 60")
    a, b = ({r["doc_id"]: r for r in lm.score_texts(docs, docs, sample_docs=20, steps=30, head_words=k).collect()} for k in (5, 1 << 17))
    for d, r in a.items():
        assert (r["n_tokens"], r["n_known"]) == (b[d]["n_tokens"], b[d]["n_known"])
        assert r["score"] == pytest.approx(b[d]["score"], rel=1e-5) and r["base_score"] == pytest.approx(b[d]["base_score"], rel=1e-9)


def test_class_totals_cover_all_words(spark, monkeypatch):
    """The words of every class add up to 1, also where the sample lacks most of them."""
    seen, made = [], lm.Scorer.__init__
    monkeypatch.setattr(lm.Scorer, "__init__", lambda self, *a: (seen.append(a), made(self, *a))[1])
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 80").select("doc_id", "text").unionByName(
        spark.createDataFrame([(900, "qzx zzqj \u4e2d\u6587 qzx"), (901, None), (902, "")], "doc_id long, text string"))
    lm.score_texts(docs, docs, sample_docs=4, steps=3)
    model, path, _, totals, _ = seen[0]
    texts = [r["text"] for r in docs.collect()]
    c = Counter(w for t in texts for w in _words(t))
    first = [np.frombuffer(i, np.int32)[0] for i in lm.Subwords(path).codec.encode_raw(list(c))]
    mass = np.bincount(model.v.cls[first], weights=list(c.values()), minlength=model.v.classes)
    mass[0] = len(texts)
    assert totals.tolist() == mass.tolist()


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA).selectExpr("*", "1 AS row", "2 AS n", "3 AS key")
    train = df.where("doc_id > 4")
    rows = lm.score_texts(df, train, sample_docs=5, steps=5).collect()
    assert len(rows) == len(ODD_DOCS)
    texts = {d[0]: d[1] for d in ODD_DOCS}
    _check(rows, [d[1] for d in ODD_DOCS if d[0] is not None and d[0] > 4], texts)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (None, 3, 4)} == {1}
    none = lm.score_texts(df, df.limit(0), sample_docs=5, steps=5).collect()
    assert len(none) == len(ODD_DOCS) and {r["n_known"] for r in none} == {0} and all(math.isfinite(r["score"]) for r in none)
    assert lm.score_texts(df.limit(0), train, sample_docs=5, steps=5).count() == 0


@pytest.fixture(scope="module")
def small():
    rng = np.random.default_rng(0)
    streams = [rng.integers(0, 50, int(n)) for n in (5, 40, 100, 1, 16, 15, 17, 0)]
    is_start = np.arange(50) % 2 == 0
    v = attention.build_vocabulary(streams, is_start)
    return streams, v, attention.train(streams, v, steps=20)


def test_blocks_equal_plain_causal_attention(small):
    """Every token once, from its own block up to itself and the whole block before."""
    streams, v, w = small
    m = attention.Model(v, w)
    token, begin = m.token_logs(np.concatenate(streams), np.array([len(s) for s in streams]))
    assert len(token) == sum(len(s) + 1 for s in streams)
    at = 0
    for s in streams:
        target = np.r_[s, v.end]
        given = v.row[np.r_[v.end, s]]
        for t, x in enumerate(target):
            lo = (t // attention.BLOCK - 1) * attention.BLOCK
            rows = np.array([given[j] if j >= 0 else v.row[v.end] for j in range(lo, t + 1)])
            a = m.key[rows] @ m.query[given[t]] + w.distance[t - np.arange(lo, t + 1)]
            p = np.exp(a)
            h = np.maximum(m.residual[given[t]] + (p / p.sum()) @ w.value[rows], 0)
            e = np.exp(h @ w.out + w.bias)
            kind = e[:v.starts].sum() if v.cls[x] < v.starts else e[v.starts:].sum()
            assert token[at] == pytest.approx(np.log(e[v.cls[x]] / kind) + v.share[x], abs=2e-3)
            assert begin[at] == pytest.approx(np.log(kind / e.sum()), abs=2e-3)
            at += 1


def test_shares_and_classes_are_distributions(small):
    streams, v, _ = small
    assert np.allclose(np.bincount(v.cls, weights=np.exp(v.share), minlength=v.classes)[np.unique(v.cls)], 1, atol=1e-4)
    assert v.cls.min() == 0 and v.cls.max() < v.classes and v.row.max() < attention.ROWS and v.row.min() >= 0


def test_gradients_lower_the_loss(small):
    streams, v, _ = small
    size = np.array([len(s) for s in streams])
    few, many = (sum(x.sum() for x in attention.Model(v, attention.train(streams, v, steps=k)).token_logs(np.concatenate(streams), size)) for k in (1, 300))
    assert many > few + 100


def test_texts_beyond_the_sample_are_learned_from(spark):
    """The order of words in texts that the first weights do not see makes the same order likelier."""
    def scores(line):
        df = spark.createDataFrame([(i, f"{line} " * 2500) for i in range(30)], "doc_id long, text string").coalesce(1)
        asked = spark.createDataFrame([(0, "red green blue " * 40), (1, "red blue green " * 40)], "doc_id long, text string")
        return {r["doc_id"]: r["score"] for r in lm.score_texts(asked, df, sample_docs=0, steps=1).collect()}

    a, b = scores("red green blue"), scores("red blue green")
    assert a[0] > b[0] + 1 and b[1] > a[1] + 1


def test_vocabulary_is_of_all_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 50").select("doc_id", "text")
    path = lm.default_model()
    v = lm.train_vocabulary(lm.text_statistics(docs.repartition(3), path), path)
    sub = lm.Subwords(path)
    streams = [x for *_, ids, size in lm._streams([r["text"] for r in docs.collect()], sub) for x in np.split(ids, np.cumsum(size)[:-1])]
    want = attention.build_vocabulary(streams, sub.is_start)
    assert (v.cls == want.cls).all() and np.allclose(v.share, want.share) and (v.row == want.row).all()


def _texts(words, each=5000):
    return [" ".join(words[i:i + each]) for i in range(0, len(words), each)]


def test_words_met_are_not_encoded_again(monkeypatch):
    sub, calls = lm.Subwords(lm.default_model()), []
    encode = sub.codec.encode_raw
    monkeypatch.setattr(sub.codec, "encode_raw", lambda words: (calls.append(len(words)), encode(words))[1])
    texts = _texts([f"w{i:x}" for i in range(310_000)])
    first = [ids for *_, ids, _ in lm._streams(texts, sub)]
    assert sum(calls) == 310_000
    again = [ids for *_, ids, _ in lm._streams(texts, sub)]
    assert sum(calls) == 310_000 and all((a == b).all() for a, b in zip(first, again, strict=True))


def test_forgotten_words_are_counted_and_encoded_alike(monkeypatch):
    """A table that is emptied between chunks gives the same counts, first ids and texts."""
    words = [f"{w}{i % 700}" for i, w in enumerate(["alpha", "b", "中文", "delta-x"] * 1500)]
    texts = [*_texts(words, 40), None, "", "x" * 3000]
    path = lm.default_model()
    monkeypatch.setattr(lm, "_CHUNK", 4000)

    def statistics(cached):
        sub = lm.Subwords(path, cached)
        monkeypatch.setattr(lm, "_subwords", lambda _: sub)
        rows = [r for b in lm._statistics_batches(iter([lm.pa.RecordBatch.from_pydict({"text": texts})]), path) for r in b.to_pylist()]
        count, ids = Counter(), b"".join(r["data"] for r in rows if r["kind"] == lm._IDS)
        for r in rows:
            if r["kind"] == lm._WORD:
                count[r["key"], r["first"]] += r["n"]
        return count, ids, sum(r["kind"] == lm._WORD for r in rows)

    a, b = statistics(1 << 19), statistics(50)
    assert a[:2] == b[:2] and b[2] > a[2] == len(a[0])
    assert sum(a[0].values()) == len(texts) + sum(len(_words(t)) for t in texts)


def test_gradients_are_the_same_where_values_are_large(small):
    """Also where exponentials overflow or vanish without the maximum taken out."""
    streams, v, w = small
    size, ids = np.array([len(s) for s in streams]), np.concatenate(streams)
    given, target, inside, first = attention.blocks(ids, size, v)
    rows, at = attention._after_starts(given, first, v.row[v.end])
    cls, counted = np.zeros(rows.shape, np.int64), np.zeros(rows.shape, bool)
    cls[at], counted[at] = v.cls[target], inside
    plain = attention.Learner(w, v)
    plain.add(rows, cls[1:], counted[1:])
    for shift in (-200.0, 0.0, 200.0):  # a bias that all classes share, and all distances, changes nothing
        moved = attention.Weights(*[x.copy() for x in w.all()])
        moved.bias += np.float32(shift)
        moved.distance += np.float32(shift)
        learner = attention.Learner(moved, v)
        learner.add(rows, cls[1:], counted[1:])
        assert np.allclose(learner.by_class, plain.by_class, atol=2e-2) and np.allclose(learner.values[:learner.rows], plain.values[:plain.rows], atol=2e-2)
        learner.step(0.01)
        assert all(np.isfinite(x).all() for x in learner.weights().all())

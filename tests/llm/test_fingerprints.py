from collections import Counter

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF, sha, words
from tidemark.llm import fingerprints as fp


def _edited(docs):
    """[(doc_id, text, edited)] in order, by definition."""
    docs = sorted(((d, t or "") for d, t in docs), key=lambda x: (x[0] is not None, x[0] or 0))
    out = []
    for i, (d, t) in enumerate(docs):
        nxt = docs[(i + 1) % len(docs)][1]
        k = len(t) // 4
        out.append((d, t, t[: len(t) - k] + nxt[:k], nxt))
    return out


def _jaccard(a, b):
    a, b = Counter(words(a)), Counter(words(b))
    return sum((a & b).values()) / sum((a | b).values()) if a or b else 1.0


def test_query(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    rows = {r["doc_id"]: r for r in fp.op4_fingerprints(spark, SF).collect()}
    assert len(rows) == len(docs)
    by_text, errors, near = {}, [], []
    for d, t, e, nxt in _edited(docs):
        r = rows[d]
        assert r["n_chars"] == len(t) and r["edited_sha256"] == sha(e)
        assert by_text.setdefault(t, r["fingerprint"]) == r["fingerprint"]
        assert (t == e) <= (r["fingerprint"] == r["edited_fingerprint"])
        errors.append(r["near_edited"] - _jaccard(t, e))
        near.append(r["near_next"] - _jaccard(t, nxt))
    assert len(set(by_text.values())) == len(by_text)
    for e in (errors, near):  # unbiased, with the deviation of 32 samples
        assert abs(sum(e) / len(e)) < 0.03 and (sum(x * x for x in e) / len(e)) ** 0.5 < 0.12


def test_groups_agree_with_one_group(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    many = {(r["doc_id"], r["next_text"]) for r in fp.with_next(df, 7).where("extra = 0").collect()}
    assert many == {(d, nxt) for d, _, _, nxt in _edited([(r["doc_id"], r["text"]) for r in df.collect()])}


def test_odd_rows(spark):
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA).selectExpr("*", "1 AS g", "2 AS pos", "3 AS h")
    rows = fp.fingerprint_edits(df).collect()
    want = sorted((str(d), len(t), sha(e)) for d, t, e, _ in _edited([x[:2] for x in ODD_DOCS]))
    assert sorted((str(r["doc_id"]), r["n_chars"], r["edited_sha256"]) for r in rows) == want
    empty = {r["fingerprint"] for r in rows if r["doc_id"] in (None, 3, 4)}
    assert len(empty) == 1
    assert fp.fingerprint_edits(df.limit(0)).count() == 0
    one = fp.fingerprint_edits(df.where("doc_id = 9")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0


def test_native_plan(spark):
    plan = fp.op4_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan

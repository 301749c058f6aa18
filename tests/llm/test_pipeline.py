import corpus_pipeline as cp

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF, base_spans
from tests.llm.test_mixing import WEIGHTS, _mix, _path
from tests.llm.test_simhash import _fingerprint, _groups


def test_stages_one_by_one(spark, tmp_path):
    """Every stage against its plain version, on what its predecessor kept."""
    import sentencepiece
    from tidemark.llm.sentencepiece import default_model

    names = [n for n, _ in cp.STAGES]
    assert names == ["language ID", "SimHash near-dedup", "secret scans", "mixing sources to target weights",
                     "SentencePiece encoding and decoding"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = []
    for i, (_, stage) in enumerate(cp.STAGES):
        before = docs
        out = stage(spark, docs, SF)
        if i < 4:
            assert out.columns == list(cp.COLUMNS)
        out.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        seen.append((before.collect(), docs.collect()))

    before, after = seen[0]  # clean documents stay, in their language
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before if any(c.isalpha() for c in r["text"])}
    assert sum(a["lang"] != b["lang"] for a, b in zip(*(sorted(x, key=lambda r: r["doc_id"]) for x in (before, after)))) <= 2

    before, after = seen[1]
    groups = _groups([(r["doc_id"], _fingerprint(r["text"])) for r in before])
    assert sorted(r["doc_id"] for r in after) == sorted(set(groups))
    assert set(after) <= set(before)

    before, after = seen[2]
    by_id = {r["doc_id"]: r["text"] for r in after}
    assert len(after) == len(before)
    for r in before:
        if base_spans(r["text"]):
            assert not base_spans(by_id[r["doc_id"]])
            assert "[SECRET]" in by_id[r["doc_id"]]

    before, after = seen[3]
    want = _mix([(r["doc_id"], r["text"]) for r in before], [_path(r) for r in before], WEIGHTS)
    assert sorted(r["doc_id"] for r in after) == sorted(d for d, _ in want)

    before, after = seen[4]
    library = sentencepiece.SentencePieceProcessor(model_file=default_model())
    assert len(after) == len(before)
    texts = {r["doc_id"]: r["text"] for r in before}
    assert all(list(r["ids"]) == library.encode(texts[r["doc_id"]]) and r["round_trip"] for r in after)


def test_run_and_odd_rows(spark, tmp_path):
    odd = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA)
    odd.write.parquet(f"{tmp_path}/odd/documents.parquet")
    rows = cp.run(spark, f"{tmp_path}/odd").collect()
    assert {r["doc_id"] for r in rows} <= {5, 7, 8, 9}
    odd.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert cp.run(spark, f"{tmp_path}/none").count() == 0

import sentencepiece as original

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF
from tidemark.llm import sentencepiece as sp


@pytest.fixture(scope="module")
def library():
    return original.SentencePieceProcessor(model_file=sp.default_model())


def test_query(spark, library):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = sp.op2_sentencepiece(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert list(r["ids"]) == library.encode(docs[r["doc_id"]]) and r["n_ids"] == len(r["ids"]) and r["round_trip"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab th é 𝒳\n\t.  ▁<s>0x0A"), max_size=40), max_size=5))
def test_parity_on_odd_texts(texts):
    codec = _CODEC.setdefault("c", sp.Codec(sp.default_model()))  # raises where the libraries differ
    for t, ids, same in zip(texts, *codec.encode_back(texts)):
        assert ids.tolist() == codec.original.encode(t)
        assert same == (codec.decode([ids.tolist()])[0] == t)


_CODEC = {}


def test_rebuilt_unigram_model_matches_scores():
    """A hand-written unigram model: the best-scoring segmentation, then bytes for what is unknown."""
    pieces = [("<unk>", 0.0, sp.UNKNOWN), ("▁a", -1.0, sp.NORMAL), ("b", -1.0, sp.NORMAL), ("▁ab", -2.5, sp.NORMAL), ("▁", -3.0, sp.NORMAL)] + \
        [(f"<0x{i:02X}>", 0.0, sp.BYTE) for i in range(256)]
    tok = sp.build_tokenizer(sp.Model(pieces, sp.UNIGRAM, True, 0, b"", True, False, True))
    assert tok.encode("ab b").tokens == ["▁a", "b", "▁", "b"]
    assert tok.encode("ac").tokens == ["▁a", "<0x63>"]
    assert tok.decode(tok.encode("ab c b").ids) == "ab c b"


def test_odd_rows(spark, library):
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA).selectExpr("*", "1 AS ids", "2 AS round_trip", "3 AS decoded")
    out = sp.decode(sp.encode(df))
    assert set(out.columns) == set(df.columns)
    rows = out.collect()
    assert len(rows) == len(ODD_DOCS)
    for r in rows:
        assert list(r["ids"]) == library.encode(r["text"] or "") and r["round_trip"] and r["decoded"] == (r["text"] or "")
    assert sp.encode(df.limit(0)).count() == 0


def test_small_cache_gives_the_same_ids():
    a, b = sp.Codec(sp.default_model()), sp.Codec(sp.default_model(), cached_chunks=5)
    texts = ["one two three four five six seven one two", "eight nine ten one", "two"]
    assert [x.tolist() for x in a.encode(texts)] == [x.tolist() for x in b.encode(texts)]

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF
from tidemark.llm import langid


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return langid.train_text_model(langid.labelled_sample(docs, 60), "text", "lang")


def test_pages_agree_with_markup(spark):
    got = langid.op3_language_id(spark, "/root/testdata/sf0.01")
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    both = got.join(pages, "page_id").withColumn("d", F.regexp_extract("html", 'lang="(..)"', 1))
    assert both.count() == pages.count()
    assert both.where("d = language").count() >= 0.95 * pages.count()


def test_held_out_documents(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id >= 6000")
    found = langid.identify_documents(docs, model)
    n = docs.count()
    assert found.count() == n
    assert found.where("text_lang = lang").count() > 0.98 * n
    assert found.where("language = lang").count() > 0.99 * n
    assert found.where("language = 'und'").count() == 0


def test_every_declared_language_has_a_model(spark):
    """90 languages, each of letters of its own; the rarest are known too."""
    def text(k, i):
        return " ".join("".join(chr(0x4E00 + 40 * k + (i * 7 + 3 * w + j) % 40) for j in range(6)) for w in range(5))

    rows = [(1000 * k + i, text(k, i), f"l{k:02}", "s") for k in range(90) for i in range(12 if k < 70 else 4)]
    docs = spark.createDataFrame(rows + [(5, None, "l00", "s"), (None, "x", "l00", "s"), (6, "y", None, "s")],
                                 "doc_id long, text string, lang string, source string").repartition(3)
    model = langid.train_text_model(langid.labelled_sample(docs, 10), "text", "lang")
    assert model.languages == tuple(f"l{k:02}" for k in range(90))
    found = langid.identify_documents(docs.where("doc_id >= 1000 OR doc_id < 3"), model)
    assert found.where("language != lang").count() == 0


def test_sample_is_the_smallest_hashes_of_a_language(spark):
    docs = spark.createDataFrame([(i % 3000, f"t{i % 3000}", "a" if i % 3000 % 9 else "b") for i in range(6000)], "doc_id long, text string, lang string")
    got = sorted(tuple(r) for r in langid.labelled_sample(docs, 20).collect())
    order = docs.distinct().orderBy(F.xxhash64("doc_id", F.lit(0))).collect()
    want = [(x, r["text"]) for x in "ab" for r in [r for r in order if r["lang"] == x][:20]]
    assert got == sorted(want * 2)


def _posterior(model, rows):
    """[(host, domain, declared, suffix, text)] -> log posteriors, by plain loops."""
    n = len(model.languages)
    sums = model.sums([r[4] for r in rows])
    scale = np.array([min(1.0, langid.TRIGRAM_CAP / k) if k else 0.0 for k in sums[:, -1]])
    flat = np.r_[np.zeros(n), np.log(langid.UNKNOWN_PRIOR)]
    logs = sums[:, :-1] * scale[:, None]

    def soft(x):
        e = np.exp(x - x.max())
        return e / e.sum()

    own = np.array([soft(x + flat) if k else np.zeros(n + 1) for x, k in zip(logs, sums[:, -1])])
    s, total, every = langid.SMOOTHING, own.sum(0), own.sum() or 1.0
    corpus = (total + s * np.r_[np.full(n, 1 / n), langid.UNKNOWN_PRIOR]) / (every + s * (1 + langid.UNKNOWN_PRIOR))
    out = []
    for i, (host, domain, declared, suffix, _) in enumerate(rows):
        x = logs[i].copy()
        if host:
            h = np.maximum(sum(own[j] for j, r in enumerate(rows) if (r[0], r[1]) == (host, domain)) - own[i], 0)
            d = np.maximum(sum(own[j] for j, r in enumerate(rows) if r[1] == domain) - own[i], 0)
            p = (d + s * corpus) / (d.sum() + s)
            x += np.log((h + s * p) / (h.sum() + s))
        else:
            x += np.log(corpus)
        for col, v in ((2, declared), (3, suffix)):
            if v is not None:
                m = sum(own[j] for j, r in enumerate(rows) if r[col] == v)
                x += np.log((m + s * (m.sum() + 1) / (every + 1)) / (total + s))
        out.append(soft(x))
    return np.array(out), sums[:, -1]


def test_fusion_equals_plain_loops(spark, model):
    docs = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").collect()]
    rows = [(f"h{i % 7}.d{i % 3}" if i % 5 else None, f"d{i % 3}", ["en", "fr", None, "xx"][i % 4], ["com", "de", None][i % 3], t[: 5 + i * 3])
            for i, t in enumerate(docs[:120])] + [(None, None, None, None, None), ("h", "d", "en", "com", ""), ("h", "d", "en", "com", "12 !?")]
    rows = [(h, d if h else None, a, s, t) for h, d, a, s, t in rows]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, h string, d string, a string, s string, t string")
    got = {r["i"]: r for r in langid.identify(df, model, F.col("t"), F.col("a"), F.col("s"), F.col("h"), F.col("d")).collect()}
    plain = [(h or "", d or "", a, s, t) for h, d, a, s, t in rows]
    want, n = _posterior(model, plain)
    names = [*model.languages, "und"]
    for i in range(len(rows)):
        if n[i]:
            assert got[i]["language"] == names[int(want[i].argmax())]
            assert abs(got[i]["confidence"] - want[i].max()) < 1e-6
        else:
            assert (got[i]["language"], got[i]["confidence"]) == ("und", 0.0)


def test_priors_decide_short_texts_and_noise_is_unknown(spark, model):
    rows = [(i, "the and of that with for", "en", "src1") for i in range(50)] + [(99, "a", None, "src1"), (100, "zqxjkvwpyf" * 30, None, "src9")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["language"] for r in langid.identify_documents(df, model).collect()}
    assert got[99] == "en" and got[100] == "und"


def test_odd_rows(spark, model):
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA).selectExpr("*", "1 AS confidence", "2 AS m0", "'x' AS __n2")
    out = langid.identify_documents(df, model)
    assert out.count() == len(ODD_DOCS)
    assert {r["language"] for r in out.where("doc_id IS NULL OR doc_id IN (3, 4)").collect()} == {"und"}
    assert langid.identify_documents(df.limit(0), model).count() == 0
    pages = spark.createDataFrame([(1, None, None), (2, "", ""), (3, "not a url", "<html lang=de>")], "page_id long, url string, html string")
    assert langid.identify_pages(pages, model).where("language = 'und'").count() == 3
    none = langid.train_text_model(df.limit(0), "text", "lang")
    assert langid.identify_documents(df, none).count() == len(ODD_DOCS)

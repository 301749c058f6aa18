import random
import re
import string

import pytest
from pyspark.sql import functions as F

from tests.llm.brute import DOC_SCHEMA, ODD_DOCS, SF, base_spans, sha, span_text
from tidemark.llm import secrets


def _check(rows, texts):
    for r in rows:
        t = texts[r["doc_id"]] or ""
        base = base_spans(t)
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r["base_sha256"] == sha(span_text(base))
        found = [x for x in r["spans"].split(",") if x]
        assert [x for x in found if not x.startswith("markov")] == [x for x in span_text(base).split(",") if x]


def test_query_matches_regex_scan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    rows = secrets.op9_secret_scans(spark, SF).collect()
    assert len(rows) == len(docs)
    _check(rows, {d["doc_id"]: d["text"] for d in docs})


@pytest.fixture(scope="module")
def ratios(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return secrets.train(secrets.labelled_samples(docs, 500))


def test_odd_rows(spark, ratios, tmp_path):
    df = spark.createDataFrame(ODD_DOCS, DOC_SCHEMA).selectExpr("*", "1 AS base_spans", "2 AS value")
    rows = secrets.scan_secrets(df, ratios).collect()
    assert len(rows) == len(ODD_DOCS) and "value" in rows[0].asDict()
    for r in rows:
        assert [(s["start"], s["kind"], s["end"]) for s in r["base_spans"]] == base_spans(r["text"] or "")
    by_id = {r["doc_id"]: r for r in rows}
    assert [s["kind"] for s in by_id[8]["secret_spans"]] == [3]  # a random string outside every pattern
    assert not by_id[9]["secret_spans"] and not by_id[None]["secret_spans"]
    assert secrets.scan_secrets(df.limit(0), ratios).count() == 0
    assert len(secrets.train(spark.createDataFrame([], "text string, random boolean"))) == len(secrets.ALPHABET) ** 2


def test_markov_model_separates_held_out_strings(spark, ratios):
    """Random strings of later rows against the words of unseen documents."""
    import hashlib

    rows = []
    for i in range(300):
        h = hashlib.sha256(f"held out {i}".encode()).digest()
        rows.append((i, (h.hex()[:32].upper() if i % 2 else re.sub("[^A-Za-z0-9]", "x", __import__("base64").b64encode(h).decode()))))
    hit = secrets.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string"), ratios)
    assert hit.where("size(secret_spans) > 0").count() >= 0.97 * len(rows)
    texts = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("doc_id > 5000").select("doc_id", "text")
    found = secrets.scan_secrets(texts, ratios).selectExpr("explode(transform(filter(secret_spans, s -> s.kind = 3), s -> s.value)) AS v").collect()
    ordinary = [r["v"] for r in found if re.fullmatch(r"[A-Za-z]?[a-z]+", r["v"])]
    assert len(ordinary) <= 5, ordinary[:20]


def test_native_plan(spark, ratios):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    plan = secrets.scan_secrets(df, ratios)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Exchange" not in plan


def test_masks(spark):
    rows = [("ab secret=0123456789abcdef01234567 é 𝒳 ffffffffffffffffffffffff.",), ("none",), ("",)]
    df = spark.createDataFrame(rows, "text string").select(
        secrets.mask_spans(secrets.text_or_empty(), secrets.base_spans(secrets.text_or_empty())))
    assert [r[0] for r in df.collect()] == ["ab [SECRET] é 𝒳 [SECRET].", "none", ""]


ALNUM = string.ascii_letters + string.digits


def test_secrets_joined_to_ordinary_text(spark, ratios):
    """Found whole: bare, within a path or an identifier, around a hexadecimal part, and short ones."""
    rng = random.Random(5)

    def value(n, of=ALNUM):
        return "".join(rng.choice(of) for _ in range(n))

    rows = []
    for _ in range(100):
        for n in (16, 32):
            for kind, before, after in (("bare", "", ""), ("path", "https://files.example.org/archive/shared/", "/index"),
                                        ("assigned", "client_credential_of_the_application=", ""),
                                        ("snake", "the_long_name_of_", "_and_the_rest"), ("glued", "credentialoftheapplication", "")):
                rows.append((kind, f"é {before}{value(n)}{after} end", 2 + len(before), 2 + len(before) + n))
        rows.append(("around hex", f"é {value(16)}{value(24, '0123456789abcdef')}{value(16)} end", 2, 58))
        rows.append(("none", f"getUserAccountByPrimaryKeyOrDefault{rng.randrange(99)} /usr/local/share/python3/site-packages/lib "
                     f"{value(16, string.digits)} 2024-0{rng.randint(1, 9)}-17T10-20-30_build/report_final_version-12", 0, 0))
    found = secrets.scan_secrets(spark.createDataFrame(rows, "kind string, text string, a int, b int"), ratios)
    shares = {r["kind"]: (r["whole"], r["any"]) for r in found.selectExpr(
        "kind", "int(exists(secret_spans, s -> s.start <= a AND s.end >= b)) AS whole", "int(size(secret_spans) > 0) AS any")
        .groupBy("kind").agg({"whole": "avg", "any": "avg"}).toDF("kind", "whole", "any").collect()}
    assert shares.pop("none")[1] <= 0.02
    assert all(whole >= 0.9 for whole, _ in shares.values()), shares


def _stretches(value, ratios, least):
    """The stretches of a run by a plain loop."""
    n, out = len(secrets.ALPHABET), []
    code = [secrets.ALPHABET.index(c) for c in value]
    piece = start = 0
    total = best = 0.0
    end = None
    for i, c in enumerate(code):
        delimiter = value[i] in "+/_=-"
        total += ratios[code[i - 1] * n + c] if i else 0.0
        if total <= 0 or total <= best - least:
            if best >= least:
                out.append((start, i if end is None else end))
                piece = max(piece, out[-1][1])
            piece = start = i + 1 if delimiter else piece
            total, best, end = 0.0, 0.0, None
            continue
        if delimiter:
            piece = i + 1
        if total > best:
            best, end = total, None
        elif delimiter and end is None:
            end = i
    if best >= least:
        out.append((start, len(value) if end is None else end))
    return out


def test_stretches_match_a_plain_loop(spark, ratios):
    rng = random.Random(6)
    ordinary = ["report", "final", "nation", "thering", "lichkeit", "the"]
    runs = ["a" * 12, "=" * 40, "-" * 12 + "x"]
    for _ in range(400):
        parts = [rng.choice(ordinary) if rng.random() < 0.6 else "".join(rng.choice(ALNUM) for _ in range(rng.randint(3, 30)))
                 for _ in range(rng.randint(2, 30))]
        runs.append("".join(p + rng.choice(["", "", *"+/_=-"]) for p in parts) + "x" * 12)
    rounded = [float(f"{x:.6f}") for x in ratios]
    for least in (6.0, 10.0):
        found = spark.createDataFrame([(r,) for r in runs], "run string").select(
            "run", secrets._random_stretches(F.col("run"), ratios, least).alias("s")).collect()
        for r in found:
            assert [tuple(x) for x in r["s"]] == _stretches(r["run"], rounded, least), r["run"]
    assert sum(len(r["s"]) > 1 for r in found) > 50


def test_thousands_of_matches_in_one_text(spark, ratios):
    text = "".join(f"é password=abcd{i} 0123456789abcdef01234567{i} " for i in range(20_000))
    df = spark.createDataFrame([(text,), (text[7:90],), ("",), (None,)], "text string")
    found = secrets.scan_secrets(df, ratios).withColumn("masked", secrets.mask_spans(F.col("text"), F.col("base_spans")))
    for r in found.collect():
        want = base_spans(r["text"] or "")
        assert [(s["start"], s["kind"], s["end"]) for s in r["base_spans"]] == want
        assert all(r["text"][s["start"]:s["end"]].endswith(s["value"]) for s in r["secret_spans"])
        out, end = [], 0
        for a, _, b in want:
            out += [r["text"][end:a], "[SECRET]"] if a >= end else []
            end = max(end, b)
        assert r["masked"] == (None if r["text"] is None else "".join(out) + r["text"][end:])

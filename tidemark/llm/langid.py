"""Language identification by Bayesian fusion of text, markup, address and host evidence.

The posterior of a row multiplies the likelihood of its text (hashed byte
trigrams under a model per language), of its declared markup language and of
its address suffix with a prior from its host. Host priors are smoothed
towards their domain's, those towards the whole corpus's. Declaration,
suffix, host, domain and corpus counts are grouped sums of text posteriors
over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import ready_workers, staged, table

UNKNOWN = "und"
_CELLS = 1 << 15
_AT_ONCE = 1 << 20
#: Labelled rows per language that the text model is fitted on.
SAMPLE_ROWS = 1500
#: A text counts as at most so many trigrams: neighbouring trigrams are not independent.
TRIGRAM_CAP = 40
#: Pseudo-counts of every smoothing step, and the prior weight of ``und``.
SMOOTHING, UNKNOWN_PRIOR = 4.0, 0.001

_LETTER = np.zeros(256, np.uint8) + 32
for _b in [*range(ord("a"), ord("z") + 1), *range(128, 256)]:
    _LETTER[_b] = _b


def _cells(raw: bytes) -> np.ndarray:
    """Cell of every trigram of lower-cased bytes; -1 where the middle is no letter."""
    b = _LETTER[np.frombuffer(raw, np.uint8)].astype(np.uint32)
    h = b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)
    cell = ((h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(17)).astype(np.int32)
    cell[b[1:-1] == 32] = -1
    return cell


def _pieces(text: str | None) -> Iterator[bytes]:
    """A text in overlapping byte pieces of bounded size, so that all trigrams are met once."""
    raw = b" " + (text or "").lower().encode("utf-8", "surrogatepass") + b" "
    for at in range(0, max(1, len(raw) - 2), _AT_ONCE):
        yield raw[at:at + _AT_ONCE + 2]


@dataclass(frozen=True)
class TextModel:
    """Log-probabilities of trigram cells by language; ``und`` is uniform."""

    languages: tuple[str, ...]
    table: np.ndarray  # (languages, cells), float32

    def sums(self, texts: list[str | None]) -> np.ndarray:
        """(rows, languages + 2): summed log-likelihoods, of ``und`` too, and trigrams."""
        out = np.zeros((len(texts), len(self.languages) + 2))
        for i, t in enumerate(texts):
            for piece in _pieces(t):
                c = _cells(piece)
                c = c[c >= 0]
                out[i, :-2] += self.table[:, c].sum(axis=1, dtype=np.float64)
                out[i, -1] += len(c)
        out[:, -2] = -math.log(_CELLS) * out[:, -1]
        return out


def train_text_model(labelled: DataFrame, text: str, lang: str, smoothing: float = 0.1) -> TextModel:
    """Model of the rows of ``labelled`` (a bounded sample) with a language and a text."""
    ready_workers(labelled.sparkSession)

    @F.pandas_udf("struct<cell:array<int>,n:array<int>>")
    def counted(texts: pd.Series) -> pd.DataFrame:
        cells, n = [], []
        for t in texts:
            own = sum((np.bincount(c[c >= 0], minlength=_CELLS) for c in map(_cells, _pieces(t))), np.zeros(_CELLS, np.int64))
            cells.append(np.flatnonzero(own).astype(np.int32))
            n.append(own[cells[-1]].astype(np.int32))
        return pd.DataFrame({"cell": cells, "n": n})

    rows = labelled.where(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), counted(F.col(text)).alias("c"))
    rows = rows.select("lang", F.explode(F.arrays_zip("c.cell", "c.n")).alias("c"))
    cells = rows.groupBy("lang", "c.cell").agg(F.sum("c.n").alias("n")).toPandas()
    languages = tuple(sorted(cells["lang"].unique()))
    counts = np.full((max(1, len(languages)), _CELLS), smoothing)
    if not languages:
        return TextModel(("und0",), np.full((1, _CELLS), -math.log(_CELLS), np.float32))
    counts[[languages.index(x) for x in cells["lang"]], cells["cell"].to_numpy()] += cells["n"].to_numpy()
    return TextModel(languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32))


def labelled_sample(docs: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents whose ids are the ``rows`` smallest by hash of each declared language, of every language.

    Only ids are ranked. Those with a hash well above the share ``rows`` takes
    of a language's ids are left out before, so that no task ranks a language whole.
    """
    ids = staged(docs.where("lang IS NOT NULL AND doc_id IS NOT NULL").select("lang", "doc_id").distinct()
                 .withColumn("h", F.xxhash64("doc_id", F.lit(0))), "langid-ids")
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("of"))  # as few as the model has rows
    # the share of hashes that holds the smallest `rows` of `of`, by more than ten standard deviations
    near = ids.join(F.broadcast(sizes), "lang").where((F.col("h") / 2.0 ** 64 + 0.5) * F.col("of") <= rows + 10 * math.sqrt(rows) + 50)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id"))
    picked = staged(near.withColumn("rank", rank).where(F.col("rank") <= rows).select("lang", "doc_id"), "langid-picked")
    return docs.join(picked, ["lang", "doc_id"], "left_semi").select("lang", "text")


def _soft(logs: np.ndarray) -> np.ndarray:
    """Rows of log-weights to rows of probabilities."""
    w = np.exp(logs - logs.max(axis=1, keepdims=True))
    return w / w.sum(axis=1, keepdims=True)


def _text_evidence(model: TextModel, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(log-likelihoods, posteriors by the text alone, trigrams); no posterior without trigrams."""
    sums = model.sums(texts)
    n = sums[:, -1]
    logs = sums[:, :-1] * np.minimum(1.0, TRIGRAM_CAP / np.maximum(n, 1.0))[:, None]
    flat = np.zeros(logs.shape[1])
    flat[-1] = math.log(UNKNOWN_PRIOR)
    return logs, _soft(logs + flat) * (n > 0)[:, None], n


def _shrunk(mass: np.ndarray, prior: np.ndarray) -> np.ndarray:
    return (mass + SMOOTHING * prior) / (mass.sum(axis=1, keepdims=True) + SMOOTHING)


def identify(rows: DataFrame, model: TextModel, text: Column, declared: Column, suffix: Column,
             host: Column, domain: Column) -> DataFrame:
    """``rows`` plus ``text_lang``, ``language``, ``confidence`` and ``n_trigrams``.

    ``language`` is the most probable by all evidence, ties to the first by
    name; ``und`` for texts that are null, empty, without letters or likelier
    noise than any language. ``confidence`` is its posterior. Null evidence
    says nothing: a null declaration or suffix has likelihood one, a null host
    the prior of the corpus. A row's own text is taken out of its host's
    counts. Every input row comes back once; input columns of the new names
    are replaced.
    """
    spark = rows.sparkSession
    ready_workers(spark)
    size = len(model.languages) + 1
    shared = spark.sparkContext.broadcast(model)
    new = ("text_lang", "language", "confidence", "n_trigrams")
    kept = [c for c in rows.columns if c not in new]

    @F.pandas_udf("array<double>")
    def by_text(texts: pd.Series) -> pd.Series:
        return pd.Series(list(_text_evidence(shared.value, texts.tolist())[1]))

    base = rows.select(*kept, text.alias("__text"), declared.alias("__declared"), suffix.alias("__suffix"),
                       F.coalesce(host, F.lit("")).alias("__host"), F.coalesce(domain, F.lit("")).alias("__domain"))

    # grouped aggregation of text posteriors, combined map-side
    keys = ["__host", "__domain", "__declared", "__suffix"]
    own = base.select(*keys, by_text("__text").alias("__own"))
    names = [f"m{i}" for i in range(size)]
    sum_of = [F.sum(m).alias(m) for m in names]
    own = own.select(*keys, *[F.get("__own", F.lit(i)).alias(m) for i, m in enumerate(names)])
    counts = staged(own.groupBy(*keys).agg(*sum_of), "langid")

    def grouped(*by):
        return counts.groupBy(*by).agg(*sum_of)

    total = np.array([x or 0.0 for x in grouped().first()])
    everything = float(total.sum()) or 1.0
    even = np.array([1 / (size - 1)] * (size - 1) + [UNKNOWN_PRIOR])
    corpus = (total + SMOOTHING * even) / (everything + SMOOTHING * even.sum())

    # likelihood of a value under each language, shrunk to the value's share of the corpus
    def likelihood(column):
        found = grouped(column).where(F.col(column).isNotNull())
        share = (sum((F.col(m) for m in names), F.lit(0.0)) + 1.0) / (everything + 1.0)
        return staged(found.select(column, F.array(*[
            F.log((F.col(m) + SMOOTHING * share) / (float(total[i]) + SMOOTHING)) for i, m in enumerate(names)]).alias(f"{column}_log")), "langid")

    hosts = grouped("__host", "__domain").select("__host", "__domain", F.array(*names).alias("__host_mass"))
    domains = grouped("__domain").select("__domain", F.array(*names).alias("__domain_mass"))
    hosts = staged(staged(hosts, "langid").join(staged(domains, "langid"), "__domain"), "langid")
    joined = base.join(hosts, ["__host", "__domain"], "left")
    for column in ("__declared", "__suffix"):
        joined = joined.join(likelihood(column), column, "left")

    def arrays(column: pd.Series) -> np.ndarray:
        return np.stack([np.zeros(size) if x is None else np.asarray(x, float) for x in column]) if len(column) else np.zeros((0, size))

    @F.pandas_udf("struct<text_lang:string,language:string,confidence:double,n_trigrams:long>")
    def fuse(texts: pd.Series, host: pd.Series, host_mass: pd.Series, domain_mass: pd.Series,
             declared_log: pd.Series, suffix_log: pd.Series) -> pd.DataFrame:
        logs, own, n = _text_evidence(shared.value, texts.tolist())
        of_domain = _shrunk(np.maximum(arrays(domain_mass) - own, 0.0), corpus)
        of_host = _shrunk(np.maximum(arrays(host_mass) - own, 0.0), of_domain)
        prior = np.where((host != "").to_numpy()[:, None], of_host, corpus)
        posterior = _soft(logs + np.log(prior) + arrays(declared_log) + arrays(suffix_log))
        known = np.array([*shared.value.languages, UNKNOWN], object)
        some = n > 0
        return pd.DataFrame({
            "text_lang": np.where(some, known[own.argmax(axis=1)], UNKNOWN),
            "language": np.where(some, known[posterior.argmax(axis=1)], UNKNOWN),
            "confidence": np.where(some, posterior.max(axis=1), 0.0),
            "n_trigrams": n.astype(np.int64)})

    out = joined.select(*kept, fuse("__text", "__host", "__host_mass", "__domain_mass", "__declared_log", "__suffix_log").alias("__found"))
    return out.select(*kept, *[F.col(f"__found.{c}").alias(c) for c in new])


# ---------------------------------------------------------------- pages

def page_text(html: Column) -> Column:
    """Visible text of a page: scripts, styles, comments and tags become spaces."""
    without = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<!--.*?-->", " ")
    return F.regexp_replace(F.regexp_replace(without, r"(?s)<[^>]*>", " "), r"&[#\w]+;", " ")


def identify_pages(pages: DataFrame, model: TextModel) -> DataFrame:
    """Evidence of web pages (url, html): markup ``lang``, address suffix, host and its domain."""
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]*)", 1))
    host = F.when(host != "", host)
    declared = F.lower(F.regexp_extract("html", r"(?is)<html\b[^>]*\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return identify(
        pages, model, page_text(F.col("html")),
        declared=F.when(declared != "", declared),
        suffix=F.element_at(F.split(host, r"\."), -1),
        host=host,
        domain=F.array_join(F.slice(F.split(host, r"\."), F.greatest(-F.size(F.split(host, r"\.")), F.lit(-2)), 2), "."))


def identify_documents(docs: DataFrame, model: TextModel) -> DataFrame:
    """Evidence of documents: the declared ``lang``, and ``source`` in the host's place."""
    return identify(docs, model, F.col("text"), declared=F.col("lang"), suffix=F.lit(None).cast("string"),
                    host=F.col("source"), domain=F.regexp_replace("source", r"[0-9]+$", ""))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train_text_model(labelled_sample(table(spark, sf_dir, "documents")), "text", "lang")
    found = identify_pages(table(spark, sf_dir, "pages"), model)
    return found.select("page_id", "text_lang", "language", "confidence", "n_trigrams")

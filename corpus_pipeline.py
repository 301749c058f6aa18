"""A corpus pipeline over ``documents``: each stage works on all that its predecessor kept.

``STAGES`` lists (name, function); a function takes ``(spark, docs, sf_dir)`` and
returns a DataFrame, which is written as Parquet and reread as the next stage's
``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import langid, mixing, secrets, sentencepiece, simhash
from tidemark.llm.tables import staged, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in no known language go: null, empty, without letters, or likelier noise than any language.

    ``lang`` becomes the language identified from text, declaration and source.
    """
    model = langid.train_text_model(langid.labelled_sample(docs), "text", "lang")
    found = langid.identify_documents(docs, model).where(F.col("language") != langid.UNKNOWN)
    return found.withColumn("lang", F.col("language")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays: the smallest ``doc_id``, as it is."""
    return simhash.keep_first(docs).select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span is replaced by ``[SECRET]``; ``n_chars`` follows the new text.

    No document goes. Rows without a secret keep text and ``n_chars`` as they
    are, nulls included.
    """
    ratios = secrets.train(secrets.labelled_samples(docs, secrets.SAMPLE_DOCS))
    found = secrets.scan_secrets(docs, ratios)
    changed = F.size("secret_spans") > 0
    masked = F.when(changed, secrets.mask_spans(F.col("text"), F.col("secret_spans"))).otherwise(F.col("text"))
    return found.withColumn("n_chars", F.when(changed, F.char_length(masked).cast("long")).otherwise(F.col("n_chars"))) \
        .withColumn("text", masked).select(*COLUMNS)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the budgets; one in several epochs comes once for each."""
    mixed = mixing.mix_sources(docs, mixing.production_levels(), weights=mixing.WEIGHTS)
    return mixed.select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document; the text itself is left behind."""
    coded = sentencepiece.encode(docs)
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_ids"), "ids", "round_trip")


STAGES = [
    ("language ID", identify_language),
    ("SimHash near-dedup", drop_near_duplicates),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix),
    ("SentencePiece encoding and decoding", encode),
]

#: Trained models, digests and tokenizer ids are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, f"stage-{i}")
    return docs

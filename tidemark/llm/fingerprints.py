"""Document fingerprints by consistent weighted sampling (gamma variates).

A document is its words weighted by their counts. For sample ``k`` every
(word, weight) draws ``r, c ~ Gamma(2, 1)`` and ``b ~ U(0, 1)`` from hashes of
the word and ``k``; with ``t = floor(ln w / r + b)`` the word with the smallest
``ln c - r (t - b + 1)`` is the sample, identified by (word, t). Two texts
agree on a sample with probability equal to their generalised Jaccard
similarity (sum of minimum weights over sum of maximum weights). Built-in
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import SPACE, table, text_or_empty

SAMPLES = 32
_LOW = "4294967295"


def _uniform(word: str, high: bool) -> str:
    """A uniform number in (0, 1) from one half of a 64-bit hash."""
    part = f"shiftrightunsigned({word}, 32)" if high else f"({word} & {_LOW})"
    return f"(({part} + 0.5D) / 4294967296D)"


def _sample(k: int, ln_w: str) -> Column:
    """The packed draw of sample ``k``: 32 bits of its value over 31 bits of its identity.

    The minimum of the packed draws is the draw of the smallest value, so a
    plain ``min`` over longs, combined map-side, selects the sample. A null
    weight draws nothing.
    """
    a, b, c = (f"xxhash64(h, {3 * k + i})" for i in range(3))
    r = f"(-ln({_uniform(a, False)} * {_uniform(a, True)}))"
    ln_c = f"ln(-ln({_uniform(b, False)} * {_uniform(b, True)}))"
    beta = _uniform(c, False)
    t = f"floor({ln_w} / {r} + {beta})"
    value = f"({ln_c} - {r} * ({t} - {beta} + 1D))"
    return F.min(F.expr(
        f"shiftleft(cast(({value} + 128D) * 16777216D as bigint), 31) | (xxhash64({c}, {t}) & 2147483647)"
    ))


def signatures(weighted: DataFrame, keys: list[str], weights: list[str], samples: int = SAMPLES) -> DataFrame:
    """``keys`` and, for every column of ``weights``, an array of longs ``<column>_signature``.

    ``weighted`` has rows (keys, ``h``: term hash, logarithms of its weights in
    several texts, null where the text lacks it): a term's variates are drawn
    once for all of them. Aggregation is map-side combined, one row per key
    and task. A text without terms gets a signature of -1.
    """
    aggs = [_sample(k, w).alias(f"{w}_{k}") for w in weights for k in range(samples)]
    out = weighted.groupBy(*keys).agg(*aggs)
    return out.select(*keys, *[
        F.array(*[F.coalesce(F.col(f"{w}_{k}"), F.lit(-1)) for k in range(samples)]).alias(f"{w}_signature") for w in weights])


def word_weights(texts: DataFrame, keys: list[str], versions: list[str]) -> DataFrame:
    """(keys, h, one column per version): hashed words with the logarithms of their counts in each text.

    A row without words in any version keeps one row with null ``h``.
    """
    body = F.array(*[F.struct(F.lit(i).alias("v"), F.col(c).alias("body")) for i, c in enumerate(versions)])
    words = F.filter(F.split(F.col("x.body"), SPACE), lambda w: w != "")
    counts = [F.sum((F.col("v") == i).cast("long")).alias(f"n{i}") for i in range(len(versions))]
    return (
        texts.select(*keys, F.explode(body).alias("x"))
        .select(*keys, F.col("x.v").alias("v"), F.explode_outer(words).alias("w"))
        .select(*keys, F.when(F.col("w").isNotNull(), F.col("v")).alias("v"), F.xxhash64("w").alias("h"))
        .groupBy(*keys, "h").agg(*counts)
        .select(*keys, "h", *[F.when(F.col(f"n{i}") > 0, F.log(F.col(f"n{i}").cast("double"))).alias(c) for i, c in enumerate(versions)])
    )


def likeness(a: Column, b: Column, samples: int = SAMPLES) -> Column:
    """Share of equal samples: the estimate of the generalised Jaccard similarity."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e)
    return F.size(same).cast("double") / F.lit(float(samples))


def fingerprint_text(signature: Column) -> Column:
    """Hexadecimal text of a signature, eight digits of identity per sample."""
    return F.array_join(F.transform(signature, lambda s: F.lpad(
        F.lower(F.hex(s.bitwiseAND(F.lit(2147483647)))), 8, "0")), "")


def with_next(docs: DataFrame, rows_per_group: int = 1000) -> DataFrame:
    """(g, pos, extra, doc_id, text, next_text) in ascending doc_id, dealt to groups by range.

    Group bounds are approximate quantiles of ``doc_id``; a bound is itself a
    ``doc_id``, so the document a group needs from its successor is known
    before the single shuffle and is dealt to both groups (``extra`` marks
    the copy). Null ids come first, rows of one id are ordered by text, and
    the last document is followed by the first.
    """
    d = docs.select("doc_id", text_or_empty().alias("text"))
    n = d.count()
    groups = max(1, n // rows_per_group)
    steps = [i / groups for i in range(1, groups)]
    stats = d.agg(
        F.percentile_approx("doc_id", steps or [0.5], max(10000, 20 * groups)).alias("cuts"),
        F.min("doc_id").alias("lo"), F.count(F.when(F.col("doc_id").isNull(), 1)).alias("nulls"),
    ).first()
    cuts = sorted({c for c in (stats["cuts"] or []) if c > stats["lo"]}) if steps else []
    lo = None if stats["nulls"] else stats["lo"]
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")

    def group_of(c: Column) -> Column:
        """Number of bounds <= c, by binary search."""
        if not cuts:
            return F.lit(0)
        bits = F.array(*[F.lit(1 << b) for b in reversed(range(len(cuts).bit_length()))])
        return F.when(c.isNull(), 0).otherwise(F.aggregate(
            bits, F.lit(0), lambda at, s: F.when(
                (at + s <= len(cuts)) & (F.get(bounds, F.least(at + s, F.lit(len(cuts))) - 1) <= c), at + s).otherwise(at)))

    first = F.col("doc_id").eqNullSafe(F.lit(lo).cast("bigint"))
    is_bound = F.lit(False) if not cuts else \
        F.coalesce(F.get(bounds, F.greatest(F.col("own") - 1, F.lit(0))) == F.col("doc_id"), F.lit(False))
    place = F.array_compact(F.array(
        F.struct(F.col("own").alias("g"), F.lit(0).alias("extra")),
        F.when(is_bound, F.struct((F.col("own") - 1).alias("g"), F.lit(1).alias("extra"))),
        F.when(first, F.struct(F.lit(len(cuts)).alias("g"), F.lit(2).alias("extra"))),
    ))
    dealt = (
        d.withColumn("own", group_of(F.col("doc_id")))
        .select("doc_id", "text", F.explode(place).alias("p"))
        .select("p.g", "p.extra", "doc_id", "text")
        .repartition("g")
    )
    w = Window.partitionBy("g").orderBy("extra", F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return dealt.select("g", F.row_number().over(w).alias("pos"), "extra", "doc_id", "text",
                        F.lead("text").over(w).alias("next_text"))


def fingerprint_edits(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per document: its fingerprint, its edited text's and their likenesses.

    The edited text replaces the last quarter of the code points by as many
    (or all) from the start of the next document. A null text counts as
    empty; an empty text has the fingerprint of no samples, alike to other
    empty texts (1.0) and to nothing else. Repeated rows are each kept, and
    other input columns are ignored.
    """
    rows = with_next(docs)
    n = F.char_length("text")
    k = F.floor(n / 4).cast("int")
    edited = F.concat(F.expr("substring(text, 1, char_length(text) - cast(floor(char_length(text) / 4) as int))"),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), k))
    rows = rows.select("g", "pos", "extra", "doc_id", n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    meta = rows.where("extra = 0").select("g", "pos", "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"))
    keys = ["g", "pos"]
    signed = signatures(word_weights(rows, keys, ["text", "edited"]), keys, ["text", "edited"], samples)
    in_order = Window.partitionBy("g").orderBy("pos")
    both = signed.select("*", F.lead("text_signature").over(in_order).alias("next_signature"))
    return meta.join(both, ["g", "pos"]).select(
        "doc_id", "n_chars", "edited_sha256",
        fingerprint_text(F.col("text_signature")).alias("fingerprint"),
        fingerprint_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("text_signature"), F.col("edited_signature"), samples).alias("near_edited"),
        likeness(F.col("text_signature"), F.col("next_signature"), samples).alias("near_next"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))

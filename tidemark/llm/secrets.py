"""Secret scans: base patterns plus character Markov models compared by log-likelihood ratio.

Two first-order character models are trained from labelled samples, one on
random strings and one on ordinary identifiers. Within a run of token
characters, a stretch is a secret when the random model explains its
transitions better than the ordinary one by at least ``min_total`` nats in
all, so ordinary words that a secret is joined to do not hide it. Scanning and
training use built-in functions only: no Python runs on executors, and the
scan itself needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import hash_sample, table, text_or_empty


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The base patterns of the scan.
_KEYWORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token")) + \
    "|" + _either_case("api") + "_?" + _either_case("key")
ASSIGN = rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # a run of 20 or more characters in all
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "markov")
MIN_ASSIGNED = 6

#: Characters of a candidate run, in natural order.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CLASS = "[A-Za-z0-9+/_=-]"


def candidate_pattern(min_length: int) -> str:
    return rf"(?<!{_CLASS}){_CLASS}{{{min_length},}}"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(items: Column) -> Column:
    """An array cut into about as many blocks as each has items; none of an empty one.

    Growing an array copies it, so arrays are grown within blocks: a text with n
    matches costs n times the root of n copies.
    """
    def cut(a):
        width = F.ceil(F.sqrt(F.size(a))).cast("int")
        last = ((F.size(a) - 1) / width).cast("int")
        return F.when(F.size(a) > 0, F.transform(F.sequence(F.lit(0), last), lambda b: F.slice(a, b * width + 1, width))) \
            .otherwise(F.filter(F.array(a), lambda x: F.size(x) > 0))
    return _let(items, cut)


def _scan(items: Column, zero: Column, step: Callable[[Column, Column], Column],
          emit: Callable[[Column, Column], Column]) -> Column:
    """``emit(state, item)`` of every item, where ``state`` is ``zero`` moved by ``step`` over all items before."""
    def states(blocks):
        return F.aggregate(
            blocks, F.struct(zero.alias("state"), F.slice(F.array(zero), 1, 0).alias("out")),
            lambda acc, b: F.struct(F.aggregate(b, acc["state"], step).alias("state"),
                                    F.concat(acc["out"], F.array(acc["state"])).alias("out")),
            lambda acc: acc["out"])

    def run(b, state):
        return F.aggregate(
            F.slice(b, 2, F.size(b)),
            F.struct(step(state, F.get(b, 0)).alias("state"), F.array(emit(state, F.get(b, 0))).alias("out")),
            lambda acc, x: F.struct(step(acc["state"], x).alias("state"),
                                    F.concat(acc["out"], F.array(emit(acc["state"], x))).alias("out")),
            lambda acc: acc["out"])

    return _let(_blocks(items), lambda blocks: F.flatten(F.zip_with(blocks, states(blocks), run)))


def _spans(text: Column, pattern: str, kind: int, value_group: int = 0, min_value: int = 0) -> Column:
    """Array of (start, kind, end, value) of the leftmost non-overlapping matches, in code points.

    The text between matches and the matches themselves alternate, so their
    lengths add up to the offsets. Matches whose value is shorter than
    ``min_value`` are dropped but still move the offset.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = whole if value_group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    pieces = F.zip_with(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), whole.alias("hit")), value, lambda p, v: F.struct(
        F.char_length(p["gap"]).alias("gap"), F.coalesce(F.char_length(p["hit"]), F.lit(0)).alias("length"), v.alias("value")))

    def one(at, p):
        start = at + p["gap"]
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + p["length"]).alias("end"), p["value"].alias("value"))

    found = _scan(pieces, F.lit(0), lambda at, p: at + p["gap"] + p["length"], one)
    found = F.filter(found, lambda s: F.char_length(s["value"]) >= min_value)  # the piece after the last match has none
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string>>")
    return F.when(text.rlike(pattern), found).otherwise(empty)


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start and then kind as listed."""
    return F.array_sort(F.concat(
        _spans(text, ASSIGN, 0, value_group=2, min_value=MIN_ASSIGNED),
        _spans(text, ACCESS, 1),
        _spans(text, HEX, 2),
    ))


def labelled_samples(docs: DataFrame, sample_docs: int, min_length: int = 8) -> DataFrame:
    """(text, random) rows from a bounded sample of documents.

    Random strings are the values the base patterns match, and hexadecimal
    and base64 renderings of digests of the sampled texts. Ordinary
    identifiers are the candidate runs outside base matches, the words there
    rendered as identifiers (snake, camel or numbered, by the text's
    hash, four at a time), and decimal renderings of digests and dates, as numbers are no secrets. ``sample_docs``
    bounds the documents read (chosen by hashed ``doc_id``).
    """
    d = hash_sample(docs, "doc_id", sample_docs).select(text_or_empty().alias("t"))
    digest = F.sha2(F.col("t"), 256)
    rendered = F.array(digest, F.upper(digest), F.base64(F.unhex(digest)),
                       F.substring(F.upper(F.sha1(F.col("t"))), 1, 20))
    random = F.concat(rendered, F.transform(base_spans(F.col("t")), lambda s: s["value"]))
    rest = F.col("t")
    for pattern in (ASSIGN, ACCESS, HEX):
        rest = F.regexp_replace(rest, pattern, " ")
    words = F.regexp_extract_all(rest, F.lit("[A-Za-z]+"), F.lit(0))
    number = F.conv(F.substring(digest, 1, 15), 16, 10)
    date = F.date_format(F.timestamp_seconds(F.pmod(F.xxhash64("t"), F.lit(2_000_000_000))), "yyyy-MM-dd_HH-mm-ss")
    groups = _let(words, lambda w: F.transform(
        F.sequence(F.lit(0), (F.size(w) / 4).cast("int")), lambda i: F.slice(w, i * 4 + 1, 4)))
    style = F.pmod(F.xxhash64("t"), F.lit(5))
    identifiers = F.transform(groups, lambda g: F.when(style < 3, F.array_join(g, "_")).when(
        style == 3, F.array_join(F.transform(g, F.initcap), "")).otherwise(
        F.array_join(F.transform(g, lambda w, i: F.concat(w, F.lit("/"), i.cast("string"))), "-")))
    ordinary = F.concat(F.regexp_extract_all(rest, F.lit(candidate_pattern(min_length)), F.lit(0)),
                        F.array(number, date), identifiers)
    return d.select(F.explode(random).alias("text"), F.lit(True).alias("random")).unionByName(
        d.select(F.explode(ordinary).alias("text"), F.lit(False).alias("random")))


def train(samples: DataFrame, smoothing: float = 0.5, unknown: float = 0.1) -> list[float]:
    """Log-likelihood ratios (random over ordinary) of all character transitions, row-major.

    Counts are one grouped aggregation; what reaches the driver is bounded by
    the square of the alphabet. With no samples of a class its model is uniform.
    A share ``unknown`` of either model is uniform anyway: a transition that the
    samples lack is no proof by itself.
    """
    n = len(ALPHABET)
    pairs = samples.where(F.char_length("text") >= 2).select("random", F.explode(_let(
        F.split("text", ""), lambda c: F.zip_with(c, F.slice(c, 2, F.size(c)), lambda x, y: F.concat(x, y)))).alias("pair"))
    counts: dict[bool, dict[str, int]] = {True: {}, False: {}}
    at = {c: i for i, c in enumerate(ALPHABET)}
    known = f"^[{''.join(chr(92) + c if c in '+/_=-' else c for c in ALPHABET)}]{{2}}$"
    for r in pairs.where(F.col("pair").rlike(known)).groupBy("random", "pair").count().collect():
        counts[r["random"]][r["pair"]] = r["count"]
    logs = {}
    for label, found in counts.items():
        rows = [[smoothing] * n for _ in range(n)]
        for pair, c in found.items():
            rows[at[pair[0]]][at[pair[1]]] += c
        logs[label] = [math.log((1 - unknown) * x / sum(row) + unknown / n) for row in rows for x in row]
    return [a - b for a, b in zip(logs[True], logs[False])]


def _random_stretches(value: Column, ratios: list[float], min_total: float) -> Column:
    """Array of (start, end) of the stretches of a run that are secrets, in order and apart.

    Ratios of transitions are summed from where the sum was last zero. A
    stretch ends where the sum is largest, once it has fallen by ``min_total``
    or to zero. Its ends are moved out to the delimiters around them (or the
    run's ends), as a secret's first and last characters may look ordinary.
    """
    n = len(ALPHABET)
    flat = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    code = F.transform(F.split(value, ""), lambda c: F.call_function("locate", c, F.lit(ALPHABET)) - 1)
    zero = F.lit(0.0)
    spans = F.array().cast("array<struct<start:int,end:int>>")

    def pack(at, last, piece, start, total, best, end, found):
        """``piece``: after the last delimiter; ``end``: of the best stretch, moved out; -1 while that goes on."""
        return F.struct(at.alias("at"), last.alias("last"), piece.alias("piece"), start.alias("start"),
                        total.alias("total"), best.alias("best"), end.alias("end"), found.alias("found"))

    def ended(a, at):
        end = F.when(a["end"] >= 0, a["end"]).otherwise(at)
        return F.when(a["best"] >= min_total, F.concat(a["found"], F.array(F.struct(a["start"].alias("start"), end.alias("end"))))) \
            .otherwise(a["found"])

    def step(a, c):
        delimiter = c >= ALPHABET.index("+")
        total = a["total"] + F.when(a["last"] < 0, zero).otherwise(F.get(flat, a["last"] * n + c))
        closes = (total <= 0) | (total <= a["best"] - min_total)
        after = F.when(delimiter, a["at"] + 1).otherwise(
            F.when(closes & (a["best"] >= min_total), F.greatest(a["piece"], F.when(a["end"] >= 0, a["end"]).otherwise(a["at"])))
            .otherwise(a["piece"]))
        grows = total > a["best"]
        end = F.when(grows, F.lit(-1)).otherwise(F.when(delimiter & (a["end"] < 0), a["at"]).otherwise(a["end"]))
        return F.when(closes, pack(a["at"] + 1, c, after, after, zero, zero, F.lit(-1), ended(a, a["at"]))).otherwise(
            pack(a["at"] + 1, c, after, a["start"], total, F.greatest(total, a["best"]), end, a["found"]))

    none = F.lit(0)
    return F.aggregate(code, pack(none, F.lit(-1), none, none, zero, zero, F.lit(-1), spans), step, lambda a: ended(a, a["at"]))


def scan_secrets(docs: DataFrame, ratios: list[float], min_length: int = 12,
                 min_total: float = 10.0) -> DataFrame:
    """``docs`` plus ``base_spans`` and ``secret_spans``: arrays of (start, kind, end, value).

    Every row comes back once, in place (no shuffle). A null or empty text has
    no spans. Offsets count code points, ``end`` exclusive; ``kind`` indexes
    :data:`KINDS`. Runs shorter than ``min_length`` are not scored. Method spans
    never lie within a base span, but may cover one with the random characters
    around it; equal texts get equal spans. Input columns of these two names
    are replaced.
    """
    text = text_or_empty()
    found = docs.withColumn("base_spans", base_spans(text))
    runs = _spans(text, candidate_pattern(min_length), 3)
    added = F.flatten(F.transform(runs, lambda r: F.transform(
        _random_stretches(r["value"], ratios, min_total), lambda s: F.struct(
            (r["start"] + s["start"]).alias("start"), F.lit(3).alias("kind"), (r["start"] + s["end"]).alias("end"),
            F.substring(r["value"], s["start"] + 1, s["end"] - s["start"]).alias("value")))))
    # in order of start, base spans first: one lies around a method span if any end so far is as far
    both = F.array_sort(F.concat(F.col("base_spans"), added))
    judged = _scan(both, F.lit(0), lambda end, s: F.when(s["kind"] < 3, F.greatest(end, s["end"])).otherwise(end),
                   lambda end, s: F.struct(s.alias("span"), ((s["kind"] < 3) | (s["end"] > end)).alias("kept")))
    return found.withColumn("secret_spans", F.transform(F.filter(judged, lambda j: j["kept"]), lambda j: j["span"]))


def span_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask_spans(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """``text`` with every span replaced by ``mask``; overlapping spans become one mask.

    Nested base matches are common (a digest inside an assignment), so a span
    that starts before the last one's end only extends it.
    """
    gaps = _scan(spans, F.lit(0), lambda end, s: F.greatest(end, s["end"]),
                 lambda end, s: F.struct(end.alias("start"), s["start"].alias("end")))

    def cut(block):
        first = F.get(block, 0)["start"]
        # positions count from the start of a string, so gaps are cut from their block's part of the text
        return _let(F.substring(text, first + 1, F.element_at(block, -1)["end"] - first), lambda part: F.transform(
            block, lambda g: F.substring(part, g["start"] - first + 1, g["end"] - g["start"])))

    kept = F.flatten(F.transform(_blocks(F.filter(gaps, lambda g: g["end"] >= g["start"])), cut))
    done = F.coalesce(F.array_max(F.transform(spans, lambda s: s["end"])), F.lit(0))
    masked = F.array_join(F.concat(kept, F.array(F.substring(text, done + 1, F.char_length(text)))), mask)
    return F.when(text.isNotNull(), masked)


#: Documents the two models are trained on.
SAMPLE_DOCS = 2000


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratios = train(labelled_samples(docs, SAMPLE_DOCS))
    found = scan_secrets(docs, ratios)

    def of_kind(k):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == k)).cast("long")

    return found.select(
        "doc_id", of_kind(0).alias("n_assign"), of_kind(1).alias("n_access"), of_kind(2).alias("n_hex"),
        F.sha2(span_text(F.col("base_spans")), 256).alias("base_sha256"),
        span_text(F.col("secret_spans")).alias("spans"))

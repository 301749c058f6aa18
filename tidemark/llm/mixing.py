"""Mixing sources to target weights by hierarchical budgeting.

The token budget flows down a tree (domain, language, source). At every node
it is split among the children by weight; a child that cannot use its share
(its subtree holds too few tokens, each usable ``max_epochs`` times) is
filled, and its shortage goes to its siblings by weight. Only when a whole
subtree is full does a shortage reach the ancestor's other children. A leaf
with budget for ``e`` whole epochs and ``r`` more tokens gives every document
``e`` times and, of epoch ``e``, the longest prefix in seeded order holding at
most ``r`` tokens. All arithmetic is on whole numbers. Built-in functions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import SPACE, staged, table, text_or_empty

_WIDE = "decimal(38,0)"


def word_tokens(text: Column) -> Column:
    """Number of words of a text."""
    return F.size(F.filter(F.split(text, SPACE), lambda w: w != "")).cast("long")


def _weight(level: Column, weights: Mapping[str, int], default: int) -> Column:
    out = F.lit(default)
    for name, w in weights.items():
        if int(w) < 1:
            raise ValueError("weights are whole numbers of 1 or more")
        out = F.when(level == name, F.lit(int(w))).otherwise(out)
    return out


def _split(nodes: DataFrame, parent: Sequence[str], name: str, weight: Column) -> DataFrame:
    """``nodes`` (parent, name, cap, given: the parent's budget) plus ``budget`` by water filling.

    Children in ascending cap per weight: a child is full when its cap does
    not exceed its share of what the fuller ones before it leave over.
    """
    by = [*parent] or [F.lit(0)]
    w = F.col("w")
    before = Window.partitionBy(*by).orderBy((F.col("cap").cast("double") / w), name).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(*by)
    zero = F.lit(0).cast(_WIDE)
    nodes = nodes.withColumn("w", weight.cast(_WIDE))
    nodes = nodes.select(
        "*", F.coalesce(F.sum("cap").over(before).cast(_WIDE), zero).alias("cap_before"),
        F.coalesce(F.sum("w").over(before).cast(_WIDE), zero).alias("w_before"),
        F.sum("w").over(every).cast(_WIDE).alias("w_all"))
    full = F.col("cap") * (F.col("w_all") - F.col("w_before")) <= w * (F.col("given") - F.col("cap_before"))
    nodes = nodes.withColumn("full", full)
    nodes = nodes.select(
        "*", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(every).cast(_WIDE), zero).alias("cap_full"),
        F.coalesce(F.sum(F.when(F.col("full"), w)).over(every).cast(_WIDE), zero).alias("w_full"))
    share = F.expr("(w * (given - cap_full)) div (w_all - w_full)").cast(_WIDE)
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("cap")).otherwise(share)).drop(
        "w", "cap_before", "w_before", "w_all", "full", "cap_full", "w_full", "given")


def leaf_budgets(leaves: DataFrame, levels: Sequence[str], total: int, max_epochs: int,
                 weights: Mapping[str, Mapping[str, int]], default: int = 1) -> DataFrame:
    """(levels, tokens, budget) for leaves (levels, tokens): one row per leaf, never one per document."""
    capped = leaves.select(*levels, "tokens", (F.col("tokens") * max_epochs).cast(_WIDE).alias("cap"))
    given = None
    for depth, name in enumerate(levels):
        parent, path = list(levels[:depth]), list(levels[: depth + 1])
        nodes = capped.groupBy(*path).agg(F.sum("cap").cast(_WIDE).alias("cap"))
        if given is None:
            whole = Window.partitionBy(F.lit(0))
            nodes = nodes.withColumn("given", F.least(F.lit(total).cast(_WIDE), F.sum("cap").over(whole).cast(_WIDE)))
        else:
            nodes = nodes.join(given, parent)
        given = _split(nodes, parent, name, _weight(F.col(name), weights.get(name, {}), default)).select(
            *path, F.col("budget").alias("given"))
    return leaves.join(given.withColumnRenamed("given", "budget"), list(levels))


def _order(seed: int, epoch: Column) -> Column:
    """Seeded place of a document in an epoch: a digest, compared as text."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(F.col("__id").cast("string"), F.lit("null"))))


def _cut_keys(tokens: DataFrame, budgets: DataFrame, levels: Sequence[str], seed: int) -> DataFrame:
    """(levels, epochs, cut): documents whose order in epoch ``epochs`` is below ``cut`` are the prefix.

    Orders are uniform digests, so a leaf is cut in three bounded steps: by
    the first three hex digits, within the crossing bucket by the next
    three, and row by row only within the bucket that remains. Sums are
    combined map-side, so a hot leaf is at most 4,096 rows in a window.
    """
    lv = list(levels)
    part = budgets.where("tokens > 0").select(
        *lv, F.expr("budget div tokens").cast("int").alias("epochs"),
        F.expr("budget % tokens").cast(_WIDE).alias("room"))
    keyed = tokens.join(F.broadcast(part) if _small(part) else part, lv).withColumn("o", _order(seed, F.col("epochs")))
    keyed = keyed.select(*lv, "epochs", "room", "o", "n", F.substring("o", 1, 3).alias("a"), F.substring("o", 4, 3).alias("b"))
    fine = keyed.groupBy(*lv, "epochs", "room", "a", "b").agg(F.sum("n").cast(_WIDE).alias("n"))

    def crossing(rows: DataFrame, bucket: str) -> DataFrame:
        run = Window.partitionBy(*lv).orderBy(bucket)
        rows = rows.withColumn("upto", F.sum("n").over(run).cast(_WIDE))
        over = rows.where(F.col("upto") > F.col("room"))
        return over.groupBy(*lv).agg(F.min_by(F.struct(bucket, (F.col("room") - F.col("upto") + F.col("n")).alias("room")), bucket).alias("x")) \
            .select(*lv, f"x.{bucket}", F.col("x.room").cast(_WIDE).alias("room"))

    coarse = fine.groupBy(*lv, "epochs", "room", "a").agg(F.sum("n").cast(_WIDE).alias("n"))
    at_a = crossing(coarse, "a")
    at_b = crossing(fine.drop("room").join(at_a, [*lv, "a"]), "b")
    at_ab = at_b.join(at_a.select(*lv, "a"), lv)
    # rows of the one remaining bucket per leaf; rows of one order (a repeated id) are taken together
    last = keyed.drop("room").join(F.broadcast(at_ab) if _small(at_ab) else at_ab, [*lv, "a", "b"])
    last = last.groupBy(*lv, "room", "o").agg(F.sum("n").cast(_WIDE).alias("n"))
    run = Window.partitionBy(*lv).orderBy("o")
    cut = last.withColumn("upto", F.sum("n").over(run).cast(_WIDE)).where("upto > room").groupBy(*lv).agg(F.min("o").alias("cut"))
    return part.select(*lv, "epochs").join(cut, lv, "left")


#: Most rows of a leaf table that is broadcast; larger ones are joined by a shuffle.
BROADCAST_LEAVES = 100_000


def _small(leaf_rows: DataFrame) -> bool:
    return leaf_rows.limit(BROADCAST_LEAVES + 1).count() <= BROADCAST_LEAVES


def mix_sources(docs: DataFrame, levels: Mapping[str, Column], share: tuple[int, int] = (4, 5),
                max_epochs: int = 2, weights: Mapping[str, Mapping[str, int]] | None = None,
                seed: int = 17, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows of ``docs`` chosen by the budgets, plus ``epoch`` (a row comes once per epoch it is in).

    ``levels`` maps level names, outermost first, to expressions over
    ``docs``; a null value is the node ``""``. The budget is ``share`` of all
    tokens (words). Leaves without tokens are never short: their documents
    come once, in epoch 0. Rows of one ``doc_id`` share an order and are
    taken together; a null id has the order of the text ``null``. A null
    text has no tokens. An input column called ``epoch`` is replaced.
    """
    names = [f"__level_{i}" for i in range(len(levels))]
    weights = {n: (weights or {}).get(k, {}) for n, k in zip(names, levels)}
    placed = [F.coalesce(c.cast("string"), F.lit("")).alias(n) for n, c in zip(names, levels.values())]
    light = staged(docs.select(F.col(doc_id).alias("__id"), *placed, word_tokens(text_or_empty(text)).alias("n")), "mixing")
    leaves = light.groupBy(*names).agg(F.sum("n").alias("tokens"))
    leaves = staged(leaves, "mixing-leaves")
    total = int(leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0)).cast(_WIDE)).first()[0]) * share[0] // share[1]
    budgets = staged(leaf_budgets(leaves, names, total, max_epochs, weights), "mixing-budgets")
    cuts = staged(_cut_keys(light, budgets, names, seed), "mixing-cuts")
    plan = budgets.select(*names).join(cuts, names, "left")
    plan = F.broadcast(plan) if _small(plan) else plan
    kept = docs.drop("epoch")
    placed_docs = kept.select("*", F.col(doc_id).alias("__id"), *placed).join(plan, names)
    whole = F.coalesce(F.col("epochs"), F.lit(1))
    in_part = F.coalesce(F.col("cut").isNotNull() & (_order(seed, F.col("epochs")) < F.col("cut")), F.lit(False))
    # without a cut and with epochs known, the rest of the budget holds the whole next epoch only if it is empty
    upto = whole + in_part.cast("int")
    chosen = placed_docs.where(upto > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), upto - 1)))
    return chosen.select(*kept.columns, "epoch")


# Production parameters of the query and of the pipeline's stage.
WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def production_levels() -> dict[str, Column]:
    """Domain (the source's number modulo four), language, source."""
    number = F.expr("try_cast(substring(source, 4) as int)")
    return {"domain": F.concat(F.lit("d"), (number % 4).cast("string")), "lang": F.col("lang"), "source": F.col("source")}


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = mix_sources(docs, production_levels(), weights=WEIGHTS)
    return mixed.select("doc_id", "lang", "source", "epoch")


def _sql_level(depth: int, names: list[str], weights: Mapping[str, int]) -> str:
    path, parent = ", ".join(names[: depth + 1]), ", ".join(names[:depth]) or "0"
    name = names[depth]
    cases = "".join(f" WHEN {name} = '{k}' THEN {v}" for k, v in weights.items())
    w = f"(CASE{cases} ELSE 1 END)" if cases else "1"
    given = "(SELECT least((SELECT total FROM budget), sum(tokens * 2)::HUGEINT) FROM leaves)" if depth == 0 else \
        f"(SELECT b.budget FROM split{depth - 1} b WHERE " + " AND ".join(f"b.{n} = leaves.{n}" for n in names[:depth]) + ")"
    group = f"SELECT {path}, sum(tokens * 2)::HUGEINT AS cap, ({w})::HUGEINT AS w, max({given})::HUGEINT AS given FROM leaves GROUP BY {path}"
    before = f"(PARTITION BY {parent} ORDER BY cap::DOUBLE / w, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    return f"""node{depth} AS ({group}),
run{depth} AS (SELECT *, coalesce(sum(cap) OVER {before}, 0)::HUGEINT AS cap_before, coalesce(sum(w) OVER {before}, 0)::HUGEINT AS w_before,
  (sum(w) OVER (PARTITION BY {parent}))::HUGEINT AS w_all FROM node{depth}),
full{depth} AS (SELECT *, cap * (w_all - w_before) <= w * (given - cap_before) AS is_full FROM run{depth}),
sat{depth} AS (SELECT *, coalesce(sum(CASE WHEN is_full THEN cap END) OVER (PARTITION BY {parent}), 0)::HUGEINT AS cap_full,
  coalesce(sum(CASE WHEN is_full THEN w END) OVER (PARTITION BY {parent}), 0)::HUGEINT AS w_full FROM full{depth}),
split{depth} AS (SELECT {path}, CASE WHEN is_full THEN cap ELSE (w * (given - cap_full)) // (w_all - w_full) END AS budget FROM sat{depth})"""


#: DuckDB SQL of the query over ``documents``.
ORACLE = f"""
WITH d AS (SELECT doc_id, lang, source,
  coalesce('d' || (try_cast(substr(source, 4) AS INTEGER) % 4), '') AS l0, coalesce(lang, '') AS l1, coalesce(source, '') AS l2,
  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS n FROM documents),
leaves AS (SELECT l0, l1, l2, sum(n)::HUGEINT AS tokens FROM d GROUP BY l0, l1, l2),
budget AS (SELECT (coalesce(sum(tokens), 0)::HUGEINT * 4) // 5 AS total FROM leaves),
{_sql_level(0, ['l0', 'l1', 'l2'], WEIGHTS['domain'])},
{_sql_level(1, ['l0', 'l1', 'l2'], WEIGHTS['lang'])},
{_sql_level(2, ['l0', 'l1', 'l2'], {})},
part AS (SELECT l0, l1, l2, budget // tokens AS epochs, budget % tokens AS room
  FROM split2 JOIN leaves USING (l0, l1, l2) WHERE tokens > 0),
ordered AS (SELECT d.*, epochs, room, md5('17:' || epochs || ':' || coalesce(doc_id::VARCHAR, 'null')) AS o FROM d JOIN part USING (l0, l1, l2)),
cum AS (SELECT *, sum(n) OVER (PARTITION BY l0, l1, l2 ORDER BY o) AS upto FROM ordered),
copies AS (SELECT doc_id, lang, source, epochs + (CASE WHEN upto <= room THEN 1 ELSE 0 END) AS k FROM cum
  UNION ALL SELECT doc_id, lang, source, 1 FROM d JOIN leaves USING (l0, l1, l2) WHERE tokens = 0)
SELECT doc_id, lang, source, epoch::INTEGER AS epoch FROM (SELECT *, unnest(range(k::BIGINT)) AS epoch FROM copies)
"""

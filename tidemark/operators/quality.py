"""Table-level data-quality rules, evaluated in one aggregate pass."""

from __future__ import annotations

import operator
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import col

_OPS = {">": operator.gt, ">=": operator.ge, "=": operator.eq, "<": operator.lt, "<=": operator.le}


@dataclass(frozen=True)
class ColumnCount:
    """Number of columns compared with ``value`` (metadata only)."""

    op: str = ">"
    value: int = 0
    metadata_only = True

    @property
    def text(self) -> str:
        return f"ColumnCount {self.op} {self.value}"

    def evaluate(self, df: DataFrame) -> tuple[int, bool]:
        n = len(df.columns)
        return n, _OPS[self.op](n, self.value)

    def actual(self, df: DataFrame) -> Column:
        return F.lit(len(df.columns)).cast("bigint")

    def passed(self, actual: Column) -> Column:
        return _OPS[self.op](actual, F.lit(self.value))

    def holds(self, actual: int) -> bool:
        return bool(_OPS[self.op](actual, self.value))


@dataclass(frozen=True)
class RowCount:
    """Number of rows compared with ``value``."""

    op: str = ">"
    value: int = 0
    metadata_only = False

    @property
    def text(self) -> str:
        return f"RowCount {self.op} {self.value}"

    def actual(self, df: DataFrame) -> Column:
        return F.count(F.lit(1))

    def passed(self, actual: Column) -> Column:
        return _OPS[self.op](actual, F.lit(self.value))

    def holds(self, actual: int) -> bool:
        return bool(_OPS[self.op](actual, self.value))


@dataclass(frozen=True)
class IsComplete:
    """No NULL in ``column``; ``actual`` is the number of NULLs."""

    column: str
    metadata_only = False

    @property
    def text(self) -> str:
        return f'IsComplete "{self.column}"'

    def actual(self, df: DataFrame) -> Column:
        return F.count_if(col(self.column).isNull())

    def passed(self, actual: Column) -> Column:
        return actual == F.lit(0)

    def holds(self, actual: int) -> bool:
        return actual == 0


DEFAULT_RULES = (ColumnCount(">", 0),)


def check_rules(df: DataFrame, rules: Sequence = DEFAULT_RULES) -> DataFrame:
    """``(rule, actual, passed)`` per rule, one row each, from a single aggregate.

    Lazy: the aggregate runs when the result is read. Rules only report;
    callers decide whether a failed rule stops a run.
    """
    if not rules:
        raise ValueError("no rules given")
    actuals = df.agg(*[r.actual(df).cast("bigint").alias(f"a{i}") for i, r in enumerate(rules)])
    rows = [
        F.struct(
            F.lit(r.text).alias("rule"),
            F.col(f"a{i}").alias("actual"),
            r.passed(F.col(f"a{i}")).alias("passed"),
        )
        for i, r in enumerate(rules)
    ]
    return actuals.select(F.inline(F.array(*rows)))


def failed_rules(results: DataFrame) -> list[str]:
    """Texts of the failed rules (one row per rule reaches the driver)."""
    return [r["rule"] for r in results.where(~F.col("passed")).select("rule").collect()]


def evaluate_rules(df: DataFrame, rules: Sequence = DEFAULT_RULES) -> list[tuple[str, int, bool]]:
    """``(rule, actual, passed)`` per rule; metadata rules need no pass over the data."""
    data_rules = [r for r in rules if not r.metadata_only]
    by_text = {}
    if data_rules:
        for row in check_rules(df, data_rules).collect():
            by_text[row["rule"]] = (row["rule"], int(row["actual"]), bool(row["passed"]))
    out = []
    for r in rules:
        if r.metadata_only:
            actual, ok = r.evaluate(df)
            out.append((r.text, int(actual), bool(ok)))
        else:
            out.append(by_text[r.text])
    return out

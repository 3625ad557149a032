"""Data-quality checks: each is one row, of what was observed, as text and as a count, and whether it passed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CRITICAL, WARNING = "CRITICAL", "WARNING"
#: Names that the text of a check lists at most; the count beside them is of all.
NAMES = 200


@dataclass(frozen=True)
class Check:
    """rule: what breaks it - a condition to count, or a frame to count; at most `allowed` rows, or `at_least` so many.

    unit follows the count in the text. names: (label, order) of the rows that a condition counts, listed in order
    ahead of the count. measure, in place of a rule, gives one row (observed: text, passed); no row is a failure.
    """

    name: str
    target: str
    severity: str
    rule: Column | Callable[[dict[str, DataFrame]], DataFrame] | None = None
    allowed: int = 0
    at_least: int | None = None
    unit: str = ""
    names: tuple[Column, Column] | None = None
    measure: Callable[[dict[str, DataFrame]], DataFrame] | None = None


def run(spark: SparkSession, tables: dict[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """check_name, target, severity, observed, n, passed. Conditions on one table are counted in one scan of it."""
    parts: list[DataFrame] = []
    by_table: dict[str, list[Check]] = {}
    for c in checks:
        if c.measure is not None:
            told = c.measure(tables).agg(F.max("observed").alias("o"), F.bool_and("passed").alias("p"))
            parts.append(told.select(*_row(c, F.coalesce("o", F.lit("")), F.lit(None), F.col("p"))))
        elif not isinstance(c.rule, Column):
            parts.append(c.rule(tables).agg(F.count("*").alias("n")).select(*_counted(c, F.col("n"))))
        elif c.names is not None:
            parts.append(_named(tables[c.target], c))
        else:
            by_table.setdefault(c.target, []).append(c)
    for target, own in by_table.items():
        counted = tables[target].agg(*[F.count_if(F.coalesce(c.rule, F.lit(False))).alias(f"c{i}") for i, c in enumerate(own)])
        rows = F.array(*[F.struct(*_counted(c, F.col(f"c{i}"))) for i, c in enumerate(own)])
        parts.append(counted.select(F.inline(rows)))
    return reduce(DataFrame.unionByName, parts)


def _named(table: DataFrame, c: Check) -> DataFrame:
    label, order = c.names
    bad = table.where(F.coalesce(c.rule, F.lit(False))).select(order.alias("at"), label.alias("name"))
    first = bad.orderBy("at", "name").limit(NAMES).agg(F.array_sort(F.collect_list(F.struct("at", "name"))).alias("l"))
    n = bad.agg(F.count("*").alias("n"))
    text = F.concat(F.array_join("l.name", "; "), F.lit(" ("), F.col("n").cast("string"), F.lit(f"{c.unit})"))
    return first.crossJoin(n).select(*_counted(c, F.col("n"), text))  # a row each


def _counted(c: Check, n: Column, text: Column | None = None) -> list[Column]:
    passed = n <= c.allowed if c.at_least is None else n >= c.at_least
    return _row(c, text if text is not None else F.concat(n.cast("string"), F.lit(c.unit)), n, passed)


def _row(c: Check, text: Column, n: Column, passed: Column) -> list[Column]:
    return [F.lit(c.name).alias("check_name"), F.lit(c.target).alias("target"), F.lit(c.severity).alias("severity"), text.alias("observed"), n.cast("long").alias("n"), F.coalesce(passed, F.lit(False)).alias("passed")]


def failed(results: DataFrame) -> list[str]:
    """Names of the critical checks that failed; the run must not be published."""
    return sorted(r["check_name"] for r in results.where((F.col("severity") == CRITICAL) & ~F.col("passed")).collect())

"""One row per key by an explicit total order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def newest(*names: str) -> list[Column]:
    """Descending, nulls first: the order in which an unknown time counts as the newest."""
    return [F.col(n).desc_nulls_first() for n in names]


def keep_latest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order. Null keys are a key like any other."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def latest_then(df: DataFrame, keys: Sequence[str], order: Sequence[Column], condition: Column) -> DataFrame:
    """Filter after the selection: a bad newest row must not bring back an older good one."""
    return keep_latest(df, keys, order).where(condition)

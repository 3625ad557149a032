"""Merges of stored and incoming rows. Plain Parquet has no MERGE; each is a union and one aggregation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.operators.latest import keep_latest


def _both(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))


def upsert(old: DataFrame, new: DataFrame, keys: Sequence[str], guard: str | None = None) -> DataFrame:
    """Incoming rows win, unless guard names a column in which they are older; stored keys without a match stay.

    Of several incoming rows of a key the one of the greatest guard wins; without a guard keys must be unique.
    """
    order = ([F.col(guard).desc_nulls_last()] if guard else []) + [F.col("_new").desc()]
    return keep_latest(_both(old, new), keys, order).drop("_new")


def widen(old: DataFrame, new: DataFrame, keys: Sequence[str], first: str, last: str, carry: Sequence[str] = ()) -> DataFrame:
    """One row per null-safe key over the widest interval; carried columns come from the row seen last."""
    both = _both(old, new)
    carried = [F.max_by(c, F.struct(last, "_new")).alias(c) for c in carry]
    return both.groupBy(*keys).agg(F.min(first).alias(first), F.max(last).alias(last), *carried).select(old.columns)


def insert_if_absent(old: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """Stored rows stay as they are; of the incoming rows of a new key the first in order is added."""
    fresh = keep_latest(new, keys, order)
    same = [F.col(f"n.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys]
    return old.unionByName(fresh.alias("n").join(old.select(*keys).alias("o"), same, "left_anti"))


def first_seen(old: DataFrame, new: DataFrame, keys: Sequence[str], checked: str, seen: str) -> DataFrame:
    """One row a key (null-safe): the one of the earliest `seen`, a stored one before incoming ones, as it is but for
    `checked`, which becomes the greatest of the key's: what comes again is touched, not replaced."""
    by = Window.partitionBy(*keys)
    first = F.row_number().over(by.orderBy("_new", F.col(seen).asc_nulls_last()))
    both = _both(old, new).withColumns({"_n": first, "_last": F.max(checked).over(by)})
    return both.where("_n = 1").withColumn(checked, F.col("_last")).select(old.columns)


def unseen(incoming: DataFrame, stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key the store doesn't have."""
    return incoming.join(stored.select(*keys).distinct(), list(keys), "left_anti")


def outcome(old: DataFrame, new: DataFrame, keys: Sequence[str], digest: str) -> DataFrame:
    """keys and INSERTED, UPDATED or UNCHANGED for every incoming row, by content digest."""
    stored = old.select(*keys, F.col(digest).alias("_was"))
    joined = new.join(stored, list(keys), "left")
    return joined.select(*keys, F.when(F.col("_was").isNull(), "INSERTED").when(F.col("_was") == F.col(digest), "UNCHANGED").otherwise("UPDATED").alias("outcome"))

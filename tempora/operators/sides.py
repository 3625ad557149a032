"""One row per side of a two-sided event, and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot_sides(df: DataFrame, pairs: Mapping[str, tuple[str, str]], flag: str = "is_home") -> DataFrame:
    """pairs: name -> (home column, away column). Own columns come first, the other side's swapped.

    Both rows are made in one pass, without reading the input twice. A pair (a, b) named x becomes x on the
    first row from a and on the second from b.
    """
    keep = [c for c in df.columns if c not in {x for p in pairs.values() for x in p}]
    home = F.struct(F.lit(True).alias(flag), *[F.col(a).alias(n) for n, (a, _) in pairs.items()])
    away = F.struct(F.lit(False).alias(flag), *[F.col(b).alias(n) for n, (_, b) in pairs.items()])
    return df.select(*keep, F.inline(F.array(home, away)))


def pivot_sides(events: DataFrame, sides: DataFrame, key: str, flag: str, columns: Sequence[str], parts: int | None = None) -> DataFrame:
    """events with home_ and away_ versions of the sides' columns.

    Both rows of an event meet in one aggregation, so that the sides are worked out once. parts: tasks to deal the
    events to, where rows are so wide that their bytes while they travel don't tell what sorting them takes.
    """
    if parts:
        events, sides = events.repartition(parts, key), sides.repartition(parts, key)
    body = F.struct(*[F.col(c) for c in columns])
    both = sides.groupBy(F.col(key).alias("_k")).agg(F.any_value(F.when(F.col(flag), body), True).alias("_home"), F.any_value(F.when(~F.col(flag), body), True).alias("_away"))
    named = both.select("_k", *[F.col(f"_{side}.{c}").alias(f"{side}_{c}") for side in ("home", "away") for c in columns])
    return events.join(named, F.col(key) == F.col("_k"), "left").drop("_k")


def points(own: str, other: str):
    """3, 1 or 0; null while one of the two is unknown."""
    return F.when(F.col(own) > F.col(other), 3).when(F.col(own) == F.col(other), 1).when(F.col(own) < F.col(other), 0)

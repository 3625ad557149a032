"""Which of many overlapping validities counts at a moment: an interval tree as one union and running maxima.

An interval of microseconds belongs to the smallest aligned block of time, a power of two long, that holds it; the
block's middle lies inside it. Before the middle it is valid from its start on, behind it until its end, so that in each half
block a running maximum - forwards over starts, backwards over ends - tells the greatest valid interval at every
moment. An interval gives two rows however long it is; a moment gives one for each block size that its key uses.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Added to microseconds, so that all are positive; what an open end counts as; microseconds of a chunk, as a shift.
BIAS, OPEN, CHUNK = 1 << 58, 1 << 60, 36


def _halves(obs: DataFrame) -> DataFrame:
    """obs (_s, _e and more) with _level and _parts: (half, place in the half's order)."""
    apart = F.col("_s").bitwiseXOR(F.col("_e") - 1)
    level = F.when(apart > 0, F.length(F.bin(apart)) - 1).otherwise(-1)
    left, right = F.struct(F.lit(0).alias("half"), F.col("_s").alias("at")), F.struct(F.lit(1).alias("half"), (1 - F.col("_e")).alias("at"))
    return obs.withColumn("_level", level).withColumn("_parts", F.when(F.col("_level") < 0, F.array(left)).otherwise(F.array(left, right)))


def _shift(value: Column, bits: Column) -> Column:
    return F.call_function("shiftright", value, bits)


def _running_max(rows: DataFrame, group: list[str]) -> DataFrame:
    """rows with _best, the greatest _value up to their place (_at, _kind) in the group.

    A group may be most of the table: places are cut in chunks of time, a chunk's rows are one window, and what the
    chunks before have is carried in from a table with one row a chunk.
    """
    chunked = rows.withColumn("_chunk", F.shiftright("_at", CHUNK))
    parts = chunked.groupBy(*group, "_chunk").agg(F.max("_value").alias("_most"))
    upto = Window.partitionBy(*group).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.select(*group, "_chunk", F.max("_most").over(upto).alias("_carried"))
    own = Window.partitionBy(*group, "_chunk").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    within = chunked.withColumn("_own", F.max("_value").over(own)).where("_kind = 1")
    return within.join(carried, [*group, "_chunk"]).withColumn("_best", F.greatest("_own", "_carried"))


def greatest_valid(events: DataFrame, observations: DataFrame, on: Sequence[str], key: Sequence[str], time: str, start: Column, until: Column, order: Sequence[Column], take: Sequence[str]) -> DataFrame:
    """events (unique `key`) with `take` of the observation of the same `on` that is greatest in `order` among those
    with start <= time < until.

    start and until: timestamps over observations; a null until is open, a null start never begins. Nulls in `on` or
    time find nothing. Of equals in order the greatest `take` counts. Events come back once, whatever is found.
    """
    on, key = list(on), list(key)
    micros = lambda c: F.unix_micros(c.cast("timestamp")) + BIAS
    names = [f"_on{i}" for i in range(len(on))]
    value = F.struct(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("order"), F.struct(*[F.col(c).alias(c) for c in take]).alias("take"))
    own = [F.col(c).alias(n) for c, n in zip(on, names)]
    known = " AND ".join(f"{n} IS NOT NULL" for n in names)
    obs = observations.select(*own, micros(start).alias("_s"), F.coalesce(micros(until), F.lit(OPEN)).alias("_e"), value.alias("_value")).where(f"_s < _e AND {known}")
    halves = _halves(obs)
    levels = halves.groupBy(*names).agg(F.collect_set("_level").alias("_levels"))
    node = _shift(F.col("_s"), F.col("_level") + 1)
    entries = halves.select(*names, "_level", node.alias("_node"), F.inline("_parts").alias("_half", "_at"), F.lit(0).alias("_kind"), "_value")
    asked = events.select(F.struct(*[F.col(c).alias(c) for c in key]).alias("_key"), *own, micros(F.col(time)).alias("_t")).where(f"_t IS NOT NULL AND {known}")
    spread = asked.join(levels, names).withColumn("_level", F.explode("_levels"))
    half = F.when(F.col("_level") < 0, 0).otherwise(_shift(F.col("_t"), F.greatest(F.col("_level"), F.lit(0))).bitwiseAND(1).cast("int"))
    moments = spread.select(*names, "_level", _shift(F.col("_t"), F.col("_level") + 1).alias("_node"), half.alias("_half"), F.when(half == 0, F.col("_t")).otherwise(-F.col("_t")).alias("_at"), F.lit(1).alias("_kind"), "_key")
    both = entries.unionByName(moments, allowMissingColumns=True)
    found = _running_max(both, [*names, "_level", "_node", "_half"]).groupBy("_key").agg(F.max("_best").alias("_best"))
    flat = found.select(*[F.col(f"_key.{c}").alias(f"_k{i}") for i, c in enumerate(key)], F.col("_best.take").alias("_found"))
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(key)]
    return events.join(flat, same, "left").select(*events.columns, *[F.col(f"_found.{c}").alias(c) for c in take])


def greatest_begun(events: DataFrame, observations: DataFrame, on: Sequence[str], time: str, start: Column, order: Sequence[Column], take: Sequence[str]) -> DataFrame:
    """events with `take` of the observation of the same `on` that is greatest in `order` among those with start <= time.

    For validities that end in the order they count in: where the greatest has ended, all have. A moment is one row,
    and nothing is joined back. Events with a null in `on` or time leave; a null start never begins.
    """
    names = [f"_on{i}" for i in range(len(on))]
    own = [F.col(c).alias(n) for c, n in zip(on, names)]
    known = " AND ".join(f"{n} IS NOT NULL" for n in ["_at", *names])
    value = F.struct(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)]).alias("order"), F.struct(*[F.col(c).alias(c) for c in take]).alias("take"))
    micros = lambda c: F.unix_micros(c.cast("timestamp")) + BIAS
    entries = observations.select(*own, micros(start).alias("_at"), F.lit(0).alias("_kind"), value.alias("_value")).where(known)
    moments = events.select(*own, micros(F.col(time)).alias("_at"), F.lit(1).alias("_kind"), F.struct("*").alias("_event")).where(known)
    found = _running_max(entries.unionByName(moments, allowMissingColumns=True), names)
    return found.select("_event.*", *[F.col(f"_best.take.{c}").alias(c) for c in take])

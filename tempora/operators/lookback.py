"""What was known strictly before an event: last-N summaries, range counts, running totals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

HOUR = 3_600_000_000
DAY = 24 * HOUR


def micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def before(scope: Sequence[str], time: str, gap: int = 0, since: int | None = None) -> WindowSpec:
    """Rows of the scope earlier than time - gap (microseconds), strictly; since: at most so far back."""
    start = Window.unboundedPreceding if since is None else -since
    return Window.partitionBy(*scope).orderBy(micros(time)).rangeBetween(start, -gap - 1)


def look_back(rows: DataFrame, scope: Sequence[str], time: str, tie: str, eligible: Column, last: Mapping[int, Mapping[str, Column]], keep: Mapping[str, str] | None = None, gap: int = 0) -> DataFrame:
    """rows with sums over the last n eligible rows of the scope that are earlier than time - gap.

    last: n -> {output column: summand}. keep: output column -> column of the newest such row. Eligible rows are
    summed over rolling frames; then every row stands twice in one order of time, as what became known at its time
    and as what is asked at time - gap, and the newest answer is carried forward. rows is read once, nothing is
    joined, and both windows need a shuffle by the scope only, or by a part of it that the rows already have.
    Nothing found, or a null in the scope: sums are null. Columns of the scope must not be those of the output.
    """
    usable = F.coalesce(eligible, F.lit(False)) & F.col(time).isNotNull()
    for c in scope:
        usable &= F.col(c).isNotNull()
    order = Window.partitionBy(*scope, "_look_usable").orderBy(F.col(time), F.col(tie))
    names = [name for sums in last.values() for name in sums] + list(keep or {})
    rolled = [F.sum(e).over(order.rowsBetween(1 - n, 0)).alias(name) for n, sums in last.items() for name, e in sums.items()]
    kept = [F.col(c).alias(name) for name, c in (keep or {}).items()]
    known = rows.withColumn("_look_usable", usable).withColumn("_look_known", F.struct(*rolled, *kept))
    twice = known.select("*", F.explode(F.when(F.col("_look_usable"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_look_told"))
    told = F.col("_look_told") == 1
    # an answer keeps only the scope of its row
    thin = [F.col(c) if c in scope else F.when(~told, F.col(c)).alias(c) for c in rows.columns]
    both = twice.select(*thin, F.when(told, micros(time)).otherwise(micros(time) - gap).alias("_look_at"), "_look_told", F.col(tie).alias("_look_tie"), F.when(told, F.col("_look_known")).alias("_look_known"))
    sofar = Window.partitionBy(*scope).orderBy("_look_at", "_look_told", "_look_tie").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_look_newest", F.last("_look_known", ignorenulls=True).over(sofar)).where("_look_told = 0")
    return found.select(*rows.columns, *[F.col(f"_look_newest.{n}").alias(n) for n in names])


def range_counts(rows: DataFrame, scope: Sequence[str], time: str, eligible: Column, spans: Mapping[str, int], gap: int = 0) -> DataFrame:
    """Eligible rows in [time - span, time - gap), for each name -> span in microseconds."""
    counts = {name: F.coalesce(F.sum(F.when(eligible, 1)).over(before(scope, time, gap, span)), F.lit(0)).cast("long") for name, span in spans.items()}
    return rows.withColumns(counts)


def totals_before(rows: DataFrame, time: str, eligible: Column, sums: Mapping[str, Column]) -> DataFrame:
    """Running totals over all rows strictly earlier, without a window over all rows.

    Rows are summed by hour; the running totals of the hours - a small table - are windowed and joined back, and
    only an hour's own rows are windowed together. Rows without a time have no totals and leave.
    """
    hour = F.date_trunc("hour", F.col(time).cast("timestamp"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    hourly = rows.groupBy(hour.alias("_hour")).agg(*[zero(F.sum(F.when(eligible, e))).alias(f"_d_{n}") for n, e in sums.items()])
    upto = Window.orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    offsets = hourly.select("_hour", *[zero(F.sum(f"_d_{n}").over(upto)).alias(f"_o_{n}") for n in sums])
    own = before(["_hour"], time)
    within = rows.withColumn("_hour", hour).withColumns({f"_w_{n}": zero(F.sum(F.when(eligible, e)).over(own)) for n, e in sums.items()})
    out = within.join(offsets, "_hour")
    return out.withColumns({n: (F.col(f"_o_{n}") + F.col(f"_w_{n}")).cast("long") for n in sums}).drop("_hour", *[f"_{p}_{n}" for p in "ow" for n in sums])

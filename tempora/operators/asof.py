"""As-of joins: the newest observation that was known, valid and young enough at an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.operators.intervals import greatest_valid


def as_of(events: DataFrame, observations: DataFrame, on: Sequence[str], time: str, observed: str, take: Sequence[str], strict: bool = True, tie: Sequence[str] = ()) -> DataFrame:
    """events with the columns `take` of the newest observation of the same key, by one union and window.

    No row is multiplied: both tables are sorted together and the newest observation is carried forward. Ties
    of `observed` go to the greatest `tie`. strict: an observation at the event's own time isn't known yet.
    """
    payload = F.struct(*[F.col(c).alias(c) for c in take])
    left = events.select(F.struct("*").alias("_e"), *[F.col(k).alias(f"_{k}") for k in on], F.col(time).cast("timestamp").alias("_t"), F.lit(None).cast(observations.select(payload.alias("p")).schema["p"].dataType).alias("_p"), F.lit(0 if strict else 2).alias("_o"), F.lit(None).cast(observations.select(F.struct(F.lit(0), *tie).alias("p")).schema["p"].dataType).alias("_tie"))
    right = observations.select(F.lit(None).cast(left.schema["_e"].dataType).alias("_e"), *[F.col(k).alias(f"_{k}") for k in on], F.col(observed).cast("timestamp").alias("_t"), payload.alias("_p"), F.lit(1).alias("_o"), F.struct(F.lit(0), *tie).alias("_tie"))
    order = Window.partitionBy(*[f"_{k}" for k in on]).orderBy("_t", "_o", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    carried = left.unionByName(right).withColumn("_last", F.last("_p", ignorenulls=True).over(order))
    return carried.where("_e IS NOT NULL").select("_e.*", *[F.col(f"_last.{c}").alias(c) for c in take])


def as_of_valid(events: DataFrame, observations: DataFrame, on: Sequence[str], key: str | Sequence[str], time: str, observed: str, until: str, take: Sequence[str], tie: Sequence[str] = (), valid_from: str | None = None) -> DataFrame:
    """events (unique `key`) with `take` of the newest observation of the same `on` that was known and valid.

    Known: observed < time. Valid: valid_from <= time < until; without valid_from from the start, a null until is
    open. Of those observed at one time the greatest valid_from counts, then the greatest `tie`. A null in `on`, time,
    observed or valid_from finds nothing.
    """
    known = F.timestamp_micros(F.unix_micros(F.col(observed).cast("timestamp")) + 1)
    start = known if valid_from is None else F.when(F.col(valid_from).isNotNull(), F.greatest(known, F.col(valid_from).cast("timestamp")))
    order = [F.col(c) for c in (observed, *([valid_from] if valid_from else []), *tie)]
    return greatest_valid(events, observations, on, [key] if isinstance(key, str) else key, time, F.when(F.col(observed).isNotNull(), start), F.col(until), order, take)


def as_of_days(events: DataFrame, observations: DataFrame, on: Sequence[str], time: str, observed: str, days: int, take: Sequence[str], tie: Sequence[str] = ()) -> DataFrame:
    """events with `take` of the newest observation of an earlier day, unless it is more than `days` days old.

    Where the newest is too old, every other is, so that one pass of as_of finds it.
    """
    start = F.date_trunc("day", F.col(time).cast("timestamp"))
    found = as_of(events.withColumn("_day", start), observations.withColumn("_seen", F.col(observed)), on, "_day", observed, ["_seen", *take], tie=tie)
    young = F.datediff(F.col("_day"), F.to_date("_seen")) <= days
    return found.select(*events.columns, *[F.when(young, F.col(c)).alias(c) for c in take])


def first_of_current_run(rows: DataFrame, key: Sequence[str], time: Sequence[str], value: str, out: str) -> DataFrame:
    """rows with the time at which the value they hold began its unbroken run (a gap-and-island)."""
    by = Window.partitionBy(*key).orderBy(*time)
    changed = F.when(F.lag(value).over(by).eqNullSafe(F.col(value)), 0).otherwise(1)
    marked = rows.withColumn("_changed", F.when(F.row_number().over(by) == 1, 1).otherwise(changed))
    marked = marked.withColumn("_run", F.sum("_changed").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    run = Window.partitionBy(*key, "_run")
    return marked.withColumn(out, F.min(time[0]).over(run)).drop("_changed", "_run")


def _runs(obs: DataFrame, on: Sequence[str]) -> DataFrame:
    """on, _o, _v of every observation with _first, the earliest of its value after the last of another one, and
    _latest, the greatest _f up to it. One pass over each key's moments, which carries where the run began."""
    moments = obs.groupBy(*on, "_o").agg(F.collect_set("_v").alias("_set"), F.max("_f").alias("_f"))
    by = Window.partitionBy(*on).orderBy("_o")
    upto = by.rowsBetween(Window.unboundedPreceding, 0)
    before = F.struct(F.lag("_o").over(by).alias("o"), F.lag("_set").over(by).alias("set"), F.col("_o").alias("first"))
    marked = moments.withColumns({"_alone": F.size("_set") == 1, "_before": before, "_latest": F.max("_f").over(upto)})
    goes_on = F.col("_alone") & F.coalesce(F.col("_before.set") == F.col("_set"), F.lit(False))
    carried = marked.withColumn("_run", F.last(F.when(~goes_on, F.col("_before")), ignorenulls=True).over(upto))
    each = carried.withColumn("_run_before", F.lag("_run").over(by)).withColumn("_v", F.explode("_set"))
    began = F.when(F.col("_alone"), F.col("_run")).when(F.col("_before.set") == F.array("_v"), F.col("_run_before")).otherwise(F.col("_before"))
    shared = F.coalesce(F.array_contains(began["set"], F.col("_v")), F.lit(False))  # the other value and this one at one moment
    return each.select(*on, "_o", "_v", F.when(shared, began["o"]).otherwise(began["first"]).alias("_first"), "_latest")


def first_of_current_value(events: DataFrame, observations: DataFrame, on: Sequence[str], key: Sequence[str], time: str, at: str, value: str, observed: str, valid_from: str, out: str) -> DataFrame:
    """events (unique `key`) with `out`: when the value that an event holds, observed at `at`, was first observed
    after the last earlier observation of another value.

    observations have `on`, observed, valid_from and `value`; one counts at an event if valid_from <= time. The run of
    a value is worked out once for each observation. Only events that come before the valid_from of an observation
    that is already made - it doesn't count for them, and runs on either side of it may be one - are joined with the
    observations of their key. Rows with a null among these columns count nowhere; events without a value get null.
    """
    on, key = list(on), list(key)
    obs = observations.select(*on, F.col(observed).alias("_o"), F.col(valid_from).alias("_f"), F.col(value).alias("_v")).dropna()
    asked = events.where(F.col(value).isNotNull()).select(*key, *[c for c in on if c not in key], F.col(time).alias("_time"), F.col(at).alias("_o"), F.col(value).alias("_v"))
    told = asked.join(_runs(obs, on), [*on, "_o", "_v"])
    plain = told.where("_latest <= _time").select(*key, F.col("_first").alias(out))
    late = told.where("_latest > _time").select(*key, *[c for c in on if c not in key], "_time", F.col("_o").alias("_at"), F.col("_v").alias("_own"))
    seen = late.join(obs, on).where("_f <= _time AND _o <= _at")
    other = F.max(F.when((F.col("_v") != F.col("_own")) & (F.col("_o") < F.col("_at")), F.col("_o")))
    mine = F.array_sort(F.collect_set(F.when(F.col("_v") == F.col("_own"), F.col("_o"))))
    some = seen.groupBy(*key).agg(other.alias("_other"), mine.alias("_mine"))
    rest = some.select(*key, F.get(F.filter("_mine", lambda o: F.col("_other").isNull() | (o >= F.col("_other"))), F.lit(0)).alias(out))
    return events.join(plain.unionByName(rest), key, "left")

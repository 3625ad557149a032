"""When to ask a source again: budgets, cached seasons, forecast windows, retries."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta
from typing import TypeVar
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

T = TypeVar("T")
ZONE = ZoneInfo("Europe/Zurich")
HORIZON_DAYS = 15


@dataclass(frozen=True)
class Plan:
    fetch: bool
    reason: str


@dataclass(frozen=True)
class Budget:
    reserve: int
    every_minutes: int
    watch_hours: int


def plan_fetch(now: datetime, has_key: bool, last_at: datetime | None, remaining: int | None, budget: Budget, kickoffs: Sequence[datetime], force: bool = False) -> Plan:
    """Whether a run may spend a credit. The first rule that applies decides."""
    age = None if last_at is None else now - last_at
    local = lambda t: t.astimezone(ZONE).date()
    near = [k for k in kickoffs if timedelta(0) < k - now <= timedelta(hours=budget.watch_hours)]
    low = remaining is not None and remaining <= budget.reserve
    rules: list[tuple[bool, bool, str]] = [
        (not has_key, False, "no key"),
        (low and age is not None and age < timedelta(days=1), False, f"{remaining} credits left, reserve {budget.reserve}"),
        (low, True, "daily probe"),
        (force, True, "forced"),
        (last_at is None or local(last_at) < local(now), True, "first fetch of the day"),
        (not near, False, f"no match within {budget.watch_hours} h"),
        (age is not None and age < timedelta(minutes=budget.every_minutes), False, f"less than {budget.every_minutes} min since the last fetch"),
    ]
    return next((Plan(go, why) for holds, go, why in rules if holds), Plan(True, "a watched match is near"))


@dataclass(frozen=True)
class Quota:
    """Credits as an answer's headers tell them; what is missing or no number is unknown."""

    remaining: int | None = None
    used: int | None = None
    last: int | None = None

    @classmethod
    def of(cls, headers: Mapping[str, str]) -> Quota:
        def number(what: str) -> int | None:
            told = {k.lower(): v for k, v in headers.items()}.get(f"x-requests-{what}")
            try:
                return None if told is None else int(float(told))
            except (TypeError, ValueError, OverflowError):
                return None

        return cls(number("remaining"), number("used"), number("last"))


def fetch_state(fetches: DataFrame, source: str, reserve: int) -> DataFrame:
    """endpoint, request_params, last_at, remaining for every request that was made: when it counts as last made, and
    the account's credits.

    Credits belong to the account: those that its newest answer tells, if any. The cadence belongs to the request; at
    the reserve, it is that of the account, so that one probe a day is left and not one for each request.
    fetches: source, endpoint, request_params, ingested_at, remaining.
    """
    live = fetches.where(F.col("source") == source)
    account = live.agg(F.max("ingested_at").alias("_any"), F.max_by("remaining", "ingested_at").alias("remaining"))  # one row
    own = live.groupBy("endpoint", "request_params").agg(F.max("ingested_at").alias("_own"))
    low = F.coalesce(F.col("remaining") <= reserve, F.lit(False))
    return own.crossJoin(F.broadcast(account)).select("endpoint", "request_params", F.when(low, F.col("_any")).otherwise(F.col("_own")).alias("last_at"), "remaining")


def retry(call: Callable[[], T], transient: Callable[[Exception], bool], attempts: int = 4, first_wait: float = 1.0, sleep: Callable[[float], None] = time.sleep) -> T:
    """Call again after a transient failure, waiting twice as long each time; other failures pass at once."""
    for n in range(attempts):
        try:
            return call()
        except Exception as e:
            if n + 1 == attempts or not transient(e):
                raise
            sleep(first_wait * 2**n)
    raise AssertionError


def transient_status(status: int) -> bool:
    return status == 429 or status >= 500


def cached_seasons(raw: DataFrame, source: str, day: str) -> DataFrame:
    """endpoint, season of stored answers by season that need no other fetch on `day`: the season has ended, and the
    competition's own stored answer tells of a later one that has begun.

    raw: source, endpoint, request_params and payload (JSON), ingestion_date; rows after `day` and of other sources
    count nowhere. Whether any answer of the competition is later is a look-up by its newest start.
    """
    at = lambda column, path: F.get_json_object(column, path)
    known = raw.where((F.col("source") == source) & (F.col("ingestion_date") <= F.lit(day).cast("date")))
    ended = F.coalesce(at("payload", "$.season.endDate"), at("payload", "$.matches[0].season.endDate"))
    held = known.select("endpoint", F.regexp_replace("endpoint", "/(matches|teams)$", "").alias("_root"), at("request_params", "$.season").alias("season"), ended.alias("_ended"))
    begun = known.groupBy(F.col("endpoint").alias("_root")).agg(F.max(F.left(at("payload", "$.currentSeason.startDate"), F.lit(4))).alias("_begun"))
    return held.where((F.col("season").isNotNull()) & (F.col("_ended") < day)).join(begun, "_root").where("_begun > season").select("endpoint", "season").distinct()


def season_requests(wanted: DataFrame, cached: DataFrame) -> DataFrame:
    """The wanted (endpoint, season) that aren't cached; a null season is the current one and always asked."""
    same = wanted["endpoint"].eqNullSafe(cached["endpoint"]) & (wanted["season"] == cached["season"])
    return wanted.join(cached, same, "left_anti")


def missing_seasons(wanted: DataFrame, stored: DataFrame, current: DataFrame) -> DataFrame:
    """Seasons to fetch: (competition_code, season_start) of `wanted` without those that are stored, have ended and
    are older than the competition's current season."""
    closed = stored.alias("s").join(current.alias("c"), "competition_code").where((F.col("s.season_end") < F.col("c.current_start")) & (F.col("s.season_start") < F.col("c.current_start")))
    return wanted.join(closed.select("competition_code", "season_start"), ["competition_code", "season_start"], "left_anti")


def forecast_requests(games: DataFrame, venues: DataFrame, day: str) -> DataFrame:
    """One request per resolved venue: first and last day of its unplayed matches inside the horizon."""
    soon = games.where(~F.col("is_finished") & F.col("match_date").between(F.lit(day).cast("date"), F.date_add(F.lit(day).cast("date"), HORIZON_DAYS)))
    known = venues.where("coordinates_status = 'RESOLVED'")
    return soon.join(known, soon["home_team_id"] == known["team_id"]).groupBy("team_id", "latitude", "longitude").agg(F.min("match_date").alias("first_day"), F.max("match_date").alias("last_day"))


def missing_crests(teams: DataFrame, stored: DataFrame) -> DataFrame:
    return teams.where(F.col("crest_url").isNotNull()).join(stored.select(F.col("url").alias("crest_url")), "crest_url", "left_anti").select("crest_url").distinct()


def upcoming(games: DataFrame, clock, hours: int) -> DataFrame:
    """Unplayed matches that kick off within `hours` of the pinned clock."""
    until = clock.now() + F.make_dt_interval(hours=F.lit(hours))
    return games.where(~F.col("is_finished") & (F.col("utc_kickoff") > clock.now()) & (F.col("utc_kickoff") <= until)).orderBy("utc_kickoff", "match_id")


def unplayed(games: DataFrame, first: str | None = None, last: str | None = None) -> DataFrame:
    """Unplayed matches in order of kick-off, those of the days between first and last where these are given."""
    out = games.where(~F.col("is_finished"))
    if first is not None and last is not None:
        out = out.where(F.col("match_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return out.select("match_id", "utc_kickoff", "match_date", "home_team_id").orderBy("utc_kickoff", "match_id")


def kickoffs_of(games: DataFrame, watched: DataFrame) -> DataFrame:
    """match_id, utc_kickoff of the watched matches (match_id), in order; none where none is watched."""
    return games.join(watched.select("match_id").distinct(), "match_id", "left_semi").select("match_id", "utc_kickoff").orderBy("utc_kickoff", "match_id")


def clubs(teams: DataFrame) -> DataFrame:
    """What the sources need to know of each club."""
    return teams.select("team_id", "name", "venue", "country", "crest_url").orderBy("team_id")

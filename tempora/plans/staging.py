"""From raw JSON to typed staging tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.operators.latest import keep_latest, newest

_SCORE = "struct<home:int,away:int>"
MATCH = f"struct<id:bigint,utcDate:timestamp,status:string,stage:string,matchday:int,lastUpdated:timestamp,competition:struct<code:string>,season:struct<id:bigint>,homeTeam:struct<id:bigint>,awayTeam:struct<id:bigint>,score:struct<winner:string,duration:string,fullTime:{_SCORE},halfTime:{_SCORE},regularTime:{_SCORE}>>"
PLAYER = "struct<id:bigint,name:string,position:string,dateOfBirth:string,nationality:string,shirtNumber:int>"
TEAM = f"struct<id:bigint,name:string,shortName:string,tla:string,crest:string,founded:int,clubColors:string,venue:string,website:string,area:struct<name:string>,runningCompetitions:array<struct<code:string>>,coach:struct<id:bigint,name:string,dateOfBirth:string,nationality:string,contract:struct<start:string>>,squad:array<{PLAYER}>>"
ROW = "struct<position:int,team:struct<id:bigint>,playedGames:int,won:int,draw:int,lost:int,points:int,goalsFor:int,goalsAgainst:int,goalDifference:int>"
STANDINGS = f"struct<season:struct<id:bigint>,standings:array<struct<type:string,table:array<{ROW}>>>>"
HOURLY = "struct<timezone:string,hourly:struct<time:array<string>,temperature_2m:array<double>,precipitation:array<double>,precipitation_probability:array<int>,wind_speed_10m:array<double>,weather_code:array<int>>>"
ODDS = "array<struct<id:string,commence_time:timestamp,home_team:string,away_team:string,bookmakers:array<struct<key:string,title:string,last_update:timestamp,markets:array<struct<key:string,last_update:timestamp,outcomes:array<struct<name:string,price:decimal(9,3)>>>>>>>>"


def seasonal() -> Column:
    """The answer was asked for by season: it may be stored on any earlier day."""
    return F.coalesce(F.array_contains(F.json_object_keys("request_params"), "season"), F.lit(False))


def _of_day(clock: Clock) -> Column:
    return (F.col("ingestion_date") == clock.today()) | ((F.col("ingestion_date") <= clock.today()) & seasonal())


def matches(raw: DataFrame, clock: Clock) -> DataFrame:
    """One row a match: the newest of the day's answers and of earlier answers by season.

    The 90-minute score is the regular-time score, or the full-time one of a match without extra time. Matches
    whose teams aren't known yet are left out.
    """
    found = raw.where(F.col("endpoint").like("%/matches") & _of_day(clock))
    m = found.select("ingestion_date", "ingested_at", F.explode(F.from_json("payload", f"matches array<{MATCH}>")["matches"]).alias("m"))
    keyed = m.select("*", F.col("m.id").alias("match_id"), F.col("m.lastUpdated").alias("last_updated"))
    one = keep_latest(keyed.where("match_id IS NOT NULL"), ["match_id"], newest("last_updated", "ingestion_date", "ingested_at"))
    regular = lambda side: F.coalesce(F.col(f"m.score.regularTime.{side}"), F.when(F.col("m.score.duration") == "REGULAR", F.col(f"m.score.fullTime.{side}")))
    return one.where("m.homeTeam.id IS NOT NULL AND m.awayTeam.id IS NOT NULL").select(
        "match_id", F.col("m.season.id").alias("season_id"), F.col("m.competition.code").alias("competition_code"), F.col("m.utcDate").alias("utc_kickoff"),
        "m.status", "m.stage", "m.matchday", F.col("m.homeTeam.id").alias("home_team_id"), F.col("m.awayTeam.id").alias("away_team_id"),
        F.col("m.score.fullTime.home").alias("home_goals"), F.col("m.score.fullTime.away").alias("away_goals"), F.col("m.score.halfTime.home").alias("home_goals_ht"),
        F.col("m.score.halfTime.away").alias("away_goals_ht"), "m.score.winner", "m.score.duration", "last_updated", clock.today().alias("ingestion_date"),
        regular("home").alias("home_goals_90min"), regular("away").alias("away_goals_90min"),
    )


def team_elements(raw: DataFrame) -> DataFrame:
    """raw rows with t: an element of a list of teams, or the payload itself where it is one team."""
    single = F.array(F.from_json("payload", TEAM))
    listed = F.coalesce(F.from_json("payload", f"teams array<{TEAM}>")["teams"], F.array().cast(f"array<{TEAM}>"))
    return raw.select("*", F.explode(F.when(F.col("endpoint").rlike("^teams/[0-9]+$"), single).otherwise(listed)).alias("t"))


def teams(raw: DataFrame, clock: Clock) -> DataFrame:
    """One row a club; an answer that isn't by season goes first."""
    found = raw.where((F.col("endpoint").like("%/teams") | F.col("endpoint").like("teams/%")) & _of_day(clock))
    keyed = team_elements(found).withColumns({"team_id": F.col("t.id"), "_seasonal": seasonal()}).where("team_id IS NOT NULL")
    one = keep_latest(keyed, ["team_id"], [F.col("_seasonal").asc(), *newest("ingestion_date", "ingested_at")])
    codes = F.coalesce(F.array_sort(F.transform("t.runningCompetitions", lambda c: c["code"])), F.array().cast("array<string>"))
    return one.select("team_id", "t.name", F.col("t.shortName").alias("short_name"), "t.tla", F.col("t.crest").alias("crest_url"), "t.founded", F.col("t.clubColors").alias("club_colors"), "t.venue", "t.website", F.col("t.area.name").alias("area_name"), codes.alias("competitions"), clock.today().alias("ingestion_date"))


def standings(raw: DataFrame, clock: Clock) -> DataFrame:
    """Season x team of the day, from the newest answer of each request, total tables only."""
    day = raw.where(F.col("endpoint").like("%/standings") & (F.col("ingestion_date") == clock.today()))
    newest_answer = keep_latest(day, ["endpoint", "request_params"], newest("ingested_at"))
    parsed = newest_answer.select("ingested_at", F.from_json("payload", STANDINGS).alias("p"))
    groups = parsed.select("ingested_at", F.col("p.season.id").alias("season_id"), F.explode("p.standings").alias("g")).where("g.type = 'TOTAL'")
    table = groups.select("ingested_at", "season_id", F.explode("g.table").alias("r")).withColumn("team_id", F.col("r.team.id")).where("team_id IS NOT NULL")
    one = keep_latest(table, ["season_id", "team_id"], newest("ingested_at"))
    names = {"position": "position", "playedGames": "played_games", "won": "won", "draw": "draw", "lost": "lost", "points": "points", "goalsFor": "goals_for", "goalsAgainst": "goals_against", "goalDifference": "goal_difference"}
    return one.select("season_id", "team_id", *[F.col(f"r.{a}").alias(b) for a, b in names.items()], clock.today().alias("ingestion_date"))


def forecasts(raw: DataFrame, clock: Clock) -> DataFrame:
    """Venue x hour of the day: columnar arrays zipped by position. Only answers in GMT count.

    raw has venue_team_id beside the raw columns.
    """
    day = raw.where(F.col("ingestion_date") == clock.today()).withColumn("p", F.from_json("payload", HOURLY)).where("p.timezone = 'GMT'")
    fields = {"temperature_2m": "temperature_c", "precipitation": "precipitation_mm", "precipitation_probability": "precipitation_probability", "wind_speed_10m": "wind_speed_kmh", "weather_code": "weather_code"}
    zipped = F.arrays_zip(F.col("p.hourly.time").alias("time"), *[F.col(f"p.hourly.{a}").alias(b) for a, b in fields.items()])
    hours = day.select("venue_team_id", "ingestion_date", F.col("ingested_at").alias("fetched_at"), F.inline(zipped))
    return hours.where("time IS NOT NULL").withColumn("forecast_hour_utc", F.to_timestamp("time")).drop("time")


def odds(raw: DataFrame, staged: DataFrame | None = None) -> DataFrame:
    """Outcome rows of the fetches that aren't staged yet: four levels of lists, missing ones empty.

    Of several rows of one fetch, event, bookmaker, market and outcome the first in the answer counts.
    """
    fresh = raw if staged is None else raw.join(staged.select("raw_id").distinct(), "raw_id", "left_anti")
    e = fresh.where(F.col("payload").rlike(r"^\s*\[")).select("raw_id", "ingested_at", F.posexplode(F.from_json("payload", ODDS)).alias("at_e", "e"))
    b = e.select("*", F.posexplode("e.bookmakers").alias("at_b", "b"))  # a missing list explodes to nothing
    m = b.select("*", F.posexplode("b.markets").alias("at_m", "m")).where("m.key = 'h2h'")
    o = m.select("*", F.posexplode("m.outcomes").alias("at_o", "o"))
    role = F.when(F.col("o.name") == F.col("e.home_team"), "HOME").when(F.col("o.name") == F.col("e.away_team"), "AWAY").when(F.lower("o.name") == "draw", "DRAW")
    rows = o.select(
        "raw_id", F.col("ingested_at").alias("fetched_at"), F.col("e.id").alias("event_id"), F.col("e.commence_time").alias("commence_time"), F.col("e.home_team").alias("home_team_name"),
        F.col("e.away_team").alias("away_team_name"), F.col("b.key").alias("bookmaker_key"), F.coalesce("b.title", "b.key").alias("bookmaker_title"), F.col("m.key").alias("market_key"),
        F.coalesce("m.last_update", "b.last_update", "ingested_at").alias("source_updated_at"), role.alias("outcome_role"), F.col("o.name").alias("outcome_name"), F.col("o.price").alias("price"), F.struct("at_e", "at_b", "at_m", "at_o").alias("place"),
    )
    good = rows.where("outcome_role IS NOT NULL AND event_id IS NOT NULL AND commence_time IS NOT NULL AND price >= 1")
    return keep_latest(good, ["raw_id", "event_id", "bookmaker_key", "market_key", "outcome_role"], [F.col("place").asc()]).drop("place")

"""Synthetic matches over the events table: the same rows in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators.sides import points, unpivot_sides

#: After it, fixtures are not played yet.
PLAYED_UNTIL = "2024-01-25 00:00:00"


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """match_id, utc_kickoff, competition_code, season_id, is_finished, both teams and both scores."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    teams = events.agg((F.max("user_id") + 1).alias("u"))  # one row
    k = F.get_json_object("props", "$.k").cast("long")
    played = F.col("ts") < F.lit(PLAYED_UNTIL).cast("timestamp_ntz")
    scored = played & (F.col("k") % 11 != 0)
    e = events.withColumn("k", k).join(F.broadcast(teams))
    return e.select(
        F.col("event_id").alias("match_id"),
        F.col("ts").cast("timestamp").alias("utc_kickoff"),
        F.col("event_type").alias("competition_code"),
        F.floor((F.dayofmonth("ts") - 1) / 10).cast("long").alias("season_id"),
        played.alias("is_finished"),
        F.col("user_id").alias("home_team_id"),
        ((F.col("user_id") + 1 + F.col("k") % (F.col("u") - 1)) % F.col("u")).alias("away_team_id"),
        F.when(scored, F.col("k") % 5).cast("long").alias("home_goals"),
        F.when(scored, F.floor("value").cast("long") % 4).cast("long").alias("away_goals"),
    )


def appearances(games: DataFrame) -> DataFrame:
    """A match from each side, with the points of the side."""
    sides = unpivot_sides(games, {"team_id": ("home_team_id", "away_team_id"), "opponent_team_id": ("away_team_id", "home_team_id"), "goals_for": ("home_goals", "away_goals"), "goals_against": ("away_goals", "home_goals")})
    return sides.withColumn("points", points("goals_for", "goals_against").cast("long"))


MATCHES_SQL = """
matches AS (
  SELECT event_id AS match_id, ts AS utc_kickoff, event_type AS competition_code,
         CAST(floor((extract(day FROM ts) - 1) / 10) AS BIGINT) AS season_id,
         ts < TIMESTAMP '2024-01-25 00:00:00' AS is_finished,
         user_id AS home_team_id, (user_id + 1 + k % (u - 1)) % u AS away_team_id,
         CASE WHEN ts < TIMESTAMP '2024-01-25 00:00:00' AND k % 11 <> 0 THEN k % 5 END AS home_goals,
         CASE WHEN ts < TIMESTAMP '2024-01-25 00:00:00' AND k % 11 <> 0 THEN CAST(floor(value) AS BIGINT) % 4 END AS away_goals
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, max(user_id) OVER () + 1 AS u FROM events) e),
sides AS (
  SELECT match_id, utc_kickoff, competition_code, season_id, is_finished, true AS is_home, home_team_id AS team_id,
         away_team_id AS opponent_team_id, home_goals AS goals_for, away_goals AS goals_against FROM matches
  UNION ALL
  SELECT match_id, utc_kickoff, competition_code, season_id, is_finished, false, away_team_id, home_team_id, away_goals, home_goals FROM matches),
apps AS (
  SELECT *, CASE WHEN goals_for > goals_against THEN 3 WHEN goals_for = goals_against THEN 1 WHEN goals_for < goals_against THEN 0 END AS points FROM sides)
"""

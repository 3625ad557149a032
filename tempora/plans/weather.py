"""The forecast that was known before kick-off, or the reason why there is none."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.operators.latest import keep_latest, newest

HORIZON_DAYS = 15
VALUES = ["temperature_c", "precipitation_mm", "precipitation_probability", "wind_speed_kmh", "weather_code"]


def match_weather(games: DataFrame, forecasts: DataFrame, venues: DataFrame, clock: Clock) -> DataFrame:
    """One row a match. The hour is that of kick-off in UTC; all-null hours don't count."""
    hour = F.date_trunc("hour", "utc_kickoff")
    m = games.select("match_id", "home_team_id", "utc_kickoff", "match_date", hour.alias("kickoff_hour_utc"))
    usable = m.join(forecasts, (F.col("venue_team_id") == F.col("home_team_id")) & (F.col("forecast_hour_utc") == F.col("kickoff_hour_utc")))
    usable = usable.where((F.col("fetched_at") < F.col("utc_kickoff")) & F.col("temperature_c").isNotNull() & (F.col("ingestion_date") <= clock.today()))
    best = keep_latest(usable, ["match_id"], newest("ingestion_date", "fetched_at")).select("match_id", F.col("ingestion_date").alias("forecast_ingestion_date"), F.col("fetched_at").alias("forecast_fetched_at"), *VALUES)
    known = venues.select(F.col("team_id").alias("home_team_id"), "coordinates_status")
    rows = m.join(best, "match_id", "left").join(known, "home_team_id", "left")
    status = (
        F.when(F.col("forecast_fetched_at").isNotNull(), "AVAILABLE")
        .when(~F.col("coordinates_status").eqNullSafe("RESOLVED"), "VENUE_UNKNOWN")
        .when(F.col("match_date") > F.date_add(clock.today(), HORIZON_DAYS), "NOT_YET_AVAILABLE")
        .when(F.col("match_date") < clock.today(), "NOT_CAPTURED")
        .otherwise("MISSING")
    )
    return rows.select("match_id", F.col("home_team_id").alias("venue_team_id"), status.alias("weather_status"), "kickoff_hour_utc", "forecast_ingestion_date", "forecast_fetched_at", F.datediff("match_date", "forecast_ingestion_date").alias("lead_days"), *VALUES, clock.today().alias("as_of_date"))

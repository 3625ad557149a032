"""Dimensions and the match fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.clock import Clock

#: Domestic leagues that the source covers.
DOMESTIC = ["PL", "PD", "BL1", "SA", "FL1", "DED", "PPL", "ELC", "BSA"]


def dim_team(teams: DataFrame) -> DataFrame:
    """The current description of each club; a missing short name falls back to the name."""
    covered = F.arrays_overlap("competitions", F.array(*map(F.lit, DOMESTIC)))
    return teams.select("team_id", "name", F.coalesce("short_name", "name").alias("short_name"), "tla", F.col("area_name").alias("country"), "venue", "crest_url", "competitions", covered.alias("has_domestic_coverage"))


def outcome(home: str = "home_goals", away: str = "away_goals"):
    return F.when(F.col(home) > F.col(away), "HOME_WIN").when(F.col(home) < F.col(away), "AWAY_WIN").when(F.col(home) == F.col(away), "DRAW")


def fact_match(matches: DataFrame, teams: DataFrame, clock: Clock) -> DataFrame:
    """Matches of known teams. A finished match without goals stops the run."""
    known = teams.select("team_id")
    side = lambda c: known.withColumnRenamed("team_id", c)
    both = matches.join(side("home_team_id"), "home_team_id", "left_semi").join(side("away_team_id"), "away_team_id", "left_semi")
    finished = F.col("status") == "FINISHED"
    broken = finished & (F.col("home_goals").isNull() | F.col("away_goals").isNull())
    return both.select(
        "match_id", "season_id", "competition_code", "utc_kickoff", F.to_date("utc_kickoff").alias("match_date"), "stage", "matchday", "status",
        F.when(broken, F.raise_error(F.concat(F.lit("finished match without a score: "), F.col("match_id").cast("string"))).cast("boolean")).otherwise(finished).alias("is_finished"),
        (~finished & (F.col("utc_kickoff") > clock.now())).alias("is_upcoming"), "home_team_id", "away_team_id", "home_goals", "away_goals",
        (F.col("home_goals") - F.col("away_goals")).alias("goal_difference"), outcome().alias("outcome"),
    )


def dim_venue(teams: DataFrame, answers: DataFrame) -> DataFrame:
    """Venue of each club from its newest place search: a stadium if there is one, else the first hit.

    answers: team_id, osm (array of places), override coordinates or a reason why there are none.
    """
    stadium = F.element_at(F.filter("osm", lambda x: x["type"] == "stadium"), 1)
    pick = F.coalesce(F.when(F.size(F.filter("osm", lambda x: x["type"] == "stadium")) > 0, stadium), F.try_element_at("osm", F.lit(1)))
    lat, lon = F.coalesce("override_lat", pick["lat"].try_cast("double")), F.coalesce("override_lon", pick["lon"].try_cast("double"))
    status = F.when(lat.isNotNull() & lon.isNotNull(), "RESOLVED").when(F.col("reason").isNotNull(), "UNRESOLVABLE").otherwise("UNRESOLVED")
    reference = F.when(pick["osm_id"].isNotNull(), F.concat(pick["osm_type"], F.lit("/"), pick["osm_id"].cast("string")))
    joined = teams.join(answers, "team_id", "left")
    return joined.select("team_id", F.col("venue").alias("venue_name"), lat.alias("latitude"), lon.alias("longitude"), reference.alias("osm_reference"), status.alias("coordinates_status"))

"""World rankings: clubs resolved by names and country, and the ranking that counted at kick-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.functions.names import STOP_RANKING, tokens
from tempora.operators.intervals import greatest_begun
from tempora.operators.match import unique_pairs
from tempora.operators.sides import pivot_sides, unpivot_sides

MAX_AGE_DAYS = 35


def _key(name: Column) -> Column:
    return F.array_join(F.array_sort(tokens(name, STOP_RANKING, False)), " ")


def check_reviewed(reviewed: DataFrame) -> None:
    """A reviewed slug names one team. Raises for the first few that name several."""
    twice = reviewed.groupBy("club_slug").agg(F.count_distinct("team_id").alias("n")).where("n > 1").orderBy("club_slug").limit(5).collect()
    if twice:
        raise ValueError("reviewed for more than one team: " + ", ".join(r["club_slug"] for r in twice))


def resolve(clubs: DataFrame, ranked: DataFrame, reviewed: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """team_id, club_slug, method: reviewed pairs of known clubs and ranked slugs, then pairs by name and country.

    clubs: team_id, name, short_name, country; ranked: club_slug, club_name, country; reviewed: team_id, club_slug;
    aliases: team_id, alias. A club is met by any of its spellings; a slug that a reviewed pair claims is out. A
    pair counts if the club meets no other slug, and the slug no other such club. A club without a country meets
    none. A reviewed pair whose slug isn't ranked leaves its club to the names.
    """
    clubs = clubs if "short_name" in clubs.columns else clubs.withColumn("short_name", F.lit(None).cast("string"))
    known = reviewed.select("team_id", "club_slug").distinct().join(clubs.select("team_id").distinct(), "team_id", "left_semi").join(ranked.select("club_slug").distinct(), "club_slug", "left_semi")
    own = clubs.select("team_id", F.explode(F.array("name", "short_name")).alias("spelling"), "country")
    if aliases is not None:
        own = own.unionByName(clubs.select("team_id", "country").join(aliases.select("team_id", F.col("alias").alias("spelling")), "team_id"))
    spelled = own.where("spelling <> ''").select("team_id", _key(F.col("spelling")).alias("n"), _key(F.coalesce("country", F.lit(""))).alias("c")).where("c <> ''")
    open_clubs = spelled.join(known.select("team_id"), "team_id", "left_anti")
    open_ranked = ranked.join(known.select("club_slug"), "club_slug", "left_anti").select("club_slug", _key(F.col("club_name")).alias("n"), _key(F.col("country")).alias("c"))
    found = unique_pairs(open_clubs, open_ranked, ["c", "n"], "team_id", "club_slug")
    return known.select("team_id", "club_slug", F.lit("REVIEWED").alias("method")).unionByName(found.withColumn("method", F.lit("EXACT_COUNTRY")))


def team_rankings(pages: DataFrame, mapping: DataFrame) -> DataFrame:
    """Rows of mapped teams. pages: raw_id, source_url, observed_at beside the parsed columns."""
    return pages.join(mapping.select("club_slug", "team_id"), "club_slug").select("raw_id", "team_id", "ranking_date", "observed_at", "source_url", "world_rank", "rating_points")


def with_rankings(games: DataFrame, rankings: DataFrame) -> DataFrame:
    """home_ and away_ rank and points of the newest ranking from an earlier day, at most 35 days old.

    A ranking is valid from the day after its date, once it was observed, for MAX_AGE_DAYS days. Where the newest is
    too old every other is, so that both sides find theirs in one pass over what has begun.
    """
    take = {"world_rank": "{}_world_rank", "rating_points": "{}_world_rating_points", "ranking_date": "audit_{}_world_ranking_date", "observed_at": "audit_{}_world_ranking_observed_at", "source_url": "audit_{}_world_ranking_source"}
    day = lambda n: F.date_add("_d", n).cast("timestamp")
    start = F.greatest(F.timestamp_micros(F.unix_micros("_o") + 1), day(1))
    r = rankings.where("observed_at IS NOT NULL AND ranking_date IS NOT NULL").select("team_id", F.col("raw_id").alias("_id"), F.col("ranking_date").alias("_d"), F.col("observed_at").cast("timestamp").alias("_o"), *take)
    sides = unpivot_sides(games.select("match_id", "utc_kickoff", "home_team_id", "away_team_id"), {"team_id": ("home_team_id", "away_team_id")})
    found = greatest_begun(sides, r, ["team_id"], "utc_kickoff", start, [F.col("_d"), F.col("_o"), F.col("_id")], ["_d", *take])
    valid = found.where(F.col("utc_kickoff").cast("timestamp") < day(MAX_AGE_DAYS + 1))
    games = pivot_sides(games, valid, "match_id", "is_home", list(take)).withColumnsRenamed({f"{side}_{c}": n.format(side) for side in ("home", "away") for c, n in take.items()})
    return games.withColumns({"world_rating_points_difference": F.col("home_world_rating_points") - F.col("away_world_rating_points"), "world_rank_advantage_home": F.col("away_world_rank") - F.col("home_world_rank")})

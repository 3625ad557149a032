"""The checks that a run must pass before its tables are published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.operators.lookback import before
from tempora.operators.quality import CRITICAL, WARNING, Check
from tempora.operators.sides import unpivot_sides
from tempora.plans.facts import outcome
from tempora.plans.odds import HIGH_MARGIN, HIGH_PRICE, LOW_MARGIN, LOW_PRICE, PRICES

T = dict[str, DataFrame]


def _without(left: str, right: str, key: str):
    return lambda t: t[left].join(t[right].select(key), key, "left_anti")


def _beside(left: str, condition: str):
    return lambda t: t[left].drop("utc_kickoff").join(t["fact_match"].select("match_id", "utc_kickoff"), "match_id").where(condition)


def _many(table: str, key: str, wrong: str):
    return lambda t: t[table].groupBy(key).agg(F.count("*").alias("n")).where(wrong)


def _too_much_form(t: T) -> DataFrame:
    """Form rows with more matches than the team had finished; counted by a window, not row by row."""
    sides = unpivot_sides(t["fact_match"].select("match_id", "utc_kickoff", "is_finished", "home_team_id", "away_team_id"), {"team_id": ("home_team_id", "away_team_id")})
    done = sides.withColumn("_done", F.coalesce(F.sum(F.when(F.col("is_finished"), 1)).over(before(["team_id"], "utc_kickoff")), F.lit(0)))
    return t["team_match_form"].join(done.select("match_id", "team_id", "_done"), ["match_id", "team_id"]).where("matches_considered > _done")


def _referenced(t: T) -> DataFrame:
    teams = t["fact_match"].select(F.col("home_team_id").alias("team_id")).union(t["fact_match"].select("away_team_id")).distinct()
    return teams.join(t["dim_team"].select("team_id"), "team_id", "left_anti")


def checks(clock: Clock) -> list[Check]:
    """All 31. Conditions on one table are counted in one pass over it."""
    c = F.col
    price = lambda p: ~c(p).between(LOW_PRICE, HIGH_PRICE)
    total = lambda a, b, d: F.abs(c(a) + c(b) + c(d) - 1) >= 0.001
    fair = total("home_prob_fair", "draw_prob_fair", "away_prob_fair")
    label = outcome("label_home_goals_90min", "label_away_goals_90min")
    late = lambda side: (c(f"audit_{side}_world_ranking_observed_at") >= c("utc_kickoff")) | (c(f"audit_{side}_world_ranking_date") >= F.to_date("utc_kickoff")) | (F.datediff(F.to_date("utc_kickoff"), c(f"audit_{side}_world_ranking_date")) > 35)
    odd = lambda side: (c(f"{side}_world_rank") <= 0) | (c(f"{side}_world_rating_points") <= 0) | (c(f"{side}_world_rank").isNull() != c(f"{side}_world_rating_points").isNull())
    any_of = lambda *xs: F.greatest(*[F.coalesce(x, F.lit(False)) for x in xs])

    def fresh(t: T) -> DataFrame:
        """A fetch is due if a match kicks off within a day; one row either way."""
        hours = (F.unix_timestamp("utc_kickoff") - F.unix_timestamp(clock.now())) / 3600
        soon = t["fact_match"].agg(F.coalesce(F.bool_or(~c("is_finished") & hours.between(0, 24)), F.lit(False)).alias("due"))
        fetched = t["raw_odds"].agg(F.max("ingested_at").alias("at"))
        young = F.unix_timestamp(clock.now()) - F.unix_timestamp("at") < 86_400
        return fetched.crossJoin(soon).select(F.coalesce(F.concat(F.lit("newest fetch "), F.date_format("at", "yyyy-MM-dd HH:mm")), F.lit("no fetch yet")).alias("observed"), (c("at").isNotNull() & (~c("due") | young)).alias("passed"))

    def window(t: T) -> DataFrame:
        full = F.round(100 * F.count_if(c("matches_considered") >= 3) / F.nullif(F.count("*"), F.lit(0)), 1)
        return t["team_match_form"].agg(F.concat(F.coalesce(full.cast("string"), F.lit("no")), F.lit(" % with 3 matches or more")).alias("observed"), F.coalesce(F.avg("matches_considered") >= 3, F.lit(False)).alias("passed"))

    def kept(t: T) -> DataFrame:
        n = lambda name, out: t[name].agg(F.count("*").alias(out))
        both = n("staging_matches", "s").crossJoin(n("fact_match", "f"))
        return both.select(F.concat(c("s").cast("string"), F.lit(" staged, "), c("f").cast("string"), F.lit(" curated")).alias("observed"), (c("s") == c("f")).alias("passed"))

    sides = F.concat_ws(" vs ", "home_team_name", "away_team_name")
    return [
        Check("fact_match_not_empty", "fact_match", CRITICAL, F.lit(True), at_least=1),
        Check("match_id_unique", "fact_match", CRITICAL, _many("fact_match", "match_id", "n > 1")),
        Check("no_match_lost_in_transformation", "fact_match", CRITICAL, measure=kept),
        Check("teams_differ", "fact_match", CRITICAL, c("home_team_id") == c("away_team_id")),
        Check("finished_matches_have_an_outcome", "fact_match", CRITICAL, c("is_finished") & c("outcome").isNull()),
        Check("outcome_matches_the_goals", "fact_match", CRITICAL, c("outcome").isNotNull() & (c("outcome") != outcome())),
        Check("goals_are_plausible", "fact_match", WARNING, any_of(~c("home_goals").between(0, 15), ~c("away_goals").between(0, 15))),
        Check("every_match_has_two_form_rows", "team_match_form", CRITICAL, _many("team_match_form", "match_id", "n <> 2")),
        Check("form_counts_add_up", "team_match_form", CRITICAL, c("wins_last_5") + c("draws_last_5") + c("losses_last_5") != c("matches_considered")),
        Check("form_uses_no_future_matches", "team_match_form", CRITICAL, _too_much_form),
        Check("form_window_is_well_populated", "team_match_form", WARNING, measure=window),
        Check("dim_team_complete", "dim_team", CRITICAL, _referenced),
        Check("every_match_has_a_weather_row", "match_weather", CRITICAL, _without("fact_match", "match_weather", "match_id"), unit=" matches without a weather row"),
        Check("weather_fetched_before_kickoff", "match_weather", CRITICAL, _beside("match_weather", "weather_status = 'AVAILABLE' AND forecast_fetched_at >= utc_kickoff")),
        Check("weather_values_plausible", "match_weather", CRITICAL, (c("weather_status") == "AVAILABLE") & any_of(~c("temperature_c").between(-40, 50), c("precipitation_mm") < 0, ~c("precipitation_probability").between(0, 100), ~c("wind_speed_kmh").between(0, 250))),
        Check("no_forecast_missing_inside_horizon", "match_weather", WARNING, c("weather_status") == "MISSING", unit=" matches MISSING"),
        Check("every_team_has_a_venue_row", "dim_venue", WARNING, _without("dim_team", "dim_venue", "team_id"), unit=" teams without a venue row"),
        Check("prediction_for_every_match", "prediction", CRITICAL, _without("fact_match", "prediction", "match_id"), unit=" matches without a forecast"),
        Check("prediction_probabilities_sum_to_one", "prediction", CRITICAL, total("home_prob", "draw_prob", "away_prob")),
        Check("odds_fair_probabilities_sum_to_one", "bookmaker_odds", CRITICAL, any_of(c("is_complete") & fair, ~c("is_complete") & c("home_prob_fair").isNotNull())),
        Check("odds_prices_plausible", "bookmaker_odds", WARNING, any_of(*map(price, PRICES), ~c("overround").between(LOW_MARGIN, HIGH_MARGIN))),
        Check("odds_events_resolved_to_fixtures", "event_match", WARNING, c("match_id").isNull(), unit=" unmatched", names=(sides, c("commence_time"))),
        Check("odds_fresh_before_kickoff", "raw_odds", WARNING, measure=fresh),
        Check("every_team_has_a_crest", "dim_team", WARNING, _without("dim_team", "team_crest", "team_id"), unit=" teams without a crest"),
        Check("training_one_row_per_match", "product", CRITICAL, _without("fact_match", "product", "match_id")),
        Check("training_match_key_unique", "product", CRITICAL, _many("product", "match_id", "n > 1")),
        Check("training_history_before_kickoff", "team_features", CRITICAL, _beside("team_features", "history_last_available_at >= utc_kickoff")),
        Check("training_90min_label_consistent", "product", CRITICAL, ~c("label_outcome_90min").eqNullSafe(label)),
        Check("team_context_before_kickoff", "team_context", CRITICAL, _beside("team_context", "greatest(context_observed_at, squad_observed_at, coach_observed_at, market_value_observed_at) >= utc_kickoff")),
        Check("world_ranking_before_kickoff", "product", CRITICAL, any_of(late("home"), late("away"))),
        Check("world_ranking_values_consistent", "product", CRITICAL, any_of(odd("home"), odd("away"), ~c("world_rating_points_difference").eqNullSafe(c("home_world_rating_points") - c("away_world_rating_points")), ~c("world_rank_advantage_home").eqNullSafe(c("away_world_rank") - c("home_world_rank")))),
    ]

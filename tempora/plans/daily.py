"""The daily run: raw answers to published tables, or nothing at all."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.operators.merge import insert_if_absent, upsert
from tempora.operators.quality import failed, run
from tempora.operators.sides import pivot_sides, points, unpivot_sides
from tempora.plans import context, facts, features, forecast, odds, ranking, staging, weather
from tempora.plans.checks import checks
from tempora.plans.export import describe
from tempora.plans.runs import Run
from tempora.store import Store

PIPELINE = "daily"
EMPTY = {
    "venue_answers": "team_id bigint, osm array<struct<lat:string,lon:string,osm_type:string,osm_id:bigint,type:string>>, override_lat double, override_lon double, reason string",
    "raw_weather": "venue_team_id bigint, ingestion_date date, ingested_at timestamp, payload string",
    "raw_odds": "raw_id string, source string, endpoint string, request_params string, ingested_at timestamp, payload string",
    "imports": None, "ranking_pages": "raw_id string, source_url string, observed_at timestamp, club_slug string, club_name string, country string, ranking_date date, world_rank int, rating_points int",
    "reviewed": "team_id bigint, club_slug string", "aliases": "team_id bigint, alias string", "team_crest": "team_id bigint", "runs": "run_id string, finished_at timestamp",
}


@dataclass
class Sources:
    """raw: the football answers; everything else may be missing. odds_source: whose odds the product may use."""

    raw: DataFrame
    other: dict[str, DataFrame] = field(default_factory=dict)
    odds_source: str = odds.LIVE_SOURCE

    def get(self, name: str) -> DataFrame:
        return self.other[name] if name in self.other else self.raw.sparkSession.createDataFrame([], EMPTY[name])


class ChecksFailed(RuntimeError):
    pass


def training_matches(staged: DataFrame, games: DataFrame) -> DataFrame:
    """Known matches with the 90-minute score, which features and labels use."""
    kept = staged.join(games.select("match_id", "is_finished"), "match_id")
    return kept.select("match_id", "utc_kickoff", "competition_code", "season_id", "stage", "matchday", "is_finished", "home_team_id", "away_team_id", F.col("home_goals_90min").alias("home_goals"), F.col("away_goals_90min").alias("away_goals"))


def _apps(games: DataFrame) -> DataFrame:
    sides = unpivot_sides(games.select("match_id", "utc_kickoff", "competition_code", "season_id", "is_finished", "home_team_id", "away_team_id", "home_goals", "away_goals"), {"team_id": ("home_team_id", "away_team_id"), "opponent_team_id": ("away_team_id", "home_team_id"), "goals_for": ("home_goals", "away_goals"), "goals_against": ("away_goals", "home_goals")})
    return sides.withColumn("points", points("goals_for", "goals_against").cast("long"))


class Draft(dict):
    """Tables by name; what is put in is written at once and read back, so that nothing is worked out twice. What is
    published stays where it was written; the store's vacuum takes the rest."""

    def __init__(self, store: Store) -> None:
        super().__init__()
        self.store, self.place = store, store.folder()

    def folder(self, name: str) -> str:
        return f"{self.place}/{name}"

    def __setitem__(self, name: str, df: DataFrame) -> None:
        path = f"{self.store.base}/{self.folder(name)}"
        df.write.parquet(path)
        super().__setitem__(name, self.store.spark.read.schema(df.schema).parquet(path))


def transform(spark: SparkSession, store: Store, sources: Sources, clock: Clock) -> Draft:
    """All tables of the day. Stored matches and teams stay unless a newer or equally new answer replaces them."""
    def merged(name: str, fresh: DataFrame, keys: list[str], guard: str | None) -> DataFrame:
        return upsert(store.read(name, fresh.schema), fresh, keys, guard)

    t = Draft(store)
    t["staging_matches"] = merged("staging_matches", staging.matches(sources.raw, clock), ["match_id"], "ingestion_date")
    t["staging_teams"] = merged("staging_teams", staging.teams(sources.raw, clock), ["team_id"], "ingestion_date")
    t["staging_standings"] = merged("staging_standings", staging.standings(sources.raw, clock), ["season_id", "team_id", "ingestion_date"], None)
    t["dim_team"] = facts.dim_team(t["staging_teams"])
    t["fact_match"] = facts.fact_match(t["staging_matches"], t["dim_team"], clock)
    games = t["fact_match"]
    apps = _apps(games)
    t["team_match_form"] = features.legacy_form(apps)
    fresh = forecast.forecast(games, t["team_match_form"]).withColumns({"model_version": F.lit(forecast.MODEL), "as_of_date": clock.today(), "predicted_at": clock.now()})
    fresh = fresh.join(games.select("match_id", "utc_kickoff"), "match_id").withColumn("is_pre_match", F.col("predicted_at") < F.col("utc_kickoff")).drop("utc_kickoff")
    t["prediction"] = merged("prediction", fresh, ["match_id", "model_version", "as_of_date"], None)
    t["dim_venue"] = facts.dim_venue(t["staging_teams"], sources.get("venue_answers"))
    hours = staging.forecasts(sources.get("raw_weather"), clock)
    t["weather_forecast"] = merged("weather_forecast", hours, ["venue_team_id", "forecast_hour_utc", "ingestion_date"], None)
    t["match_weather"] = merged("match_weather", weather.match_weather(games, t["weather_forecast"], t["dim_venue"], clock), ["match_id"], "as_of_date")
    fetches = sources.get("raw_odds")
    t["raw_odds"] = insert_if_absent(store.read("raw_odds", fetches.schema), fetches, ["raw_id"], [F.col("ingested_at"), F.col("payload")])
    stored = store.read("staged_odds", staging.odds(t["raw_odds"]).schema)
    t["staged_odds"] = stored.unionByName(staging.odds(t["raw_odds"], stored))
    staged = t["staged_odds"]
    events = staged.groupBy("event_id").agg(*[F.max_by(c, "fetched_at").alias(c) for c in ("commence_time", "home_team_name", "away_team_name")])
    sides = odds.fixtures(games, t["dim_team"], sources.get("aliases"))
    t["event_match"] = odds.resolve_open(store.read("event_match", odds.resolve(events, sides).schema), events, sides)
    t["bookmaker_odds"] = odds.priced(odds.changes(staged, t["event_match"]))
    snapshots = context.api_snapshots(sources.raw, sources.get("runs"), clock)
    if "imports" in sources.other:
        snapshots = snapshots.unionByName(context.csv_snapshots(sources.other["imports"]))
    t["team_context_snapshot"] = snapshots
    snapshots = t["team_context_snapshot"]
    training = training_matches(t["staging_matches"], games)
    own = _apps(training)
    t["team_context"] = context.team_context(own.select("match_id", "team_id", "is_home", "utc_kickoff", "is_finished", "points"), snapshots)
    t["team_features"] = features.team_features(own)
    ranking.check_reviewed(sources.get("reviewed"))
    mapping = ranking.resolve(t["dim_team"], sources.get("ranking_pages"), sources.get("reviewed"), sources.get("aliases"))
    rankings = ranking.team_rankings(sources.get("ranking_pages"), mapping)
    product = wide(training, t["team_features"], t["team_context"], t["match_weather"], odds.training_summary(training, odds.training_quotes(staged, t["raw_odds"], t["event_match"], sources.odds_source)), rankings)
    t["product"] = audited(product, t["staging_matches"], t["dim_team"], clock)
    t["team_crest"] = sources.get("team_crest")
    return t


def wide(training: DataFrame, team: DataFrame, known: DataFrame, rain: DataFrame, market: DataFrame, rankings: DataFrame) -> DataFrame:
    """The product: one row a match. Every enrichment has one row per match or side, so none multiplies rows."""
    out = features.product(training, team)
    skip = {"match_id", "team_id", "is_home", "utc_kickoff", "is_finished", "points"}
    out = pivot_sides(out, known, "match_id", "is_home", [c for c in known.columns if c not in skip])
    values = rain.select("match_id", "weather_status", *weather.VALUES, F.col("lead_days").alias("weather_lead_days"), F.col("forecast_fetched_at").alias("audit_weather_observed_at"))
    out = out.join(values, "match_id", "left").withColumn("weather_status", F.coalesce("weather_status", F.lit("NOT_CAPTURED")))
    late = F.coalesce(F.col("audit_weather_observed_at") >= F.col("utc_kickoff"), F.lit(False))
    out = out.withColumns({c: F.when(~late, F.col(c)) for c in [*weather.VALUES, "weather_lead_days", "audit_weather_observed_at"]} | {"weather_status": F.when(late, "NOT_CAPTURED").otherwise(F.col("weather_status"))})
    return ranking.with_rankings(out.join(market, "match_id", "left"), rankings)


#: What the rows rest on, and the version of the features. Such columns are marked as audit.
RESTS_ON = "history_first_kickoff history_last_kickoff history_last_available_at context_observed_at context_source squad_source squad_observed_at coach_id coach_name coach_source coach_observed_at market_value_observed_at market_value_source".split()
FEATURE_VERSION = "regular-time-v3"


def audited(product: DataFrame, staged: DataFrame, teams: DataFrame, clock: Clock) -> DataFrame:
    """The product as it is handed out: what a row rests on, names and the state of its match as audit columns.

    The result itself stays in label columns only.
    """
    name = lambda side: teams.select(F.col("team_id").alias(f"{side}_team_id"), F.col("name").alias(f"audit_{side}_team_name"))
    state = staged.select("match_id", F.col("status").alias("audit_match_status"), F.col("duration").alias("audit_result_duration"), F.col("last_updated").alias("audit_result_last_updated"), F.col("ingestion_date").alias("audit_ingestion_date"))
    out = product.withColumnsRenamed({f"{side}_{c}": f"audit_{side}_{c}" for side in ("home", "away") for c in RESTS_ON})
    out = out.drop("is_finished", "home_goals", "away_goals").join(state, "match_id").join(name("home"), "home_team_id").join(name("away"), "away_team_id")
    out = out.withColumns({"audit_computed_at": clock.now(), "audit_feature_version": F.lit(FEATURE_VERSION)})
    keys = ["match_id", "season_id", "competition_code", "utc_kickoff", "match_date", "stage", "matchday", "home_team_id", "away_team_id"]
    return describe(out.select(*keys, *[c for c in out.columns if c not in keys]), comments(out.columns))


def comments(columns: list[str]) -> dict[str, str]:
    """What the columns say, by the families that their names follow."""
    families = [
        (r"^label_", "target: the result after 90 minutes, never a feature"), (r"^audit_", "what the row rests on; not a feature"),
        (r"_last_\d+_days$", "finished matches in so many days, up to three hours before kick-off"), (r"_last_\d+$", "results known three hours before kick-off; counts are 0 without one, rates null"),
        (r"_season_", "this season's results known three hours before kick-off"), (r"squad_|coach_|context_", "the newest squad, coach or value known and valid at kick-off"),
        (r"^(weather|temperature|precipitation|wind)", "forecast for the hour of kick-off, made before it"), (r"^odds_", "over each bookmaker's last complete and plausible quote before kick-off"), (r"world_", "world ranking of an earlier day, at most 35 days old"),
    ]
    side = lambda c: next((f"{s} team: " for s in ("home", "away") if c.startswith((f"{s}_", f"audit_{s}_"))), "")
    told = {c: next((why for pattern, why in families if re.search(pattern, c)), None) for c in columns}
    plain = lambda c: re.sub("^(audit_)?(home_|away_)?", "", c).replace("_", " ")
    return {c: f"{side(c)}{plain(c)}; {why}" for c, why in told.items() if why}


def daily(spark: SparkSession, store: Store, sources: Sources, clock: Clock) -> str:
    """Transform, write, check what was written, publish. A critical failure leaves the published version as it is."""
    with Run(spark, f"{store.base}/runs", PIPELINE, clock) as log:
        draft = transform(spark, store, sources, clock)
        log.add(extracted=sources.raw.count(), loaded=draft["product"].count())
        tables = {name: draft[name] for name in CHECKED}
        results = run(spark, tables, checks(clock)).withColumn("checked_at", clock.now())
        results.write.mode("append").parquet(f"{store.base}/check_results")
        if bad := failed(results):
            raise ChecksFailed(", ".join(bad))
        names = [*CHECKED, "staging_teams", "staging_standings", "weather_forecast", "staged_odds", "team_context_snapshot"]
        version = store.publish(written={n: draft.folder(n) for n in names})
        store.vacuum()
        return version


CHECKED = ["staging_matches", "fact_match", "team_match_form", "dim_team", "dim_venue", "match_weather", "prediction", "bookmaker_odds", "event_match", "raw_odds", "team_crest", "product", "team_features", "team_context"]

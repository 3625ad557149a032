"""Verification of a finished run: rows of check_name, observed (text) and passed. One false row fails the whole."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.plans.odds import LIVE_SOURCE
from tempora.plans.runs import RUNNING, SUCCESS

#: Endpoints that an observed competition has on its newest day.
CURRENT_ENDPOINTS = 4
HANGING = "INTERVAL 1 HOUR"


def _row(df: DataFrame, name: str, observed: Column, passed: Column) -> DataFrame:
    return df.agg(observed.cast("string").alias("observed"), F.coalesce(passed, F.lit(False)).alias("passed")).select(F.lit(name).alias("check_name"), "observed", "passed")


def _none(df: DataFrame, name: str, unit: str = "") -> DataFrame:
    """No row may be left."""
    return _row(df, name, F.concat(F.count("*").cast("string"), F.lit(unit)), F.count("*") == 0)


def _some(df: DataFrame, name: str) -> DataFrame:
    return _row(df, name, F.count("*"), F.count("*") > 0)


def raw_zone(raw: DataFrame, runs: DataFrame) -> DataFrame:
    """raw: source, endpoint, request_params, ingestion_date, run_id, payload; runs: run_id. Five rows."""
    newest = raw.agg(F.max("ingestion_date").alias("ingestion_date"))
    today = raw.join(F.broadcast(newest), "ingestion_date", "left_semi").where("request_params = '{}'").where(F.col("endpoint").rlike("^competitions/[^/]+(/teams|/matches|/standings)?$"))
    groups = today.groupBy("source", F.split_part("endpoint", F.lit("/"), F.lit(2)).alias("competition")).agg(F.countDistinct("endpoint").alias("endpoints"))
    complete = (F.count("*") > 0) & F.bool_and(F.col("endpoints") == CURRENT_ENDPOINTS)
    records = F.max(F.expr("json_array_length(get_json_object(payload, '$.matches'))"))
    keys = ["source", "endpoint", "request_params", "ingestion_date"]
    return _union(
        _some(raw, "raw payloads present"),
        _row(groups, "four current endpoints per competition", F.concat(F.count("*").cast("string"), F.lit(" complete competition/source groups")), complete),
        _none(raw.groupBy(*keys).count().where("count > 1"), "no duplicate business keys"),
        _row(raw.where("endpoint LIKE '%/matches'"), "match payload carries matches", F.coalesce(records.cast("string"), F.lit("none")), F.coalesce(records, F.lit(0)) > 0),
        _none(raw.join(runs.select("run_id"), "run_id", "left_anti"), "every raw row belongs to a known run"),
    )


def run_log(runs: DataFrame, clock: Clock) -> DataFrame:
    """runs: one row a run (runs.current). Three rows."""
    newest = F.max_by(F.struct("status", "finished_at"), "started_at")
    told = F.concat(newest["status"], F.lit(" at "), F.coalesce(newest["finished_at"].cast("string"), F.lit("still running")))
    hanging = runs.where((F.col("status") == RUNNING) & (F.col("started_at") < clock.now() - F.expr(HANGING)))
    return _union(
        _some(runs, "at least one run recorded"),
        _row(runs, "latest run succeeded", F.coalesce(told, F.lit("no runs")), newest["status"] == SUCCESS),
        _none(hanging, "no run left hanging in RUNNING for over an hour"),
    )


def odds_zone(games: DataFrame, predictions: DataFrame, raw_odds: DataFrame, staged: DataFrame, resolved: DataFrame, quotes: DataFrame) -> DataFrame:
    """Six rows; all pass on an empty odds zone but the forecasts."""
    fetched = raw_odds.where("coalesce(json_array_length(payload), 0) > 0")
    keyed = F.col("endpoint").ilike("%apiKey=%") | F.coalesce(F.array_contains(F.json_object_keys("request_params"), "apiKey"), F.lit(False))
    fair = F.col("home_prob_fair") + F.col("draw_prob_fair") + F.col("away_prob_fair")
    hits = F.count("match_id")
    newest = F.max(F.when(F.col("source") == LIVE_SOURCE, F.col("ingested_at")))
    return _union(
        _none(games.join(predictions.select("match_id"), "match_id", "left_anti"), "model forecast for every match", " match(es) without one"),
        _none(raw_odds.where(keyed), "no API key in the raw zone"),
        _none(fetched.join(staged.select("raw_id"), "raw_id", "left_anti"), "every fetch is staged", " fetch(es) not staged"),
        _row(resolved, "bookmaker events resolved to fixtures", F.concat(hits.cast("string"), F.lit(" of "), F.count("*").cast("string")), hits == F.count("*")),
        _none(quotes.where(F.col("is_complete") & (F.abs(fair - 1) >= 0.001)), "fair probabilities add up per bookmaker quote"),
        _row(raw_odds, "newest odds fetch", F.coalesce(F.date_format(newest, "yyyy-MM-dd HH:mm"), F.lit("none")), F.lit(True)),
    )


def training(product: DataFrame, features: DataFrame, games: DataFrame) -> DataFrame:
    """product: one row a match; features: match_id, history_last_available_at of each side. Four rows."""
    beside = product.select("match_id", F.lit(1).alias("in_product")).join(games.select("match_id", F.lit(1).alias("in_games")), "match_id", "full")
    once = (F.count("in_product") == F.count("*")) & (F.count("in_games") == F.count("*")) & (F.count("*") == F.countDistinct("match_id"))
    late = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) >= F.col("utc_kickoff"), F.lit(False)) for c in product.columns if c.startswith("audit_") and c.endswith(("_observed_at", "_source_updated_at"))], F.lit(False))
    history = features.select("match_id", "history_last_available_at").join(games.select("match_id", "utc_kickoff"), "match_id")
    return _union(
        _row(beside, "one row per canonical match", F.count("in_product"), once),
        _row(product, "regular-time labels are available", F.count("label_outcome_90min"), F.count("*") > 0),
        _none(history.where("history_last_available_at >= utc_kickoff"), "no future history"),
        _none(product.where(late), "no future observed context or odds"),
    )


def _union(*rows: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, rows)


def failed(rows: DataFrame) -> list[str]:
    """Names of the checks that failed."""
    return sorted(r["check_name"] for r in rows.where("NOT passed").select("check_name").collect())

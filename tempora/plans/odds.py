"""Bookmaker events to fixtures, quotes to change histories, and what a model may see of them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.names import overlap, tokens
from tempora.functions.odds import fair, implied_total, overround
from tempora.operators.latest import keep_latest, newest
from tempora.operators.match import best_unambiguous, interval_join
from tempora.operators.merge import widen

#: Kick-off tolerance in microseconds, least similarity of both names, bounds of a plausible quote.
TOLERANCE, THRESHOLD = 3 * 3_600_000_000, 0.6
PRICES = ["home_price", "draw_price", "away_price"]
LOW_PRICE, HIGH_PRICE, LOW_MARGIN, HIGH_MARGIN = 1.01, 1000, -0.02, 0.30
QUOTE = ["match_id", "bookmaker_key", "market_key", "source_updated_at", *PRICES]
#: Fixed value: the source of live fetches. Recorded samples have another and stay out of the training product.
LIVE_SOURCE = "the-odds-api.com"


def fixtures(games: DataFrame, teams: DataFrame, aliases: DataFrame) -> DataFrame:
    """match_id, utc_kickoff and all token sets of both sides: name, short name, code and aliases.

    aliases: team_id, alias.
    """
    extra = aliases.groupBy("team_id").agg(F.collect_set("alias").alias("aliases"))
    names = teams.join(extra, "team_id", "left")
    spelled = F.filter(F.concat(F.array("name", "short_name", "tla"), F.coalesce("aliases", F.array().cast("array<string>"))), lambda n: n.isNotNull())
    sets = names.select("team_id", F.transform(spelled, lambda n: tokens(n)).alias("names"))
    side = lambda p: sets.select(F.col("team_id").alias(f"{p}_team_id"), F.col("names").alias(f"{p}_names"))
    return games.select("match_id", "utc_kickoff", "home_team_id", "away_team_id").join(side("home"), "home_team_id").join(side("away"), "away_team_id")


def resolve(events: DataFrame, fixtures: DataFrame) -> DataFrame:
    """event_id with match_id and confidence, or null and a note: no candidate, or two equally good ones.

    events: event_id, commence_time, home_team_name, away_team_name; one row an event.
    """
    pairs = interval_join(events, fixtures, "commence_time", "utc_kickoff", TOLERANCE)
    like = lambda name, sets: F.array_max(F.transform(sets, lambda s: overlap(tokens(F.col(name)), s)))
    scored = pairs.withColumns({"_home": like("home_team_name", "home_names"), "_away": like("away_team_name", "away_names")})
    near = F.least("_home", "_away") >= THRESHOLD
    best = best_unambiguous(scored, "event_id", "match_id", F.col("_home") + F.col("_away"), near)
    some = scored.where(near).select("event_id").distinct().withColumn("_some", F.lit(True))
    out = events.join(best, "event_id", "left").join(some, "event_id", "left")
    note = F.when(F.col("match_id").isNotNull(), "kick-off time and team names").when(F.col("_some"), "ambiguous between matches").otherwise("no fixture within 3 h with similar names")
    return out.select(*events.columns, "match_id", F.round(F.coalesce(F.col("score"), F.lit(0.0)) / 2, 3).alias("confidence"), note.alias("note"))


def resolve_open(stored: DataFrame, events: DataFrame, fixtures: DataFrame) -> DataFrame:
    """Resolutions that stand are kept; open and new events are looked up again."""
    settled = stored.where("match_id IS NOT NULL")
    todo = events.join(settled.select("event_id"), "event_id", "left_anti")
    return settled.unionByName(resolve(todo, fixtures))


def by_role(staged: DataFrame, *keys: str) -> DataFrame:
    """One row for each quote, with the prices of its three outcomes."""
    role = lambda r, name: F.max(F.when(F.col("outcome_role") == r, F.col("price"))).alias(name)
    return staged.groupBy(*keys).agg(role("HOME", "home_price"), role("DRAW", "draw_price"), role("AWAY", "away_price"))


def event_changes(staged: DataFrame) -> DataFrame:
    """One row for each distinct quote of an event, resolved or not, with the interval in which it was seen."""
    quotes = by_role(staged, "fetched_at", "event_id", "bookmaker_key", "bookmaker_title", "market_key", "source_updated_at")
    return quotes.groupBy("event_id", *QUOTE[1:]).agg(F.min("fetched_at").alias("first_seen_at"), F.max("fetched_at").alias("last_seen_at"), F.max_by("bookmaker_title", F.struct("fetched_at", "bookmaker_title")).alias("bookmaker_title"))


def changes(staged: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row for each distinct quote of a match, with the interval in which it was seen. Null prices are equal."""
    quotes = by_role(staged, "fetched_at", "event_id", "bookmaker_key", "bookmaker_title", "market_key", "source_updated_at")
    known = quotes.join(resolved.where("match_id IS NOT NULL").select("event_id", "match_id"), "event_id")
    return known.groupBy(*QUOTE).agg(F.min("fetched_at").alias("first_seen_at"), F.max("fetched_at").alias("last_seen_at"), F.max_by("bookmaker_title", F.struct("fetched_at", "bookmaker_title")).alias("bookmaker_title"))


def priced(quotes: DataFrame) -> DataFrame:
    """Completeness, margin and fair probabilities."""
    return quotes.withColumns({"is_complete": implied_total(PRICES).isNotNull(), "overround": overround(PRICES), **{p.replace("price", "prob_fair"): fair(p, PRICES) for p in PRICES}})


def merge(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Intervals widen, whatever the order in which fetches arrive."""
    base = [*QUOTE, "first_seen_at", "last_seen_at", "bookmaker_title"]
    return priced(widen(stored.select(base), fresh.select(base), QUOTE, "first_seen_at", "last_seen_at", ["bookmaker_title"]))


def latest(facts: DataFrame, raw: DataFrame, staged: DataFrame, resolved: DataFrame) -> DataFrame:
    """The newest quote of each match, bookmaker and market; is_current while its own scope's newest fetch has it.

    A scope is what one request covers; another sport's fetch can't withdraw a quote.
    """
    request = ["source", "endpoint", "request_params"]
    known = staged.select("event_id", "raw_id").distinct().join(resolved.where("match_id IS NOT NULL").select("event_id", "match_id"), "event_id")
    scopes = known.join(raw, "raw_id").select("match_id", *request).distinct()
    fetched = raw.groupBy(*request).agg(F.max("ingested_at").alias("at"))
    newest_fetch = scopes.join(fetched, request).groupBy("match_id").agg(F.max("at").alias("latest_fetch_at"))
    # two quotes may be seen last at one time, with one time of the source: the greater prices, so that reruns agree
    one = keep_latest(facts, ["match_id", "bookmaker_key", "market_key"], [*newest("last_seen_at", "source_updated_at"), *[F.col(p).desc_nulls_last() for p in PRICES]])
    return one.join(newest_fetch, "match_id").withColumn("is_current", F.col("last_seen_at") >= F.col("latest_fetch_at"))


def latest_predictions(predictions: DataFrame) -> DataFrame:
    """The newest forecast of each match and model version."""
    return keep_latest(predictions, ["match_id", "model_version"], newest("as_of_date", "predicted_at"))


def comparison(predictions: DataFrame, quotes: DataFrame) -> DataFrame:
    """Model odds beside the market's, and the deviation in percentage points."""
    both = predictions.join(quotes, "match_id")
    made = {}
    for side in ("home", "draw", "away"):
        made[f"{side}_model_odds"] = F.round(F.try_divide(F.lit(1.0), F.col(f"{side}_prob")), 2)
        made[f"{side}_deviation_pp"] = F.round((F.col(f"{side}_prob") - F.col(f"{side}_prob_fair")) * 100, 1)
    return both.withColumns(made)


def training_quotes(staged: DataFrame, raw: DataFrame, resolved: DataFrame, source: str = LIVE_SOURCE) -> DataFrame:
    """The quotes of every live fetch, not collapsed: a sample or an equal quote of another fetch gives none its time."""
    live = staged.join(raw.where(F.col("source") == source).select("raw_id").distinct(), "raw_id", "left_semi")
    known = live.join(resolved.where("match_id IS NOT NULL").select("event_id", "match_id"), "event_id")
    quotes = by_role(known, "raw_id", "match_id", "bookmaker_key", "market_key", "source_updated_at", "fetched_at")
    return priced(quotes.withColumnsRenamed({"raw_id": "odds_id", "fetched_at": "first_seen_at"}))


def training_summary(games: DataFrame, quotes: DataFrame) -> DataFrame:
    """Per match, over each bookmaker's last of training_quotes that could be seen before kick-off.

    Incomplete and implausible quotes go after the selection: they must not bring older ones back.
    """
    before = quotes.where("market_key = 'h2h'").join(games.select("match_id", "utc_kickoff"), "match_id").where("first_seen_at < utc_kickoff AND source_updated_at < utc_kickoff")
    last = keep_latest(before, ["match_id", "bookmaker_key"], newest("source_updated_at", "first_seen_at", "odds_id"))
    fine = F.col("is_complete") & F.col("overround").between(LOW_MARGIN, HIGH_MARGIN)
    for p in PRICES:
        fine = fine & F.col(p).between(LOW_PRICE, HIGH_PRICE)
    probs = [p.replace("price", "prob_fair") for p in PRICES]
    told = last.where(fine).groupBy("match_id").agg(
        F.count("*").cast("int").alias("odds_bookmaker_count"), *[F.avg(p).alias(f"odds_{p}") for p in probs], F.avg("overround").alias("odds_mean_overround"),
        *[F.avg(p).alias(f"odds_{p}_mean") for p in PRICES], *[F.stddev_pop(p).alias(f"odds_{p.replace('_fair', '')}_stddev") for p in probs],
        F.max("first_seen_at").alias("audit_odds_observed_at"), F.max("source_updated_at").alias("audit_odds_source_updated_at"),
    )
    return games.select("match_id").join(told, "match_id", "left").withColumn("odds_bookmaker_count", F.coalesce("odds_bookmaker_count", F.lit(0)))

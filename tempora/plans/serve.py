"""Read-only questions that a viewer asks of the published tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.operators.lookback import before


def page(product: DataFrame, number: int, size: int = 500, competitions: Sequence[str] = (), search: str = "", columns: Sequence[str] = ()) -> DataFrame:
    """A page of the product, newest kick-off first, in total order."""
    rows = product
    if competitions:
        rows = rows.where(F.col("competition_code").isin(list(competitions)))
    if search:
        names = [c for c in rows.columns if c.endswith("_name")]
        rows = rows.where(F.greatest(*[F.coalesce(F.col(c).ilike(f"%{search}%"), F.lit(False)) for c in names], F.lit(False)))
    ordered = rows.orderBy(F.col("utc_kickoff").desc(), "match_id").offset(number * size).limit(size)
    return ordered.select(*columns) if columns else ordered


def page_csv(rows: DataFrame, target: str) -> None:
    """A page as one CSV file in a new folder, in its order; a page is bounded by its size."""
    rows.coalesce(1).write.options(header=True, escape='"').csv(target)


def column_group(product: DataFrame, prefixes: Sequence[str]) -> list[str]:
    keys = [c for c in ("match_id", "utc_kickoff", "home_team_id", "away_team_id") if c in product.columns]
    return [*keys, *[c for c in product.columns if c not in keys and c.startswith(tuple(prefixes))]]


def season_overview(product: DataFrame) -> DataFrame:
    """Matches, labelled ones, first and last day of each competition and season."""
    return product.groupBy("competition_code", "season_id").agg(F.count("*").alias("matches"), F.count("label_outcome_90min").alias("labelled"), F.min("utc_kickoff").alias("first"), F.max("utc_kickoff").alias("last"))


def outcome_shares(product: DataFrame) -> DataFrame:
    counted = product.where("label_outcome_90min IS NOT NULL").groupBy("label_outcome_90min").agg(F.count("*").alias("n"))
    return counted.withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 1))


def team_matches(games: DataFrame, team_id: int, limit: int = 10) -> DataFrame:
    """A team's matches, home or away, newest first."""
    mine = (F.col("home_team_id") == team_id) | (F.col("away_team_id") == team_id)
    return games.where(mine).orderBy(F.col("utc_kickoff").desc(), F.col("match_id").desc()).limit(limit)


def result_of(team: str) -> Column:
    own = F.when(F.col("home_team_id") == F.col(team), F.col("home_goals")).otherwise(F.col("away_goals"))
    other = F.when(F.col("home_team_id") == F.col(team), F.col("away_goals")).otherwise(F.col("home_goals"))
    return F.when(own > other, "W").when(own == other, "D").when(own < other, "L")


def latest_checks(results: DataFrame) -> DataFrame:
    """The newest batch of check results."""
    newest = results.agg(F.max("checked_at").alias("checked_at"))
    return results.join(F.broadcast(newest), "checked_at", "left_semi")


def quote_timeline(facts: DataFrame, match_id: int) -> DataFrame:
    """A match's quotes by bookmaker in time."""
    return facts.where(F.col("match_id") == match_id).orderBy("bookmaker_key", "source_updated_at")


def market_by_outcome(quotes: DataFrame) -> DataFrame:
    """Bookmakers as rows, fair probabilities of the current quotes as columns, with the market's mean."""
    current = quotes.where("is_current AND is_complete")
    return current.groupBy("match_id").agg(F.countDistinct("bookmaker_key").alias("bookmakers"), *[F.round(F.avg(f"{s}_prob_fair"), 5).alias(f"{s}_prob") for s in ("home", "draw", "away")])


def latest_run(runs: DataFrame, pipeline: str) -> DataFrame:
    """The newest successful run of a pipeline."""
    return runs.where((F.col("pipeline") == pipeline) & (F.col("status") == "SUCCESS")).orderBy(F.col("finished_at").desc_nulls_last()).limit(1)


def model_features(games: DataFrame, teams: DataFrame, form: DataFrame, weather: DataFrame, predictions: DataFrame, quotes: DataFrame) -> DataFrame:
    """One row a match between known teams: names, label, form of both sides, weather, forecast and market.

    form: a row for each match and team; weather and predictions: at most one for each match; quotes: the current
    ones of all bookmakers, averaged. A match without quotes has 0 bookmakers.
    """
    side = lambda s: form.select(
        "match_id", F.col("team_id").alias(f"{s}_team_id"), F.col("matches_considered").alias(f"{s}_form_matches"), F.col("points_last_5").alias(f"{s}_form_points"), F.col("goals_scored_last_5").alias(f"{s}_goals_scored_last_5"),
        F.col("goals_conceded_last_5").alias(f"{s}_goals_conceded_last_5"), F.col("days_since_last_match").alias(f"{s}_rest_days"),
    )
    name = lambda s: teams.select(F.col("team_id").alias(f"{s}_team_id"), F.col("name").alias(f"{s}_team"))
    market = quotes.groupBy("match_id").agg(*[F.avg(f"{s}_prob_fair").alias(f"fair_prob_{s}") for s in ("home", "draw", "away")], F.countDistinct("bookmaker_key").alias("bookmaker_count"))
    rain = weather.select("match_id", "weather_status", "temperature_c", "precipitation_probability", "wind_speed_kmh", F.col("lead_days").alias("weather_lead_days"))
    guess = predictions.select("match_id", *[F.col(f"{s}_prob").alias(f"model_prob_{s}") for s in ("home", "draw", "away")])
    out = games.select("match_id", "season_id", "match_date", "utc_kickoff", "matchday", "is_finished", "home_team_id", "away_team_id", "outcome", "home_goals", "away_goals")
    for s in ("home", "away"):
        out = out.join(name(s), f"{s}_team_id").join(side(s), ["match_id", f"{s}_team_id"], "left")
    for more in (rain, guess, market):
        out = out.join(more, "match_id", "left")
    return out.drop("home_team_id", "away_team_id").withColumn("bookmaker_count", F.coalesce("bookmaker_count", F.lit(0)))


def dataset_summary(product: DataFrame) -> DataFrame:
    """One row: matches, labelled ones, distinct seasons and competitions."""
    return product.agg(F.count("*").alias("matches"), F.count("label_outcome_90min").alias("labelled"), F.count_distinct("season_id").alias("seasons"), F.count_distinct("competition_code").alias("competitions"))


def feature_coverage(rows: DataFrame, features: Sequence[tuple[str, str, str]]) -> DataFrame:
    """feature, present, share (percent), absent_because for each (label, column, reason), in one scan.

    A form row always exists: it counts once it rests on a match. A column that isn't there is never present.
    """
    def present(column: str) -> Column:
        if column not in rows.columns:
            return F.lit(0).cast("long")
        return F.count_if(F.coalesce(F.col(column) > 0, F.lit(False)) if column.endswith("_form_matches") else F.col(column).isNotNull())

    counted = rows.agg(F.count("*").alias("_n"), *[present(c).alias(f"_p{i}") for i, (_, c, _) in enumerate(features)])
    told = [F.struct(F.lit(label).alias("feature"), F.col(f"_p{i}").alias("present"), F.round(F.try_divide(100 * F.col(f"_p{i}"), F.col("_n"))).cast("int").alias("share"), F.lit(why).alias("absent_because")) for i, (label, _, why) in enumerate(features)]
    return counted.select(F.inline(F.array(*told)))


def leakage(games: DataFrame, form: DataFrame, weather: DataFrame, window: int = 5) -> DataFrame:
    """guarantee, violations: the three rules that keep the future out, worked out again from the tables."""
    sides = games.select("match_id", "utc_kickoff", "is_finished", F.explode(F.array("home_team_id", "away_team_id")).alias("team_id"))
    done = F.coalesce(F.sum(F.when(F.col("is_finished"), 1)).over(before(["team_id"], "utc_kickoff")), F.lit(0))
    expected = sides.select("match_id", "team_id", F.least(done, F.lit(window)).alias("_expected"))
    wrong = form.join(expected, ["match_id", "team_id"]).where("matches_considered <> _expected")
    late = weather.where("weather_status = 'AVAILABLE'").join(games.select("match_id", "utc_kickoff"), "match_id").where("forecast_fetched_at >= utc_kickoff")
    odd = form.groupBy("match_id").agg(F.count("*").alias("n")).where("n <> 2")
    count = lambda name, bad: bad.agg(F.count("*").alias("violations")).select(F.lit(name).alias("guarantee"), "violations")
    return count("form rests on finished matches before kick-off", wrong).unionByName(count("weather was fetched before kick-off", late)).unionByName(count("a match has two form rows", odd))


def pivot_mean(rows: DataFrame, index: Sequence[str], column: str, value: str, most: int = 200) -> DataFrame:
    """index and one column for each value of `column`, with the mean of `value`; names in order.

    A first pass finds the names, of which there may be `most`; more raise, since each is a column. Null names and
    nulls in `value` count nowhere; an index without any value has no row.
    """
    known = rows.where(F.col(column).isNotNull() & F.col(value).isNotNull())
    names = [r[0] for r in known.select(column).distinct().orderBy(column).limit(most + 1).collect()]
    if len(names) > most:
        raise ValueError(f"{column} has more than {most} values")
    if not names:
        return rows.select(*index).limit(0)
    return known.groupBy(*index).pivot(column, names).agg(F.avg(value))


MODEL = "Model"


def odds_history(facts: DataFrame, predictions: DataFrame, as_odds: bool = False) -> DataFrame:
    """match_id, series, outcome, at, value: the steps of every bookmaker's complete quotes and of the model.

    A quote stands from the fetch that first showed it; a bookmaker's newest one is drawn on to the fetch that last
    confirmed it. Values are decimal odds, or margin-free probabilities in percent.
    """
    whole = facts.where("is_complete AND market_key = 'h2h'")
    by = Window.partitionBy("match_id", "bookmaker_title").orderBy(*[F.col(c).desc() for c in ("last_seen_at", "first_seen_at", "source_updated_at", "home_price", "draw_price", "away_price")])
    step = lambda at, quote: F.struct(F.col(at).alias("at"), *quote)
    value = lambda s: (F.col(f"{s}_price").cast("double") if as_odds else 100 * F.col(f"{s}_prob_fair")).alias(f"{s}")
    quote = [value(s) for s in ("home", "draw", "away")]
    points = F.when(F.row_number().over(by) == 1, F.array(step("first_seen_at", quote), step("last_seen_at", quote))).otherwise(F.array(step("first_seen_at", quote)))
    quoted = whole.withColumn("_points", points).select("match_id", F.col("bookmaker_title").alias("series"), F.inline("_points"))
    model = lambda s: (F.try_divide(F.lit(1.0), F.col(f"{s}_prob")) if as_odds else 100 * F.col(f"{s}_prob")).alias(s)
    modelled = predictions.select("match_id", F.lit(MODEL).alias("series"), F.col("predicted_at").alias("at"), *[model(s) for s in ("home", "draw", "away")])
    return quoted.unionByName(modelled).unpivot(["match_id", "series", "at"], ["home", "draw", "away"], "outcome", "value")

"""A query for every operator on the given tables, and its DuckDB SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.functions.names import overlap, tokens
from tempora.functions.odds import fair, implied_total, overround
from tempora.operators.asof import as_of, as_of_days, as_of_valid, first_of_current_run
from tempora.operators.latest import keep_latest, latest_then, newest
from tempora.operators.lookback import DAY
from tempora.operators.match import best_nearest, overlap_join
from tempora.operators.merge import insert_if_absent, unseen, upsert, widen
from tempora.operators.quality import CRITICAL, WARNING, Check, run
from tempora.plans import baseline, features, forecast, serve
from tempora.plans.export import AUDIT_WORDS, IDENTIFIERS, coverage
from tempora.plans.facts import outcome
from tempora.plans.fixtures import MATCHES_SQL, appearances, matches
from tempora.registry import ORACLES, QUERIES, query, table
from tempora.sources.ranking import links

def apps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return appearances(matches(spark, sf_dir))


def look_back_sql(select: str, limit: int, where: str = "", gap: str = "- INTERVAL 3 HOUR", eligible: str = "p.is_finished AND p.goals_for IS NOT NULL AND p.goals_against IS NOT NULL", keys: str = "a.match_id, a.team_id") -> str:
    return f"""WITH {MATCHES_SQL} SELECT {keys}, {select} FROM apps a LEFT JOIN LATERAL (
      SELECT p.*, row_number() OVER (ORDER BY p.utc_kickoff DESC, p.match_id DESC) AS rn FROM apps p
      WHERE p.team_id = a.team_id AND {eligible} AND p.utc_kickoff < a.utc_kickoff {gap} {where}
      ORDER BY p.utc_kickoff DESC, p.match_id DESC LIMIT {limit}) w ON true GROUP BY ALL"""


def _n(cond: str, name: str) -> str:
    return f"CAST(count(*) FILTER (WHERE w.rn IS NOT NULL AND {cond}) AS BIGINT) AS {name}"


def _s(expr: str, cond: str, name: str) -> str:
    return f"CAST(coalesce(sum({expr}) FILTER (WHERE {cond}), 0) AS BIGINT) AS {name}"


def _rate(expr: str, cond: str, name: str) -> str:
    return f"round(CAST(sum({expr}) FILTER (WHERE {cond}) AS DOUBLE) / nullif(count(*) FILTER (WHERE w.rn IS NOT NULL AND {cond}), 0), 4) AS {name}"


def _form_sql(n: int) -> str:
    c = f"w.rn <= {n}"
    return ", ".join([
        _n(c, f"matches_last_{n}"), _n(f"{c} AND w.goals_for > w.goals_against", f"wins_last_{n}"), _n(f"{c} AND w.goals_for = w.goals_against", f"draws_last_{n}"),
        _n(f"{c} AND w.goals_for < w.goals_against", f"losses_last_{n}"), _s("w.points", c, f"points_last_{n}"), _s("w.goals_for", c, f"goals_for_last_{n}"),
        _s("w.goals_against", c, f"goals_against_last_{n}"), _s("w.goals_for - w.goals_against", c, f"goal_difference_last_{n}"),
        _n(f"{c} AND w.goals_against = 0", f"clean_sheets_last_{n}"), _n(f"{c} AND w.goals_for = 0", f"failed_to_score_last_{n}"),
        _n(f"{c} AND w.goals_for > 0 AND w.goals_against > 0", f"both_teams_scored_last_{n}"), _n(f"{c} AND w.goals_for + w.goals_against > 2", f"over_2_5_last_{n}"),
        _rate("w.goals_for", c, f"goals_for_per_match_last_{n}"), _rate("w.goals_against", c, f"goals_against_per_match_last_{n}"), _rate("w.points", c, f"points_per_match_last_{n}"),
        _rate("CASE WHEN w.goals_for > w.goals_against THEN 1 ELSE 0 END", c, f"win_rate_last_{n}"),
    ])


def _scope_sql(scope: str, names: str) -> str:
    part = {"matches": _n("true", f"{scope}_matches_last_5"), "wins": _n("w.goals_for > w.goals_against", f"{scope}_wins_last_5"), "draws": _n("w.goals_for = w.goals_against", f"{scope}_draws_last_5"), "losses": _n("w.goals_for < w.goals_against", f"{scope}_losses_last_5"), "points": _s("w.points", "true", f"{scope}_points_last_5"), "goals_for": _s("w.goals_for", "true", f"{scope}_goals_for_last_5"), "goals_against": _s("w.goals_against", "true", f"{scope}_goals_against_last_5"), "clean_sheets": _n("w.goals_against = 0", f"{scope}_clean_sheets_last_5")}
    return ", ".join([part[n] for n in names.split()] + [_rate("w.points", "true", f"{scope}_points_per_match_last_5")])


ID = ["match_id", "team_id"]


def _only(df: DataFrame, like: tuple[str, ...]) -> DataFrame:
    return df.select(*ID, *[c for c in df.columns if c.startswith(like) or any(x in c for x in like if x.startswith("_last_"))])


@query(look_back_sql(_form_sql(5), 5))
def form_last5(spark, sf_dir):
    return _only(features.form(apps(spark, sf_dir), (5,)), ("_last_5",))


@query(look_back_sql(_form_sql(3) + ", " + _form_sql(10), 10))
def form_last3_10(spark, sf_dir):
    return _only(features.form(apps(spark, sf_dir), (3, 10)), ("_last_3", "_last_10"))


@query(look_back_sql(_scope_sql("venue", features.SCOPED["venue"][1]), 5, "AND p.is_home = a.is_home"))
def form_venue(spark, sf_dir):
    return _only(features.scoped_form(apps(spark, sf_dir), "venue"), ("venue_",))


@query(look_back_sql(_scope_sql("competition", features.SCOPED["competition"][1]), 5, "AND p.competition_code = a.competition_code"))
def form_competition(spark, sf_dir):
    return _only(features.scoped_form(apps(spark, sf_dir), "competition"), ("competition_matches", "competition_p", "competition_w", "competition_g", "competition_cl"))


@query(look_back_sql(_scope_sql("h2h", features.SCOPED["h2h"][1]), 5, "AND p.opponent_team_id = a.opponent_team_id"))
def form_h2h(spark, sf_dir):
    return _only(features.scoped_form(apps(spark, sf_dir), "h2h"), ("h2h_",))


@query(f"""WITH {MATCHES_SQL} SELECT match_id, team_id, {", ".join(f"CAST(count(*) FILTER (WHERE is_finished) OVER (PARTITION BY team_id ORDER BY utc_kickoff RANGE BETWEEN INTERVAL {d} DAY PRECEDING AND INTERVAL '3 hours 1 microsecond' PRECEDING) AS BIGINT) AS played_last_{d}_days" for d in (7, 14, 30))} FROM apps""")
def load_7_14_30(spark, sf_dir):
    return _only(features.load(apps(spark, sf_dir)), ("played_",))


@query(f"""WITH {MATCHES_SQL}, run AS (SELECT *, {", ".join(f"sum(CASE WHEN is_finished AND points IS NOT NULL THEN {e} END) OVER s AS r_{m}" for m, e in {"matches": "1", "wins": "CAST(points = 3 AS INT)", "draws": "CAST(points = 1 AS INT)", "losses": "CAST(points = 0 AS INT)", "points": "points", "goals_for": "goals_for", "goals_against": "goals_against"}.items())}
  FROM apps WINDOW s AS (PARTITION BY team_id, competition_code, season_id ORDER BY utc_kickoff RANGE UNBOUNDED PRECEDING))
SELECT a.match_id, a.team_id, {", ".join(f"CAST(coalesce(p.r_{m}, 0) AS BIGINT) AS season_{m}" for m in features.SEASON.split())},
  CAST(coalesce(p.r_goals_for - p.r_goals_against, 0) AS BIGINT) AS season_goal_difference, round(CAST(p.r_points AS DOUBLE) / nullif(p.r_matches, 0), 4) AS season_points_per_match
FROM apps a LEFT JOIN LATERAL (SELECT * FROM run p WHERE p.team_id = a.team_id AND p.is_finished AND p.utc_kickoff < a.utc_kickoff - INTERVAL 3 HOUR AND p.goals_for IS NOT NULL
  AND p.goals_against IS NOT NULL AND p.competition_code = a.competition_code AND p.season_id = a.season_id ORDER BY p.utc_kickoff DESC, p.match_id DESC LIMIT 1) p ON true""")
def season_to_date(spark, sf_dir):
    return _only(features.season_to_date(apps(spark, sf_dir)), ("season_matches", "season_wins", "season_draws", "season_losses", "season_points", "season_goal"))


@query(f"""WITH {MATCHES_SQL}, run AS (SELECT *, count(*) FILTER (WHERE is_finished) OVER s AS n, min(utc_kickoff) FILTER (WHERE is_finished) OVER s AS f FROM apps WINDOW s AS (PARTITION BY team_id ORDER BY utc_kickoff RANGE UNBOUNDED PRECEDING))
SELECT a.match_id, a.team_id, CAST(coalesce(p.n, 0) AS BIGINT) AS history_matches, epoch_us(p.f) AS first_us, epoch_us(p.utc_kickoff) AS last_us,
  CAST(round((epoch_us(a.utc_kickoff) - epoch_us(p.utc_kickoff)) / 86400000000, 3) AS DOUBLE) AS rest_days
FROM apps a LEFT JOIN LATERAL (SELECT * FROM run p WHERE p.team_id = a.team_id AND p.is_finished AND p.utc_kickoff < a.utc_kickoff - INTERVAL 3 HOUR ORDER BY p.utc_kickoff DESC, p.match_id DESC LIMIT 1) p ON true""")
def history_rest(spark, sf_dir):
    return features.history(apps(spark, sf_dir)).select(*ID, "history_matches", F.unix_micros("history_first_kickoff").alias("first_us"), F.unix_micros("history_last_kickoff").alias("last_us"), F.col("rest_days").cast("double").alias("rest_days"))


LEGACY_SQL = look_back_sql(", ".join([_n("true", "matches_considered"), _n("w.goals_for > w.goals_against", "wins_last_5"), _n("w.goals_for = w.goals_against", "draws_last_5"), _n("w.goals_for < w.goals_against", "losses_last_5"), _s("w.goals_for", "true", "goals_scored_last_5"), _s("w.goals_against", "true", "goals_conceded_last_5"), _s("w.points", "true", "points_last_5"), "CAST(floor((epoch_us(a.utc_kickoff) - epoch_us(max(w.utc_kickoff))) / 86400000000) AS INTEGER) AS days_since_last_match"]), 5, gap="", keys="a.match_id, a.team_id, a.utc_kickoff").replace("SELECT a.match_id, a.team_id, a.utc_kickoff,", "SELECT a.match_id, a.team_id,").replace("GROUP BY ALL", "GROUP BY a.match_id, a.team_id, a.utc_kickoff")


@query(LEGACY_SQL)
def form_legacy(spark, sf_dir):
    return features.legacy_form(apps(spark, sf_dir)).select(*ID, "matches_considered", "wins_last_5", "draws_last_5", "losses_last_5", "goals_scored_last_5", "goals_conceded_last_5", "points_last_5", "days_since_last_match")


LEAGUE_SQL = """league AS (SELECT m.match_id, CAST(count(f.match_id) AS BIGINT) AS n, CAST(coalesce(sum(f.home_goals), 0) AS BIGINT) AS h, CAST(coalesce(sum(f.away_goals), 0) AS BIGINT) AS a
  FROM matches m LEFT JOIN (SELECT * FROM matches WHERE is_finished AND home_goals IS NOT NULL AND away_goals IS NOT NULL) f ON f.utc_kickoff < m.utc_kickoff GROUP BY m.match_id)"""


@query(f"WITH {MATCHES_SQL}, {LEAGUE_SQL} SELECT match_id, n AS league_matches_considered, h AS home_goals_before, a AS away_goals_before, round((h + 31.0) / (n + 20), 6)::DOUBLE AS mu_home, round((a + 25.0) / (n + 20), 6)::DOUBLE AS mu_away FROM league")
def league_mean_before(spark, sf_dir):
    out = forecast.league_before(matches(spark, sf_dir))
    return out.select("match_id", "league_matches_considered", F.col("_h").alias("home_goals_before"), F.col("_a").alias("away_goals_before"), F.round("mu_home", 6).alias("mu_home"), F.round("mu_away", 6).alias("mu_away"))


@query(f"""WITH {MATCHES_SQL}, {LEAGUE_SQL}, form AS ({LEGACY_SQL.replace("WITH " + MATCHES_SQL, "")}),
s AS (SELECT m.match_id, l.n, (h + 31.0::DOUBLE) / (n + 20) AS mh, (a + 25.0::DOUBLE) / (n + 20) AS ma, fh.matches_considered AS hn, fa.matches_considered AS an, fh.goals_scored_last_5 AS hf, fh.goals_conceded_last_5 AS hc, fa.goals_scored_last_5 AS af, fa.goals_conceded_last_5 AS ac
  FROM matches m JOIN league l USING (match_id) JOIN form fh ON fh.match_id = m.match_id AND fh.team_id = m.home_team_id JOIN form fa ON fa.match_id = m.match_id AND fa.team_id = m.away_team_id),
t AS (SELECT *, (mh + ma) / 2 AS mu FROM s),
r AS (SELECT *, least(greatest(mh * ((hf + 3 * mu) / ((hn + 3) * mu)) * ((ac + 3 * mu) / ((an + 3) * mu)), 0.2), 6) AS lh, least(greatest(ma * ((af + 3 * mu) / ((an + 3) * mu)) * ((hc + 3 * mu) / ((hn + 3) * mu)), 0.2), 6) AS la FROM t),
g AS (SELECT match_id, i, j, exp(-lh) * pow(lh, i) / factorial(i::INT) * exp(-la) * pow(la, j) / factorial(j::INT) AS p FROM r, generate_series(0, 10) x(i), generate_series(0, 10) y(j)),
o AS (SELECT match_id, sum(p) FILTER (WHERE i > j) / sum(p) AS hp, sum(p) FILTER (WHERE i = j) / sum(p) AS dp, sum(p) FILTER (WHERE i < j) / sum(p) AS ap FROM g GROUP BY match_id)
SELECT match_id, round(hp, 5) AS home_prob, round(dp, 5) AS draw_prob, round(ap, 5) AS away_prob, round(lh, 3) AS expected_home_goals, round(la, 3) AS expected_away_goals, hn AS home_matches_considered, an AS away_matches_considered, n AS league_matches_considered FROM r JOIN o USING (match_id)""")
def poisson_forecast(spark, sf_dir):
    games = matches(spark, sf_dir)
    return forecast.forecast(games, features.legacy_form(appearances(games)))


FAMILIES = ["history_rest", "load_7_14_30", "form_last3_10", "form_last5", "form_venue", "form_competition", "form_h2h", "season_to_date"]


def _family_sql(name: str) -> str:
    """A family's SQL as a table expression of its own name, without the matches that it shares with others."""
    return f"{name} AS ({ORACLES[name].replace(f'WITH {MATCHES_SQL}, ', 'WITH ').replace(f'WITH {MATCHES_SQL}', '')})"


_TEAM_SQL = f"""team AS (SELECT * EXCLUDE (first_us, last_us), first_us AS history_first_kickoff_us, last_us AS history_last_kickoff_us, last_us + 10800000000 AS history_last_available_at_us
  FROM {FAMILIES[0]} {" ".join(f"JOIN {f} USING (match_id, team_id)" for f in FAMILIES[1:])}),
home AS (SELECT COLUMNS('(.*)') AS 'home_\\1' FROM team), away AS (SELECT COLUMNS('(.*)') AS 'away_\\1' FROM team)"""


def _minus_sql(names: str) -> str:
    return ", ".join(f"home_{c} - away_{c} AS {name}" for name, c in (n.split(":") for n in names.split()))


@query(f"""WITH {MATCHES_SQL}, {", ".join(map(_family_sql, FAMILIES))}, {_TEAM_SQL}
SELECT m.* EXCLUDE (utc_kickoff), epoch_us(utc_kickoff) AS utc_kickoff_us, h.* EXCLUDE (home_match_id, home_team_id), a.* EXCLUDE (away_match_id, away_team_id),
  CAST(CAST(utc_kickoff AS DATE) AS VARCHAR) AS match_date, year(utc_kickoff) AS kickoff_year, month(utc_kickoff) AS kickoff_month, isodow(utc_kickoff) AS kickoff_day_of_week, hour(utc_kickoff) AS kickoff_hour_utc,
  is_finished AND home_goals IS NOT NULL AND away_goals IS NOT NULL AS label_available, CASE WHEN label_available THEN CASE WHEN home_goals > away_goals THEN 'HOME_WIN' WHEN home_goals < away_goals THEN 'AWAY_WIN' ELSE 'DRAW' END END AS label_outcome_90min,
  CASE WHEN is_finished THEN home_goals END AS label_home_goals_90min, CASE WHEN is_finished THEN away_goals END AS label_away_goals_90min,
  {_minus_sql("points_difference_last_5:points_last_5 points_difference_last_10:points_last_10 goals_for_difference_last_5:goals_for_last_5 goals_against_difference_last_5:goals_against_last_5 goal_difference_difference_last_10:goal_difference_last_10 season_points_per_match_difference:season_points_per_match")},
  round(home_rest_days - away_rest_days, 3) AS rest_days_difference, home_matches_last_10 = 10 AND away_matches_last_10 = 10 AS has_full_history_last_10, home_matches_last_10 = 0 AS home_has_no_prior_results, away_matches_last_10 = 0 AS away_has_no_prior_results
FROM matches m JOIN home h ON home_match_id = m.match_id AND h.home_team_id = m.home_team_id JOIN away a ON away_match_id = m.match_id AND a.away_team_id = m.away_team_id""")
def training_product(spark, sf_dir):
    """The whole product; moments as microseconds, decimals as doubles and days as text, so that engines compare."""
    return _comparable(_product(spark, sf_dir))


def _product(spark, sf_dir):
    games = matches(spark, sf_dir)
    return features.product(games, features.team_features(appearances(games)))


def _comparable(df: DataFrame) -> DataFrame:
    kinds = {f.name: f.dataType.typeName() for f in df.schema}
    told = {"timestamp": lambda c: F.unix_micros(c).alias(f"{c}_us"), "decimal": lambda c: F.col(c).cast("double").alias(c), "date": lambda c: F.col(c).cast("string").alias(c)}
    return df.select(*[told.get(kinds[c], F.col)(c) for c in df.columns])


_LABEL_SQL = "CASE WHEN is_finished AND home_goals > away_goals THEN 'HOME_WIN' WHEN is_finished AND home_goals < away_goals THEN 'AWAY_WIN' WHEN is_finished AND home_goals = away_goals THEN 'DRAW' END"


def _labelled(spark, sf_dir):
    return matches(spark, sf_dir).withColumn("label_outcome_90min", F.when(F.col("is_finished"), outcome()))


@query(f"""WITH {MATCHES_SQL} SELECT match_id, CASE WHEN utc_kickoff + INTERVAL 3 HOUR < TIMESTAMP '2024-01-15' THEN 'train' ELSE 'test' END AS part FROM matches
WHERE {_LABEL_SQL} IS NOT NULL AND utc_kickoff + INTERVAL 3 HOUR < TIMESTAMP '2024-01-25' AND (utc_kickoff + INTERVAL 3 HOUR < TIMESTAMP '2024-01-15' OR utc_kickoff >= TIMESTAMP '2024-01-15' AND utc_kickoff < TIMESTAMP '2024-01-22')""")
def chronological_split(spark, sf_dir):
    parts = baseline.chronological_split(_labelled(spark, sf_dir), "label_outcome_90min", datetime(2024, 1, 15), datetime(2024, 1, 22), datetime(2024, 1, 25), history=())
    train, test = (df.select("match_id", F.lit(name).alias("part")) for df, name in zip(parts, ("train", "test")))
    return train.unionByName(test)


@query(f"""WITH {MATCHES_SQL} SELECT competition_code, season_id, CAST(count(*) AS BIGINT) AS matches, CAST(count({_LABEL_SQL}) AS BIGINT) AS labelled, epoch_us(min(utc_kickoff)) AS first_us, epoch_us(max(utc_kickoff)) AS last_us FROM matches GROUP BY 1, 2""")
def season_overview(spark, sf_dir):
    return _comparable(serve.season_overview(_labelled(spark, sf_dir)))


@query(f"WITH {MATCHES_SQL} SELECT label_outcome_90min, CAST(count(*) AS BIGINT) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1)::DOUBLE AS pct FROM (SELECT {_LABEL_SQL} AS label_outcome_90min FROM matches) WHERE label_outcome_90min IS NOT NULL GROUP BY 1")
def outcome_shares(spark, sf_dir):
    return serve.outcome_shares(_labelled(spark, sf_dir))


def _form_side_sql(side: str) -> str:
    names = {"form_matches": "matches_considered", "form_points": "points_last_5", "goals_scored_last_5": "goals_scored_last_5", "goals_conceded_last_5": "goals_conceded_last_5", "rest_days": "days_since_last_match"}
    return ", ".join(f"f{side[0]}.{c} AS {side}_{name}" for name, c in names.items())


@query(f"""WITH {MATCHES_SQL}, form AS ({LEGACY_SQL.replace("WITH " + MATCHES_SQL, "")}),
market AS (SELECT l_partkey AS match_id, avg(CAST(l_discount AS DOUBLE)) AS fair_prob_home, avg(CAST(l_tax AS DOUBLE)) AS fair_prob_draw, avg(CAST(l_quantity AS DOUBLE)) AS fair_prob_away, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1)
SELECT m.match_id, season_id, CAST(CAST(utc_kickoff AS DATE) AS VARCHAR) AS match_date, epoch_us(utc_kickoff) AS utc_kickoff_us, season_id AS matchday, is_finished, h.c_name AS home_team, a.c_name AS away_team, {_LABEL_SQL} AS outcome,
  home_goals, away_goals, {_form_side_sql("home")}, {_form_side_sql("away")}, o_orderpriority AS weather_status, CAST(o_totalprice AS DOUBLE) AS temperature_c, CAST(o_custkey AS BIGINT) AS precipitation_probability, CAST(o_totalprice AS DOUBLE) AS wind_speed_kmh,
  CAST(o_custkey AS BIGINT) AS weather_lead_days, CAST(s_acctbal AS DOUBLE) AS model_prob_home, CAST(s_acctbal AS DOUBLE) AS model_prob_draw, CAST(s_acctbal AS DOUBLE) AS model_prob_away,
  round(fair_prob_home, 6) AS fair_prob_home, round(fair_prob_draw, 6) AS fair_prob_draw, round(fair_prob_away, 6) AS fair_prob_away, CAST(coalesce(n, 0) AS BIGINT) AS bookmaker_count
FROM matches m JOIN customer h ON h.c_custkey = home_team_id JOIN customer a ON a.c_custkey = away_team_id LEFT JOIN form fh ON fh.match_id = m.match_id AND fh.team_id = home_team_id LEFT JOIN form fa ON fa.match_id = m.match_id AND fa.team_id = away_team_id
LEFT JOIN orders ON o_orderkey = m.match_id LEFT JOIN supplier ON s_suppkey = m.match_id LEFT JOIN market q ON q.match_id = m.match_id""")
def model_features(spark, sf_dir):
    """Orders stand for the weather, suppliers for the forecasts, line items for the quotes, customers for the teams."""
    games = matches(spark, sf_dir).withColumns({"match_date": F.to_date("utc_kickoff"), "matchday": F.col("season_id"), "outcome": F.when(F.col("is_finished"), outcome())})
    double, long = (lambda c, name: F.col(c).cast("double").alias(name)), (lambda c, name: F.col(c).cast("long").alias(name))
    teams = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("team_id"), F.col("c_name").alias("name"))
    rain = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("match_id"), F.col("o_orderpriority").alias("weather_status"), double("o_totalprice", "temperature_c"), long("o_custkey", "precipitation_probability"), double("o_totalprice", "wind_speed_kmh"), long("o_custkey", "lead_days"))
    guess = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("match_id"), *[double("s_acctbal", f"{s}_prob") for s in ("home", "draw", "away")])
    quotes = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("match_id"), F.col("l_suppkey").alias("bookmaker_key"), double("l_discount", "home_prob_fair"), double("l_tax", "draw_prob_fair"), double("l_quantity", "away_prob_fair"))
    out = serve.model_features(games, teams, features.legacy_form(appearances(games)), rain, guess, quotes)
    return _comparable(out.withColumns({f"fair_prob_{s}": F.round(f"fair_prob_{s}", 6) for s in ("home", "draw", "away")}))


@query("SELECT DISTINCT ON (user_id) user_id, event_id, event_type, value FROM events ORDER BY user_id, ts DESC NULLS FIRST, event_id DESC")
def latest_event_per_user(spark, sf_dir):
    return keep_latest(table(spark, sf_dir, "events"), ["user_id"], newest("ts", "event_id")).select("user_id", "event_id", "event_type", "value")


@query("SELECT DISTINCT ON (o_custkey, o_orderpriority) o_custkey, o_orderpriority, o_orderkey FROM orders ORDER BY o_custkey, o_orderpriority, o_orderstatus = 'F', o_orderdate DESC NULLS FIRST, o_orderkey DESC")
def latest_two_scopes(spark, sf_dir):
    return keep_latest(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderpriority"], [(F.col("o_orderstatus") == "F").asc(), *newest("o_orderdate", "o_orderkey")]).select("o_custkey", "o_orderpriority", "o_orderkey")


@query("SELECT user_id, event_id, value FROM (SELECT DISTINCT ON (user_id) * FROM events WHERE event_type <> 'view' ORDER BY user_id, ts DESC, event_id DESC) WHERE value BETWEEN 10 AND 90")
def select_latest_then_filter(spark, sf_dir):
    return latest_then(table(spark, sf_dir, "events").where("event_type <> 'view'"), ["user_id"], newest("ts", "event_id"), F.col("value").between(10, 90)).select("user_id", "event_id", "value")


ROLES_SQL = "SELECT l_orderkey, l_suppkey % 5 AS book, max(CAST(1 + l_quantity / 10 AS DECIMAL(9,3))) FILTER (WHERE l_returnflag = 'A') AS home_price, max(CAST(1 + l_quantity / 10 AS DECIMAL(9,3))) FILTER (WHERE l_returnflag = 'N') AS draw_price, max(CAST(1 + l_quantity / 10 AS DECIMAL(9,3))) FILTER (WHERE l_returnflag = 'R') AS away_price FROM lineitem GROUP BY ALL"


def _roles(spark, sf_dir):
    price = (1 + F.col("l_quantity") / 10).cast("decimal(9,3)")
    role = lambda flag, name: F.max(F.when(F.col("l_returnflag") == flag, price)).alias(name)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey", (F.col("l_suppkey") % 5).alias("book")).agg(role("A", "home_price"), role("N", "draw_price"), role("R", "away_price"))


@query(ROLES_SQL)
def pivot_roles(spark, sf_dir):
    return _roles(spark, sf_dir)


@query(f"""SELECT l_orderkey, book, t IS NOT NULL AS is_complete, round(t - 1, 5) AS overround, round((1 / home_price::DOUBLE) / t, 5) AS home_prob_fair, round((1 / draw_price::DOUBLE) / t, 5) AS draw_prob_fair, round((1 / away_price::DOUBLE) / t, 5) AS away_prob_fair
FROM (SELECT *, 1 / home_price::DOUBLE + 1 / draw_price::DOUBLE + 1 / away_price::DOUBLE AS t FROM ({ROLES_SQL}))""")
def overround_fair(spark, sf_dir):
    prices = ["home_price", "draw_price", "away_price"]
    return _roles(spark, sf_dir).select("l_orderkey", "book", implied_total(prices).isNotNull().alias("is_complete"), overround(prices).alias("overround"), *[fair(p, prices).alias(p.replace("price", "prob_fair")) for p in prices])


@query("""SELECT user_id, event_type, CAST(floor(value / 10) AS BIGINT) AS quote, epoch_us(min(ts)) AS first_us, epoch_us(max(ts)) AS last_us, arg_max(event_id, struct_pack(a := ts, b := event_id)) AS newest_id, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2, 3""")
def quote_changes(spark, sf_dir):
    quoted = table(spark, sf_dir, "events").withColumn("quote", F.floor(F.col("value") / 10).cast("long"))
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return quoted.groupBy("user_id", "event_type", "quote").agg(us(F.min("ts")).alias("first_us"), us(F.max("ts")).alias("last_us"), F.max_by("event_id", F.struct("ts", "event_id")).alias("newest_id"), F.count("*").alias("n"))


@query("""SELECT user_id, event_type, last_us < scope_us AS is_withdrawn FROM (SELECT user_id, event_type, epoch_us(max(ts)) AS last_us FROM events GROUP BY ALL) JOIN (SELECT event_type, epoch_us(max(ts)) - 86400000000 AS scope_us FROM events GROUP BY ALL) USING (event_type)""")
def withdrawn_flag(spark, sf_dir):
    e = table(spark, sf_dir, "events").withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    scope = e.groupBy("event_type").agg((F.max("us") - DAY).alias("scope_us"))
    return e.groupBy("user_id", "event_type").agg(F.max("us").alias("last_us")).join(scope, "event_type").select("user_id", "event_type", (F.col("last_us") < F.col("scope_us")).alias("is_withdrawn"))


@query("""SELECT a.event_id, p.event_id AS seen_id, p.value AS seen_value FROM events a LEFT JOIN LATERAL (SELECT * FROM events p WHERE p.user_id = a.user_id AND p.event_type = 'purchase' AND p.ts < a.ts ORDER BY p.ts DESC, p.event_id DESC LIMIT 1) p ON true""")
def asof_newest_prior(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    seen = e.where("event_type = 'purchase'").select("user_id", "ts", F.col("event_id").alias("seen_id"), F.col("value").alias("seen_value"))
    return as_of(e, seen, ["user_id"], "ts", "ts", ["seen_id", "seen_value"], tie=["seen_id"]).select("event_id", "seen_id", "seen_value")


_OBS = "observations AS (SELECT event_id AS obs_id, user_id AS o_user, ts AS observed_at, ts + INTERVAL 1 HOUR * CAST(floor(value) AS BIGINT) AS valid_until, value AS o_value FROM events WHERE event_type IN ('click', 'purchase'))"


def _observations(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type IN ('click', 'purchase')")
    return e.select(F.col("event_id").alias("obs_id"), F.col("user_id").alias("o_user"), F.col("ts").alias("observed_at"), (F.unix_micros(F.col("ts").cast("timestamp")) + F.floor("value").cast("long") * F.lit(3_600_000_000)).alias("until_us"), F.col("value").alias("o_value"))


@query(f"""WITH {_OBS} SELECT e.event_id, o.obs_id, o.o_value FROM (SELECT * FROM events WHERE event_type = 'view') e LEFT JOIN LATERAL (SELECT * FROM observations o WHERE o.o_user = e.user_id AND o.observed_at < e.ts AND e.ts < o.valid_until ORDER BY o.observed_at DESC, o.obs_id DESC LIMIT 1) o ON true""")
def asof_validity(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type = 'view'").select("event_id", "user_id", "ts")
    o = _observations(spark, sf_dir).withColumn("until", F.timestamp_micros("until_us"))
    return as_of_valid(e, o.withColumnRenamed("o_user", "user_id"), ["user_id"], "event_id", "ts", "observed_at", "until", ["obs_id", "o_value"], ["obs_id"]).select("event_id", "obs_id", "o_value")


@query(f"""WITH {_OBS} SELECT e.event_id, o.obs_id FROM (SELECT * FROM events WHERE event_type = 'view') e LEFT JOIN LATERAL (SELECT * FROM observations o WHERE o.o_user = e.user_id AND CAST(o.observed_at AS DATE) < CAST(e.ts AS DATE) AND date_diff('day', CAST(o.observed_at AS DATE), CAST(e.ts AS DATE)) <= 5 ORDER BY CAST(o.observed_at AS DATE) DESC, o.observed_at DESC, o.obs_id DESC LIMIT 1) o ON true""")
def asof_maxage(spark, sf_dir):
    e = table(spark, sf_dir, "events").where("event_type = 'view'").select("event_id", "user_id", "ts")
    o = _observations(spark, sf_dir).withColumnRenamed("o_user", "user_id")
    return as_of_days(e, o, ["user_id"], "ts", "observed_at", 5, ["obs_id"], ["obs_id"]).select("event_id", "obs_id")


@query("""SELECT event_id, event_type, epoch_us(min(ts) OVER (PARTITION BY user_id, run)) AS since_us FROM (SELECT *, sum(changed) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM (SELECT *, CASE WHEN lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) = event_type THEN 0 ELSE 1 END AS changed FROM events))""")
def gap_islands_first_seen(spark, sf_dir):
    out = first_of_current_run(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], "event_type", "since")
    return out.select("event_id", "event_type", F.unix_micros(F.col("since").cast("timestamp")).alias("since_us"))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F') AND EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey AND s_acctbal > 0)")
def semi_known_parent(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    suppliers = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_suppkey").alias("l_suppkey"))
    return table(spark, sf_dir, "lineitem").join(suppliers, "l_suppkey", "left_semi").join(orders, "l_orderkey", "left_semi").select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def anti_unstaged(spark, sf_dir):
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return unseen(table(spark, sf_dir, "customer"), urgent, ["c_custkey"]).select("c_custkey", "c_name")


@query("SELECT o_orderkey, l_linenumber FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate > o_orderdate AND l_quantity > 45")
def left_residual(spark, sf_dir):
    o, li = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem").where("l_quantity > 45")
    return o.join(li, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("l_shipdate") > F.col("o_orderdate")), "left").select("o_orderkey", "l_linenumber")


@query("""SELECT o_orderkey, CASE WHEN n > 0 THEN 'AVAILABLE' WHEN c_mktsegment IS DISTINCT FROM 'BUILDING' THEN 'VENUE_UNKNOWN' WHEN o_orderdate > TIMESTAMP '1998-01-01' + INTERVAL 15 DAY THEN 'NOT_YET_AVAILABLE' WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'NOT_CAPTURED' ELSE 'MISSING' END AS status
FROM orders LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_quantity > 40 GROUP BY 1) ON l_orderkey = o_orderkey""")
def status_machine(spark, sf_dir):
    day = F.lit("1998-01-01").cast("timestamp_ntz")
    known = table(spark, sf_dir, "lineitem").where("l_quantity > 40").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    rows = table(spark, sf_dir, "orders").join(c, F.col("c_custkey") == F.col("o_custkey"), "left").join(known, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    status = F.when(F.col("n") > 0, "AVAILABLE").when(~F.col("c_mktsegment").eqNullSafe("BUILDING"), "VENUE_UNKNOWN").when(F.col("o_orderdate") > day + F.expr("INTERVAL 15 DAYS"), "NOT_YET_AVAILABLE").when(F.col("o_orderdate") < day, "NOT_CAPTURED").otherwise("MISSING")
    return rows.select("o_orderkey", status.alias("status"))


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, json_exists(props, '$.k') AS has_k, json_exists(props, '$.season') AS has_season FROM events")
def json_unpack(spark, sf_dir):
    parsed = F.from_json("props", "k bigint")
    has = lambda key: F.array_contains(F.json_object_keys("props"), key)
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"), has("k").alias("has_k"), has("season").alias("has_season"))


@query("SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_quantity) AS INTEGER) AS pos, l_partkey, l_quantity FROM lineitem")
def zip_arrays(spark, sf_dir):
    lines = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity")))
    columnar = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(lines.alias("x")).select("l_orderkey", F.col("x.l_partkey").alias("parts"), F.col("x.l_quantity").alias("amounts"))
    return columnar.select("l_orderkey", F.posexplode(F.arrays_zip("parts", "amounts"))).select("l_orderkey", (F.col("pos") + 1).alias("pos"), F.col("col.parts").alias("l_partkey"), F.col("col.amounts").alias("l_quantity"))


@query("SELECT p_partkey, CASE WHEN regexp_matches(lower(p_type), 'steel') THEN 'GK' WHEN regexp_matches(lower(p_type), 'copper|brass') THEN 'DF' WHEN regexp_matches(lower(p_type), 'tin') THEN 'MF' WHEN regexp_matches(lower(p_type), 'nickel|promo') THEN 'FW' ELSE 'UNKNOWN' END AS role FROM part")
def position_regex(spark, sf_dir):
    t = F.lower("p_type")
    return table(spark, sf_dir, "part").select("p_partkey", F.when(t.rlike("steel"), "GK").when(t.rlike("copper|brass"), "DF").when(t.rlike("tin"), "MF").when(t.rlike("nickel|promo"), "FW").otherwise("UNKNOWN").alias("role"))


@query("SELECT doc_id, source FROM documents WHERE text ILIKE '%license%' AND lang IN ('en', 'de')")
def ilike_search(spark, sf_dir):
    return table(spark, sf_dir, "documents").where(F.col("text").ilike("%license%") & F.col("lang").isin("en", "de")).select("doc_id", "source")


@query("SELECT l_suppkey, list_sort(list(DISTINCT l_returnflag)) AS flags, string_agg(DISTINCT l_linestatus, ', ' ORDER BY l_linestatus) AS statuses, CAST(count(DISTINCT l_partkey) AS BIGINT) AS n_parts, bool_and(l_quantity > 0) AS all_positive, round(stddev_pop(CAST(l_quantity AS BIGINT)), 6) AS spread FROM lineitem GROUP BY l_suppkey")
def aggregates(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.array_sort(F.collect_set("l_returnflag")).alias("flags"), F.array_join(F.array_sort(F.collect_set("l_linestatus")), ", ").alias("statuses"), F.countDistinct("l_partkey").alias("n_parts"), F.bool_and(F.col("l_quantity") > 0).alias("all_positive"), F.round(F.stddev_pop("l_quantity"), 6).alias("spread"))


@query("SELECT o_orderpriority, CAST(count(*) AS BIGINT) AS n, round(100.0 * count(*) / sum(count(*)) OVER (), 4)::DOUBLE AS pct FROM orders GROUP BY 1")
def pct_of_total(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n")).withColumn("pct", F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 4))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey LIMIT 50 OFFSET 100")
def page_offset(spark, sf_dir):
    return table(spark, sf_dir, "orders").orderBy(F.col("o_orderdate").desc_nulls_first(), "o_orderkey").offset(100).limit(50).select("o_orderkey", "o_totalprice")


@query(f"WITH {MATCHES_SQL} SELECT match_id, team_id, opponent_team_id, is_home, goals_for, goals_against, CAST(points AS BIGINT) AS points FROM apps")
def unpivot_sides_all(spark, sf_dir):
    return apps(spark, sf_dir).select("match_id", "team_id", "opponent_team_id", "is_home", "goals_for", "goals_against", "points")


@query("SELECT n_nationkey AS key FROM nation UNION SELECT c_nationkey FROM customer UNION SELECT s_nationkey FROM supplier")
def union_distinct(spark, sf_dir):
    key = lambda t, c: table(spark, sf_dir, t).select(F.col(c).alias("key"))
    return key("nation", "n_nationkey").union(key("customer", "c_nationkey")).union(key("supplier", "s_nationkey")).distinct()


def _split(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("us"))
    late = keep_latest(e.where("event_id % 2 = 0"), ["user_id", "event_type"], newest("us", "event_id"))
    early = keep_latest(e.where("event_id % 2 = 1"), ["user_id", "event_type"], newest("us", "event_id"))
    return early, late


_SPLIT_SQL = "e AS (SELECT user_id, event_type, event_id, value, epoch_us(ts) AS us FROM events), o AS (SELECT DISTINCT ON (user_id, event_type) * FROM e WHERE event_id % 2 = 1 ORDER BY user_id, event_type, us DESC, event_id DESC), n AS (SELECT DISTINCT ON (user_id, event_type) * FROM e WHERE event_id % 2 = 0 ORDER BY user_id, event_type, us DESC, event_id DESC)"


@query(f"WITH {_SPLIT_SQL} SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, value, us FROM (SELECT *, 0 AS f FROM o UNION ALL SELECT *, 1 AS f FROM n) ORDER BY user_id, event_type, us DESC, f DESC")
def upsert_guarded(spark, sf_dir):
    return upsert(*_split(spark, sf_dir), ["user_id", "event_type"], "us")


@query(f"WITH {_SPLIT_SQL} SELECT user_id, event_type, min(us) AS first_us, max(us) AS last_us, arg_max(event_id, us) AS event_id FROM (SELECT * FROM o UNION ALL SELECT * FROM n) GROUP BY 1, 2")
def upsert_widen(spark, sf_dir):
    early, late = (x.select("user_id", "event_type", F.col("us").alias("first_us"), F.col("us").alias("last_us"), "event_id") for x in _split(spark, sf_dir))
    return widen(early, late, ["user_id", "event_type"], "first_us", "last_us", ["event_id"])


@query(f"WITH {_SPLIT_SQL} SELECT user_id, event_type, event_id, value, us FROM o UNION ALL SELECT user_id, event_type, event_id, value, us FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.user_id = n.user_id AND o.event_type = n.event_type)")
def insert_absent(spark, sf_dir):
    return insert_if_absent(*_split(spark, sf_dir), ["user_id", "event_type"], newest("us", "event_id"))


_TOKENS = "list_distinct(list_filter(string_split_regex(lower({0}), '[^a-z0-9]+'), lambda x: x <> '' AND x NOT IN ('de', 'fc')))"


_OVERLAP_SQL = f"""WITH p AS (SELECT p_partkey, p_size, {_TOKENS.format("p_name")} AS t FROM part), q AS (SELECT p_partkey AS q_partkey, p_size AS q_size, t AS u FROM p)
SELECT q_partkey, p_partkey, len(list_intersect(t, u)) / CAST(least(len(t), len(u)) AS DOUBLE) AS score FROM p JOIN q ON p_size = q_size AND p_partkey <> q_partkey WHERE least(len(t), len(u)) > 0 AND len(list_intersect(t, u)) / CAST(least(len(t), len(u)) AS DOUBLE) >= 0.5"""


@query(_OVERLAP_SQL)
def name_overlap_match(spark, sf_dir):
    return name_overlap_all(spark, sf_dir)


@query(_OVERLAP_SQL)
def name_overlap_all(spark, sf_dir):
    """Every part with all parts of its size whose names overlap by half. An overlap above 0 needs a shared token."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_size", tokens(F.col("p_name"), ["de", "fc"], False).alias("t"))
    return overlap_join(p, "p_partkey", "p_size", "t", overlap, 0.5).withColumnRenamed("other_p_partkey", "q_partkey")


@query("""WITH a AS (SELECT event_id AS a_id, ts AS a_ts, value AS a_value FROM events WHERE event_type = 'purchase'), b AS (SELECT event_id AS b_id, ts AS b_ts, value AS b_value FROM events WHERE event_type = 'signup'),
s AS (SELECT a_id, b_id, 100 - abs(a_value - b_value) AS score FROM a JOIN b ON abs(epoch_us(a_ts) - epoch_us(b_ts)) <= 10800000000 AND abs(a_value - b_value) <= 40),
r AS (SELECT *, row_number() OVER (PARTITION BY a_id ORDER BY score DESC, b_id DESC) AS n, lead(score) OVER (PARTITION BY a_id ORDER BY score DESC, b_id DESC) AS nx FROM s)
SELECT a_id, b_id, score FROM r WHERE n = 1 AND nx IS DISTINCT FROM score""")
def interval_match(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    side = lambda kind, p: e.where(F.col("event_type") == kind).select(*[F.col(c).alias(f"{p}_{n}") for c, n in (("event_id", "id"), ("ts", "ts"), ("value", "value"))])
    return best_nearest(side("purchase", "a"), side("signup", "b"), "a_id", "b_id", ("a_ts", "b_ts"), 3 * 3_600_000_000, ("a_value", "b_value"), lambda gap: 100 - gap, 40)


@query("""SELECT * FROM (SELECT 'orders_not_empty' AS check_name, 'orders' AS target, 'CRITICAL' AS severity, count(*) AS observed, count(*) >= 1 AS passed FROM orders
UNION ALL SELECT 'order_key_unique', 'orders', 'CRITICAL', count(*), count(*) = 0 FROM (SELECT o_orderkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'line_without_order', 'lineitem', 'CRITICAL', count(*), count(*) = 0 FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
UNION ALL SELECT 'discount_plausible', 'lineitem', 'WARNING', count(*), count(*) = 0 FROM lineitem WHERE l_discount NOT BETWEEN 0 AND 0.1
UNION ALL SELECT 'quantity_positive', 'lineitem', 'CRITICAL', count(*), count(*) = 0 FROM lineitem WHERE l_quantity <= 0
UNION ALL SELECT 'price_matches_customer', 'orders', 'WARNING', count(*), count(*) = 0 FROM orders WHERE o_totalprice < 0)""")
def dq_checks(spark, sf_dir):
    tables = {t: table(spark, sf_dir, t) for t in ("orders", "lineitem")}
    checks = [
        Check("orders_not_empty", "orders", CRITICAL, F.lit(True), at_least=1),
        Check("order_key_unique", "orders", CRITICAL, lambda t: t["orders"].groupBy("o_orderkey").count().where("count > 1")),
        Check("line_without_order", "lineitem", CRITICAL, lambda t: t["lineitem"].join(t["orders"], F.col("l_orderkey") == F.col("o_orderkey"), "left_anti")),
        Check("discount_plausible", "lineitem", WARNING, ~F.col("l_discount").between(0, 0.1)),
        Check("quantity_positive", "lineitem", CRITICAL, F.col("l_quantity") <= 0),
        Check("price_matches_customer", "orders", WARNING, F.col("o_totalprice") < 0),
    ]
    return run(spark, tables, checks).drop("observed").withColumnRenamed("n", "observed")


@query("""WITH p AS (SELECT doc_id, quality, CASE WHEN n_chars > 1000 THEN 0.9 ELSE 0.6 END AS p FROM labels JOIN documents USING (doc_id))
SELECT CAST(count(*) AS BIGINT) AS n, round(avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END), 6) AS accuracy, round(avg(2 * (quality - p) * (quality - p)), 6)::DOUBLE AS brier, round(-avg(ln(CASE WHEN quality = 1 THEN p ELSE 1 - p END)), 6) AS log_loss FROM p""")
def metrics_brier(spark, sf_dir):
    rows = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    p = F.when(F.col("n_chars") > 1000, 0.9).otherwise(0.6)
    scored = rows.select(F.col("quality").cast("string").alias("label"), F.map_from_arrays(F.array(F.lit("0"), F.lit("1")), F.array(1 - p, p)).alias("probabilities"))
    return baseline.class_metrics(scored).select("n", "accuracy", "brier", "log_loss")


@query("""SELECT page_id, CAST(unnest(range(len(h))) AS INTEGER) AS pos, unnest(h) AS href FROM (SELECT page_id, list_filter(list_transform(regexp_extract_all(regexp_replace(html, '(?is)<!--.*?-->|<script\\b[^>]*>.*?</script>|<style\\b[^>]*>.*?</style>', ' ', 'g'), '(?is)<a\\s[^>]*>'), lambda a: regexp_extract(a, '(?is)\\shref="([^"]*)"', 1)), lambda x: x <> '') AS h FROM pages)""")
def html_links(spark, sf_dir):
    return links(table(spark, sf_dir, "pages"), "page_id", "html")


_AUDIT_SQL = " OR ".join(f"contains(column_name, '{w}')" for w in AUDIT_WORDS)


@query(f"""WITH product AS ({ORACLES["training_product"]}), counted AS (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM product) ON COLUMNS(*) INTO NAME column_name VALUE n)
SELECT column_name, CASE WHEN column_name LIKE 'label#_%' ESCAPE '#' THEN 'label' WHEN column_name IN ({", ".join(f"'{c}'" for c in sorted(IDENTIFIERS))}) OR column_name LIKE '%#_id' ESCAPE '#' OR column_name LIKE '%#_name' ESCAPE '#' THEN 'identifier'
  WHEN column_name LIKE 'audit#_%' ESCAPE '#' OR column_name LIKE '%#_at' ESCAPE '#' OR {_AUDIT_SQL} THEN 'audit' ELSE 'feature' END AS role, CAST((SELECT count(*) FROM product) - n AS BIGINT) AS n_null, CAST((SELECT count(*) FROM product) AS BIGINT) AS n_rows FROM counted""")
def export_roles(spark, sf_dir):
    """Role and nulls of every column of the training product."""
    return coverage(_comparable(_product(spark, sf_dir)))

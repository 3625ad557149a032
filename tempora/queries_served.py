"""Queries of squads, contracts, cached seasons and what a viewer asks; and their DuckDB SQL."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.functions import weather as words
from tempora.operators.latest import keep_latest
from tempora.operators.merge import first_seen
from tempora.operators.quality import run
from tempora.plans import context, features, serve, weather
from tempora.plans.checks import checks
from tempora.plans.facts import outcome
from tempora.plans.fixtures import MATCHES_SQL, appearances, matches
from tempora.queries import LEGACY_SQL, _LABEL_SQL, _labelled
from tempora.queries_known import _QUOTES_SQL, _market
from tempora.registry import query, table
from tempora.sources import contracts, planner

#: Positions that parts stand for, by key; the last one is unknown.
POSITIONS = ["Goalkeeper", "Centre-Back", "Defence", "Central Midfield", "Left Winger", "Offence", "Striker", None]
_ROLES = {"GK": (0,), "DF": (1, 2), "MF": (3,), "FW": (4, 5, 6), "UNKNOWN": (7,)}


def _role_sql() -> str:
    return ", ".join(f"CASE WHEN count(id) > 0 THEN CAST(count(*) FILTER (WHERE id % 8 IN ({', '.join(map(str, at))})) AS INTEGER) END AS {context.ROLE_COUNTS[role]}" for role, at in _ROLES.items())


@query(f"""WITH p AS (SELECT DISTINCT l_orderkey, l_partkey AS id, CASE WHEN l_partkey % 7 <> 0 AND l_partkey % 11 <> 0 THEN DATE '1980-01-01' + CAST(l_partkey % 9000 AS INTEGER) END AS born, CASE WHEN l_partkey % 5 <> 0 THEN 'N' || l_partkey % 4 END AS nation FROM lineitem WHERE l_partkey % 13 <> 0),
a AS (SELECT o_orderkey, id, nation, (CAST(o_orderdate AS DATE) - born) / 365.2425::DOUBLE AS age, CASE WHEN o_orderkey % 2 = 0 THEN 'N1' END AS home FROM orders LEFT JOIN p ON l_orderkey = o_orderkey)
SELECT o_orderkey, CASE WHEN count(id) > 0 THEN CAST(count(id) AS INTEGER) END AS squad_size, round(avg(age), 6) AS squad_avg_age, round(min(age), 6) AS squad_min_age, round(max(age), 6) AS squad_max_age, CAST(nullif(count(DISTINCT nation), 0) AS INTEGER) AS squad_nationalities,
  CASE WHEN count(id) > 0 AND count(nation) = count(id) AND any_value(home) IS NOT NULL THEN CAST(count(*) FILTER (WHERE nation <> home) AS INTEGER) END AS squad_foreign_players, CASE WHEN count(id) > 0 THEN CAST(count(id) - count(age) AS INTEGER) END AS squad_missing_birthdates, {_role_sql()}
FROM a GROUP BY o_orderkey""")
def squad_aggregates(spark, sf_dir):
    """Orders as teams, their lines as players: nested arrays, reduced where they stand."""
    key = F.col("l_partkey")
    born = F.when(key % 7 == 0, "").when(key % 11 == 0, "1990-02-31").otherwise(F.date_add(F.lit("1980-01-01").cast("date"), (key % 9000).cast("int")).cast("string"))
    position = F.get(F.array(*[F.lit(p) for p in POSITIONS]), (key % 8).cast("int"))
    player = F.struct(F.when(key % 13 != 0, key).alias("id"), position.alias("position"), born.alias("dateOfBirth"), F.when(key % 5 == 0, "").otherwise(F.concat(F.lit("N"), (key % 4).cast("string"))).alias("nationality"), F.col("l_linenumber").alias("shirtNumber"))
    squads = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(player).alias("squad"))
    teams = table(spark, sf_dir, "orders").join(squads, "o_orderkey", "left").withColumn("squad", context.players(F.col("squad")))
    told = context.squad_told(F.col("squad"), F.col("o_orderdate"), F.when(F.col("o_orderkey") % 2 == 0, "N1"))
    rows = teams.select("o_orderkey", told.alias("told")).select("o_orderkey", "told.*")
    return rows.select(*[F.round(c, 6).alias(c) if c.endswith("_age") else F.col(c) for c in rows.columns])


#: What a payload made of an event must have.
RULES = [("id", "int", False), ("user.name", "str", False), ("user.rank", "int", True), ("props.k", "int", False), ("tags[].at", "timestamp", False), ("season.id", "int", False), ("kind", "str", False)]


@query("""WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
p AS (SELECT event_id, list_filter([
  CASE WHEN k % 5 = 0 THEN 'id is null' END, CASE WHEN k % 4 = 1 THEN 'user.name is not str: ''' || user_id || '''' END, CASE WHEN k % 3 = 2 THEN 'user.rank is not int: ''first''' END,
  CASE WHEN k % 10 = 0 THEN 'props.k missing' END, CASE k % 6 WHEN 0 THEN 'tags is empty' WHEN 1 THEN 'tags missing or not a list' WHEN 2 THEN 'tags[1] (id 4).at is not timestamp: ''2024''' WHEN 3 THEN 'tags[0] is not an object' END,
  CASE WHEN k % 2 = 0 THEN 'season.id missing' END, CASE WHEN k % 8 = 0 THEN 'kind missing' END], lambda x: x IS NOT NULL) AS all_ FROM e)
SELECT event_id, CAST(len(all_) AS BIGINT) AS n_problems, array_to_string(all_[1:5], '; ') || CASE WHEN len(all_) > 5 THEN ' (and ' || len(all_) - 5 || ' more)' ELSE '' END AS shown FROM p""")
def contract_verdicts(spark, sf_dir):
    """Payloads made from events.props, each held against its contract: the first five problems and their count."""
    k = F.get_json_object("props", "$.k").cast("long")
    either = lambda cond, yes, no="": F.when(cond, F.lit(yes)).otherwise(F.lit(no))
    tags = F.when(k % 6 == 0, '"tags": []').when(k % 6 == 1, '"tags": {}').when(k % 6 == 2, '"tags": [{"at": "2024-01-01T00:00:00Z"}, {"id": 4, "at": "2024"}]').when(k % 6 == 3, '"tags": [7]').otherwise('"tags": [{"at": "2024-01-01T00:00:00+01:00"}]')
    name = F.when(k % 4 == 1, F.col("user_id").cast("string")).otherwise(F.lit('"u"'))
    payload = F.concat(
        F.lit('{"id": '), F.when(k % 5 == 0, "null").otherwise(F.col("event_id").cast("string")), F.lit(', "user": {"name": '), name, either(k % 3 == 2, ', "rank": "first"}', ', "rank": null}'), F.lit(', "props": '), F.when(k % 10 == 0, "{}").otherwise(F.col("props")),
        F.lit(", "), tags, either(k % 2 == 0, ', "season": null', ', "season": {"id": 1}'), either(k % 8 == 0, "", ', "kind": "x"'), F.lit("}"),
    )
    return contracts.verdicts(table(spark, sf_dir, "events").select("event_id", payload.alias("payload")), RULES, "event_id", "payload")


_SEASON_DAY = "2024-01-20"


@query(f"""WITH e AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(ts AS DATE) <= DATE '{_SEASON_DAY}' AND event_type <> 'error'),
held AS (SELECT 'competitions/' || event_type || '/' || user_id || CASE k % 3 WHEN 1 THEN '/matches' ELSE '/teams' END AS endpoint, 'competitions/' || event_type || '/' || user_id AS root, CAST(2020 + k % 6 AS VARCHAR) AS season, 2020 + event_id % 6 || '-05-31' AS ended FROM e WHERE k % 3 <> 0 AND k % 10 <> 7),
begun AS (SELECT 'competitions/' || event_type || '/' || user_id AS root, CAST(2019 + event_id % 6 AS VARCHAR) AS began FROM e WHERE k % 3 = 0)
SELECT DISTINCT endpoint, season FROM held WHERE ended < '{_SEASON_DAY}' AND EXISTS (SELECT 1 FROM begun WHERE begun.root = held.root AND began > season)""")
def cached_seasons(spark, sf_dir):
    """Events as stored answers: of a competition, its matches or its teams, by season or not."""
    k = F.get_json_object("props", "$.k").cast("long")
    e = table(spark, sf_dir, "events")
    root = F.concat_ws("/", F.lit("competitions"), "event_type", F.col("user_id").cast("string"))
    year = lambda c: c.cast("string")
    ended = F.concat(year(2020 + F.col("event_id") % 6), F.lit("-05-31"))
    body = F.when(k % 3 == 0, F.concat(F.lit('{"currentSeason": {"startDate": "'), year(2019 + F.col("event_id") % 6), F.lit('-08-01"}}'))).when(k % 3 == 1, F.concat(F.lit('{"matches": [{"season": {"endDate": "'), ended, F.lit('"}}]}'))).otherwise(F.concat(F.lit('{"season": {"endDate": "'), ended, F.lit('"}, "teams": []}')))
    params = F.when((k % 3 == 0) | (k % 10 == 7), "{}").otherwise(F.concat(F.lit('{"season": "'), year(2020 + k % 6), F.lit('"}')))
    raw = e.select(F.when(F.col("event_type") == "error", "sample").otherwise("live").alias("source"), F.concat(root, F.when(k % 3 == 0, "").when(k % 3 == 1, "/matches").otherwise("/teams")).alias("endpoint"), params.alias("request_params"), body.alias("payload"), F.to_date("ts").alias("ingestion_date"))
    return planner.cached_seasons(raw, "live", _SEASON_DAY)


_KINDS = "click error purchase signup view".split()


@query(f"""SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {", ".join(f"round(avg(value) FILTER (WHERE event_type = '{x}' AND event_id % 4 <> 0), 6) AS {x}" for x in _KINDS)} FROM events WHERE event_id % 4 <> 0 GROUP BY 1""")
def pivot_table(spark, sf_dir):
    """A column for each kind of event that occurs, found by a first pass."""
    rows = table(spark, sf_dir, "events").select(F.to_date("ts").cast("string").alias("day"), "event_type", F.when(F.col("event_id") % 4 != 0, F.col("value")).alias("value"))
    out = serve.pivot_mean(rows, ["day"], "event_type", "value")
    return out.select("day", *[F.round(c, 6).alias(c) for c in out.columns[1:]])


@query(f"""WITH {MATCHES_SQL} SELECT CAST(count(*) AS BIGINT) AS matches, CAST(count({_LABEL_SQL}) AS BIGINT) AS labelled, CAST(count(DISTINCT season_id) AS BIGINT) AS seasons, CAST(count(DISTINCT competition_code) AS BIGINT) AS competitions FROM matches""")
def dataset_summary(spark, sf_dir):
    return serve.dataset_summary(_labelled(spark, sf_dir))


FEATURES = [("Form, home", "home_form_matches", "no finished match before"), ("Goals, home", "home_goals", "not played yet"), ("Label", "label_outcome_90min", "no score"), ("Weather", "temperature_c", "no forecast")]


@query(f"""WITH {MATCHES_SQL}, form AS ({LEGACY_SQL.replace("WITH " + MATCHES_SQL, "")}), m AS (SELECT m.*, matches_considered, {_LABEL_SQL} AS label FROM matches m LEFT JOIN form f ON f.match_id = m.match_id AND f.team_id = m.home_team_id),
c AS (SELECT count(*) AS n, [count(*) FILTER (WHERE matches_considered > 0), count(home_goals), count(label), 0] AS p FROM m), f AS (SELECT unnest([{", ".join(f"'{x[0]}'" for x in FEATURES)}]) AS feature, unnest([{", ".join(f"'{x[2]}'" for x in FEATURES)}]) AS absent_because, unnest(range(1, 5)) AS i)
SELECT feature, CAST(p[i] AS BIGINT) AS present, CAST(floor(100.0::DOUBLE * p[i] / n + 0.5) AS INTEGER) AS share, absent_because FROM f, c""")
def feature_coverage(spark, sf_dir):
    games = _labelled(spark, sf_dir)
    form = features.legacy_form(appearances(games)).select("match_id", F.col("team_id").alias("home_team_id"), F.col("matches_considered").alias("home_form_matches"))
    return serve.feature_coverage(games.join(form, ["match_id", "home_team_id"], "left"), FEATURES)


@query(f"""WITH {_QUOTES_SQL}, t AS (SELECT *, 1 / home_price::DOUBLE + 1 / draw_price::DOUBLE + 1 / away_price::DOUBLE AS total FROM facts WHERE away_price IS NOT NULL),
q AS (SELECT *, [round((1 / home_price::DOUBLE) / total, 5), round((1 / draw_price::DOUBLE) / total, 5), round((1 / away_price::DOUBLE) / total, 5)] AS fair, row_number() OVER (PARTITION BY match_id, book ORDER BY last_seen DESC, first_seen DESC, updated DESC, home_price DESC, draw_price DESC, away_price DESC) AS n FROM t),
steps AS (SELECT match_id, upper(book) AS series, first_seen AS at_, fair FROM q UNION ALL SELECT match_id, upper(book), last_seen, fair FROM q WHERE n = 1
  UNION ALL SELECT CAST(c_nationkey AS BIGINT), 'Model', to_timestamp(c_custkey)::TIMESTAMP, [(c_custkey % 37 + 20) / 100.0::DOUBLE, 0.3::DOUBLE, 0.2::DOUBLE] FROM customer)
SELECT match_id, series, unnest(['home', 'draw', 'away']) AS outcome, epoch_us(at_) AS at_us, round(100 * unnest(fair), 3) AS value FROM steps""")
def odds_history(spark, sf_dir):
    """Quotes of events and forecasts of customers as one series each."""
    facts = _market(spark, sf_dir)[0]
    c = table(spark, sf_dir, "customer")
    guess = c.select(F.col("c_nationkey").cast("long").alias("match_id"), F.timestamp_seconds("c_custkey").alias("predicted_at"), ((F.col("c_custkey") % 37 + 20) / 100).alias("home_prob"), F.lit(0.3).alias("draw_prob"), F.lit(0.2).alias("away_prob"))
    return serve.odds_history(facts, guess).select("match_id", "series", "outcome", F.unix_micros("at").alias("at_us"), F.round("value", 3).alias("value"))


#: Checks of plans.checks whose tables the given ones can stand for.
CHECKED = "fact_match_not_empty match_id_unique teams_differ finished_matches_have_an_outcome outcome_matches_the_goals goals_are_plausible every_match_has_two_form_rows form_counts_add_up form_uses_no_future_matches form_window_is_well_populated dim_team_complete prediction_for_every_match prediction_probabilities_sum_to_one odds_prices_plausible odds_events_resolved_to_fixtures odds_fresh_before_kickoff".split()
_NOW = "2024-01-29 12:00:00"


def _check_sql(name: str, target: str, severity: str, n: str, rest: str, unit: str = "", passed: str = "n = 0") -> str:
    return f"SELECT v, '{name}' AS check_name, '{target}' AS target, '{severity}' AS severity, n || '{unit}' AS observed, CAST(n AS BIGINT) AS n, {passed} AS passed FROM (SELECT v, {n} AS n FROM variants LEFT JOIN {rest} GROUP BY v)"


_FACT = "fact_match", "CRITICAL"
_CHECKS_SQL = " UNION ALL ".join([
    _check_sql("fact_match_not_empty", *_FACT, "count(match_id)", "fact USING (v)", passed="n >= 1"),
    _check_sql("match_id_unique", *_FACT, "count(k)", "(SELECT v, match_id AS k FROM fact GROUP BY ALL HAVING count(*) > 1) USING (v)"),
    _check_sql("teams_differ", *_FACT, "count(*) FILTER (WHERE home_team_id = away_team_id)", "fact USING (v)"),
    _check_sql("finished_matches_have_an_outcome", *_FACT, "count(*) FILTER (WHERE is_finished AND outcome IS NULL)", "fact USING (v)"),
    _check_sql("outcome_matches_the_goals", *_FACT, "count(*) FILTER (WHERE outcome <> CASE WHEN home_goals > away_goals THEN 'HOME_WIN' WHEN home_goals < away_goals THEN 'AWAY_WIN' ELSE 'DRAW' END)", "fact USING (v)"),
    _check_sql("goals_are_plausible", "fact_match", "WARNING", "count(*) FILTER (WHERE home_goals NOT BETWEEN 0 AND 15 OR away_goals NOT BETWEEN 0 AND 15)", "fact USING (v)"),
    _check_sql("every_match_has_two_form_rows", "team_match_form", "CRITICAL", "count(k)", "(SELECT match_id AS k FROM form GROUP BY 1 HAVING count(*) <> 2) ON true"),
    _check_sql("form_counts_add_up", "team_match_form", "CRITICAL", "count(*) FILTER (WHERE wins_last_5 + draws_last_5 + losses_last_5 <> matches_considered)", "form ON true"),
    _check_sql("form_uses_no_future_matches", "team_match_form", "CRITICAL", "count(done)", "(SELECT d.v, d.done FROM done d JOIN form f ON f.match_id = d.match_id AND f.team_id = d.team_id WHERE matches_considered > done) USING (v)"),
    "SELECT v, 'form_window_is_well_populated', 'team_match_form', 'WARNING', (SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE matches_considered >= 3) / count(*), 1) || ' % with 3 matches or more' FROM form), NULL, (SELECT avg(matches_considered) >= 3 FROM form) FROM variants",
    _check_sql("dim_team_complete", "dim_team", "CRITICAL", "count(team_id)", "(SELECT DISTINCT v, unnest([home_team_id, away_team_id]) AS team_id FROM fact) t ON t.v = variants.v AND team_id NOT IN (SELECT s_suppkey FROM supplier)").replace("SELECT v, count", "SELECT variants.v, count").replace("GROUP BY v)", "GROUP BY 1)"),
    _check_sql("prediction_for_every_match", "prediction", "CRITICAL", "count(match_id)", "fact ON fact.v = variants.v AND match_id NOT IN (SELECT c_custkey FROM customer)", " matches without a forecast").replace("SELECT v, count", "SELECT variants.v, count").replace("GROUP BY v)", "GROUP BY 1)"),
    _check_sql("prediction_probabilities_sum_to_one", "prediction", "CRITICAL", "count(*) FILTER (WHERE c_custkey % 10 = 0)", "customer ON true"),
    _check_sql("odds_prices_plausible", "bookmaker_odds", "WARNING", "count(*) FILTER (WHERE NOT (home_price BETWEEN 1.01 AND 1000) OR NOT (draw_price BETWEEN 1.01 AND 1000) OR NOT (away_price BETWEEN 1.01 AND 1000) OR NOT (round(1 / home_price::DOUBLE + 1 / draw_price::DOUBLE + 1 / away_price::DOUBLE - 1, 5) BETWEEN -0.02 AND 0.30))", "facts ON true"),
    "SELECT v, 'odds_events_resolved_to_fixtures', 'event_match', 'WARNING', (SELECT array_to_string(list('H' || user_id || ' vs A' || user_id ORDER BY at_, 'H' || user_id || ' vs A' || user_id)[1:200], '; ') || ' (' || count(*) || ' unmatched)' FROM (SELECT user_id, min(ts) AS at_ FROM events WHERE user_id % 11 = 0 GROUP BY 1)), (SELECT CAST(count(DISTINCT user_id) AS BIGINT) FROM events WHERE user_id % 11 = 0), (SELECT count(*) = 0 FROM events WHERE user_id % 11 = 0) FROM variants",
    f"SELECT v, 'odds_fresh_before_kickoff', 'raw_odds', 'WARNING', (SELECT 'newest fetch ' || strftime(max(hour), '%Y-%m-%d %H:%M') FROM raw), NULL, NOT (SELECT count(*) > 0 FROM fact f WHERE f.v = variants.v AND NOT is_finished AND utc_kickoff BETWEEN TIMESTAMP '{_NOW}' AND TIMESTAMP '{_NOW}' + INTERVAL 1 DAY) OR (SELECT max(hour) FROM raw) > TIMESTAMP '{_NOW}' - INTERVAL 1 DAY FROM variants",
])


@query(f"""WITH {MATCHES_SQL}, {_QUOTES_SQL}, form AS ({LEGACY_SQL.replace("WITH " + MATCHES_SQL, "")}), variants AS (SELECT unnest(['sound', 'broken']) AS v),
labelled AS (SELECT *, CASE WHEN is_finished THEN CASE WHEN home_goals > away_goals THEN 'HOME_WIN' WHEN home_goals < away_goals THEN 'AWAY_WIN' WHEN home_goals = away_goals THEN 'DRAW' END END AS outcome FROM matches),
fact AS (SELECT 'sound' AS v, * FROM labelled UNION ALL
  SELECT 'broken', match_id, utc_kickoff, competition_code, season_id, is_finished AND match_id % 9 <> 0, home_team_id, CASE WHEN match_id % 100 = 0 THEN home_team_id ELSE away_team_id END, CASE WHEN match_id % 70 = 0 THEN 16 ELSE home_goals END, away_goals, outcome FROM labelled),
done AS (SELECT v, match_id, team_id, count(*) FILTER (WHERE is_finished) OVER (PARTITION BY v, team_id ORDER BY utc_kickoff RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING) AS done FROM (SELECT v, match_id, utc_kickoff, is_finished, unnest([home_team_id, away_team_id]) AS team_id FROM fact))
SELECT v AS variant, check_name, target, severity, observed, n, passed FROM ({_CHECKS_SQL})""")
def quality_checks(spark, sf_dir):
    """The plan's own checks, with their texts, over tables that stand for its own and over a broken variant."""
    clock = Clock.at("2024-01-29", datetime(2024, 1, 29, 12, tzinfo=timezone.utc))
    games = matches(spark, sf_dir)
    form = features.legacy_form(appearances(games))
    facts, raw, *_ = _market(spark, sf_dir)
    users = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(F.col("ts").cast("timestamp")).alias("commence_time"))
    name = lambda p: F.concat(F.lit(p), F.col("user_id").cast("string"))
    odd = F.when(F.col("c_custkey") % 10 == 0, 0.6).otherwise(0.5)
    tables = {
        "team_match_form": form, "dim_team": table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("team_id")), "bookmaker_odds": facts, "raw_odds": raw,
        "event_match": users.select("commence_time", name("H").alias("home_team_name"), name("A").alias("away_team_name"), F.when(F.col("user_id") % 11 != 0, F.col("user_id")).alias("match_id")),
        "prediction": table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("match_id"), odd.alias("home_prob"), F.lit(0.3).alias("draw_prob"), F.lit(0.2).alias("away_prob")),
    }
    own = [c for c in checks(clock) if c.name in CHECKED]
    sound = games.withColumn("outcome", F.when(F.col("is_finished"), outcome()))
    broken = sound.withColumns({"is_finished": F.col("is_finished") & (F.col("match_id") % 9 != 0), "away_team_id": F.when(F.col("match_id") % 100 == 0, F.col("home_team_id")).otherwise(F.col("away_team_id")), "home_goals": F.when(F.col("match_id") % 70 == 0, 16).otherwise(F.col("home_goals"))})
    told = [run(spark, {**tables, "fact_match": fact}, own).select(F.lit(v).alias("variant"), "*") for v, fact in (("sound", sound), ("broken", broken))]
    return told[0].unionByName(told[1])


_CODES_SQL = "MAP {" + ", ".join(f"{k}: '{v}'" for k, v in words.CODES.items()) + "}"
_WHY_SQL = " ".join(f"WHEN '{k}' THEN '{v.replace(chr(39), chr(39) * 2)}'" for k, v in words.WHY.items())
_STATES = ["AVAILABLE", "NOT_YET_AVAILABLE", *words.WHY]


@query(f"""WITH e AS (SELECT event_id, CAST(ts AS DATE) AS day, CAST(json_extract(props, '$.k') AS INTEGER) AS k, [{", ".join(f"'{s}'" for s in _STATES)}][event_id % 5 + 1] AS status FROM events)
SELECT event_id, {_CODES_SQL}[k] AS weather, CASE status WHEN 'NOT_YET_AVAILABLE' THEN 'forecasts reach 16 days ahead: from ' || CAST(day - 15 AS VARCHAR) {_WHY_SQL} END AS why FROM e""")
def weather_words(spark, sf_dir):
    """Codes and states of events in words."""
    status = F.get(F.array(*map(F.lit, _STATES)), (F.col("event_id") % 5).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", words.description(F.get_json_object("props", "$.k")).alias("weather"), words.why_absent(status, F.to_date("ts")).alias("why"))


@query("""WITH s AS (SELECT user_id, event_type, floor(value / 20) AS digest, event_id, ts, CAST(ts AS DATE) AS day, CASE WHEN ts < TIMESTAMP '2024-01-15' THEN 0 ELSE 1 END AS new FROM events),
k AS (SELECT *, row_number() OVER (PARTITION BY user_id, event_type, digest, new ORDER BY ts, event_id) AS n FROM s)
SELECT user_id, event_type, CAST(digest AS BIGINT) AS digest, arg_min(event_id, struct_pack(new, ts)) AS event_id, CAST(max(day) AS VARCHAR) AS checked FROM k WHERE n = 1 OR new = 1 GROUP BY ALL""".replace("WHERE n = 1 OR new = 1 GROUP BY ALL", "GROUP BY 1, 2, 3"))
def first_seen_touched(spark, sf_dir):
    """Captures of the second half of the month touch those of the first that they repeat."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", F.floor(F.col("value") / 20).cast("long").alias("digest"), "event_id", "ts", F.to_date("ts").alias("checked"))
    half = F.lit("2024-01-15").cast("timestamp_ntz")
    keys = ["user_id", "event_type", "digest"]
    old = keep_latest(e.where(F.col("ts") < half), keys, [F.col("ts"), F.col("event_id")])
    last = e.where(F.col("ts") < half).groupBy(*keys).agg(F.max("checked").alias("checked"))
    stored = old.drop("checked").join(last, keys).select(e.columns)
    out = first_seen(stored, e.where(F.col("ts") >= half), keys, "checked", "ts")
    return out.select(*keys, "event_id", F.col("checked").cast("string").alias("checked"))


@query("""WITH f AS (SELECT event_type AS endpoint, CAST(user_id % 7 AS VARCHAR) AS request_params, ts, CASE WHEN event_id % 3 = 0 THEN CAST(floor(value) AS BIGINT) END AS remaining FROM events WHERE event_type <> 'error'),
a AS (SELECT ts AS any_, remaining FROM f ORDER BY ts DESC LIMIT 1)
SELECT endpoint, request_params, epoch_us(CASE WHEN a.remaining <= 20 THEN any_ ELSE max(ts) END) AS last_us, a.remaining AS remaining FROM f, a GROUP BY endpoint, request_params, a.remaining, any_""")
def fetch_state(spark, sf_dir):
    """Events as fetches of many requests on one account."""
    e = table(spark, sf_dir, "events")
    fetches = e.select(F.when(F.col("event_type") == "error", "sample").otherwise("live").alias("source"), F.col("event_type").alias("endpoint"), (F.col("user_id") % 7).cast("string").alias("request_params"), F.col("ts").cast("timestamp").alias("ingested_at"), F.when(F.col("event_id") % 3 == 0, F.floor("value").cast("long")).alias("remaining"))
    return planner.fetch_state(fetches, "live", 20).select("endpoint", "request_params", F.unix_micros("last_at").alias("last_us"), "remaining")


@query(f"WITH {MATCHES_SQL} SELECT match_id, epoch_us(utc_kickoff) AS at_us, home_team_id FROM matches WHERE NOT is_finished AND CAST(utc_kickoff AS DATE) BETWEEN DATE '2024-01-26' AND DATE '2024-01-28'")
def unplayed_between(spark, sf_dir):
    games = matches(spark, sf_dir).withColumn("match_date", F.to_date("utc_kickoff"))
    return planner.unplayed(games, "2024-01-26", "2024-01-28").select("match_id", F.unix_micros("utc_kickoff").alias("at_us"), "home_team_id")


_ROLE_SQL = " ".join(f"WHEN regexp_matches(lower(position), '{pattern}') THEN '{role}'" for pattern, role in context.POSITIONS)
_NAMED = ["GOALKEEPER", "Left-Back", "Central Defence", "Defensive Midfield", "Second Striker", "Right Winger", "Coach"]


@query(f"""SELECT p_partkey, CASE {_ROLE_SQL} ELSE 'UNKNOWN' END AS role FROM (SELECT p_partkey, CASE WHEN p_size % 5 <> 0 THEN p_type || ' ' || [{", ".join(f"'{x}'" for x in _NAMED)}][p_size % 7 + 1] END AS position FROM part)""")
def player_roles(spark, sf_dir):
    """The plan's roles of positions that part types and sizes spell; some are null."""
    named = F.get(F.array(*map(F.lit, _NAMED)), (F.col("p_size") % 7).cast("int"))
    position = F.when(F.col("p_size") % 5 != 0, F.concat_ws(" ", "p_type", named))
    return table(spark, sf_dir, "part").select("p_partkey", context.role_of(position).alias("role"))


@query(f"""WITH {MATCHES_SQL}, told AS (SELECT user_id AS team, date_trunc('hour', ts) AS hour, CAST(ts - INTERVAL 1 DAY * (event_id % 4) AS DATE) AS ingested, ts - INTERVAL 1 DAY * (event_id % 4) - INTERVAL 3 MINUTE AS fetched, CASE WHEN event_id % 5 <> 0 THEN value END AS temperature, event_id FROM events),
usable AS (SELECT match_id, ingested, fetched, temperature, CAST(utc_kickoff AS DATE) AS day FROM matches JOIN told ON team = home_team_id AND hour = date_trunc('hour', utc_kickoff) WHERE fetched < utc_kickoff AND temperature IS NOT NULL AND ingested <= DATE '2024-01-20'),
best AS (SELECT DISTINCT ON (match_id) * FROM usable ORDER BY match_id, ingested DESC, fetched DESC)
SELECT m.match_id, CASE WHEN fetched IS NOT NULL THEN 'AVAILABLE' WHEN s_suppkey IS NULL OR s_suppkey % 3 = 0 THEN 'VENUE_UNKNOWN' WHEN CAST(utc_kickoff AS DATE) > DATE '2024-01-20' + 15 THEN 'NOT_YET_AVAILABLE' WHEN CAST(utc_kickoff AS DATE) < DATE '2024-01-20' THEN 'NOT_CAPTURED' ELSE 'MISSING' END AS weather_status,
  epoch_us(fetched) AS fetched_us, temperature AS temperature_c, CAST(day - ingested AS INTEGER) AS lead_days FROM matches m LEFT JOIN best USING (match_id) LEFT JOIN supplier ON s_suppkey = home_team_id""")
def match_weather(spark, sf_dir):
    """Events as hourly forecasts for their user's venue, suppliers as venues: the plan's own states."""
    e = table(spark, sf_dir, "events")
    days = (F.col("event_id") % 4).cast("int")
    fetched = F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) - (days.cast("long") * 1440 + 3) * F.lit(60_000_000))
    made = {c: F.lit(1.0) for c in weather.VALUES} | {"temperature_c": F.when(F.col("event_id") % 5 != 0, F.col("value"))}
    forecasts = e.select(F.col("user_id").alias("venue_team_id"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("forecast_hour_utc"), F.date_sub(F.to_date("ts"), days).alias("ingestion_date"), fetched.alias("fetched_at"), *[c.alias(n) for n, c in made.items()])
    venues = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("team_id"), F.when(F.col("s_suppkey") % 3 != 0, "RESOLVED").otherwise("UNRESOLVED").alias("coordinates_status"))
    games = matches(spark, sf_dir).withColumn("match_date", F.to_date("utc_kickoff"))
    out = weather.match_weather(games, forecasts, venues, Clock.at("2024-01-20"))
    return out.select("match_id", "weather_status", F.unix_micros("forecast_fetched_at").alias("fetched_us"), "temperature_c", "lead_days")

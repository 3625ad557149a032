"""Queries of what was known when: open validities, current values, ranked names, quotes; and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.functions.names import STOP_RANKING
from tempora.operators.asof import as_of_valid, first_of_current_value
from tempora.plans import odds, ranking
from tempora.plans.fixtures import MATCHES_SQL, matches
from tempora.registry import query, table

HOUR = 3_600_000_000
#: Clicks and purchases as observations: some valid hours after they are made, two thirds with an end.
_SEEN_SQL = """seen AS (SELECT event_id AS obs_id, user_id AS who, ts AS observed_at, ts + INTERVAL 1 HOUR * (event_id % 5) AS valid_from,
  CASE WHEN event_id % 3 <> 0 THEN ts + INTERVAL 1 HOUR * CAST(floor(value * 4) AS BIGINT) END AS valid_until, CAST(floor(value) AS BIGINT) % 3 AS coach FROM events WHERE event_type IN ('click', 'purchase')),
asked AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'view')"""


def _later(hours) -> F.Column:
    return F.timestamp_micros(F.unix_micros(F.col("ts").cast("timestamp")) + hours.cast("long") * F.lit(HOUR))


def _seen(spark, sf_dir) -> DataFrame:
    e = table(spark, sf_dir, "events").where("event_type IN ('click', 'purchase')")
    until = F.when(F.col("event_id") % 3 != 0, _later(F.floor(F.col("value") * 4)))
    return e.select(F.col("event_id").alias("obs_id"), "user_id", F.col("ts").cast("timestamp").alias("observed_at"), _later(F.col("event_id") % 5).alias("valid_from"), until.alias("valid_until"), (F.floor("value").cast("long") % 3).alias("coach"))


def _asked(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "events").where("event_type = 'view'").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))


@query(f"""WITH {_SEEN_SQL} SELECT event_id, o.obs_id FROM asked LEFT JOIN LATERAL (SELECT obs_id FROM seen
  WHERE who = user_id AND observed_at < ts AND valid_from <= ts AND (valid_until IS NULL OR ts < valid_until) ORDER BY observed_at DESC, valid_from DESC, obs_id DESC LIMIT 1) o ON true""")
def asof_open_validity(spark, sf_dir):
    return as_of_valid(_asked(spark, sf_dir), _seen(spark, sf_dir), ["user_id"], "event_id", "ts", "observed_at", "valid_until", ["obs_id"], ["obs_id"], "valid_from").select("event_id", "obs_id")


@query(f"""WITH {_SEEN_SQL}, held AS (SELECT asked.*, o.coach, o.held_at FROM asked JOIN LATERAL (SELECT coach, observed_at AS held_at FROM seen
  WHERE who = user_id AND observed_at < ts AND valid_from <= ts AND (valid_until IS NULL OR ts < valid_until) ORDER BY observed_at DESC, valid_from DESC, obs_id DESC LIMIT 1) o ON true),
visible AS (SELECT event_id, h.coach AS own, held_at, s.coach, observed_at FROM held h JOIN seen s ON who = user_id AND valid_from <= ts AND observed_at <= held_at),
other AS (SELECT event_id, max(observed_at) FILTER (WHERE coach <> own AND observed_at < held_at) AS last FROM visible GROUP BY 1),
began AS (SELECT event_id, min(observed_at) FILTER (WHERE coach = own AND (last IS NULL OR observed_at >= last)) AS first FROM visible JOIN other USING (event_id) GROUP BY 1)
SELECT event_id, coach, epoch_us(first) AS first_us FROM asked LEFT JOIN held USING (event_id) LEFT JOIN began USING (event_id)""")
def first_observation(spark, sf_dir):
    """Since when the value that counts at an event has been the one that is observed."""
    seen = _seen(spark, sf_dir)
    held = as_of_valid(_asked(spark, sf_dir), seen.withColumn("at", F.col("observed_at")), ["user_id"], "event_id", "ts", "observed_at", "valid_until", ["coach", "at"], ["obs_id"], "valid_from")
    out = first_of_current_value(held, seen, ["user_id"], ["event_id"], "ts", "at", "coach", "observed_at", "valid_from", "first")
    return out.select("event_id", "coach", F.unix_micros("first").alias("first_us"))


def _side_sql(side: str) -> str:
    return f"""LEFT JOIN LATERAL (SELECT * FROM ranks r WHERE r.team_id = m.{side}_team_id AND r.observed_at < m.utc_kickoff AND r.ranking_date < CAST(m.utc_kickoff AS DATE) AND CAST(m.utc_kickoff AS DATE) - r.ranking_date <= 35
  ORDER BY r.ranking_date DESC, r.observed_at DESC, r.raw_id DESC LIMIT 1) {side} ON true"""


@query(f"""WITH {MATCHES_SQL}, ranks AS (SELECT CAST(event_id AS VARCHAR) AS raw_id, user_id AS team_id, CAST(ts AS DATE) - CAST(event_id % 50 AS INTEGER) AS ranking_date, ts AS observed_at, CAST(floor(value) AS INTEGER) + 1 AS world_rank, CAST(event_id % 2000 AS INTEGER) AS rating_points FROM events WHERE event_type <> 'error')
SELECT m.match_id, home.raw_id AS home_id, away.raw_id AS away_id, home.world_rank AS home_world_rank, away.world_rank AS away_world_rank, home.rating_points - away.rating_points AS world_rating_points_difference, away.world_rank - home.world_rank AS world_rank_advantage_home
FROM matches m {_side_sql("home")} {_side_sql("away")}""")
def ranking_asof(spark, sf_dir):
    """Events stand for ranking rows; their date lies up to 49 days before they are observed."""
    e = table(spark, sf_dir, "events").where("event_type <> 'error'")
    ranks = e.select(F.col("event_id").cast("string").alias("raw_id"), F.col("user_id").alias("team_id"), F.date_sub(F.to_date("ts"), (F.col("event_id") % 50).cast("int")).alias("ranking_date"), F.col("ts").alias("observed_at"), F.col("event_id").cast("string").alias("source_url"), (F.floor("value").cast("int") + 1).alias("world_rank"), (F.col("event_id") % 2000).cast("int").alias("rating_points"))
    out = ranking.with_rankings(matches(spark, sf_dir), ranks)
    return out.select("match_id", F.col("audit_home_world_ranking_source").alias("home_id"), F.col("audit_away_world_ranking_source").alias("away_id"), "home_world_rank", "away_world_rank", "world_rating_points_difference", "world_rank_advantage_home")


_STOP = ", ".join(f"'{w}'" for w in STOP_RANKING)


def _name_sql(name: str) -> str:
    return f"array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower({name}), '[^a-z0-9]+'), lambda x: x <> '' AND x NOT IN ({_STOP})))), ' ')"


@query(f"""WITH clubs AS (SELECT p_partkey AS team_id, p_name || ' ' || p_type AS name, p_name || ' ' || p_size || ' AC' AS short_name, nullif(p_brand, 'Brand#7') AS country FROM part),
ranked AS (SELECT DISTINCT 'p/' || p_partkey AS club_slug, 'FC ' || CASE WHEN p_size > 25 THEN p_type ELSE CAST(p_size AS VARCHAR) END || ' ' || p_name AS club_name, p_brand AS country FROM part),
known AS (SELECT s_suppkey AS team_id, 'p/' || s_suppkey * 30 AS club_slug FROM supplier WHERE s_suppkey IN (SELECT team_id FROM clubs) AND 'p/' || s_suppkey * 30 IN (SELECT club_slug FROM ranked)),
spelled AS (SELECT team_id, country, name AS s FROM clubs UNION SELECT team_id, country, short_name FROM clubs UNION SELECT p_partkey, nullif(p_brand, 'Brand#7'), p_name || ' club ' || p_size + 1 FROM part),
pairs AS (SELECT DISTINCT team_id, club_slug FROM spelled x JOIN ranked r ON {_name_sql("x.country")} = {_name_sql("r.country")} AND {_name_sql("s")} = {_name_sql("club_name")}
  WHERE x.country IS NOT NULL AND s <> '' AND team_id NOT IN (SELECT team_id FROM known) AND club_slug NOT IN (SELECT club_slug FROM known)),
one AS (SELECT team_id, min(club_slug) AS club_slug FROM pairs GROUP BY 1 HAVING count(*) = 1)
SELECT team_id, club_slug, 'REVIEWED' AS method FROM known UNION ALL SELECT min(team_id), club_slug, 'EXACT_COUNTRY' FROM one GROUP BY club_slug HAVING count(*) = 1""")
def resolve_unique_names(spark, sf_dir):
    """Parts as clubs with three spellings, and as ranked clubs with one; suppliers as reviewed pairs."""
    p = table(spark, sf_dir, "part")
    size, country = F.col("p_size").cast("string"), F.nullif("p_brand", F.lit("Brand#7"))
    clubs = p.select(F.col("p_partkey").alias("team_id"), F.concat_ws(" ", "p_name", "p_type").alias("name"), F.concat_ws(" ", "p_name", size, F.lit("AC")).alias("short_name"), country.alias("country"))
    ranked = p.select(F.concat(F.lit("p/"), F.col("p_partkey").cast("string")).alias("club_slug"), F.concat_ws(" ", F.lit("FC"), F.when(F.col("p_size") > 25, F.col("p_type")).otherwise(size), "p_name").alias("club_name"), F.col("p_brand").alias("country"))
    reviewed = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("team_id"), F.concat(F.lit("p/"), (F.col("s_suppkey") * 30).cast("string")).alias("club_slug"))
    aliases = p.select(F.col("p_partkey").alias("team_id"), F.concat_ws(" ", "p_name", F.lit("club"), (F.col("p_size") + 1).cast("string")).alias("alias"))
    return ranking.resolve(clubs, ranked, reviewed, aliases)


#: Events as quotes: an hour of one type is a fetch, a user an event, a quarter of k a bookmaker.
_QUOTES_SQL = """e AS (SELECT *, date_trunc('hour', ts) AS hour, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events),
raw AS (SELECT DISTINCT event_type, hour FROM e),
quotes AS (SELECT hour, user_id AS match_id, 'b' || k % 4 AS book, date_trunc('day', ts) AS updated, max(CAST(1 + k / 20 AS DECIMAL(9,3))) AS home_price, max(CAST(2 + k / 50 AS DECIMAL(9,3))) AS draw_price, max(CASE WHEN k % 9 <> 0 THEN CAST(1.5 + k / 10 AS DECIMAL(9,3)) END) AS away_price
  FROM e WHERE user_id % 11 <> 0 GROUP BY 1, 2, 3, 4),
facts AS (SELECT match_id, book, updated, home_price, draw_price, away_price, min(hour) AS first_seen, max(hour) AS last_seen FROM quotes GROUP BY ALL),
fetched AS (SELECT match_id, max(last) AS latest FROM (SELECT DISTINCT user_id AS match_id, event_type FROM e WHERE user_id % 11 <> 0) JOIN (SELECT event_type, max(hour) AS last FROM raw GROUP BY 1) USING (event_type) GROUP BY 1),
latest AS (SELECT *, last_seen >= latest AS is_current, 1 / home_price::DOUBLE + 1 / draw_price::DOUBLE + 1 / away_price::DOUBLE AS t,
  row_number() OVER (PARTITION BY match_id, book ORDER BY last_seen DESC, updated DESC, home_price DESC, draw_price DESC, away_price DESC NULLS LAST) AS n FROM facts JOIN fetched USING (match_id))"""


def _market(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(facts, raw, staged, resolved) as the odds plan makes them."""
    k = F.get_json_object("props", "$.k").cast("long")
    e = table(spark, sf_dir, "events").withColumns({"k": k, "hour": F.date_trunc("hour", F.col("ts").cast("timestamp"))})
    name = F.concat_ws("/", "event_type", F.col("hour").cast("string"))
    raw = e.select(name.alias("raw_id"), F.lit("s").alias("source"), F.col("event_type").alias("endpoint"), F.lit("{}").alias("request_params"), F.col("hour").alias("ingested_at")).distinct()
    role = lambda name, price: F.struct(F.lit(name).alias("outcome_role"), price.cast("decimal(9,3)").alias("price"))
    prices = F.array(role("HOME", 1 + F.col("k") / 20), role("DRAW", 2 + F.col("k") / 50), role("AWAY", F.when(F.col("k") % 9 != 0, 1.5 + F.col("k") / 10)))
    book = F.concat(F.lit("b"), (F.col("k") % 4).cast("string"))
    staged = e.select(name.alias("raw_id"), F.col("hour").alias("fetched_at"), F.col("user_id").cast("string").alias("event_id"), book.alias("bookmaker_key"), F.upper(book).alias("bookmaker_title"), F.lit("h2h").alias("market_key"), F.date_trunc("day", F.col("ts").cast("timestamp")).alias("source_updated_at"), F.inline(prices))
    users = e.select("user_id").distinct()
    resolved = users.select(F.col("user_id").cast("string").alias("event_id"), F.when(F.col("user_id") % 11 != 0, F.col("user_id")).alias("match_id"))
    return odds.priced(odds.changes(staged, resolved)), raw, staged, resolved


def _latest(spark, sf_dir) -> DataFrame:
    return odds.latest(*_market(spark, sf_dir))


@query(f"""WITH {_QUOTES_SQL} SELECT match_id, book AS bookmaker_key, epoch_us(updated) AS updated_us, epoch_us(first_seen) AS first_us, epoch_us(last_seen) AS last_us, epoch_us(latest) AS latest_us, home_price, draw_price, away_price, t IS NOT NULL AS is_complete, round((1 / home_price::DOUBLE) / t, 5) AS home_prob_fair, is_current FROM latest WHERE n = 1""")
def odds_latest(spark, sf_dir):
    """The newest quote of each match and bookmaker, and whether the newest fetch of its own scope still had it."""
    us = lambda c, name: F.unix_micros(c).alias(name)
    return _latest(spark, sf_dir).select("match_id", "bookmaker_key", us("source_updated_at", "updated_us"), us("first_seen_at", "first_us"), us("last_seen_at", "last_us"), us("latest_fetch_at", "latest_us"), "home_price", "draw_price", "away_price", "is_complete", "home_prob_fair", "is_current")


@query(f"""WITH {_QUOTES_SQL}, guess AS (SELECT DISTINCT ON (match_id) * FROM (SELECT c_nationkey AS match_id, c_custkey, (c_custkey % 37 + 20) / 100.0::DOUBLE AS home_prob, (c_custkey % 23 + 10) / 100.0::DOUBLE AS draw_prob FROM customer) ORDER BY match_id, c_custkey DESC)
SELECT match_id, c_custkey, book AS bookmaker_key, is_current, round(1 / home_prob, 2) AS home_model_odds, round(1 / draw_prob, 2) AS draw_model_odds, round((home_prob - round((1 / home_price::DOUBLE) / t, 5)) * 100, 1) AS home_deviation_pp, round((draw_prob - round((1 / draw_price::DOUBLE) / t, 5)) * 100, 1) AS draw_deviation_pp
FROM latest JOIN guess USING (match_id) WHERE n = 1""")
def odds_comparison(spark, sf_dir):
    """Customers as forecasts, by nation: the newest of each match beside the newest quotes."""
    c = table(spark, sf_dir, "customer")
    guess = c.select(F.col("c_nationkey").cast("long").alias("match_id"), "c_custkey", F.lit("m").alias("model_version"), F.to_date(F.lit("2024-01-01")).alias("as_of_date"), F.timestamp_seconds("c_custkey").alias("predicted_at"), ((F.col("c_custkey") % 37 + 20) / 100).alias("home_prob"), ((F.col("c_custkey") % 23 + 10) / 100).alias("draw_prob"), F.lit(0.3).alias("away_prob"))
    out = odds.comparison(odds.latest_predictions(guess), _latest(spark, sf_dir))
    return out.select("match_id", "c_custkey", "bookmaker_key", "is_current", "home_model_odds", "draw_model_odds", "home_deviation_pp", "draw_deviation_pp")

"""The daily run on synthetic payloads, end to end."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.plans import daily, odds, staging
from tempora.plans.daily import Sources
from tempora.plans.export import column_role
from tempora.sources import raw
from tempora.store import Store

UTC = timezone.utc
START = datetime(2026, 8, 1, 15, tzinfo=UTC)
DAY = date(2026, 9, 20)
AT = datetime(2026, 9, 20, 6, tzinfo=UTC)
TEAMS = {1: "Alpha FC", 2: "Beta United", 3: "Gamma Städte", 4: "Delta 1907"}


def match(i, home, away, days, score=None, duration="REGULAR", regular=None, status=None, updated="2026-09-19T00:00:00Z"):
    at = START + timedelta(days=days)
    full = {"home": score[0], "away": score[1]} if score else {"home": None, "away": None}
    s = {"winner": None, "duration": duration, "fullTime": full, "halfTime": {"home": None, "away": None}}
    if regular:
        s["regularTime"] = {"home": regular[0], "away": regular[1]}
    return {"id": i, "utcDate": at.strftime("%Y-%m-%dT%H:%M:%SZ"), "status": status or ("FINISHED" if score else "TIMED"), "stage": "LEAGUE", "matchday": 1, "lastUpdated": updated, "competition": {"code": "PL"}, "season": {"id": 7}, "homeTeam": {"id": home}, "awayTeam": {"id": away}, "score": s}


def games():
    out = [match(k + 1, 1 + k % 4, 1 + (k + 1 + k // 4 % 3) % 4, 3 * k, (k % 3, (k + 1) % 2)) for k in range(12)]
    out.append(match(90, 1, 2, 40, (3, 2), "EXTRA_TIME", (2, 2)))
    out.append(match(91, 3, 4, 41, (5, 4), "PENALTY_SHOOTOUT"))
    out += [match(100, 1, 2, 51.1), match(101, 3, 4, 60), match(102, None, 4, 62), match(103, 2, 3, 75)]
    return out


def teams(coach="c1"):
    squad = lambda t: [{"id": 10 * t + i, "name": f"P{i}", "position": p, "dateOfBirth": b, "nationality": n, "shirtNumber": i} for i, (p, b, n) in enumerate([("Goalkeeper", "2000-01-01", "X"), ("Defensive Midfield", "1996-01-01", "Y"), ("Midfield", None, "X"), ("Winger", "1990-01-01", "X"), (None, "1999-01-01", "X")])]
    return [{"id": t, "name": n, "shortName": None, "tla": n[:3].upper(), "crest": f"http://x/{t}.png", "area": {"name": "X"}, "runningCompetitions": [{"code": "PL"}, {"code": "CL"}], "venue": f"V{t}", "coach": {"id": 5 + t, "name": coach, "dateOfBirth": "1970-01-01", "nationality": "X", "contract": {"start": "2025-07"}}, "squad": squad(t) + squad(t)[:1]} for t, n in TEAMS.items()]


def answers(spark, day=DAY, at=AT, matches=None, extra=()):
    standing = {"season": {"id": 7}, "standings": [{"type": "TOTAL", "table": [{"position": t, "team": {"id": t}, "playedGames": 3, "won": 1, "draw": 1, "lost": 1, "points": 4, "goalsFor": 5, "goalsAgainst": 5, "goalDifference": 0} for t in TEAMS]}, {"type": "HOME", "table": []}]}
    rows = [("f", "competitions/PL/matches", {}, {"matches": matches if matches is not None else games()}), ("f", "competitions/PL/teams", {}, {"teams": teams()}), ("f", "competitions/PL/standings", {}, standing), *extra]
    return raw.rows(spark, rows, day, at, "run1")


def odds_rows(spark):
    def book(key, h, d, a, updated):
        outcomes = [{"name": "Alpha", "price": h}, {"name": "Draw", "price": d}, {"name": "Beta Utd", "price": a}]
        return {"key": key, "title": key.title(), "last_update": updated, "markets": [{"key": "h2h", "last_update": updated, "outcomes": [o for o in outcomes if o["price"]]}]}

    kick = (START + timedelta(days=51.1)).strftime("%Y-%m-%dT%H:%M:%SZ")
    event = lambda books: [{"id": "e1", "commence_time": kick, "home_team": "Alpha", "away_team": "Beta Utd", "bookmakers": books}]
    fetches = [(AT - timedelta(hours=3), event([book("b1", 2.0, 3.5, 4.0, "2026-09-20T02:00:00Z"), book("b2", 2.1, 3.4, 3.9, "2026-09-20T02:00:00Z")])), (AT, event([book("b1", 2.2, 3.5, 3.6, "2026-09-20T05:00:00Z"), book("b2", 2.1, None, 3.9, "2026-09-20T05:30:00Z")]))]
    return spark.createDataFrame([(f"o{i}", "the-odds", "odds", "{}", at, raw.canonical(p)) for i, (at, p) in enumerate(fetches)], daily.EMPTY["raw_odds"])


@pytest.fixture(scope="module")
def published(spark, tmp_path_factory):
    kick = START + timedelta(days=51.1)
    hours = [(kick.replace(minute=0) + timedelta(hours=h)).strftime("%Y-%m-%dT%H:%M") for h in range(-3, 4)]
    payload = raw.canonical({"timezone": "GMT", "hourly": {"time": hours, "temperature_2m": [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, None], "precipitation": [0.0] * 7, "precipitation_probability": [5] * 7, "wind_speed_10m": [9.0] * 7, "weather_code": [1] * 7}})
    page_day = date(2026, 9, 1)
    ranks = [(f"r{i}", "u", datetime(2026, 9, 2, tzinfo=UTC), n.lower().replace(" ", "-"), n, "X", page_day, t, 1000 - t) for i, (t, n) in enumerate(TEAMS.items())]
    other = {
        "venue_answers": spark.createDataFrame([(t, [{"lat": "1", "lon": "2", "osm_type": "way", "osm_id": t, "type": "pitch"}, {"lat": "47.5", "lon": "8.5", "osm_type": "way", "osm_id": 100 + t, "type": "stadium"}], None, None, None) for t in (1, 2, 3)], daily.EMPTY["venue_answers"]),
        "raw_weather": spark.createDataFrame([(1, DAY, AT, payload)], daily.EMPTY["raw_weather"]),
        "raw_odds": odds_rows(spark),
        "aliases": spark.createDataFrame([(2, "Beta Utd")], daily.EMPTY["aliases"]),
        "ranking_pages": spark.createDataFrame(ranks, daily.EMPTY["ranking_pages"]),
        "runs": spark.createDataFrame([("run1", AT + timedelta(minutes=5))], daily.EMPTY["runs"]),
        "team_crest": spark.createDataFrame([(t,) for t in TEAMS], daily.EMPTY["team_crest"]),
    }
    store = Store(spark, str(tmp_path_factory.mktemp("store")))
    sources = Sources(answers(spark), other, odds_source="the-odds")
    clock = Clock.at(DAY, datetime(2026, 9, 20, 12, tzinfo=UTC))
    daily.daily(spark, store, sources, clock)
    return store, sources, clock


def one(df, **keys):
    for k, v in keys.items():
        df = df.where(F.col(k) == v)
    rows = df.collect()
    assert len(rows) == 1, rows
    return rows[0]


def test_matches_and_labels(published):
    store, *_ = published
    m = store.read("staging_matches")
    assert m.count() == 17  # the match without a home team is left out
    assert (one(m, match_id=90)["home_goals_90min"], one(m, match_id=90)["home_goals"]) == (2, 3)
    assert one(m, match_id=91)["home_goals_90min"] is None
    p = store.read("product")
    assert p.count() == 17
    assert one(p, match_id=90)["label_outcome_90min"] == "DRAW"
    assert one(p, match_id=91)["label_outcome_90min"] is None and not one(p, match_id=91)["label_available"]
    assert one(p, match_id=101)["label_home_goals_90min"] is None
    extra = one(p, match_id=90)
    assert (extra["audit_match_status"], extra["audit_result_duration"], extra["audit_home_team_name"], extra["audit_ingestion_date"], extra["audit_feature_version"]) == ("FINISHED", "EXTRA_TIME", "Alpha FC", DAY, "regular-time-v3")
    assert {"home_goals", "away_goals", "is_finished", "home_coach_id"}.isdisjoint(p.columns) and {"audit_home_coach_id", "audit_away_history_last_kickoff", "audit_computed_at"} <= set(p.columns)
    assert not [c for c in p.columns if column_role(c) == "feature" and c in ("home_goals", "away_goals")] and p.schema["home_points_last_5"].metadata["comment"].startswith("home team: points last 5; results known")
    assert len(p.columns) == 304
    assert one(store.read("fact_match"), match_id=100)["is_upcoming"]


def test_weather_has_a_reason_for_every_match(published):
    w = published[0].read("match_weather")
    assert one(w, match_id=100)["weather_status"] == "AVAILABLE" and one(w, match_id=100)["temperature_c"] == 4.0
    assert one(w, match_id=1)["weather_status"] == "NOT_CAPTURED"
    assert one(w, match_id=101)["weather_status"] == "MISSING"
    assert one(w, match_id=103)["weather_status"] == "NOT_YET_AVAILABLE"
    assert one(published[0].read("dim_venue"), team_id=1)["osm_reference"] == "way/101"


def test_odds_are_matched_and_selected_before_they_are_filtered(published):
    store, *_ = published
    e = one(store.read("event_match"), event_id="e1")
    assert e["match_id"] == 100 and e["confidence"] == 1.0
    q = store.read("bookmaker_odds")
    assert q.count() == 4 and q.where("NOT is_complete AND home_prob_fair IS NULL").count() == 1
    p = one(store.read("product"), match_id=100)
    assert p["odds_bookmaker_count"] == 1  # b2's newest quote is incomplete and brings no older one back
    assert abs(p["odds_home_prob_fair"] - (1 / 2.2) / (1 / 2.2 + 1 / 3.5 + 1 / 3.6)) < 1e-5


def test_training_quotes_are_those_of_live_fetches(spark):
    def offer(price, times=1):
        outcomes = [{"name": n, "price": p} for n, p in (("Alpha", price), ("Draw", 3.0), ("Beta", 4.0))] + [{"name": "Draw", "price": 9.0}] * (times - 1)
        return raw.canonical([{"id": "e", "commence_time": "2026-09-21T00:00:00Z", "home_team": "Alpha", "away_team": "Beta", "bookmakers": [{"key": "b", "markets": [{"key": "h2h", "last_update": "2026-09-20T01:00:00Z", "outcomes": outcomes}]}]}])

    hour = lambda h: datetime(2026, 9, 20, h, tzinfo=UTC)
    rows = [("f1", "live", 2, offer(2.0)), ("f2", "live", 3, offer(2.5)), ("f3", "live", 4, offer(2.0)), ("f4", "live", 4, offer(2.1, 2)), ("f5", "sample", 5, offer(8.0))]
    fetched = spark.createDataFrame([(i, s, "odds", "{}", hour(h), p) for i, s, h, p in rows], daily.EMPTY["raw_odds"])
    resolved = spark.createDataFrame([("e", 1)], "event_id string, match_id long")
    games = spark.createDataFrame([(1, datetime(2026, 9, 21, tzinfo=UTC))], "match_id long, utc_kickoff timestamp")
    staged = staging.odds(fetched)
    assert one(staged, raw_id="f4", outcome_role="DRAW")["price"] == 3  # the first in the answer
    quotes = odds.training_quotes(staged, fetched, resolved, "live")
    assert quotes.count() == 4
    got = one(odds.training_summary(games, quotes), match_id=1)  # the last fetch, of two at that time the greater id
    assert float(got["odds_home_price_mean"]) == 2.1 and got["audit_odds_observed_at"].hour == 4


def test_context_counts_once_its_run_had_ended(published):
    store, *_ = published
    s = one(store.read("team_context_snapshot"), team_id=1)
    assert s["observed_at"] == datetime(2026, 9, 20, 6, 5)
    assert (s["squad_size"], s["squad_goalkeepers"], s["squad_defenders"], s["squad_midfielders"], s["squad_attackers"], s["squad_unknown_positions"], s["squad_missing_birthdates"], s["squad_foreign_players"]) == (5, 1, 1, 1, 1, 1, 1, 1)
    c = store.read("team_context")
    assert one(c, match_id=1, team_id=1)["squad_size"] is None
    late = one(c, match_id=103, team_id=2)
    assert late["squad_size"] == 5 and late["coach_prior_matches"] == 0 and late["coach_observed_tenure_days"] == 25


def test_ranking_is_from_an_earlier_day_and_young_enough(published):
    p = published[0].read("product")
    assert one(p, match_id=100)["home_world_rank"] == 1 and one(p, match_id=100)["world_rank_advantage_home"] == 1
    assert one(p, match_id=1)["home_world_rank"] is None
    assert one(p, match_id=103)["home_world_rank"] is None  # 44 days old


def test_standings_and_prediction(published):
    store, *_ = published
    assert store.read("staging_standings").count() == 4
    f = store.read("prediction")
    assert f.count() == 17 and f.where("abs(home_prob + draw_prob + away_prob - 1) > 0.001").count() == 0


def test_rerun_changes_nothing_and_older_days_do_not_overwrite(spark, published):
    store, sources, clock = published
    before = {n: sorted(map(str, store.read(n).collect())) for n in ("product", "fact_match", "bookmaker_odds", "prediction")}
    daily.daily(spark, store, sources, clock)
    assert before == {n: sorted(map(str, store.read(n).collect())) for n in before}
    daily.daily(spark, store, Sources(sources.raw, {k: v for k, v in sources.other.items() if k != "raw_odds"}, sources.odds_source), clock)
    assert before == {n: sorted(map(str, store.read(n).collect())) for n in before}  # stored fetches stay
    older = staging.matches(answers(spark, date(2026, 9, 19), AT - timedelta(days=1), [match(1, 1, 2, 0, (9, 9))]), Clock.at("2026-09-19"))
    from tempora.operators.merge import upsert

    kept = upsert(store.read("staging_matches"), older, ["match_id"], "ingestion_date")
    assert one(kept, match_id=1)["home_goals"] == one(store.read("staging_matches"), match_id=1)["home_goals"]


def test_a_failed_check_publishes_nothing(spark, published, tmp_path):
    _, sources, clock = published
    store = Store(spark, str(tmp_path / "s"))
    broken = Sources(answers(spark, matches=[match(1, 1, 1, 0, (1, 0))]), sources.other)
    with pytest.raises(daily.ChecksFailed, match="teams_differ"):
        daily.daily(spark, store, broken, clock)
    assert store.current() is None


def test_finished_without_score_stops_the_run(spark, published, tmp_path):
    _, sources, clock = published
    broken = Sources(answers(spark, matches=[match(1, 1, 2, 0, None, status="FINISHED")]), sources.other)
    with pytest.raises(Exception, match="without a score"):
        daily.daily(spark, Store(spark, str(tmp_path / "s")), broken, clock)

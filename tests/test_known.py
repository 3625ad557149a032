"""What counts at a moment: open and overlapping validities, runs of a value, names by several spellings, quotes."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tempora.operators import intervals
from tempora.operators.asof import as_of_valid, first_of_current_value
from tempora.operators.intervals import greatest_valid
from tempora.operators.match import unique_pairs
from tempora.plans import odds, ranking

UTC = timezone.utc
START = datetime(1969, 12, 30, tzinfo=UTC)


@pytest.mark.parametrize("chunk", [36, 4])
def test_greatest_valid_against_all_pairs(spark, monkeypatch, chunk):
    """Intervals from a microsecond to open ends, on both sides of 1970, in chunks long and short."""
    monkeypatch.setattr(intervals, "CHUNK", chunk)
    r = random.Random(3)
    at = lambda: START + timedelta(microseconds=r.choice([r.randrange(50), r.randrange(10**12), r.randrange(300) * 3_600_000]))
    events = [(i, r.choice(["a", "b", "c", None]), 1, at() if r.random() > 0.05 else None) for i in range(200)]
    obs = []
    for i in range(160):
        a = at() if r.random() > 0.05 else None
        until = None if a is None or r.random() < 0.2 else a + timedelta(microseconds=r.choice([1, 2, 3, 17, 10**6, 10**9, 10**11, -5, 0]))
        obs.append((i, r.choice(["a", "b", "d", None]), r.choice([1, 2]), a, until, r.randrange(20)))
    e = spark.createDataFrame(events, "id int, k string, k2 int, t timestamp")
    o = spark.createDataFrame(obs, "oid int, k string, k2 int, s timestamp, u timestamp, p int")
    got = greatest_valid(e, o, ["k", "k2"], ["id"], "t", F.col("s"), F.col("u"), [F.col("p")], ["oid"])
    want = {}
    for i, k, k2, t in events:
        fit = [(p, oid) for oid, ok, ok2, a, u, p in obs if k is not None and (ok, ok2) == (k, k2) and t and a and a <= t and (u is None or t < u)]
        want[i] = max(fit)[1] if fit else None
    assert got.columns == ["id", "k", "k2", "t", "oid"]
    assert {x["id"]: x["oid"] for x in got.collect()} == want and sum(v is not None for v in want.values()) > 60


def test_validity_of_a_century_is_two_rows(spark):
    """However long it is: no row for each day."""
    e = spark.createDataFrame([(1, "a", datetime(2024, 1, 1, tzinfo=UTC)), (2, "a", datetime(1950, 1, 1, tzinfo=UTC))], "id int, k string, t timestamp")
    o = spark.createDataFrame([("a", datetime(1900, 1, 1, tzinfo=UTC), datetime(2900, 1, 1, tzinfo=UTC), 7), ("a", datetime(2000, 1, 1, tzinfo=UTC), None, 8)], "k string, o timestamp, u timestamp, v int")
    halves = intervals._halves(o.select((F.unix_micros("o") + intervals.BIAS).alias("_s"), F.coalesce(F.unix_micros("u") + intervals.BIAS, F.lit(intervals.OPEN)).alias("_e")))
    assert halves.agg(F.sum(F.size("_parts"))).first()[0] == 4
    assert {x["id"]: x["v"] for x in as_of_valid(e, o, ["k"], "id", "t", "o", "u", ["v"]).collect()} == {1: 8, 2: 7}
    assert as_of_valid(e.limit(0), o, ["k"], "id", "t", "o", "u", ["v"]).count() == 0
    assert {x["v"] for x in as_of_valid(e, o.limit(0), ["k"], "id", "t", "o", "u", ["v"]).collect()} == {None}


def test_first_of_current_value_against_nested_search(spark):
    r = random.Random(6)
    hour = lambda h: START + timedelta(hours=h)
    obs = [(k, o := r.randrange(40), o + r.choice([0, 0, 0, 0, 6]), r.choice("xyz") if r.random() > 0.1 else None) for k in "ab" for _ in range(35)]
    events = [(i, r.choice("abc"), r.randrange(45)) for i in range(150)]
    held, want = [], {}
    for i, k, t in events:
        seen = [x for x in obs if x[0] == k and x[3] and x[2] <= t and x[1] < t]
        newest = max(seen, key=lambda x: (x[1], x[3])) if seen else None
        held.append((i, k, hour(t), newest and newest[3], newest and hour(newest[1])))
        if newest:
            own = [x for x in obs if x[0] == k and x[3] == newest[3] and x[1] <= newest[1] and x[2] <= t]
            between = lambda x: any(y[0] == k and y[3] and y[3] != newest[3] and x[1] < y[1] < newest[1] and y[2] <= t for y in obs)  # noqa: B023, E731
            want[i] = hour(min(x[1] for x in own if not between(x)))
        else:
            want[i] = None
    e = spark.createDataFrame(held, "id int, k string, t timestamp, v string, at timestamp")
    o = spark.createDataFrame([(k, hour(o), hour(f), v) for k, o, f, v in obs], "k string, o timestamp, f timestamp, v string")
    got = first_of_current_value(e, o, ["k"], ["id"], "t", "at", "v", "o", "f", "first")
    assert {x["id"]: x["first"] and x["first"].replace(tzinfo=UTC) for x in got.collect()} == want


def test_names_resolve_by_any_spelling_if_alone(spark):
    club = lambda *rows: spark.createDataFrame(rows, "team_id long, name string, short_name string, country string")
    ranked = spark.createDataFrame([("north", "Northern Úlm", "Xland"), ("east", "East End FC", "Xland"), ("west", "West", "Yland"), ("fc", "FC", "Zland")], "club_slug string, club_name string, country string")
    none = spark.createDataFrame([], "team_id long, club_slug string")

    def got(clubs, reviewed=none, aliases=None):
        aliases = spark.createDataFrame(aliases, "team_id long, alias string") if aliases else None
        return {(r["team_id"], r["club_slug"], r["method"][0]) for r in ranking.resolve(clubs, ranked, reviewed, aliases).collect()}

    pairs = lambda *rows: spark.createDataFrame(rows, "team_id long, club_slug string")
    by_name = club((1, "SC Ulm Northern", None, "xland"), (2, "Eastern", "East-End", "XLAND"), (3, "West", None, "Xland"), (4, "West", "", None))
    assert got(by_name) == {(1, "north", "E"), (2, "east", "E")}  # another country, or none, meets nothing
    assert got(club((5, "W.", None, "Yland")), aliases=[(5, "west club"), (6, "east end")]) == {(5, "west", "E")}
    assert got(club((1, "Northern Ulm", "East End", "Xland"))) == set()  # two slugs by two spellings
    assert got(club((1, "East End", None, "Xland"), (2, "Q", "End East", "Xland"))) == set()  # two clubs
    assert got(club((1, "East End", "East End AC", "Xland"))) == {(1, "east", "E")}  # two spellings, one name
    assert got(club((7, "AC", None, "Zland"))) == {(7, "fc", "E")}  # nothing but stop words on either side
    reviewed = pairs((1, "west"), (2, "gone"), (99, "north"))
    clubs = club((1, "East End", None, "Xland"), (2, "End East", None, "Xland"), (3, "West", None, "Yland"), (4, "Northern Ulm", None, "Xland"))
    # 1 and its slug are claimed; the slug of 2 isn't ranked, so that names decide; 99 is no club, so that its slug is free
    assert got(clubs, reviewed) == {(1, "west", "R"), (2, "east", "E"), (4, "north", "E")}
    ranking.check_reviewed(pairs((1, "a"), (1, "a"), (2, "b")))
    with pytest.raises(ValueError, match="more than one team: a"):
        ranking.check_reviewed(pairs((1, "a"), (2, "a")))


def test_unique_pairs_counts_edges(spark):
    left = spark.createDataFrame([(1, "a"), (1, "b"), (2, "b"), (3, "c"), (3, "d")], "l int, n string")
    right = spark.createDataFrame([("x", "a"), ("x", "b"), ("y", "c"), ("y", "d"), ("y", "c")], "r string, n string")
    assert [tuple(x) for x in unique_pairs(left, right, ["n"], "l", "r").collect()] == [(3, "y")]


def test_rankings_are_of_an_earlier_day_known_and_young(spark):
    kick = lambda d: datetime(2026, 10, d, 15, tzinfo=UTC) if d <= 31 else datetime(2026, 12, 1, tzinfo=UTC)
    games = spark.createDataFrame([(i, kick(d), 1, 2) for i, d in enumerate([10, 16, 17, 32])], "match_id long, utc_kickoff timestamp, home_team_id long, away_team_id long")
    row = lambda i, team, day, at, rank: (i, team, date(2026, 10, day), at, "u" + i, rank, 1000 - rank)
    rows = [row("a", 1, 11, datetime(2026, 10, 16, 15, tzinfo=UTC), 3), row("b", 2, 11, datetime(2026, 10, 12, tzinfo=UTC), 5), row("c", 2, 16, datetime(2026, 10, 16, 1, tzinfo=UTC), 4)]
    out = ranking.with_rankings(games, spark.createDataFrame(rows, "raw_id string, team_id long, ranking_date date, observed_at timestamp, source_url string, world_rank int, rating_points int"))
    got = {r["match_id"]: (r["home_world_rank"], r["away_world_rank"], r["world_rank_advantage_home"]) for r in out.collect()}
    assert got == {0: (None, None, None), 1: (None, 5, None), 2: (3, 4, 1), 3: (None, None, None)}


def test_quotes_are_withdrawn_by_their_own_scope_only(spark):
    hour = lambda h: datetime(2026, 9, 20, h, tzinfo=UTC)
    raw = spark.createDataFrame([("f1", "s", "pl", "{}", hour(1)), ("f2", "s", "pl", "{}", hour(5)), ("g1", "s", "cl", "{}", hour(2)), ("h1", "s", "pl", '{"r":1}', hour(9))], "raw_id string, source string, endpoint string, request_params string, ingested_at timestamp")
    quote = lambda raw_id, h, event, book, price: [(raw_id, hour(h), event, book, book.upper(), "h2h", hour(0), role, p) for role, p in zip(("HOME", "DRAW", "AWAY"), price)]
    rows = [*quote("f1", 1, "e1", "b1", (2.0, 3.0, 4.0)), *quote("f1", 1, "e1", "b2", (2.5, 3.0, None)), *quote("f2", 5, "e1", "b1", (2.0, 3.0, 4.0)), *quote("g1", 2, "e2", "b1", (5.0, 3.0, 1.5)), *quote("h1", 9, "e3", "b1", (5.0, 3.0, 1.5))]
    staged = spark.createDataFrame(rows, "raw_id string, fetched_at timestamp, event_id string, bookmaker_key string, bookmaker_title string, market_key string, source_updated_at timestamp, outcome_role string, price double").withColumn("price", F.col("price").cast("decimal(9,3)"))
    resolved = spark.createDataFrame([("e1", 1), ("e2", 2), ("e3", None)], "event_id string, match_id long")
    facts = odds.priced(odds.changes(staged, resolved))
    latest = odds.latest(facts, raw, staged, resolved)
    got = {(r["match_id"], r["bookmaker_key"]): (r["is_current"], r["is_complete"]) for r in latest.collect()}
    assert got == {(1, "b1"): (True, True), (1, "b2"): (False, False), (2, "b1"): (True, True)}
    guess = spark.createDataFrame([(1, "m", date(2026, 9, 19), hour(0), 0.5, 0.3, 0.2), (1, "m", date(2026, 9, 20), hour(3), 0.4, 0.3, 0.3), (3, "m", date(2026, 9, 20), hour(3), 0.4, 0.3, 0.3)], "match_id long, model_version string, as_of_date date, predicted_at timestamp, home_prob double, draw_prob double, away_prob double")
    both = {r["bookmaker_key"]: r for r in odds.comparison(odds.latest_predictions(guess), latest).collect()}
    assert set(both) == {"b1", "b2"} and both["b1"]["home_model_odds"] == 2.5 and both["b2"]["home_deviation_pp"] is None
    assert both["b1"]["home_deviation_pp"] == round((0.4 - both["b1"]["home_prob_fair"]) * 100, 1) and both["b1"]["predicted_at"].hour == 3

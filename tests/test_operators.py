"""Temporal operators on seeded rows, with expectations worked out by hand or by brute force."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.functions.names import overlap, tokens
from tempora.operators.asof import as_of, as_of_days, as_of_valid, first_of_current_run
from tempora.operators.latest import keep_latest, newest
from tempora.operators.lookback import HOUR, look_back, range_counts, totals_before
from tempora.operators.merge import insert_if_absent, outcome, upsert, widen
from tempora.plans import baseline, features, forecast
from tempora.plans.export import column_role, describe, export, verify_export
from tempora.plans.fixtures import appearances
from tempora.queries import QUERIES

START = datetime(2024, 1, 1, 15)


@pytest.fixture(scope="module")
def games(spark):
    r = random.Random(4)
    rows = []
    for i in range(120):
        at = START + timedelta(hours=r.choice([0, 1, 3, 24, 48]) + 12 * (i // 3))
        home = r.randrange(6)
        score = None if i % 9 == 0 else (r.randrange(4), r.randrange(4))
        rows.append((i, at, f"C{i % 2}", i // 60, i < 110, home, (home + r.randrange(1, 6)) % 6, *(score or (None, None))))
    return spark.createDataFrame(rows, "match_id long, utc_kickoff timestamp, competition_code string, season_id int, is_finished boolean, home_team_id long, away_team_id long, home_goals long, away_goals long").cache()


@pytest.fixture(scope="module")
def sides(games):
    return sorted((r.asDict() for r in appearances(games).collect()), key=lambda r: (r["utc_kickoff"], r["match_id"]))


def prior(sides, a, n, gap=timedelta(hours=3), **same):
    fits = [p for p in sides if p["team_id"] == a["team_id"] and p["is_finished"] and p["goals_for"] is not None and p["utc_kickoff"] < a["utc_kickoff"] - gap and all(p[k] == a[k] for k in same)]
    return fits[-n:]


def test_form_of_all_windows_and_scopes(games, sides):
    got = {(r["match_id"], r["team_id"]): r for r in features.team_features(appearances(games)).collect()}
    assert len(got) == 240
    for a in sides:
        g = got[a["match_id"], a["team_id"]]
        for n in (3, 5, 10):
            w = prior(sides, a, n)
            assert g[f"matches_last_{n}"] == len(w) and g[f"points_last_{n}"] == sum(p["points"] for p in w)
            assert g[f"over_2_5_last_{n}"] == sum(p["goals_for"] + p["goals_against"] > 2 for p in w)
            assert g[f"win_rate_last_{n}"] == (round(sum(p["points"] == 3 for p in w) / len(w), 4) if w else None)
        assert g["venue_points_last_5"] == sum(p["points"] for p in prior(sides, a, 5, is_home=1))
        assert g["competition_goals_for_last_5"] == sum(p["goals_for"] for p in prior(sides, a, 5, competition_code=1))
        assert g["h2h_matches_last_5"] == len(prior(sides, a, 5, opponent_team_id=1))
        days = [p for p in sides if p["team_id"] == a["team_id"] and p["is_finished"] and a["utc_kickoff"] - timedelta(days=7) <= p["utc_kickoff"] < a["utc_kickoff"] - timedelta(hours=3)]
        assert g["played_last_7_days"] == len(days)
        if not prior(sides, a, 1):
            assert g["points_per_match_last_5"] is None and g["goals_for_last_5"] == 0


def test_future_rows_change_nothing(games):
    early = games.where(F.col("utc_kickoff") < START + timedelta(days=10))
    key = ["match_id", "team_id", "points_last_5", "rest_days", "season_points", "history_matches"]
    a = features.team_features(appearances(early)).select(key)
    b = features.team_features(appearances(games)).where(F.col("utc_kickoff") < START + timedelta(days=10)).select(key)
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_product_has_both_sides(games):
    p = features.product(games, features.team_features(appearances(games)))
    assert p.count() == 120
    r = p.where("match_id = 100").first()
    assert r["points_difference_last_5"] == r["home_points_last_5"] - r["away_points_last_5"]


def test_totals_before_and_forecast(games, sides):
    got = {r["match_id"]: r for r in forecast.league_before(games).collect()}
    rows = [r.asDict() for r in games.collect()]
    for m in rows:
        w = [p for p in rows if p["is_finished"] and p["home_goals"] is not None and p["utc_kickoff"] < m["utc_kickoff"]]
        assert got[m["match_id"]]["league_matches_considered"] == len(w)
        assert abs(got[m["match_id"]]["mu_home"] - (sum(p["home_goals"] for p in w) + 31) / (len(w) + 20)) < 1e-12
    f = forecast.forecast(games, features.legacy_form(appearances(games)))
    assert f.count() == 120 and f.where("abs(home_prob + draw_prob + away_prob - 1) > 1e-4").count() == 0
    assert totals_before(games.limit(0), "utc_kickoff", F.lit(True), {"n": F.lit(1)}).count() == 0


def test_latest_and_merges(spark):
    rows = spark.createDataFrame([("a", 1, "x"), ("a", None, "y"), ("b", 2, "z"), (None, 1, "n"), (None, 3, "m")], "k string, t int, v string")
    assert {r["k"]: r["v"] for r in keep_latest(rows, ["k"], newest("t")).collect()} == {"a": "y", "b": "z", None: "m"}
    old = spark.createDataFrame([(1, 5, "old"), (2, 5, "stays"), (3, 5, "old")], "k int, g int, v string")
    new = spark.createDataFrame([(1, 5, "new"), (3, 4, "older"), (4, 1, "new")], "k int, g int, v string")
    assert {r["k"]: r["v"] for r in upsert(old, new, ["k"], "g").collect()} == {1: "new", 2: "stays", 3: "old", 4: "new"}
    assert {r["k"]: r["v"] for r in upsert(old, new, ["k"]).collect()} == {1: "new", 2: "stays", 3: "older", 4: "new"}
    a = spark.createDataFrame([("q", None, 3, 5, "t3")], "k string, p int, f int, l int, title string")
    b = spark.createDataFrame([("q", None, 1, 2, "t1"), ("q", 7, 9, 9, "t9")], "k string, p int, f int, l int, title string")
    for first, second in ((a, b), (b, a)):
        assert sorted(map(tuple, widen(first, second, ["k", "p"], "f", "l", ["title"]).collect()), key=repr) == [("q", 7, 9, 9, "t9"), ("q", None, 1, 5, "t3")]
    assert insert_if_absent(old, new, ["k"], [F.col("g")]).count() == 4
    assert {r["k"]: r["outcome"] for r in outcome(old, new, ["k"], "v").collect()} == {1: "UPDATED", 3: "UPDATED", 4: "INSERTED"}


def test_as_of(spark):
    at = lambda h: START + timedelta(hours=h)
    events = spark.createDataFrame([(1, "a", at(10)), (2, "a", at(0)), (3, "b", at(5)), (4, None, at(5))], "id int, k string, t timestamp")
    obs = spark.createDataFrame([("a", at(10), 1, None), ("a", at(9), 2, at(9.5)), ("a", at(8), 3, None), ("b", at(1), 4, at(2))], "ok string, o timestamp, v int, until timestamp")
    got = as_of(events, obs.withColumnRenamed("ok", "k"), ["k"], "t", "o", ["v"])
    assert {r["id"]: r["v"] for r in got.collect()} == {1: 2, 2: None, 3: 4, 4: None}
    loose = as_of(events, obs.withColumnRenamed("ok", "k"), ["k"], "t", "o", ["v"], strict=False)
    assert {r["id"]: r["v"] for r in loose.collect()}[1] == 1
    valid = as_of_valid(events, obs.withColumnRenamed("ok", "k"), ["k"], "id", "t", "o", "until", ["v"])
    assert {r["id"]: r["v"] for r in valid.collect()} == {1: 3, 2: None, 3: None, 4: None}  # expired: the older valid one


def test_islands_and_ranges(spark):
    rows = spark.createDataFrame([("t", i, v) for i, v in enumerate("aabbab")], "k string, o int, v string")
    got = sorted((r["o"], r["since"]) for r in first_of_current_run(rows, ["k"], ["o"], "v", "since").collect())
    assert got == [(0, 0), (1, 0), (2, 2), (3, 2), (4, 4), (5, 5)]
    at = spark.createDataFrame([(i, 1, START + timedelta(hours=h)) for i, h in enumerate([0, 3, 3.001, 50])], "id int, k int, t timestamp")
    got = {r["id"]: r["n"] for r in range_counts(at, ["k"], "t", F.lit(True), {"n": 48 * HOUR}, 3 * HOUR).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 2}
    assert look_back(at.limit(0), ["k"], "t", "id", F.lit(True), {3: {"s": F.lit(1)}}).count() == 0


def test_names(spark):
    rows = spark.createDataFrame([("1. FC Köln", "Koeln"), ("Malmö FF", "malmo ff"), ("FC", "AC"), ("Bodø/Glimt", "Bodo Glimt")], "a string, b string")
    got = [r[0] for r in rows.select(overlap(tokens(F.col("a")), tokens(F.col("b")))).collect()]
    assert got == [0.0, 1.0, 0.0, 1.0]


def test_every_part_looks_for_its_partners(spark, tmp_path):
    r = random.Random(5)
    rows = [(i, r.choice([1, 2, None]), " ".join(r.choice(["red", "hot", "ring", "de", "bolt", "gear", "Nut"]) for _ in range(r.randint(0, 4)))) for i in range(60)] + [(60, 1, None)]
    spark.createDataFrame(rows, "p_partkey int, p_size int, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    names = {i: {w for w in (n or "").lower().split() if w != "de"} for i, _, n in rows}
    want = {}
    for q, size, _ in rows:
        for p, other, _ in rows:
            least = min(len(names[p]), len(names[q]))
            if p != q and size is not None and size == other and least and len(names[p] & names[q]) / least >= 0.5:
                want[q, p] = len(names[p] & names[q]) / least
    got = [tuple(x) for x in QUERIES["name_overlap_all"](spark, str(tmp_path)).collect()]
    assert sorted(got) == sorted((q, p, s) for (q, p), s in want.items())
    some = [tuple(x) for x in QUERIES["name_overlap_match"](spark, str(tmp_path)).collect()]
    assert sorted(some) == sorted(got)


def test_clock():
    with pytest.raises(ValueError):
        Clock.at("2026-01-01", datetime(2026, 1, 1))
    assert Clock.at("2026-01-01").as_of == datetime(2026, 1, 1, 23, 59, 59, tzinfo=timezone.utc)


def test_export_and_roles(spark, tmp_path):
    assert [column_role(c) for c in ("label_x", "match_id", "weather_status", "audit_y", "seen_at", "home_points", "label_available")] == ["label", "identifier", "audit", "audit", "audit", "feature", "label"]
    df = describe(spark.createDataFrame([(2, None), (1, "x")], "match_id int, home_kind string"), {"home_kind": 'of the "home" side'})
    target = f"file://{tmp_path}/v1"
    m = export(df, target, ["match_id"], "v1", single_file=True)
    assert m["rows"] == 2 and m["roles"]["home_kind"] == "feature" and len(m["files"]) == 1
    assert [r["match_id"] for r in spark.read.csv(f"{target}/data", header=True).collect()] == ["1", "2"]
    told = {r["column_name"]: r["description"] for r in spark.read.csv(f"{target}/dictionary", header=True, escape='"').collect()}
    assert told == {"match_id": "match id", "home_kind": 'of the "home" side'}
    with pytest.raises(FileExistsError):
        export(df, target, ["match_id"], "v1")


def test_export_is_ordered_over_many_files(spark, tmp_path):
    r = random.Random(4)
    rows = [(i, START + timedelta(hours=r.randrange(500)), r.choice(["", None, 'a "b", c', "line\nline", "\\", "é"]), r.random()) for i in range(900)]
    df = spark.createDataFrame(rows, "match_id int, utc_kickoff timestamp, note string, x double")
    target = f"{tmp_path}/v1"
    with_many = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in with_many}
    for k, v in with_many.items():
        spark.conf.set(k, v)
    m = export(df, target, ["utc_kickoff", "match_id"], "v1")
    for k, v in before.items():
        spark.conf.set(k, v)
    assert len(m["files"]) > 1 and m["files"] == sorted(m["files"], key=lambda f: f["file"]) and sum(f["rows"] for f in m["files"]) == 900
    got = []
    for f in m["files"]:  # names keep the order
        got += [(x["utc_kickoff"], int(x["match_id"]), x["note"] or "") for x in spark.read.options(header=True, escape='"', multiLine=True).csv(f"{target}/data/{f['file']}").collect()]
    assert [(i, n) for _, i, n in got] == [(i, n or "") for i, at, n, _ in sorted(rows, key=lambda x: (x[1], x[0]))]
    assert verify_export(spark, target) == []
    lost = sorted((tmp_path / "v1" / "data").glob("part-*"))[0]
    lost.unlink()
    assert verify_export(spark, target) == [f"{lost.name} is missing", "rows", "content"]


def test_baseline_beats_the_prior(spark):
    r = random.Random(8)
    rows = []
    for i in range(400):
        x = r.gauss(0, 1)
        label = "HOME_WIN" if x + r.gauss(0, 0.5) > 0.3 else "AWAY_WIN" if x < -0.3 else "DRAW"
        rows.append((START + timedelta(hours=i), label, x, None if i % 7 == 0 else r.random(), f"L{i % 3}"))
    df = spark.createDataFrame(rows, "t timestamp, label string, x double, z double, league string")
    train, test = baseline.split_by_time(df, "t")
    assert train.agg(F.max("t")).first()[0] < test.agg(F.min("t")).first()[0]
    model = baseline.fit(train, "label", ["x", "z"], ["league"])
    mine = baseline.class_metrics(baseline.predict(model, test, "label", ["x", "z"])).first()
    flat = baseline.class_metrics(baseline.prior(train, test, "label")).first()
    assert mine["accuracy"] > flat["accuracy"] and mine["log_loss"] < flat["log_loss"] and mine["brier"] < flat["brier"]


def test_as_of_by_validity_and_by_age_match_brute_force(spark):
    r = random.Random(5)
    at = lambda: None if r.random() < 0.05 else START + timedelta(hours=r.randrange(0, 400))
    events = [(i, r.choice(["a", "b", None]), at()) for i in range(120)]
    seen = [(i, r.choice(["a", "b", None]), t := at(), None if t is None or r.random() < 0.1 else t + timedelta(hours=r.choice([-3, 0, 5, 30, 200]))) for i in range(60)]
    e = spark.createDataFrame(events, "id int, k string, t timestamp")
    o = spark.createDataFrame(seen, "oid int, k string, o timestamp, u timestamp")

    def best(good):
        out = {}
        for i, k, t in events:
            fit = [(ot, oid) for oid, ok, ot, u in seen if k is not None and ok == k and t and ot and good(t, ot, u)]
            out[i] = max(fit)[1] if fit else None
        return out

    valid = as_of_valid(e, o, ["k"], "id", "t", "o", "u", ["oid"], ["oid"])
    assert valid.columns == ["id", "k", "t", "oid"]
    assert {x["id"]: x["oid"] for x in valid.collect()} == best(lambda t, ot, u: ot < t and (u is None or t < u))
    known = e.where("t IS NOT NULL AND k IS NOT NULL")
    young = as_of_days(known, o.where("o IS NOT NULL"), ["k"], "t", "o", 3, ["oid"], ["oid"])
    wanted = best(lambda t, ot, u: 0 < (t.date() - ot.date()).days <= 3)
    assert {x["id"]: x["oid"] for x in young.collect()} == {i: wanted[i] for i, k, t in events if k and t}

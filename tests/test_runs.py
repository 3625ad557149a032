"""The run log, the verification rows, replay of recorded answers, and the split by two dates."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.plans import baseline, runs, staging, verify
from tempora.sources import raw

UTC = timezone.utc
CLOCK = Clock.at("2026-09-20", datetime(2026, 9, 20, 6, tzinfo=UTC))


def test_a_run_is_logged_before_and_after(spark, tmp_path):
    path = str(tmp_path / "runs")
    with runs.Run(spark, path, "daily", CLOCK, "r1") as run:
        assert [r["status"] for r in runs.read(spark, path).collect()] == ["RUNNING"]
        run.add(extracted=3, loaded=2)
        run.add(loaded=1)
    with pytest.raises(KeyError), runs.Run(spark, path, "daily", CLOCK, "r2"):
        raise KeyError("x" * 5000)
    rows = {r["run_id"]: r for r in runs.current(runs.read(spark, path)).collect()}
    assert runs.read(spark, path).count() == 4 and set(rows) == {"r1", "r2"}
    assert (rows["r1"]["status"], rows["r1"]["rows_extracted"], rows["r1"]["rows_loaded"], rows["r1"]["error_message"]) == ("SUCCESS", 3, 3, None)
    assert rows["r2"]["status"] == "FAILED" and len(rows["r2"]["error_message"]) == runs.MESSAGE and rows["r2"]["error_message"].startswith("KeyError")
    assert all(r["started_at"] <= r["finished_at"] for r in rows.values())


def log(spark, rows):
    return spark.createDataFrame(rows, "run_id string, status string, started_at timestamp, finished_at timestamp")


def told(rows):
    return {r["check_name"]: (r["observed"], r["passed"]) for r in rows.collect()}


def test_run_log_rows(spark):
    now = CLOCK.as_of
    good = log(spark, [("a", "FAILED", now - timedelta(days=1), now - timedelta(days=1)), ("b", "SUCCESS", now - timedelta(minutes=9), now - timedelta(minutes=5))])
    assert verify.failed(verify.run_log(good, CLOCK)) == []
    stuck = log(spark, [("a", "RUNNING", now - timedelta(hours=2), None)])
    assert verify.failed(verify.run_log(stuck, CLOCK)) == ["latest run succeeded", "no run left hanging in RUNNING for over an hour"]
    assert told(verify.run_log(stuck, CLOCK))["latest run succeeded"][0] == "RUNNING at still running"
    assert verify.failed(verify.run_log(log(spark, []), CLOCK)) == ["at least one run recorded", "latest run succeeded"]


def test_raw_zone_rows(spark):
    day, at = date(2026, 9, 20), CLOCK.as_of
    names = ["competitions/CL", "competitions/CL/matches", "competitions/CL/teams", "competitions/CL/standings"]
    whole = raw.rows(spark, [("f", n, {}, {"matches": [1, 2]}) for n in names], day, at, "b")
    known = log(spark, [("b", "SUCCESS", at, at)])
    got = told(verify.raw_zone(whole, known))
    assert len(got) == 5 and all(p for _, p in got.values()) and got["match payload carries matches"][0] == "2"
    bad = raw.rows(spark, [("f", n, {}, {"matches": []}) for n in names[:2]], day, at, "z")
    assert verify.failed(verify.raw_zone(bad.union(bad), known)) == ["every raw row belongs to a known run", "four current endpoints per competition", "match payload carries matches", "no duplicate business keys"]
    assert "raw payloads present" in verify.failed(verify.raw_zone(whole.limit(0), known))


def test_odds_rows(spark):
    at = CLOCK.as_of
    games = spark.createDataFrame([(1,), (2,)], "match_id long")
    fetch = lambda i, params="{}", body="[1]": (i, "the-odds-api.com", "odds", params, at, body)
    schema = "raw_id string, source string, endpoint string, request_params string, ingested_at timestamp, payload string"
    staged = spark.createDataFrame([("o1",)], "raw_id string")
    resolved = spark.createDataFrame([("e", 1)], "event_id string, match_id long")
    quotes = spark.createDataFrame([(True, 0.5, 0.3, 0.2), (False, None, None, None)], "is_complete boolean, home_prob_fair double, draw_prob_fair double, away_prob_fair double")
    good = verify.odds_zone(games, games, spark.createDataFrame([fetch("o1"), fetch("o2", body="[]")], schema), staged, resolved, quotes)
    assert good.count() == 6 and verify.failed(good) == []
    wrong = quotes.union(spark.createDataFrame([(True, 0.5, 0.3, 0.3)], quotes.schema))
    bad = verify.odds_zone(games, games.limit(1), spark.createDataFrame([fetch("o9", '{"apiKey":"k"}')], schema), staged, resolved.union(spark.createDataFrame([("f", None)], resolved.schema)), wrong)
    assert len(verify.failed(bad)) == 5
    empty = verify.odds_zone(games, games, spark.createDataFrame([], schema), staged.limit(0), resolved.limit(0), quotes.limit(0))
    assert verify.failed(empty) == [] and told(empty)["newest odds fetch"][0] == "none"


def test_training_rows(spark):
    at = CLOCK.as_of
    games = spark.createDataFrame([(1, at), (2, at)], "match_id long, utc_kickoff timestamp")
    product = spark.createDataFrame([(1, at, "DRAW", at - timedelta(hours=1)), (2, at, None, None)], "match_id long, utc_kickoff timestamp, label_outcome_90min string, audit_odds_observed_at timestamp")
    features = spark.createDataFrame([(1, at - timedelta(days=1)), (2, None)], "match_id long, history_last_available_at timestamp")
    assert verify.failed(verify.training(product, features, games)) == []
    late = product.withColumn("audit_odds_observed_at", F.col("utc_kickoff"))
    assert verify.failed(verify.training(late.union(late.limit(1)), features.withColumn("history_last_available_at", F.lit(at)), games)) == ["no future history", "no future observed context or odds", "one row per canonical match"]
    assert "one row per canonical match" in verify.failed(verify.training(product.where("match_id = 1"), features, games))


def test_replayed_files_are_staged(spark, tmp_path):
    folder = tmp_path / "recorded" / "competitions" / "CL"
    folder.mkdir(parents=True)
    team = {"id": 5, "name": "Alpha", "runningCompetitions": [{"code": "CL"}]}
    (folder / "teams.json").write_text(json.dumps({"teams": [team]}))
    rows = raw.replay(spark, str(tmp_path / "recorded"), "f", CLOCK.logical_date, CLOCK.as_of, "r", ["competitions/CL/teams"])
    assert [r["endpoint"] for r in rows.collect()] == ["competitions/CL/teams"]
    assert [r["team_id"] for r in staging.teams(rows, CLOCK).collect()] == [5]
    with pytest.raises(FileNotFoundError, match="matches"):
        raw.replay(spark, str(tmp_path / "recorded"), "f", CLOCK.logical_date, CLOCK.as_of, "r", ["competitions/CL/matches"])


START = datetime(2026, 8, 1, 12, tzinfo=UTC)


def played(spark, labels, leak=False):
    rows = [(i, START + timedelta(hours=2 * i), label, START + timedelta(hours=2 * i + (0 if leak else -5))) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "match_id long, utc_kickoff timestamp, label string, seen timestamp")


def split(df, start=20, end=30, now=100):
    at = lambda h: START + timedelta(hours=h)
    return baseline.chronological_split(df, "label", at(start), at(end), at(now), history=["seen"])


def test_split_by_two_dates(spark):
    labels = [baseline.CLASSES[i % 3] for i in range(20)]
    train, test = split(played(spark, labels))
    ids = lambda df: sorted(r["match_id"] for r in df.collect())
    assert ids(train) == list(range(9)) and ids(test) == list(range(10, 15))  # 9 was not known at the cut
    assert ids(split(played(spark, labels), now=28)[1]) == [10, 11, 12]
    one = played(spark, labels)
    for df, told in ((one.union(one.limit(1)), "repeated"), (played(spark, labels, leak=True), "before kick-off"), (played(spark, ["DRAW"] * 20), "every class"), (played(spark, labels[:5]), "both periods"), (one.limit(0), "both periods")):
        with pytest.raises(ValueError, match=told):
            split(df)
    with pytest.raises(ValueError, match="earlier"):
        split(one, 30, 20)


def test_experiment_is_saved_once(spark, tmp_path):
    rows = [(i, START + timedelta(hours=2 * i), baseline.CLASSES[i % 3], float(i % 3)) for i in range(60)]
    df = spark.createDataFrame(rows, "match_id long, utc_kickoff timestamp, label string, x double")
    model = baseline.fit(df, "label", ["x"])
    scored = baseline.predict(model, df, "label", ["x"])
    folder = str(tmp_path / "experiment")
    baseline.save_experiment(folder, model, scored, baseline.class_metrics(scored))
    assert spark.read.csv(f"{folder}/predictions", header=True).columns == ["label", "prob_away_win", "prob_draw", "prob_home_win"]
    assert spark.read.json(f"{folder}/metrics").first()["n"] == 60
    again = baseline.PipelineModel.load(f"{folder}/model")
    assert again.stages[0].labels == model.stages[0].labels
    with pytest.raises(FileExistsError):
        baseline.save_experiment(folder, model, scored, scored)

"""What sets the size of a task, and answers found in one pass."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

from pyspark.sql import functions as F

from tempora.operators.intervals import greatest_begun
from tempora.plans import context, features
from tempora.plans.fixtures import appearances, matches

SMALL = "/root/testdata/sf0.001"
START = datetime(1969, 12, 31, tzinfo=timezone.utc)


def test_rows_set_the_number_of_tasks(spark, monkeypatch):
    """However few bytes they travel as; a team isn't divided."""
    monkeypatch.setattr(features, "TEAM_ROWS", 200)
    monkeypatch.setattr(features, "MATCH_ROWS", 100)
    games = matches(spark, SMALL)
    rows = games.count() * 2
    team = features.team_features(appearances(games))
    held = team.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()
    assert len(held) > 1 and rows / max(x["n"] for x in held) > rows / 200 / 3
    teams = team.select("team_id", F.spark_partition_id().alias("p")).distinct()
    assert teams.count() == teams.select("team_id").distinct().count()
    assert features.product(games, team).rdd.getNumPartitions() == -(-rows // 100)


def test_greatest_begun_against_all_pairs(spark):
    r = random.Random(5)
    at = lambda: None if r.random() < 0.05 else START + timedelta(microseconds=r.choice([r.randrange(50), r.randrange(10**12)]))
    events = [(i, r.choice(["a", "b", "c", None]), at()) for i in range(150)]
    obs = [(i, r.choice(["a", "b", "d", None]), at(), r.randrange(20)) for i in range(120)]
    e, o = spark.createDataFrame(events, "id int, k string, t timestamp"), spark.createDataFrame(obs, "oid int, k string, s timestamp, p int")
    got = greatest_begun(e, o, ["k"], "t", F.col("s"), [F.col("p")], ["oid"])
    want = {i: max(((p, oid) for oid, ok, s, p in obs if ok == k and s and s <= t), default=(0, None))[1] for i, k, t in events if k and t}
    assert got.columns == ["id", "k", "t", "oid"] and {x["id"]: x["oid"] for x in got.collect()} == want


def test_players_and_what_is_told_of_them(spark):
    """JSON decides only between rows of one id; the struct says what the columns say."""
    kind = "s array<struct<id: long, position: string, dateOfBirth: string, nationality: string>>"
    rows = [([(3, "Goalkeeper", "1990-01-01", "A"), (None, "x", "", "B"), (1, None, "2000-02-30", "")],), ([(2, "b", "", "Z"), (1, "Left-Back", "2000-01-01", "B"), (2, "a", "", "A")],), ([],), (None,)]
    df = spark.createDataFrame(rows, kind).select(context.players(F.col("s")).alias("s"))
    assert [[(p["id"], p["position"]) for p in x["s"]] for x in df.collect()] == [[(1, None), (3, "Goalkeeper")], [(1, "Left-Back"), (2, "a")], [], []]
    args = F.col("s"), F.lit("2020-01-01").cast("timestamp"), F.lit("A")
    columns = context.squad_summary(*args)
    out = df.select(context.squad_told(*args).alias("told"), *[c.alias(n) for n, c in columns.items()]).collect()
    assert all(x["told"].asDict() == {n: x[n] for n in columns} for x in out)
    assert [(x["squad_size"], x["squad_missing_birthdates"], x["squad_goalkeepers"], x["squad_foreign_players"]) for x in out] == [(2, 1, 1, None), (2, 1, 0, 1), (None, None, None, None), (None, None, None, None)]

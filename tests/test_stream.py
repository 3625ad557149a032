"""The store's parts and the stream of odds: late, repeated and crashed batches, and what a batch writes."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tempora.plans import odds, staging
from tempora.sources.raw import canonical
from tempora.store import Change, Store, part_of
from tempora.streaming import odds as stream

UTC = timezone.utc
KICK = datetime(2026, 10, 1, 15, tzinfo=UTC)
TEAMS = ["Alpha", "Beta", "Gamma", "Delta", "Omega", "Sigma", "Kappa", "Lambda"]


def fixtures(spark, pairs):
    games = spark.createDataFrame([(i, KICK + timedelta(hours=12 * i), 2 * i, 2 * i + 1) for i in range(pairs)], "match_id long, utc_kickoff timestamp, home_team_id long, away_team_id long")
    teams = spark.createDataFrame([(i, f"{TEAMS[i % 8]} {i}", None, None) for i in range(2 * pairs)], "team_id long, name string, short_name string, tla string")
    return odds.fixtures(games, teams, spark.createDataFrame([], "team_id long, alias string"))


def event(i, price, updated, name="", books=("b1", "b2")):
    at = (KICK + timedelta(hours=12 * i)).strftime("%Y-%m-%dT%H:%M:%SZ")
    home, away = f"{TEAMS[2 * i % 8]} {2 * i}{name}", f"{TEAMS[(2 * i + 1) % 8]} {2 * i + 1}"
    outcomes = [{"name": n, "price": p} for n, p in ((home, price), ("Draw", 3.0), (away, 4.0))]
    return {"id": f"e{i}", "commence_time": at, "home_team": home, "away_team": away, "bookmakers": [{"key": b, "title": b.upper(), "last_update": updated, "markets": [{"key": "h2h", "outcomes": outcomes}]} for b in books]}


def fetch(n, events, hour):
    return (f"f{n}", "s", "odds", "{}", datetime(2026, 9, 20, tzinfo=UTC) + timedelta(hours=hour), canonical(events))


def frame(spark, rows):
    return spark.createDataFrame(rows, stream.RAW)


def content(store):
    key = lambda r: json.dumps(r.asDict(), default=str, sort_keys=True)
    return {t: sorted(map(key, store.read(t, s).collect())) for t, s in (("staged_odds", stream.STAGED), ("bookmaker_odds", stream.FACTS), ("event_quotes", stream.QUOTES), ("odds_events", stream.EVENTS))}


def fetches(seed, n, pairs):
    r = random.Random(seed)
    return [fetch(k, [event(i, r.choice([2.0, 2.5, 3.0]), f"2026-09-{19 + k % 3}T00:00:00Z") for i in r.sample(range(pairs), 3)], 9 * k) for k in range(n)]


@pytest.fixture(scope="module")
def games(spark):
    return fixtures(spark, 6).cache()


def test_any_order_and_cut_gives_what_one_pass_gives(spark, tmp_path, games):
    rows = fetches(1, 8, 6)
    facts = odds.priced(odds.changes(staging.odds(frame(spark, rows)), odds.resolve(staging.odds(frame(spark, rows)).select("event_id", "commence_time", "home_team_name", "away_team_name").distinct(), games)))
    want = sorted(json.dumps(r.asDict(), default=str, sort_keys=True) for r in facts.collect())
    stores = []
    for k, batches in enumerate([[rows], [rows[5:], rows[:2], rows[2:5], rows[1:6]]]):  # late, and fetches that come again
        store = Store(spark, f"{tmp_path}/s{k}")
        for n, batch in enumerate(batches):
            stream.absorb(store, frame(spark, batch), games, ("c", n), parts=4)
        stores.append(content(store))
    assert stores[0] == stores[1] and stores[0]["bookmaker_odds"] == want and want


def test_a_repeated_batch_changes_nothing(spark, tmp_path, games):
    store, rows = Store(spark, f"{tmp_path}/s"), fetches(2, 3, 6)
    first = stream.absorb(store, frame(spark, rows), games, ("c", 0), parts=4)
    before = content(store)
    assert first and stream.absorb(store, frame(spark, rows), games, ("c", 0), parts=4) is None and store.current() == first
    stream.absorb(store, frame(spark, rows), games, ("another checkpoint", 0), parts=4)  # known by their ids
    assert content(store) == before


def test_a_crash_before_the_rename_leaves_the_version_before(spark, tmp_path, games, monkeypatch):
    store, rows = Store(spark, f"{tmp_path}/s"), fetches(3, 4, 6)
    stream.absorb(store, frame(spark, rows[:2]), games, ("c", 0), parts=4)
    before, version = content(store), store.current()
    with monkeypatch.context() as m:
        m.setattr(Store, "_names", lambda self, folder, real=Store._names: (_ for _ in ()).throw(OSError("lost")) if folder.endswith("odds_events") else real(self, folder))
        with pytest.raises(OSError, match="lost"):
            stream.absorb(store, frame(spark, rows[2:]), games, ("c", 1), parts=4)
    assert store.current() == version and content(store) == before
    assert stream.absorb(store, frame(spark, rows[2:]), games, ("c", 1), parts=4)
    plain = Store(spark, f"{tmp_path}/p")
    stream.absorb(plain, frame(spark, rows), games, parts=4)
    assert content(store) == content(plain)
    gone = store.vacuum(keep=1, hours=0)  # what the crash left, and replaced parts
    assert gone and content(store) == content(plain) and store.vacuum(keep=1, hours=0) == []


def test_late_resolution_brings_the_whole_history(spark, tmp_path, games):
    store = Store(spark, f"{tmp_path}/s")
    stream.absorb(store, frame(spark, [fetch(0, [event(9, 2.0, "2026-09-19T00:00:00Z")], 1)]), games, parts=4)
    stream.absorb(store, frame(spark, [fetch(1, [event(9, 2.5, "2026-09-20T00:00:00Z")], 5)]), games, parts=4)
    assert store.read("bookmaker_odds", stream.FACTS).count() == 0 and store.read("event_quotes", stream.QUOTES).count() == 4
    later = fixtures(spark, 12)
    assert stream.look_again(store, later, parts=4)
    facts = store.read("bookmaker_odds", stream.FACTS)
    assert facts.count() == 4 and {r["match_id"] for r in facts.collect()} == {9}
    assert stream.look_again(store, later, parts=4) is None


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    """A store of 400 events, then one fetch of one event: the parts of that event are written, and no others."""
    games, store = fixtures(spark, 400).cache(), Store(spark, f"{tmp_path}/s")
    all_ = [fetch(k, [event(i, 2.0 + k / 4, f"2026-09-2{k}T00:00:00Z", books=("b1", "b2", "b3")) for i in range(400)], k) for k in range(3)]
    first = stream.absorb(store, frame(spark, all_), games, ("c", 0))
    before = store.manifest()["tables"]
    second = stream.absorb(store, frame(spark, [fetch(9, [event(7, 5.0, "2026-09-20T09:00:00Z")], 30)]), games, ("c", 1))
    after = store.manifest()["tables"]
    changed = {t: [p for p in after[t] if after[t][p] != before[t].get(p)] for t in after}
    assert {t: len(p) for t, p in changed.items()} == {"staged_odds": 1, "odds_events": 1, "event_quotes": 1, "bookmaker_odds": 1}
    assert store.written(second) < 0.2 * store.written(first)
    assert store.read("bookmaker_odds", stream.FACTS).where("match_id = 7 AND home_price = 5").count() == 2


def test_files_that_arrive_are_taken_once(spark, tmp_path, games):
    raw, store = tmp_path / "raw", Store(spark, f"{tmp_path}/s")
    raw.mkdir()
    names = ["raw_id", "source", "endpoint", "request_params", "ingested_at", "payload"]

    def arrive(name, rows):
        (raw / name).write_text("".join(json.dumps(dict(zip(names, r)), default=lambda t: t.isoformat()) + "\n" for r in rows))
        stream.run(spark, str(raw), store, games, f"{tmp_path}/checkpoint").awaitTermination()

    rows = fetches(5, 4, 6)
    arrive("a.json", rows[:2])
    arrive("b.json", [*rows[2:], rows[0]])  # one of them for the second time
    plain = Store(spark, f"{tmp_path}/p")
    stream.absorb(plain, frame(spark, rows), games)
    assert content(store) == content(plain)


def test_store_carries_by_path_and_changes_parts(spark, tmp_path):
    store = Store(spark, f"{tmp_path}/s")
    rows = lambda *x: spark.createDataFrame(x, "k int, v string").withColumn("part", part_of("k", parts=3))
    store.publish({"whole": spark.range(3)}, {"t": Change(rows((1, "a"), (2, "b"), (3, "c"), (4, "d")))})
    first = store.manifest()["tables"]
    part = spark.createDataFrame([(1,)], "k int").select(part_of("k", parts=3)).first()[0]
    version = store.publish(changes={"t": Change(rows((1, "z")), [part])}, marks={"m": "1"})
    second = store.manifest()
    assert second["tables"]["whole"] == first["whole"] and second["marks"] == {"m": "1"} and store.written(version) > 0
    kept = {r["k"]: r["v"] for r in store.read("t", "k int, v string").collect()}
    assert kept[1] == "z" and {k: v for k, v in kept.items() if k != 1} == {r["k"]: r["v"] for r in rows((2, "b"), (3, "c"), (4, "d")).where(F.col("part") != part).collect()}
    store.publish(changes={"t": Change(rows((9, "n")).limit(0), [part])})
    assert store.read("t", "k int, v string", [part]).count() == 0 and store.read("t", "k int, v string", ["absent"]).count() == 0
    assert "t" in store.manifest()["tables"] and store.read("none", "a int").count() == 0

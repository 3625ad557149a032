"""Contracts, budgets, pages, files."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest

from tempora.operators.quality import CRITICAL, Check, failed, run
from tempora.sources import context_csv, contracts, planner, ranking, raw
from tempora.store import Store

NOW = datetime(2026, 9, 20, 12, tzinfo=timezone.utc)


def test_contracts():
    good = {"matches": [{"id": 1, "utcDate": "2026-01-01T00:00:00Z", "status": "TIMED", "season": {"id": 2}, "homeTeam": {"id": None}, "awayTeam": {"id": 3}, "score": {"fullTime": {"home": None, "away": None}}}]}
    assert contracts.problems("matches", good) == []
    bad = {"matches": [{**good["matches"][0], "id": "1", "utcDate": "2026-01-01", "season": {}}, 5]}
    found = contracts.problems("matches", bad)
    assert any("is not int" in p for p in found) and any("is not timestamp" in p for p in found) and any("season.id missing" in p for p in found) and "matches[1] is not an object" in found
    assert contracts.problems("matches", {"matches": []}) == ["matches is empty"]
    assert contracts.problems("standings", {"season": {"id": 1}, "standings": []}) == []
    hourly = {"time": ["a", "b"], **{v: [1, 2] for v in contracts.HOURLY}}
    assert contracts.problems("forecast", {"timezone": "GMT", "hourly": hourly}) == []
    assert "values for 2 hours" in contracts.problems("forecast", {"timezone": "GMT", "hourly": {**hourly, "precipitation": [1]}})[0]
    with pytest.raises(contracts.ContractError, match=r"and 3 more"):
        contracts.require("matches", {"matches": [{}]}, "x")


def test_violations_of_stored_payloads(spark):
    table = spark.createDataFrame([(1, '{"id": 1, "name": "a"}'), (2, '{"id": "x"}'), (3, None)], "k int, payload string")
    assert sorted((r["k"], r["problem"]) for r in contracts.violations(table, "team", "k", "payload").collect()) == [(2, "id is not int: 'x'"), (2, "name missing"), (3, "payload is empty")]


@pytest.mark.parametrize(
    ("change", "fetch"),
    [({"has_key": False}, False), ({"remaining": 5}, False), ({"remaining": 5, "last_at": NOW - timedelta(days=2)}, True), ({"force": True}, True), ({"last_at": None}, True), ({"last_at": NOW - timedelta(days=1)}, True), ({}, False), ({"kickoffs": [NOW + timedelta(hours=2)]}, True), ({"kickoffs": [NOW + timedelta(hours=2)], "last_at": NOW - timedelta(minutes=5)}, False), ({"kickoffs": [NOW - timedelta(hours=1), NOW + timedelta(hours=30)]}, False)],
)
def test_budget(change, fetch):
    plain = {"now": NOW, "has_key": True, "last_at": NOW - timedelta(hours=3), "remaining": 100, "budget": planner.Budget(10, 60, 6), "kickoffs": [], "force": False}
    assert planner.plan_fetch(**{**plain, **change}).fetch is fetch


def test_retry():
    waits, tries = [], iter([OSError(), OSError(), 7])

    def call():
        x = next(tries)
        if isinstance(x, Exception):
            raise x
        return x

    assert planner.retry(call, lambda e: isinstance(e, OSError), sleep=waits.append) == 7 and waits == [1.0, 2.0]
    with pytest.raises(ValueError):
        planner.retry(lambda: int("x"), lambda e: isinstance(e, OSError), sleep=waits.append)
    assert planner.transient_status(429) and planner.transient_status(503) and not planner.transient_status(404)


def page(rows, day="1 September 2026"):
    body = "".join(f'<tr><td>{r}</td><td><a href="/clubs-ranking/{s}">{n}</a> <a href="/ranking/x">{c}</a></td><td>{p}</td></tr>' for r, s, n, c, p in rows)
    return f'<span itemprop="dateModified">{day}</span><a href="/ranking/world/63">63</a><table>{body}</table>'


def test_ranking_pages(spark):
    rows = [(1, "a", "A &amp; B", "X", "1,900"), (2, "b", "B", "Y", "1800")]
    broken = [[(2, "a", "A", "X", 1)], [(1, "a", "A", "X", 0)], [(1, "a", "A", "X", 5), (2, "a", "A", "X", 4)], [(1, "a", "", "X", 5)], [], [(1, "a", "A", "X", 5), (1, "b", "B", "X", 4)]]
    many = spark.createDataFrame([(1, page(x)) for x in broken[:1]] + [(1, page(rows, "yesterday"))], "page int, html string")
    for one in [*(spark.createDataFrame([(1, page(x))], many.schema) for x in broken), many.where("html LIKE '%yesterday%'")]:
        assert [r["error"] is not None for r in ranking.parse_pages(one).collect()] == [True]
    first = ranking.parse_pages(spark.createDataFrame([(1, page(rows))], many.schema)).orderBy("world_rank").first()
    assert first.asDict() == {"page": 1, "ranking_date": date(2026, 9, 1), "last_page": 63, "club_slug": "a", "club_name": "A & B", "country": "X", "world_rank": 1, "rating_points": 1900, "error": None}
    table = spark.createDataFrame([(1, page(rows)), (2, page(rows)), (3, None)], "page int, html string")
    out = ranking.parse_pages(table).collect()
    assert [r["page"] for r in out if r["error"] is None] == [1, 1] and sorted(r["page"] for r in out if r["error"]) == [2, 3]
    whole = [(n, page([(50 * (n - 1) + k, f"c{n}-{k}", "N", "X", 9) for k in range(1, 51)]).replace("/63", f"/{2}")) for n in (1, 2)]
    editions = [ranking.one_edition(ranking.parse_pages(spark.createDataFrame(x, "page int, html string"))).first()["complete"] for x in (whole, whole[:1], [whole[0], (2, whole[1][1].replace("1 September", "2 September"))])]
    assert editions == [True, False, False]


HEAD = "team_id,observed_at,valid_from,source,source_url,squad_size,squad_min_age,squad_max_age,coach_namespace,coach_id,coach_name"


def test_context_csv(spark, tmp_path):
    def read(*lines, head=HEAD):
        f = tmp_path / f"{abs(hash((lines, head)))}.csv"
        f.write_text("\n".join([head, *lines]) + "\n")
        return context_csv.read(spark, f"file://{f}").collect()

    good = read("1,2026-01-01T00:00:00Z,2026-01-01T00:00:00+01:00,s,u,25,18,35,ns,7,Name")
    assert good[0]["error"] is None and good[0]["coach_id"] == "ns:7" and good[0]["squad_size"] == 25
    cases = {
        "time zone": "1,2026-01-01T00:00:00,2026-01-01T00:00:00Z,s,u,25,,,,,", "required cell": "1,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,,u,25,,,,,", "positive": "0,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,s,u,25,,,,,",
        "between 10 and 70": "1,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,s,u,25,5,,,,", "exceeds": "1,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,s,u,25,30,20,,,", "without squad_size": "1,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,s,u,,30,,,,",
        "coach_namespace": "1,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,s,u,25,,,,7,Name", "is needed": "1,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,s,u,,,,,,",
    }
    for why, line in cases.items():
        assert why in read(line)[0]["error"], why
    same = "1,2026-01-01T00:00:00Z,2026-01-01T00:00:00Z,s,u,25,,,,,"
    assert [r["error"] for r in read(same, same)] == ["the snapshot occurs twice"] * 2
    with pytest.raises(ValueError, match="unknown"):
        read(same, head=HEAD + ",typo")


def test_raw_zone(spark):
    day = date(2026, 9, 20)
    row = lambda payload, at: raw.rows(spark, [("f", "e", {}, payload)], day, at, "r")
    zone, told = raw.load(spark.createDataFrame([], raw.SCHEMA), row({"b": 1, "a": 2}, NOW))
    assert [r["outcome"] for r in told.collect()] == ["INSERTED"]
    assert [r["outcome"] for r in raw.load(zone, row({"a": 2, "b": 1}, NOW))[1].collect()] == ["UNCHANGED"]
    newer, told = raw.load(zone, row({"a": 3}, NOW + timedelta(hours=1)))
    assert [r["outcome"] for r in told.collect()] == ["UPDATED"] and newer.count() == 1 and newer.first()["payload"] == '{"a":3}'


def test_store_swaps_whole_versions(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/s")
    assert store.current() is None and store.read("t", "a int").count() == 0
    store.publish({"t": spark.range(2), "u": spark.range(1)})
    store.publish({"t": spark.range(5)})
    assert store.read("t").count() == 5 and store.read("u").count() == 1


def test_checks(spark):
    from pyspark.sql import functions as F

    t = {"x": spark.range(3), "y": spark.range(0)}
    checks = [Check("some", "x", CRITICAL, F.lit(True), at_least=1), Check("none", "y", CRITICAL, F.lit(True), at_least=1), Check("small", "x", CRITICAL, F.col("id") > 1), Check("frame", "x", CRITICAL, lambda t: t["x"].where("id > 5"))]
    assert failed(run(spark, t, checks)) == ["none", "small"]

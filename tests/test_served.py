"""Ingestion in order, ranking pages of a day, reviewed names, credits, and what a viewer asks."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.functions import weather
from tempora.operators.merge import first_seen
from tempora.operators.quality import CRITICAL, WARNING, Check, failed, run
from tempora.plans import context, runs, serve
from tempora.plans.ingest import Result, SourceError, Step, ingest
from tempora.sources import contracts, crosswalk, planner, ranking
from tests.test_sources import page

UTC = timezone.utc
DAY = date(2026, 9, 20)
AT = datetime(2026, 9, 20, 6, tzinfo=UTC)


def edition(first, rows=50, day="1 September 2026", last=2):
    body = page([(50 * (first - 1) + k, f"c{first}-{k}", "N", "X", 900) for k in range(1, rows + 1)], day)
    return body.replace("/ranking/world/63", f"/ranking/world/{last}")


def fetched(spark, *pages, at=AT):
    return spark.createDataFrame([(n, html, at, f"u/{n}", "r") for n, html in pages], "page int, html string, observed_at timestamp, request_url string, run_id string")


def absorbed(spark, stored, pages, day):
    """As a run writes them."""
    kept, told = ranking.absorb(stored, pages, day)
    return spark.createDataFrame(kept.collect(), ranking.PAGES), {r["page"]: r["error"] for r in told.collect()}


def test_pages_of_a_day_are_fetched_once(spark):
    stored = spark.createDataFrame([], ranking.PAGES)
    ask = lambda s, day=DAY: sorted(r["page"] for r in ranking.to_fetch(s, day, 60).collect())
    assert ask(stored) == [1]
    stored, told = absorbed(spark, stored, fetched(spark, (1, edition(1))), DAY)
    assert ask(stored) == [2] and told == {1: None}
    stored, _ = absorbed(spark, stored, fetched(spark, (2, edition(2))), DAY)
    assert ask(stored) == [] and stored.count() == 2
    before = {(r["page"], r["observed_at"], r["run_id"]) for r in stored.collect()}
    tomorrow = DAY + timedelta(days=1)
    assert ask(stored, tomorrow) == [1]
    again, _ = absorbed(spark, stored, fetched(spark, (1, edition(1)), (2, edition(2)), at=AT + timedelta(days=1)), tomorrow)
    assert {(r["page"], r["observed_at"], r["run_id"]) for r in again.collect()} == before  # the first capture stays
    assert {r["last_checked_date"] for r in again.collect()} == {tomorrow} and ask(again, tomorrow) == []


def test_a_bad_page_refuses_what_follows_it(spark):
    stored = spark.createDataFrame([], ranking.PAGES)
    for pages, errors in (
        ([(1, edition(1)), (2, edition(2, day="2 September 2026")), (3, edition(3, last=3))], {1: None, 2: "changed", 3: "before it"}),
        ([(1, edition(1, day="21 September 2026"))], {1: "ahead"}),
        ([(1, edition(1)), (2, "<html>denied</html>"), (3, edition(3))], {1: None, 2: "date", 3: "before it"}),
    ):
        kept, got = absorbed(spark, stored, fetched(spark, *pages), DAY)
        assert got.keys() == errors.keys() and all((got[n] is None) if e is None else e in got[n] for n, e in errors.items())
        assert sorted(r["page"] for r in kept.collect()) == [n for n, e in errors.items() if e is None]
    whole = ranking.parse_pages(fetched(spark, (1, edition(1)), (2, edition(2))))
    assert ranking.one_edition(whole, "2026-09-01").first()["complete"] and not ranking.one_edition(whole, "2026-08-31").first()["complete"]


def test_first_seen_is_touched(spark):
    names = "k string, h string, checked date, seen int, v string"
    old = spark.createDataFrame([("a", "1", date(2026, 1, 1), 5, "old"), (None, "1", date(2026, 1, 1), 5, "null")], names)
    new = spark.createDataFrame([("a", "1", date(2026, 1, 3), 1, "again"), ("a", "2", date(2026, 1, 2), 8, "late"), ("a", "2", date(2026, 1, 2), 7, "early"), (None, "1", date(2025, 1, 1), 9, "x")], names)
    got = {(r["k"], r["h"]): (r["checked"].day, r["seen"], r["v"]) for r in first_seen(old, new, ["k", "h"], "checked", "seen").collect()}
    assert got == {("a", "1"): (3, 5, "old"), ("a", "2"): (2, 7, "early"), (None, "1"): (1, 5, "null")}


def test_reviewed_names(spark, tmp_path):
    def file(text):
        f = tmp_path / f"{len(list(tmp_path.iterdir()))}.csv"
        f.write_text(text, encoding="utf-8")
        return str(f)

    got = crosswalk.aliases(spark, file('﻿team_id,alias,note\n1, Ålfa ,x\n1,Ålfa,y\n2,,z\n3,"B, C",\n')).collect()
    assert {tuple(r) for r in got} == {(1, "Ålfa"), (3, "B, C")}
    good = crosswalk.reviewed(spark, file("club_slug,team_id,note\n a-b ,1,\nc,2,\n"))
    assert {tuple(r) for r in good.collect()} == {(1, "a-b"), (2, "c")}
    for text, told in (("team_id,club_slug,note\n1,a,\n1,b,\n", "so for 1"), ("team_id,club_slug,note\n1,,\n", "so for 1"), ("team_id,slug\n1,a\n", "should have"), ("team_id,club_slug,note\nx,a,\n", "not a team: x")):
        with pytest.raises(ValueError, match=told):
            crosswalk.reviewed(spark, file(text))


def test_credits_and_cadence(spark):
    assert planner.Quota.of({"X-Requests-Remaining": "12.0", "x-requests-used": "n/a"}) == planner.Quota(12, None, None)
    assert planner.Quota.of({}) == planner.Quota() and planner.Quota.of({"x-requests-last": "inf"}).last is None
    hour = lambda h: AT + timedelta(hours=h)
    rows = [("live", "a", "{}", hour(0), 90), ("live", "a", "{}", hour(1), 80), ("live", "b", "{}", hour(3), 20), ("sample", "a", "{}", hour(9), 5)]
    fetches = spark.createDataFrame(rows, "source string, endpoint string, request_params string, ingested_at timestamp, remaining long")
    state = lambda reserve: {r["endpoint"]: (r["last_at"].hour - AT.hour, r["remaining"]) for r in planner.fetch_state(fetches, "live", reserve).collect()}
    assert state(10) == {"a": (1, 20), "b": (3, 20)} and state(20) == {"a": (3, 20), "b": (3, 20)}


def test_sources_run_in_order(spark, tmp_path):
    clock, done = Clock.at("2026-09-20"), []

    def step(name, fails=None, best_effort=False):
        def read(run):
            done.append(name)
            run.add(loaded=2)
            if fails:
                raise fails
            return "2 rows"

        return Step(name, f"ingest_{name}", read, best_effort)

    log = str(tmp_path / "runs")
    steps = [step("football"), step("ranking", SourceError("layout"), True), step("odds")]
    assert ingest(spark, log, clock, steps) == [Result("football", "2 rows"), Result("ranking", "failed: layout", True), Result("odds", "2 rows")]
    states = {r["pipeline"]: (r["status"], r["rows_loaded"]) for r in runs.current(runs.read(spark, log)).collect()}
    assert states == {"ingest_football": ("SUCCESS", 2), "ingest_ranking": ("FAILED", 2), "ingest_odds": ("SUCCESS", 2)}
    done.clear()
    assert [r.name for r in ingest(spark, log, clock, steps, only="odds")] == ["odds"] and done == ["odds"]
    for broken, kind in ((step("weather", SourceError("x")), SourceError), (step("crests", KeyError("bug"), True), KeyError)):
        with pytest.raises(kind):
            ingest(spark, log, clock, [broken, steps[2]])
    assert done == ["odds", "weather", "crests"]
    with pytest.raises(ValueError, match="no source"):
        ingest(spark, log, clock, steps, only="typo")


def test_squads_all_or_nothing(spark):
    player = "array<struct<id:int,position:string,dateOfBirth:string,nationality:string>>"
    rows = [(1, None, "X"), (2, [], "X"), (3, [(1, "Goalkeeper", "2000-01-01", "X"), (1, "Goalkeeper", "2000-01-01", "X"), (2, "Left Back", "", "Y"), (None, "Winger", "1990-01-01", "X")], "X"), (4, [(1, None, "bad", ""), (2, "Striker", None, "X")], "X"), (5, [(1, "x", "2000-01-01", "X")], None)]
    df = spark.createDataFrame(rows, f"t int, squad {player}, home string").withColumn("squad", context.players(F.col("squad")))
    got = {r["t"]: r for r in df.select("t", *[c.alias(n) for n, c in context.squad_summary(F.col("squad"), F.lit("2026-01-01").cast("timestamp"), F.col("home")).items()]).collect()}
    assert all(v is None for t in (1, 2) for k, v in got[t].asDict().items() if k != "t")
    assert (got[3]["squad_size"], got[3]["squad_foreign_players"], got[3]["squad_missing_birthdates"], got[3]["squad_goalkeepers"], got[3]["squad_defenders"]) == (2, 1, 1, 1, 1)
    assert abs(got[3]["squad_avg_age"] - 26.0) < 0.01 and got[3]["squad_nationalities"] == 2
    assert (got[4]["squad_foreign_players"], got[4]["squad_avg_age"], got[4]["squad_nationalities"], got[4]["squad_unknown_positions"]) == (None, None, 1, 1)
    assert got[5]["squad_foreign_players"] is None


def test_contract_verdicts(spark):
    rows = spark.createDataFrame([("a", '{"k": 1}'), ("b", None), ("c", "{"), ("d", "[]")], "id string, p string")
    rules = [(f"f{i}", "int", False) for i in range(7)] + [("k", "int", False)]
    got = {r["id"]: (r["n_problems"], r["shown"]) for r in contracts.verdicts(rows, rules, "id", "p").collect()}
    assert got["a"] == (7, "f0 missing; f1 missing; f2 missing; f3 missing; f4 missing (and 2 more)")
    assert got["b"] == (1, "payload is empty") and got["c"] == (1, "payload is not JSON") and got["d"][0] == 8
    assert contracts.violations(rows.limit(0), rules, "id", "p").count() == 0 and contracts.violations(rows, rules, "id", "p").count() == 17


def test_checks_tell_names_in_order(spark):
    t = {"x": spark.createDataFrame([(2, "b", True), (1, "z", True), (1, "a", True), (0, "ok", False)], "at int, name string, bad boolean")}
    rules = [Check("named", "x", CRITICAL, F.col("bad"), unit=" open", names=(F.col("name"), F.col("at"))), Check("none", "x", WARNING, F.col("at") > 9, unit=" late", names=(F.col("name"), F.col("at"))), Check("counted", "x", WARNING, F.col("bad"), allowed=3, unit=" rows")]
    rules += [Check("measured", "x", CRITICAL, measure=lambda t: t["x"].agg(F.lit("fine").alias("observed"), F.lit(True).alias("passed"))), Check("unmeasured", "x", CRITICAL, measure=lambda t: t["x"].select(F.lit("x").alias("observed"), F.lit(True).alias("passed")).limit(0))]
    out = run(spark, t, rules)
    assert {r["check_name"]: (r["observed"], r["n"], r["passed"]) for r in out.collect()} == {"named": ("a; z; b (3 open)", 3, False), "none": (" (0 late)", 0, True), "counted": ("3 rows", 3, True), "measured": ("fine", None, True), "unmeasured": ("", None, False)}
    assert failed(out) == ["named", "unmeasured"]


def test_pivot_and_pages(spark, tmp_path):
    rows = spark.createDataFrame([(1, "b", 2.0), (1, "b", 4.0), (1, "a", None), (2, "c", 1.0), (3, None, 9.0)], "i int, k string, v double")
    out = serve.pivot_mean(rows, ["i"], "k", "v")
    assert out.columns == ["i", "b", "c"] and {tuple(r) for r in out.collect()} == {(1, 3.0, None), (2, None, 1.0)}
    with pytest.raises(ValueError, match="more than 1"):
        serve.pivot_mean(rows, ["i"], "k", "v", most=1)
    assert serve.pivot_mean(rows.limit(0), ["i"], "k", "v").count() == 0
    product = spark.createDataFrame([(i, AT + timedelta(hours=i), f"n{i}", "PL" if i % 2 else "CL") for i in range(7)], "match_id int, utc_kickoff timestamp, home_team_name string, competition_code string")
    assert [r["match_id"] for r in serve.page(product, 1, 2, ["PL"]).collect()] == [1] and [r["match_id"] for r in serve.page(product, 0, 9, search="N3").collect()] == [3]
    serve.page_csv(serve.page(product, 0, 3, columns=["match_id"]), f"{tmp_path}/page")
    assert [r["match_id"] for r in spark.read.csv(f"{tmp_path}/page", header=True).collect()] == ["6", "5", "4"]


def test_history_draws_the_newest_quote_on(spark):
    facts = spark.createDataFrame([(1, "B", "h2h", AT, AT, AT + timedelta(hours=1), 2.0, 4.0, 4.0, True, 0.5, 0.25, 0.25), (1, "B", "h2h", AT, AT + timedelta(hours=2), AT + timedelta(hours=5), 4.0, 4.0, 2.0, True, 0.25, 0.25, 0.5), (1, "C", "h2h", AT, AT, AT, None, 4.0, 2.0, False, None, None, None)], "match_id long, bookmaker_title string, market_key string, source_updated_at timestamp, first_seen_at timestamp, last_seen_at timestamp, home_price double, draw_price double, away_price double, is_complete boolean, home_prob_fair double, draw_prob_fair double, away_prob_fair double")
    guess = spark.createDataFrame([(1, AT, 0.4, 0.4, 0.2)], "match_id long, predicted_at timestamp, home_prob double, draw_prob double, away_prob double")
    told = lambda odds: sorted((r["series"], r["at"].hour, r["value"]) for r in serve.odds_history(facts, guess, odds).where("outcome = 'home'").collect())
    assert told(False) == [("B", 6, 50.0), ("B", 8, 25.0), ("B", 11, 25.0), ("Model", 6, 40.0)]
    assert told(True) == [("B", 6, 2.0), ("B", 8, 4.0), ("B", 11, 4.0), ("Model", 6, 2.5)]


def test_weather_in_words(spark):
    got = spark.createDataFrame([(0, "AVAILABLE"), (99, "NOT_YET_AVAILABLE"), (4, "MISSING"), (None, None)], "c int, s string").select(weather.description(F.col("c")), weather.why_absent(F.col("s"), F.lit("2026-10-20").cast("date"))).collect()
    assert [r[0] for r in got] == ["Clear sky", "Thunderstorm with heavy hail", None, None]
    assert got[0][1] is None and got[1][1].endswith("2026-10-05") and got[2][1] == weather.WHY["MISSING"] and got[3][1] is None


def test_links_by_patterns(spark):
    html = """<!-- <a href="no">x</a> --><script>var t='<a href="no">';</script><A HREF='one?x=1&amp;y=2' title="a>b">1</A><a class=x href=two>2</a><a name="n">3</a><a
      href = "three">4</a><a href="">5</a><abbr href="no"></abbr><a data-href="no" href="four">"""
    got = ranking.links(spark.createDataFrame([(1, html), (2, None), (3, "<p>")], "id long, h string"), "id", "h").orderBy("id", "pos").collect()
    assert [tuple(r) for r in got] == [(1, 0, "one?x=1&y=2"), (1, 1, "two"), (1, 2, "three"), (1, 3, "four")]

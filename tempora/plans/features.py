"""Team features of every appearance: only what was known before kick-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.operators.lookback import DAY, HOUR, look_back, micros, range_counts
from tempora.operators.sides import pivot_sides

#: A result counts as known this long after kick-off.
AVAILABLE_AFTER = 3 * HOUR


def finished() -> Column:
    return F.col("is_finished")


def scored() -> Column:
    return F.col("is_finished") & F.col("goals_for").isNotNull() & F.col("goals_against").isNotNull()


def _flag(c: Column) -> Column:
    return F.when(c, 1).otherwise(0)


def measures(names: str) -> dict[str, Column]:
    """Summands by name; every one counts or adds over eligible rows."""
    gf, ga = F.col("goals_for"), F.col("goals_against")
    every = {
        "matches": F.lit(1), "wins": _flag(gf > ga), "draws": _flag(gf == ga), "losses": _flag(gf < ga), "points": F.col("points"),
        "goals_for": gf, "goals_against": ga, "clean_sheets": _flag(ga == 0), "failed_to_score": _flag(gf == 0),
        "both_teams_scored": _flag((gf > 0) & (ga > 0)), "over_2_5": _flag(gf + ga > 2),
    }
    return {n: every[n] for n in names.split()}


def rate(total: str, count: str) -> Column:
    """Per match, 4 digits; null without a match."""
    return F.round(F.when(F.col(count) > 0, F.col(total) / F.col(count)), 4)


FORM = "matches wins draws losses points goals_for goals_against clean_sheets failed_to_score both_teams_scored over_2_5"
SCOPED = {
    "venue": (["team_id", "is_home"], "matches points wins goals_for goals_against clean_sheets"),
    "competition": (["team_id", "competition_code"], "matches points wins goals_for goals_against clean_sheets"),
    "h2h": (["team_id", "opponent_team_id"], "matches wins draws losses points goals_for goals_against"),
}


def _zero(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(0)).cast("long") for n in names})


def form(apps: DataFrame, sizes: tuple[int, ...] = (3, 5, 10), gap: int = AVAILABLE_AFTER) -> DataFrame:
    """Last-n counts, sums and rates over all of a team's results."""
    last = {n: {f"{m}_last_{n}": e for m, e in measures(FORM).items()} for n in sizes}
    out = _zero(look_back(apps, ["team_id"], "utc_kickoff", "match_id", scored(), last, gap=gap), [c for sums in last.values() for c in sums])
    for n in sizes:
        more = {f"goal_difference_last_{n}": F.col(f"goals_for_last_{n}") - F.col(f"goals_against_last_{n}")}
        more |= {f"{m}_per_match_last_{n}": rate(f"{m}_last_{n}", f"matches_last_{n}") for m in ("goals_for", "goals_against", "points")}
        out = out.withColumns(more | {f"win_rate_last_{n}": rate(f"wins_last_{n}", f"matches_last_{n}")})
    return out


def scoped_form(apps: DataFrame, scope: str, n: int = 5) -> DataFrame:
    """The same within a venue side, a competition, or against the opponent."""
    keys, names = SCOPED[scope]
    last = {n: {f"{scope}_{m}_last_{n}": e for m, e in measures(names).items()}}
    out = _zero(look_back(apps, keys, "utc_kickoff", "match_id", scored(), last, gap=AVAILABLE_AFTER), list(last[n]))
    return out.withColumn(f"{scope}_points_per_match_last_{n}", rate(f"{scope}_points_last_{n}", f"{scope}_matches_last_{n}"))


SEASON = "matches wins draws losses points goals_for goals_against"


def season_to_date(apps: DataFrame) -> DataFrame:
    """Totals of the season as they stood after the newest known result.

    Totals include results at the same kick-off as that one, as a running total over peers does.
    """
    keys = ["team_id", "competition_code", "season_id"]
    peers = Window.partitionBy(*keys).orderBy(micros("utc_kickoff")).rangeBetween(Window.unboundedPreceding, 0)
    run = {f"_run_{m}": F.sum(F.when(scored(), e)).over(peers) for m, e in measures(SEASON).items()}
    keep = {f"season_{m}": f"_run_{m}" for m in SEASON.split()}
    out = look_back(apps.withColumns(run), keys, "utc_kickoff", "match_id", scored(), {}, keep, AVAILABLE_AFTER).drop(*run)
    out = _zero(out, list(keep))
    return out.withColumns({"season_goal_difference": F.col("season_goals_for") - F.col("season_goals_against"), "season_points_per_match": rate("season_points", "season_matches")})


def history(apps: DataFrame) -> DataFrame:
    """Finished matches before, the first and the newest of them, and days of rest."""
    peers = Window.partitionBy("team_id").orderBy(micros("utc_kickoff")).rangeBetween(Window.unboundedPreceding, 0)
    run = apps.withColumns({"_n": F.sum(_flag(finished())).over(peers), "_first": F.min(F.when(finished(), F.col("utc_kickoff"))).over(peers), "_at": F.col("utc_kickoff")})
    keep = {"history_matches": "_n", "history_first_kickoff": "_first", "history_last_kickoff": "_at"}
    out = look_back(run, ["team_id"], "utc_kickoff", "match_id", finished(), {}, keep, AVAILABLE_AFTER).drop("_n", "_first", "_at")
    rest = (micros("utc_kickoff") - micros("history_last_kickoff")).cast("decimal(20,0)") / F.lit(DAY)
    return _zero(out, ["history_matches"]).withColumns({"history_last_available_at": F.col("history_last_kickoff") + F.expr("INTERVAL '3' HOUR"), "rest_days": F.round(rest, 3).cast("decimal(12,3)")})


def load(apps: DataFrame) -> DataFrame:
    """Finished matches in the last 7, 14 and 30 days, with goals or without."""
    return range_counts(apps, ["team_id"], "utc_kickoff", finished(), {f"played_last_{d}_days": d * DAY for d in (7, 14, 30)}, AVAILABLE_AFTER)


#: Appearances that one task widens by all families, and that one task pairs by match. A team isn't divided.
TEAM_ROWS, MATCH_ROWS = 40_000, 100_000


def tasks(rows: int, each: int) -> int:
    return max(1, -(-rows // each))


def team_features(apps: DataFrame) -> DataFrame:
    """All 87 columns of every appearance. Each family widens the rows by windows; every scope has the team, so
    that one shuffle by team serves all of them.

    Rows are narrow while they travel and a hundred times as wide in the sorts behind it. So their number sets the
    number of tasks, each a range of teams: it grows with the table, and what a task sorts doesn't.
    """
    out = form(load(history(apps.repartitionByRange(tasks(apps.count(), TEAM_ROWS), "team_id"))))
    for scope in SCOPED:
        out = scoped_form(out, scope)
    return season_to_date(out)


KEYS = ("match_id", "utc_kickoff", "competition_code", "season_id", "is_finished", "team_id", "opponent_team_id", "is_home", "goals_for", "goals_against", "points")


def legacy_form(apps: DataFrame) -> DataFrame:
    """The older last-5 form: strictly before kick-off, whole days of rest."""
    last = {5: {m: e for m, e in {"matches_considered": F.lit(1), **{f"{k}_last_5": v for k, v in measures("wins draws losses").items()}, "goals_scored_last_5": F.col("goals_for"), "goals_conceded_last_5": F.col("goals_against")}.items()}}
    out = look_back(apps.withColumn("_at", F.col("utc_kickoff")), ["team_id"], "utc_kickoff", "match_id", scored(), last, {"_last": "_at"})
    out = _zero(out, list(last[5]))
    days = F.floor((micros("utc_kickoff") - micros("_last")) / DAY).cast("int")
    return out.withColumns({"goal_difference_last_5": F.col("goals_scored_last_5") - F.col("goals_conceded_last_5"), "points_last_5": F.col("wins_last_5") * 3 + F.col("draws_last_5"), "days_since_last_match": days}).drop("_at", "_last")


def product(games: DataFrame, features: DataFrame) -> DataFrame:
    """One row a match: home_ and away_ features, differences, completeness flags and labels."""
    columns = [c for c in features.columns if c not in KEYS]
    wide = pivot_sides(games, features, "match_id", "is_home", columns, tasks(2 * games.count(), MATCH_ROWS))
    known = F.col("is_finished") & F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()
    outcome = F.when(F.col("home_goals") > F.col("away_goals"), "HOME_WIN").when(F.col("home_goals") < F.col("away_goals"), "AWAY_WIN").otherwise("DRAW")
    minus = lambda c: F.col(f"home_{c}") - F.col(f"away_{c}")
    made = {
        "match_date": F.to_date("utc_kickoff"), "kickoff_year": F.year("utc_kickoff"), "kickoff_month": F.month("utc_kickoff"),
        "kickoff_day_of_week": F.expr("extract(DAYOFWEEK_ISO FROM utc_kickoff)"), "kickoff_hour_utc": F.hour("utc_kickoff"),
        "label_outcome_90min": F.when(known, outcome), "label_home_goals_90min": F.when(F.col("is_finished"), F.col("home_goals")),
        "label_away_goals_90min": F.when(F.col("is_finished"), F.col("away_goals")), "label_available": known,
        "points_difference_last_5": minus("points_last_5"), "points_difference_last_10": minus("points_last_10"),
        "goals_for_difference_last_5": minus("goals_for_last_5"), "goals_against_difference_last_5": minus("goals_against_last_5"),
        "goal_difference_difference_last_10": minus("goal_difference_last_10"), "rest_days_difference": minus("rest_days"),
        "season_points_per_match_difference": minus("season_points_per_match"),
        "has_full_history_last_10": (F.col("home_matches_last_10") == 10) & (F.col("away_matches_last_10") == 10),
        "home_has_no_prior_results": F.col("home_matches_last_10") == 0, "away_has_no_prior_results": F.col("away_matches_last_10") == 0,
    }
    return wide.withColumns(made)

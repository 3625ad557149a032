"""Poisson forecast from recent form, shrunk towards the league's mean before kick-off."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.operators.lookback import totals_before

#: Prior goals of home and away side, weight of the prior in matches, shrinkage of a team's form
#: in matches, most goals of the grid, bounds of the rates.
PRIOR_HOME, PRIOR_AWAY, PRIOR_WEIGHT, SHRINK, MOST, LOW, HIGH = 1.55, 1.25, 20, 3, 10, 0.2, 6.0
MODEL = "form-poisson-v1"


def league_before(games: DataFrame) -> DataFrame:
    """Matches and goals of all finished matches strictly before kick-off, and the smoothed means."""
    known = F.col("is_finished") & F.col("home_goals").isNotNull() & F.col("away_goals").isNotNull()
    out = totals_before(games, "utc_kickoff", known, {"league_matches_considered": F.lit(1), "_h": F.col("home_goals"), "_a": F.col("away_goals")})
    n = F.col("league_matches_considered") + PRIOR_WEIGHT
    return out.withColumns({"mu_home": (F.col("_h") + PRIOR_WEIGHT * PRIOR_HOME) / n, "mu_away": (F.col("_a") + PRIOR_WEIGHT * PRIOR_AWAY) / n})


def scores(rate: Column, most: int = MOST) -> Column:
    """Poisson probabilities of 0 to `most` goals, each written out, so that they are compiled arithmetic."""
    return F.array(*[F.exp(-rate) * F.pow(rate, F.lit(g)) / F.lit(float(math.factorial(g))) for g in range(most + 1)])


def outcome_probabilities(home: str, away: str, most: int = MOST) -> Column:
    """struct<home, draw, away> of two independent scores, normalised; home and away are columns of scores().

    The sums over the grid are written out: nothing is multiplied or grouped, and no array function is interpreted.
    """
    h, a = ([F.get(F.col(c), F.lit(g)) for g in range(most + 1)] for c in (home, away))
    total = lambda terms: reduce(Column.__add__, terms)
    win, draw, loss = (total([h[i] * a[j] for i in range(most + 1) for j in range(most + 1) if (i > j) - (i < j) == sign]) for sign in (1, 0, -1))
    every = total(h) * total(a)
    return F.struct((win / every).alias("home"), (draw / every).alias("draw"), (loss / every).alias("away"))


def forecast(games: DataFrame, form: DataFrame) -> DataFrame:
    """Probabilities (5 digits) and expected goals (3 digits) of every match with form on both sides.

    form: match_id, is_home, matches_considered, goals_scored_last_5, goals_conceded_last_5. Both sides of a match
    meet in one aggregation, so that form is worked out once.
    """
    of = F.struct(F.col("matches_considered").alias("n"), F.col("goals_scored_last_5").alias("for"), F.col("goals_conceded_last_5").alias("against"))
    sides = form.groupBy(F.col("match_id").alias("f_id")).agg(F.any_value(F.when(F.col("is_home"), of), True).alias("h"), F.any_value(F.when(~F.col("is_home"), of), True).alias("a"))
    named = sides.where("h IS NOT NULL AND a IS NOT NULL").select("f_id", *[F.col(f"{p}.{c}").alias(f"{p}_{c}") for p in "ha" for c in ("n", "for", "against")])
    both = league_before(games).join(named, F.col("match_id") == F.col("f_id"))
    mean = (F.col("mu_home") + F.col("mu_away")) / 2
    strength = lambda goals, n: (F.col(goals) + SHRINK * mean) / ((F.col(n) + SHRINK) * mean)
    clamp = lambda c: F.least(F.greatest(c, F.lit(LOW)), F.lit(HIGH))
    rates = both.withColumns({"lambda_home": clamp(F.col("mu_home") * strength("h_for", "h_n") * strength("a_against", "a_n")), "lambda_away": clamp(F.col("mu_away") * strength("a_for", "a_n") * strength("h_against", "h_n"))})
    goals = rates.withColumns({"_ph": scores(F.col("lambda_home")), "_pa": scores(F.col("lambda_away"))})
    p = goals.withColumn("p", outcome_probabilities("_ph", "_pa"))
    return p.select(
        "match_id", F.round("p.home", 5).alias("home_prob"), F.round("p.draw", 5).alias("draw_prob"), F.round("p.away", 5).alias("away_prob"),
        F.round("lambda_home", 3).alias("expected_home_goals"), F.round("lambda_away", 3).alias("expected_away_goals"),
        F.col("h_n").alias("home_matches_considered"), F.col("a_n").alias("away_matches_considered"), "league_matches_considered",
    )

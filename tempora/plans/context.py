"""Squads, coaches and valuations as they were known at kick-off."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.operators.asof import as_of_valid, first_of_current_value
from tempora.operators.latest import keep_latest, newest
from tempora.operators.lookback import HOUR, before
from tempora.plans.staging import seasonal, team_elements
from tempora.sources.context_csv import AGES, COUNTS

YEAR = 365.2425
COACH = ["coach_id", "coach_name", "coach_birth_date", "coach_nationality", "coach_tenure_start"]
#: Position patterns, the first that matches decides.
POSITIONS = [("keeper", "GK"), ("defen|defence|back", "DF"), ("midfield", "MF"), ("offen|offence|attack|forward|wing|striker", "FW")]
ROLE_COUNTS = {"GK": "squad_goalkeepers", "DF": "squad_defenders", "MF": "squad_midfielders", "FW": "squad_attackers", "UNKNOWN": "squad_unknown_positions"}
SNAPSHOT = ["snapshot_id", "team_id", "source", "source_url", "observed_at", "valid_from", "valid_until", *COUNTS, *AGES, *COACH, "coach_contract_start", "squad_market_value_eur"]


def role_of(position: Column) -> Column:
    out = None
    for pattern, role in POSITIONS:
        hit = F.lower(position).rlike(pattern)
        out = F.when(hit, role) if out is None else out.when(hit, role)
    return out.otherwise("UNKNOWN")


def players(squad: Column) -> Column:
    """Players with an id, one each: the first by its canonical JSON, which is written only where an id is repeated."""
    known = F.filter(F.coalesce(squad, F.array()), lambda p: p["id"].isNotNull())
    ordered = F.array_sort(F.transform(known, lambda p: F.struct(p["id"].alias("id"), F.to_json(p).alias("text"), p.alias("p"))))
    firsts = F.filter(ordered, lambda x, i: (i == 0) | (F.try_element_at(ordered, i)["id"] != x["id"]))
    single = F.array_sort(F.transform(known, lambda p: F.struct(p["id"].alias("id"), p.alias("p"))))
    repeated = F.size(F.array_distinct(F.transform(known, lambda p: p["id"]))) < F.size(known)
    return F.when(repeated, F.transform(firsts, lambda x: x["p"])).otherwise(F.transform(single, lambda x: x["p"]))


def squad_summary(squad: Column, observed: Column, home: Column) -> dict[str, Column]:
    """Aggregates of a squad as it was observed, by name, without a join or an explode.

    A count is null where there is no squad at all, ages where no birth date is known. Foreign players are counted
    only where the nationality of all, and the club's own country, are known: a part of them would mislead.
    """
    told = squad_told(squad, observed, home)
    return {n: told[n] for n in ("squad_size", "squad_avg_age", "squad_min_age", "squad_max_age", "squad_nationalities", "squad_foreign_players", "squad_missing_birthdates", *ROLE_COUNTS.values())}


def squad_told(squad: Column, observed: Column, home: Column) -> Column:
    """squad_summary as one struct: ages, nations and roles are worked out once for all that is counted in them."""
    filled = lambda field: F.filter(F.transform(squad, lambda p: F.nullif(p[field], F.lit(""))), lambda x: x.isNotNull())
    born = F.filter(F.transform(filled("dateOfBirth"), lambda d: d.try_cast("date")), lambda d: d.isNotNull())
    ages = F.transform(born, lambda d: F.datediff(F.to_date(observed), d) / YEAR)
    made = F.struct(F.size(squad).alias("size"), ages.alias("ages"), filled("nationality").alias("nations"), F.transform(squad, lambda p: role_of(p["position"])).alias("roles"))

    def told(s: Column) -> Column:
        count = lambda c: F.when(s["size"] > 0, c).cast("int")
        out = {
            "squad_size": count(s["size"]), "squad_avg_age": F.aggregate(s["ages"], F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size(s["ages"]), F.lit(0)), "squad_min_age": F.array_min(s["ages"]), "squad_max_age": F.array_max(s["ages"]),
            "squad_nationalities": F.nullif(F.size(F.array_distinct(s["nations"])), F.lit(0)),
            "squad_foreign_players": F.when((s["size"] > 0) & (F.size(s["nations"]) == s["size"]) & home.isNotNull(), F.size(F.filter(s["nations"], lambda n: n != home))),
            "squad_missing_birthdates": count(s["size"] - F.size(s["ages"])), **{name: count(F.size(_equal(s["roles"], role))) for role, name in ROLE_COUNTS.items()},
        }
        return F.struct(*[c.alias(n) for n, c in out.items()])

    return F.get(F.transform(F.array(made), told), F.lit(0))


def api_snapshots(raw: DataFrame, runs: DataFrame, clock: Clock) -> DataFrame:
    """A snapshot of every team of every answer that isn't by season.

    It counts as observed when its run had ended, not when the answer came. raw has raw_id; runs: run_id,
    finished_at.
    """
    found = raw.where((F.col("ingestion_date") <= clock.today()) & F.col("endpoint").rlike(r"^(competitions/[^/]+/teams|teams/[0-9]+)$") & ~seasonal())
    timed = found.join(runs.select("run_id", "finished_at"), "run_id", "left").withColumn("observed_at", F.greatest("ingested_at", "finished_at"))
    rows = team_elements(timed).where("t.id IS NOT NULL").withColumn("squad", players(F.col("t.squad")))
    rows = rows.withColumn("told", squad_told(F.col("squad"), F.col("observed_at"), F.col("t.area.name")))
    coach = F.col("t.coach")
    made = {
        "snapshot_id": F.concat_ws(":", F.lit("football"), F.col("raw_id").cast("string"), F.col("t.id").cast("string")), "team_id": F.col("t.id"), "source_url": F.col("request_url"),
        "valid_from": F.col("observed_at"), "valid_until": F.lit(None).cast("timestamp"), **{c: F.col(f"told.{c}") for c in [*COUNTS, *AGES]},
        "coach_id": F.when(coach["id"].isNotNull(), F.concat(F.lit("football-data.org:"), coach["id"].cast("string"))), "coach_name": coach["name"],
        "coach_birth_date": F.nullif(coach["dateOfBirth"], F.lit("")).try_cast("date"), "coach_nationality": coach["nationality"], "coach_tenure_start": F.lit(None).cast("date"),
        "coach_contract_start": coach["contract"]["start"], "squad_market_value_eur": F.lit(None).cast("double"),
    }
    return rows.withColumns(made).select(SNAPSHOT)


def _equal(values: Column, wanted: str) -> Column:
    return F.filter(values, lambda v: v == wanted)


def csv_snapshots(imports: DataFrame) -> DataFrame:
    """Imported rows (with ingested_at and import_id); the newest import of a snapshot counts."""
    one = keep_latest(imports, ["team_id", "source", "observed_at", "valid_from"], newest("ingested_at", "import_id"))
    key = F.concat(F.lit("csv:"), F.md5(F.concat_ws("|", F.col("team_id").cast("string"), "source", F.col("observed_at").cast("string"), F.col("valid_from").cast("string"))))
    return one.withColumns({"snapshot_id": key, "coach_contract_start": F.lit(None).cast("string")}).select(SNAPSHOT)


def player_snapshots(raw: DataFrame, snapshots: DataFrame) -> DataFrame:
    """One row per player and snapshot, for later research."""
    rows = team_elements(raw.where(~seasonal())).where("t.id IS NOT NULL")
    named = rows.select(F.concat_ws(":", F.lit("football"), F.col("raw_id").cast("string"), F.col("t.id").cast("string")).alias("snapshot_id"), F.explode(players(F.col("t.squad"))).alias("p"))
    kept = named.join(snapshots.select("snapshot_id"), "snapshot_id", "left_semi")
    return kept.select("snapshot_id", F.col("p.id").alias("player_id"), F.col("p.name").alias("player_name"), F.col("p.position").alias("position"), F.nullif("p.dateOfBirth", F.lit("")).try_cast("date").alias("birth_date"), F.col("p.nationality").alias("nationality"), F.col("p.shirtNumber").alias("shirt_number"))


def _known(apps: DataFrame, snapshots: DataFrame, needs: str, take: dict[str, str]) -> DataFrame:
    """apps with the newest valid snapshot in which `needs` is filled; take: snapshot column -> output column."""
    own = snapshots.where(F.col(needs).isNotNull()).select("team_id", F.col("observed_at").alias("_observed"), F.col("valid_from").alias("_from"), F.col("valid_until").alias("_until"), F.col("snapshot_id").alias("_id"), *[F.col(c).alias(n) for c, n in take.items()])
    return as_of_valid(apps, own, ["team_id"], ["match_id", "team_id"], "utc_kickoff", "_observed", "_until", list(take.values()), ["_id"], "_from")


def team_context(apps: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Squad, coach and valuation, each by its own newest valid snapshot; ages moved on to kick-off.

    apps: match_id, team_id, utc_kickoff, is_finished, points. The coach's record counts results that were
    known three hours before kick-off, at any club; unknown coaches are left out before the window.
    """
    squad = {c: c for c in [*COUNTS, *AGES]} | {"source": "squad_source", "observed_at": "squad_observed_at"}
    coach = {c: c for c in COACH} | {"source": "coach_source", "observed_at": "coach_observed_at"}
    value = {"squad_market_value_eur": "squad_market_value_eur", "source": "market_value_source", "observed_at": "market_value_observed_at"}
    out = _known(_known(_known(apps, snapshots, "squad_size", squad), snapshots, "coach_id", coach), snapshots, "squad_market_value_eur", value)
    out = first_of_current_value(out, snapshots, ["team_id"], ["match_id", "team_id"], "utc_kickoff", "coach_observed_at", "coach_id", "observed_at", "valid_from", "coach_first_observed_at")
    day = F.to_date("utc_kickoff")
    micros = lambda c: F.unix_micros(F.col(c))
    observed = F.greatest("squad_observed_at", "coach_observed_at", "market_value_observed_at")
    aged = {c: F.col(c) + (micros("utc_kickoff") - micros("squad_observed_at")) / (24 * HOUR * YEAR) for c in AGES}
    made = aged | {
        "context_observed_at": observed, "context_source": F.nullif(F.concat_ws("; ", "squad_source", "coach_source", "market_value_source"), F.lit("")),
        "context_age_days": (micros("utc_kickoff") - F.unix_micros(observed)) / (24 * HOUR), "coach_age": F.datediff(day, "coach_birth_date") / YEAR,
        "coach_tenure_days": F.when(F.col("coach_tenure_start") <= day, F.datediff(day, "coach_tenure_start")),
        "coach_observed_tenure_days": F.datediff(day, F.to_date("coach_first_observed_at")),
    }
    out = out.withColumns(made)
    prior = before(["coach_id"], "utc_kickoff", 3 * HOUR)
    counted = F.col("is_finished") & F.col("points").isNotNull()
    record = out.where("coach_id IS NOT NULL").select(
        "match_id", "team_id", F.coalesce(F.sum(F.when(counted, 1)).over(prior), F.lit(0)).alias("coach_prior_matches"),
        F.avg(F.when(counted, F.when(F.col("points") == 3, 1.0).otherwise(0.0))).over(prior).alias("coach_prior_win_rate"), F.avg(F.when(counted, F.col("points"))).over(prior).alias("coach_prior_points_per_match"),
    )
    return out.join(record, ["match_id", "team_id"], "left").drop("coach_birth_date", "coach_tenure_start", "coach_first_observed_at")

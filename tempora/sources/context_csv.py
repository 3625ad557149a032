"""Dated team context from CSV: every rule is a column, every broken rule is reported with its line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The columns by kind.
REQUIRED = ["team_id", "observed_at", "valid_from", "source", "source_url"]
POSITIONS = ["squad_goalkeepers", "squad_defenders", "squad_midfielders", "squad_attackers", "squad_unknown_positions"]
COUNTS = ["squad_size", "squad_nationalities", "squad_foreign_players", *POSITIONS, "squad_missing_birthdates"]
AGES = ["squad_min_age", "squad_avg_age", "squad_max_age"]
COACH = ["coach_namespace", "coach_id", "coach_name", "coach_nationality", "coach_birth_date", "coach_tenure_start"]
OPTIONAL = [*COUNTS, *AGES, *COACH, "valid_until", "squad_market_value_eur"]
ZONED = r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(:\d\d(\.\d+)?)?(Z|[+-]\d\d:?\d\d)$"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Typed rows with `line` and `error`, null where the row is good. A wrong header is refused at once."""
    lines = spark.read.text(path)
    header = lines.first()["value"].lstrip("\ufeff").split(",")
    if len(set(header)) < len(header):
        raise ValueError("a column occurs twice")
    if (missing := set(REQUIRED) - set(header)) or (unknown := set(header) - set(REQUIRED) - set(OPTIONAL)):
        raise ValueError(f"columns missing {sorted(missing)}, unknown {sorted(set() if missing else unknown)}")
    schema = ", ".join(f"{c} string" for c in header) + ", _bad string"
    raw = spark.read.csv(path, header=True, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord="_bad", enforceSchema=True)
    raw = raw.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in header}).withColumns({c: F.lit(None).cast("string") for c in OPTIONAL if c not in header})
    typed = raw.withColumns(
        {"_team": F.col("team_id").try_cast("long"), **{f"_{c}": F.col(c).try_cast("timestamp") for c in ("observed_at", "valid_from", "valid_until")}, **{f"_{c}": F.col(c).try_cast("int") for c in COUNTS}, **{f"_{c}": F.col(c).try_cast("double") for c in [*AGES, "squad_market_value_eur"]}, **{f"_{c}": F.col(c).try_cast("date") for c in ("coach_birth_date", "coach_tenure_start")}}
    )
    same = Window.partitionBy("_team", "source", "_observed_at", "_valid_from")
    checked = typed.withColumn("_times", F.count("*").over(same)).withColumn("error", _error())
    out = {"team_id": F.col("_team"), "coach_id": F.when(F.col("coach_id").isNotNull(), F.concat("coach_namespace", F.lit(":"), "coach_id"))}
    out |= {c: F.col(f"_{c}") for c in ["observed_at", "valid_from", "valid_until", *COUNTS, *AGES, "squad_market_value_eur", "coach_birth_date", "coach_tenure_start"]}
    return checked.select(*[out.get(c, F.col(c)).alias(c) for c in [*REQUIRED, *OPTIONAL] if c != "coach_namespace"], "error")


def _error() -> Column:
    c = F.col
    wrong = lambda x: c(x).isNotNull() & c(f"_{x}").isNull()
    zoned = lambda x: c(x).isNotNull() & (~c(x).rlike(ZONED) | c(f"_{x}").isNull())
    some = lambda xs: F.coalesce(*[c(x) for x in xs]).isNotNull()
    total = sum((F.coalesce(c(f"_{x}"), F.lit(0)) for x in POSITIONS), F.lit(0))
    rules: list[tuple[Column, str]] = [
        (c("_bad").isNotNull(), "more or fewer cells than columns"),
        (F.greatest(*[c(x).isNull() for x in REQUIRED]), "a required cell is empty"),
        (c("_team").isNull() | (c("_team") <= 0), "team_id must be positive"),
        *[(zoned(x), f"{x} requires a time zone") for x in ("observed_at", "valid_from", "valid_until")],
        (c("_valid_until") <= c("_valid_from"), "valid_until must be later than valid_from"),
        *[(wrong(x) | (c(f"_{x}") < 0), f"{x} must be a whole number, 0 or more") for x in COUNTS],
        *[(wrong(x) | ~c(f"_{x}").between(10, 70), f"{x} must be between 10 and 70") for x in AGES],
        (wrong("squad_market_value_eur") | (c("_squad_market_value_eur") < 0) | F.isnan("_squad_market_value_eur") | (c("_squad_market_value_eur") == float("inf")), "squad_market_value_eur must be finite, 0 or more"),
        (c("_squad_size") == 0, "squad_size must be positive"),
        (F.greatest(*[F.coalesce(c(f"_{x}"), F.lit(0)) for x in COUNTS]) > c("_squad_size"), "a count exceeds squad_size"),
        (total > c("_squad_size"), "players by position are more than squad_size"),
        (c("squad_size").isNull() & some(COUNTS + AGES), "squad figures without squad_size"),
        *[(c(f"_{a}") > c(f"_{b}"), f"{a} exceeds {b}") for a, b in (("squad_min_age", "squad_avg_age"), ("squad_avg_age", "squad_max_age"), ("squad_min_age", "squad_max_age"))],
        *[(wrong(x), f"{x} is not a date") for x in ("coach_birth_date", "coach_tenure_start")],
        (c("coach_id").isNotNull() & (c("coach_namespace").isNull() | c("coach_name").isNull()), "coach_id requires coach_namespace and coach_name"),
        (c("coach_id").isNull() & some(COACH), "coach details require coach_id"),
        (~some(["squad_size", "coach_id", "squad_market_value_eur"]), "a squad, a coach or a valuation is needed"),
        (c("_times") > 1, "the snapshot occurs twice"),
    ]
    return F.coalesce(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(why)) for rule, why in rules])


def load(spark: SparkSession, path: str) -> DataFrame:
    """The rows, all or nothing: one bad row refuses the file."""
    rows = read(spark, path)
    bad = rows.where("error IS NOT NULL").select("team_id", "error").limit(5).collect()
    if bad:
        raise ValueError("; ".join(f"team {r['team_id']}: {r['error']}" for r in bad))
    return rows.drop("error")

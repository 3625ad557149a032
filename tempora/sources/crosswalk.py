"""Reviewed names from CSV: a club's other spellings, and its page in the ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ALIASES, REVIEWED = ["team_id", "alias", "note"], ["team_id", "club_slug", "note"]


def _rows(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Typed rows of a file with just these columns, blanks at the ends gone, empty cells null."""
    header = spark.read.option("header", True).csv(path).columns
    if sorted(c.strip("﻿ ") for c in header) != sorted(columns):
        raise ValueError(f"{path} should have the columns {', '.join(columns)}")
    raw = spark.read.csv(path, header=True, schema=", ".join(f"{c.strip(chr(0xFEFF) + ' ')} string" for c in header), escape='"', enforceSchema=True)
    text = raw.select(*[F.nullif(F.trim(c), F.lit("")).alias(c) for c in columns])
    typed = text.withColumn("_id", F.col("team_id").try_cast("long"))
    bad = [r["team_id"] for r in typed.where("_id IS NULL OR _id <= 0").select("team_id").limit(5).collect()]
    if bad:
        raise ValueError(f"{path}: not a team: {', '.join(map(str, bad))}")
    return typed.withColumn("team_id", F.col("_id")).drop("_id")


def aliases(spark: SparkSession, path: str) -> DataFrame:
    """team_id, alias; rows without an alias are left out, repeats are one."""
    return _rows(spark, path, ALIASES).where("alias IS NOT NULL").select("team_id", "alias").distinct()


def reviewed(spark: SparkSession, path: str) -> DataFrame:
    """team_id, club_slug. A team that occurs twice, and a row without a slug, refuse the file."""
    rows = _rows(spark, path, REVIEWED)
    bad = rows.groupBy("team_id").agg(F.count("club_slug").alias("n"), F.count("*").alias("m")).where("n <> 1 OR m <> 1").orderBy("team_id").limit(5).collect()
    if bad:
        raise ValueError(f"{path}: one slug a team, not so for " + ", ".join(str(r["team_id"]) for r in bad))
    return rows.select("team_id", "club_slug")

"""A dataset version: data, manifest, dictionary and coverage, published at once and never overwritten."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import xor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Names that identify a row, and words that mark a column as audit.
IDENTIFIERS = {"match_id", "season_id", "utc_kickoff", "match_date", "home_team_id", "away_team_id", "home_team_name", "away_team_name"}
AUDIT_WORDS = ("observed_at", "ingested_at", "computed_at", "updated_at", "fetched_at", "available_at", "source", "status", "cutoff", "provenance", "snapshot", "latest_history", "max_history", "label_available", "is_finished", "is_upcoming")


def column_role(name: str) -> str:
    """label, identifier, audit or feature; only features may reach a model."""
    rules = (
        ("label", name.startswith("label_")),
        ("identifier", name in IDENTIFIERS or name.endswith(("_id", "_name"))),
        ("audit", name.startswith("audit_") or name.endswith("_at") or any(w in name for w in AUDIT_WORDS)),
    )
    return next((role for role, holds in rules if holds), "feature")


def coverage(df: DataFrame) -> DataFrame:
    """column_name, role, n_null, n_rows of every column, by one aggregation."""
    counted = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(column_role(c)).alias("role"), F.col(c).alias("n_null"), F.col("_n").alias("n_rows")) for c in df.columns])
    return counted.select(F.inline(rows))


def describe(df: DataFrame, comments: Mapping[str, str]) -> DataFrame:
    """df with comments on its columns, which Parquet keeps with the schema."""
    return df.select(*[F.col(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]}) if c in comments else F.col(c) for c in df.columns])


def dictionary(df: DataFrame) -> list[tuple[str, str, str, str]]:
    """(column_name, type, role, description) in order; a column without a comment is told by its name."""
    return [(f.name, f.dataType.simpleString(), column_role(f.name), f.metadata.get("comment") or f.name.replace("_", " ")) for f in df.schema]


def _as_text(df: DataFrame, columns: Sequence[str]) -> Column:
    """What a row says in a CSV file, hashed; an empty text and a null are one there."""
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


CSV = {"header": True, "escape": '"', "multiLine": True}


def file_digests(spark: SparkSession, folder: str, columns: Sequence[str]) -> DataFrame:
    """file, rows, xxhash64 (of all rows, in any order) of every data file of an export, read back."""
    rows = spark.read.options(**CSV).schema(", ".join(f"`{c}` string" for c in columns)).csv(folder)
    named = rows.withColumn("_file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    return named.groupBy(F.col("_file").alias("file")).agg(F.count("*").alias("rows"), F.bit_xor(_as_text(named, columns)).alias("xxhash64"))


def export(df: DataFrame, target: str, order: list[str], version: str, single_file: bool = False) -> dict:
    """Write df to the new folder `target`: data as gzipped CSV in total order, dictionary, coverage, manifest.

    The data are sorted by range: every file is a range of `order`, file names follow it, and the manifest has each
    file's rows and digest, in order. Everything is written beside the target, read back, compared with
    what was to be written, and renamed at the end; an existing target is refused. single_file sends all rows
    through one task, for readers of a dataset of a few thousand rows.
    """
    spark = df.sparkSession
    jvm = spark._jvm
    final, temporary = jvm.org.apache.hadoop.fs.Path(target), jvm.org.apache.hadoop.fs.Path(target.rstrip("/") + ".tmp")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(final):
        raise FileExistsError(target)
    fs.delete(temporary, True)
    base = temporary.toString()
    df.write.parquet(f"{base}/snapshot")
    fixed = spark.read.schema(df.schema).parquet(f"{base}/snapshot")
    text = fixed.select(*[F.col(c).cast("string").alias(c) for c in fixed.columns], *[F.col(c).alias(f"_by{i}") for i, c in enumerate(order)])
    ordered = text.orderBy(*[f"_by{i}" for i in range(len(order))]).select(*fixed.columns)
    (ordered.coalesce(1) if single_file else ordered).write.options(header=True, escape='"', compression="gzip").csv(f"{base}/data")
    coverage(fixed).coalesce(1).write.option("header", True).csv(f"{base}/coverage")
    told = spark.createDataFrame(dictionary(df), "column_name string, type string, role string, description string")
    told.coalesce(1).write.options(header=True, escape='"').csv(f"{base}/dictionary")
    digest = fixed.agg(F.count("*").alias("n"), F.bit_xor(_as_text(fixed, fixed.columns)).alias("x")).first()
    files = [r.asDict() for r in file_digests(spark, f"{base}/data", fixed.columns).orderBy("file").collect()]  # one row a file
    manifest = {"version": version, "rows": digest["n"], "columns": len(fixed.columns), "content_xxhash64": digest["x"], "order": order, "files": files, "roles": {c: column_role(c) for c in fixed.columns}}
    if problems := differences(manifest):
        raise OSError("what was written reads back otherwise: " + "; ".join(problems))
    spark.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "value string").coalesce(1).write.text(f"{base}/manifest")
    fs.delete(jvm.org.apache.hadoop.fs.Path(f"{base}/snapshot"), True)
    if not fs.rename(temporary, final):
        raise OSError(f"{target} can't be published")
    return manifest


def differences(manifest: dict, files: Sequence[dict] | None = None) -> list[str]:
    """Where files - those of the manifest, or others that were found - don't add up to the manifest."""
    found = manifest["files"] if files is None else files
    known = {f["file"]: f for f in manifest["files"]}
    out = [f"{f['file']} differs" for f in found if known.get(f["file"]) != f] + [f"{n} is missing" for n in sorted(known.keys() - {f["file"] for f in found})]
    if sum(f["rows"] for f in found) != manifest["rows"]:
        out.append("rows")
    if reduce(xor, (f["xxhash64"] for f in found), 0) != (manifest["content_xxhash64"] or 0):
        out.append("content")
    return out


def verify_export(spark: SparkSession, target: str) -> list[str]:
    """What is wrong with a published export, read back file by file; nothing if it is whole."""
    manifest = json.loads(spark.read.text(f"{target}/manifest").first()["value"])
    columns = spark.read.options(**CSV).csv(f"{target}/dictionary")
    names = [r["column_name"] for r in columns.collect()]  # a row a column
    return differences(manifest, [r.asDict() for r in file_digests(spark, f"{target}/data", names).collect()])

"""The raw zone: payloads as they came, content-addressed, a partition for every source and day."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.operators.latest import keep_latest, newest
from tempora.operators.merge import outcome

SCHEMA = "raw_id string, source string, endpoint string, request_params string, ingestion_date date, ingested_at timestamp, run_id string, request_url string, payload string, payload_hash string"
KEYS = ("source", "endpoint", "request_params", "ingestion_date")


def canonical(payload: object) -> str:
    return json.dumps(payload, sort_keys=True, separators=(",", ":"), ensure_ascii=False)


def digest(payload: object) -> str:
    return hashlib.sha256(canonical(payload).encode()).hexdigest()


def rows(spark: SparkSession, answers: Sequence[tuple[str, str, dict, object]], day: date, at: datetime, run_id: str, url: str = "") -> DataFrame:
    """answers: (source, endpoint, request parameters, payload)."""
    made = [(digest([s, e, p, at.isoformat(), digest(x)])[:16], s, e, canonical(p), day, at, run_id, url or e, canonical(x), digest(x)) for s, e, p, x in answers]
    return spark.createDataFrame(made, SCHEMA)


def replay(spark: SparkSession, path: str, source: str, day: date, at: datetime, run_id: str, wanted: Sequence[str] = ()) -> DataFrame:
    """Files of recorded answers as raw rows; a file's place under path, without .json, is its endpoint.

    So `path/competitions/CL/matches.json` answers `competitions/CL/matches`. A missing folder is an error, and so
    is a wanted endpoint without a file.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    whole = folder.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(folder).toString()
    plain = lambda c: F.regexp_replace(c, "^([A-Za-z0-9]+):/+", "$1:/")
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True).select(F.input_file_name().alias("f"), "value")
    name = F.regexp_replace(F.expr("url_decode(rest)"), r"\.json$", "")
    files = files.withColumn("rest", F.substr(plain(F.col("f")), F.length(plain(F.lit(whole))) + 2))
    if wanted:
        found = {r["n"] for r in files.select(name.alias("n")).where(F.col("n").isin(*wanted)).distinct().collect()}
        if missing := sorted(set(wanted) - found):
            raise FileNotFoundError(", ".join(missing))
    lit = lambda v, t: F.lit(v).cast(t)
    return files.select(
        F.left(F.sha2(F.concat_ws("|", F.lit(source), name, F.lit(at.isoformat()), "value"), 256), F.lit(16)).alias("raw_id"), F.lit(source).alias("source"), name.alias("endpoint"), F.lit("{}").alias("request_params"), lit(day.isoformat(), "date").alias("ingestion_date"),
        lit(at.isoformat(), "timestamp").alias("ingested_at"), F.lit(run_id).alias("run_id"), F.col("f").alias("request_url"), F.col("value").alias("payload"), F.sha2("value", 256).alias("payload_hash"),
    )


def load(stored: DataFrame, incoming: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the zone with the newest answer of every key, INSERTED / UPDATED / UNCHANGED of the incoming ones)."""
    told = outcome(stored, incoming, KEYS, "payload_hash")
    changed = incoming.join(told.where("outcome <> 'UNCHANGED'").select(*KEYS), list(KEYS), "left_semi")
    return keep_latest(stored.unionByName(changed), KEYS, newest("ingested_at", "payload_hash")), told


def write(zone: DataFrame, path: str) -> None:
    """Only the partitions of the days in zone are replaced."""
    zone.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source", "ingestion_date").parquet(path)

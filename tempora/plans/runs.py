"""The log of runs: append-only rows, so that a killed run leaves its RUNNING row as evidence."""

from __future__ import annotations

import uuid
from types import TracebackType

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.clock import Clock
from tempora.operators.latest import keep_latest

RUNNING, SUCCESS, FAILED = "RUNNING", "SUCCESS", "FAILED"
SCHEMA = "run_id string, pipeline string, logical_date date, status string, started_at timestamp, finished_at timestamp, rows_extracted long, rows_loaded long, rows_updated long, error_message string"
#: Characters of an error that are kept.
MESSAGE = 2000


class Run:
    """with Run(...) as run: the RUNNING row is written first, SUCCESS or FAILED at the end; errors go on."""

    def __init__(self, spark: SparkSession, path: str, pipeline: str, clock: Clock, run_id: str | None = None) -> None:
        self.spark, self.path, self.pipeline, self.clock = spark, path, pipeline, clock
        self.run_id = run_id or uuid.uuid4().hex
        self.counts = {"rows_extracted": 0, "rows_loaded": 0, "rows_updated": 0}

    def add(self, **counts: int) -> None:
        for name, n in counts.items():
            self.counts[f"rows_{name}"] += n

    def _write(self, status: str, finished: bool, error: str | None) -> None:
        now = F.current_timestamp()
        started = now if not finished else F.lit(self._started).cast("timestamp")
        row = self.spark.range(1).select(
            F.lit(self.run_id).alias("run_id"), F.lit(self.pipeline).alias("pipeline"), self.clock.today().alias("logical_date"), F.lit(status).alias("status"), started.alias("started_at"),
            (now if finished else F.lit(None).cast("timestamp")).alias("finished_at"), *[F.lit(n).cast("long").alias(c) for c, n in self.counts.items()], F.lit(error).cast("string").alias("error_message"),
        )
        row.coalesce(1).write.mode("append").parquet(self.path)

    def __enter__(self) -> Run:
        self._write(RUNNING, False, None)
        mine = read(self.spark, self.path).where(F.col("run_id") == self.run_id)
        self._started = mine.select(F.date_format("started_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("s")).first()["s"]
        return self

    def __exit__(self, kind: type[BaseException] | None, error: BaseException | None, trace: TracebackType | None) -> bool:
        self._write(SUCCESS if error is None else FAILED, True, None if error is None else f"{kind.__name__}: {error}"[:MESSAGE])
        return False


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path)


def current(log: DataFrame) -> DataFrame:
    """One row a run: its end where it has one."""
    return keep_latest(log, ["run_id"], [F.col("finished_at").desc_nulls_last()])

"""What the operators share: scratch tables in the cluster's shared folder, and regex spans without Python."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space that separates words everywhere in this subpackage.
BLANK = r"\x20\x09-\x0D"
WORD = rf"[^{BLANK}]+"


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name under spark.checkpoint.dir, which driver and executors share.

    Only a session on one machine may do without the setting; it gets a temporary folder. On a cluster such a
    folder would lose rows, so that there the setting must be given.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="tempora-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df once in the scratch folder and read it back: cuts lineage and fixes what a rerun could change."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(what: DataFrame | str, spark: SparkSession | None = None) -> None:
    """Delete the scratch folder of a materialized frame, or a folder by its name, that nothing reads any more."""
    spark = spark or what.sparkSession
    paths = {what} if isinstance(what, str) else {f.rpartition("/")[0] for f in what.inputFiles()}
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def spark_hash(n: np.ndarray) -> np.ndarray:
    """Spark's hash of ints, as bucketBy uses it."""
    with np.errstate(over="ignore"):
        k = n.astype(np.uint32) * np.uint32(0xCC9E2D51)
        k = (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)
        h = np.uint32(42) ^ k
        h = (h << np.uint32(13) | h >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(4)
        h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
        h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
    return h.view(np.int32).astype(np.int64)


def part_number(partition: int, parts: int) -> int:
    """A number that Spark's hash puts in bucket `partition` of `parts`, so that each has a bucket of its own."""
    if partition >= parts:
        raise ValueError(f"partition {partition} of a job that was to have {parts}")
    at, step = 0, 1 << 16
    while True:
        hit = np.flatnonzero(spark_hash(np.arange(at, at + step)) % parts == partition)
        if len(hit):
            return int(at + hit[0])
        at += step


def part_numbers(parts: int) -> list[int]:
    """The part_number of every partition."""
    found, at, step = np.full(parts, -1), 0, 16 * parts
    while (found < 0).any():
        n = np.arange(at, at + step)
        bucket, first = np.unique(spark_hash(n) % parts, return_index=True)
        new = found[bucket] < 0
        found[bucket[new]] = n[first[new]]
        at += step
    return found.tolist()


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Rows one at a time: large values of a batch are not all copied at once."""
    for b in batches:
        for i in range(b.num_rows):
            yield b.slice(i, 1).to_pylist()[0]


def bucketed(df: DataFrame, parts: int, name: str, listed: bool = True) -> tuple[DataFrame, str]:
    """df as a table in the scratch folder with a bucket for every part, and its path.

    A task writes one part, under the part_number of its partition. listed: the catalog keeps the table's name.
    """
    spark = df.sparkSession
    path, table = scratch(spark, name), f"tempora_{uuid.uuid4().hex[:12]}"
    df.write.format("parquet").option("compression", "zstd").option("path", path).bucketBy(parts, "part").saveAsTable(table)
    out = spark.table(table)
    if not listed:  # the frame has its files and buckets by now
        spark.sql(f"DROP TABLE {table}")
    return out, path


#: Buckets that in_parts makes at most. With more input parts than that, parts share buckets.
BUCKETS = 1 << 15
CO_LOCATED = "spark.sql.requireAllClusterKeysForCoPartition"


def in_parts(df: DataFrame, name: str) -> tuple[DataFrame, int, str]:
    """df with part and row (unique) as a table in buckets by part, written where it is read; their number; its folder.

    Each promised partition has a bucket of its own; one beyond them shares a bucket.
    """
    parts = min(BUCKETS, max(1, df.rdd.getNumPartitions()))
    at = F.spark_partition_id()
    part = F.coalesce(F.get(F.array(*map(F.lit, part_numbers(parts))), at), at)
    table, path = bucketed(df.withColumns({"part": part, "row": F.monotonically_increasing_id()}), parts, name, listed=False)
    return table, parts, path


@contextmanager
def co_located(spark: SparkSession) -> Iterator[None]:
    """What runs inside may join buckets by part to rows by (part, row): the buckets stay where they are."""
    before = spark.conf.get(CO_LOCATED)
    spark.conf.set(CO_LOCATED, "false")
    try:
        yield
    finally:
        spark.conf.set(CO_LOCATED, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


SPAN = "start:int,end:int,found:string,left:string,right:string"
#: Elements that a step of a running total copies at most.
RUN = 256


def bind(value: Column, use) -> Column:
    """use(value) with value worked out once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def sums_before(numbers: Column) -> Column:
    """For each of numbers (an array, not empty) the sum of those before it.

    Runs of RUN elements are added up one by one, and their totals likewise, so that a long array isn't copied
    at every step.
    """
    grow = lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x))
    init = lambda a: F.slice(a, F.lit(1), F.size(a) - 1)
    zero = F.array(F.lit(0))

    def whole(n: Column) -> Column:
        runs = F.transform(F.sequence(F.lit(0), F.floor((F.size(n) - 1) / RUN).cast("int")), lambda k: F.slice(n, k * RUN + 1, F.lit(RUN)))
        totals = F.aggregate(F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda a, x: a + x)), zero, grow)
        return F.flatten(F.zip_with(runs, init(totals), lambda r, at: init(F.aggregate(r, F.array(at), grow))))

    return bind(numbers, whole)


def regex_spans(text: Column, pattern: str, screen: Column | None = None) -> Column:
    """array<struct<start, end, found, left, right>> of the leftmost non-overlapping matches, in code points, end exclusive.

    The text is split at the matches; lengths of pieces and matches add up to positions. left is the match before
    with the gap after it, right the gap behind with the next match. screen: a cheap condition without which no
    match is possible. Texts without a match cost one scan.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))  # one gap more than hits

    def spans(x: Column) -> Column:
        n = F.size(x) - 1
        starts = sums_before(F.transform(F.slice(x, F.lit(1), n), lambda p: F.length(p["gap"]) + F.length(p["hit"])))
        before = F.concat(F.array(F.lit("")), F.transform(x, lambda p: p["hit"]))
        rows = F.arrays_zip(F.slice(x, F.lit(1), n).alias("own"), starts.alias("at"), F.slice(before, F.lit(1), n).alias("before"), F.slice(x, F.lit(2), n).alias("next"))
        at = lambda r: r["at"] + F.length(r["own"]["gap"])
        return F.transform(
            rows,
            lambda r: F.struct(at(r).alias("start"), (at(r) + F.length(r["own"]["hit"])).alias("end"), r["own"]["hit"].alias("found"), F.concat(r["before"], r["own"]["gap"]).alias("left"), F.concat(r["next"]["gap"], F.coalesce(r["next"]["hit"], F.lit(""))).alias("right")),
        )

    hit = text.rlike(pattern) if screen is None else screen & text.rlike(pattern)
    return F.when(hit, bind(pairs, spans)).otherwise(F.array().cast(f"array<struct<{SPAN}>>"))


def span_string(spans: Column) -> Column:
    """'kind:start:end' joined by commas, in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

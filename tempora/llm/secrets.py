"""Secret scans over an incremental blob ledger.

Every version of a file is content-addressed by the SHA-256 of its text. The ledger is a Parquet table of (rule
version, blob, spans). A run writes its texts once, bucketed by input part, names one row for each blob that the
ledger doesn't have under the current rule version, scans those rows where their texts lie, appends what it found -
blobs without findings too, so that they count as seen - and joins the findings back to every path that holds the
blob. Only names of blobs and rows travel, whatever the sizes.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import co_located, discard, documents, in_parts, materialize, regex_spans, scratch, span_string

#: Pattern of each kind, in the order in which kinds are listed. The lower bounds of access and
#: hex stand in the patterns, where they change nothing: a maximal run that is too short has no longer suffix.
RULES = {
    "assign": r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]{14,}",
    "hex": r"[0-9a-f]{16,}",
}
ASSIGN_VALUE, ASSIGN_LEAST = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", 12
LEDGER = "rule_version string, blob string, spans array<struct<start:int,rank:int,end:int,kind:string>>"
SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def rule_version(rules: dict[str, str] = RULES) -> str:
    return hashlib.sha256(repr((sorted(rules.items()), ASSIGN_LEAST)).encode()).hexdigest()[:16]


def ranked(spans: Column, rank: int, kind: str) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def scan(text: Column, rules: dict[str, str] = RULES) -> Column:
    """Findings of a text by start, then rule order."""
    found = []
    for rank, (kind, pattern) in enumerate(rules.items()):
        spans = regex_spans(text, pattern)
        if kind == "assign":
            spans = F.filter(spans, lambda s: F.length(F.regexp_extract(s["found"], ASSIGN_VALUE, 1)) >= ASSIGN_LEAST)
        found.append(ranked(spans, rank, kind))
    return F.array_sort(F.concat(*found))


def _ledger(spark: SparkSession, ledger: str, version: str) -> DataFrame:
    """What the ledger has under one rule version; an empty ledger is made where there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        spark.createDataFrame([], LEDGER).write.parquet(ledger)
    return spark.read.schema(LEDGER).parquet(ledger).where(F.col("rule_version") == version)


def _unseen(table: DataFrame, parts: int, seen: DataFrame) -> DataFrame:
    """One row of table for each blob that seen doesn't have; to be planned in co_located(), which keeps its texts in
    their buckets. A blob that a third of the rows hold is pre-aggregated before it is shuffled."""
    lead = table.groupBy("blob").agg(F.min(F.struct("part", "row")).alias("lead")).join(seen, "blob", "left_anti")
    todo = lead.select("lead.part", "lead.row").repartition(parts, "part")
    return table.join(todo.hint("shuffle_hash"), ["part", "row"], "left_semi")


def scan_paths(paths: DataFrame, ledger: str, key: str = "doc_id", text: str = "text", rules: dict[str, str] = RULES) -> DataFrame:
    """key, blob, spans for every row of paths; ledger: folder of the ledger, created if absent.

    A null text is the empty blob. Equal texts are scanned once, whatever their paths, and not at all if the ledger
    has them; repeated rows all come back. Null keys and other columns, whatever their names, change nothing. An
    empty table leaves the ledger as it is.
    """
    spark, version = paths.sparkSession, rule_version(rules)
    body = F.coalesce(F.col(text), F.lit(""))
    table, parts, folder = in_parts(paths.select(F.col(key).alias("path"), F.sha2(body, 256).alias("blob"), body.alias("body")), "secret-texts")
    seen = _ledger(spark, ledger, version).select("blob")
    with co_located(spark):
        new = _unseen(table, parts, seen).select(F.lit(version).alias("rule_version"), "blob", scan(F.col("body"), rules).alias("spans"))
        new.write.mode("append").parquet(ledger)
    held = _ledger(spark, ledger, version).where(F.size("spans") > 0).select("blob", "spans")
    none = F.array().cast(SPANS)
    out = materialize(table.select("path", "blob").join(held, "blob", "left").select(F.col("path").alias(key), "blob", F.coalesce("spans", none).alias("spans")), "secret-findings")
    discard(folder, spark)
    return out


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of the table through one ledger: rows of even doc_id first, then all of them, of which only the
    blobs that are new are scanned."""
    docs, ledger = documents(spark, sf_dir), scratch(spark, "secret-ledger")
    scan_paths(docs.where("doc_id % 2 = 0"), ledger)
    found = scan_paths(docs, ledger)
    n = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(n, RULES), F.sha2(span_string(F.col("spans")), 256).alias("base_sha256"), span_string(F.col("spans")).alias("spans"), "blob")

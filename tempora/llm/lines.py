"""Line dedup: lines whose key many documents share go, everywhere.

Documents are written once, bucketed by input part, with the hashes of their lines' keys beside the text. Two passes
read the hashes alone: one counts the documents of every key, each document counting once; the other tells rows the
positions of their frequent keys. Only names of rows, positions and hashes travel; positions come to the bucket in
which their text lies, and the text is put together again from its other lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import co_located, discard, documents, in_parts, materialize

#: White space that a key loses at both ends, and what it lower-cases.
BLANKS, UPPER, LOWER = "\x20\t\n\x0b\x0c\r", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_DOCUMENTS, LEAST_LENGTH = 10, 1


def line_keys(text: Column) -> Column:
    """The key of every line: stripped, A-Z in lower case."""
    return F.transform(F.split(F.translate(text, UPPER, LOWER), "\n", -1), lambda x: F.btrim(x, F.lit(BLANKS)))


def key_hashes(text: Column, least: int) -> Column:
    """128 bits of every line's key; null for keys of under `least` code points."""
    bits = lambda x: F.struct(F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"))
    return F.transform(line_keys(text), lambda x: F.when(F.length(x) >= least, bits(x)))


def drop_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", least_documents: int = LEAST_DOCUMENTS, least_length: int = LEAST_LENGTH, kept: bool = True) -> DataFrame:
    """key, n_lines, n_dropped, kept_sha256 of every row, and with kept what is left as `text`.

    A key of least_length code points or more that stands in least_documents rows or more loses all its lines, the
    first too. A row is a document: repeated rows, and rows that share a key or have none, count one each, and all
    come back. A null text is empty, which is one empty line. An empty table gives an empty result. Other columns,
    whatever their names, are not read.
    """
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    table, parts, path = in_parts(rows.withColumn("hashes", key_hashes(F.col("text"), least_length)), "line-texts")
    once = F.explode(F.array_distinct(F.filter("hashes", lambda h: h.isNotNull()))).alias("h")
    often = table.select(once).groupBy("h.a", "h.b").agg(F.count("*").alias("n")).where(F.col("n") >= least_documents).select("a", "b")
    every = table.select("part", "row", F.posexplode("hashes").alias("pos", "h")).where("h IS NOT NULL").select("part", "row", "pos", "h.a", "h.b")
    gone = every.join(often, ["a", "b"], "left_semi").repartition(parts, "part").groupBy("part", "row").agg(F.collect_list("pos").alias("gone"))
    lines = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    rest = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.transform(left, lambda i: F.get(lines, i)), "\n"))
    both = table.join(gone.hint("shuffle_hash"), ["part", "row"], "left").select(F.col("key").alias(key), F.size(lines).cast("long").alias("n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"), rest.alias("kept"))
    told = both.select(key, "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"), *[F.col("kept").alias("text")] * kept)
    with co_located(docs.sparkSession):
        out = materialize(told, "line-kept")
    discard(path, docs.sparkSession)
    return out


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_lines(documents(spark, sf_dir), kept=False)

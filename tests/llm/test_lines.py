"""Line dedup against a plain version."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

from pyspark.sql import functions as F

from tempora.llm import common, lines
from tempora.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"


def key(line):
    return line.translate(str.maketrans(lines.UPPER, lines.LOWER)).strip(WHITE)


def plain(texts, least=10, length=1):
    every = [(t or "").split("\n") for t in texts]
    held = Counter(k for own in every for k in {key(x) for x in own} if len(k) >= length)
    left = [[x for x in own if len(key(x)) < length or held[key(x)] < least] for own in every]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(every, left)]


def folder(spark, tmp_path, texts):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5).write.parquet(f"file://{tmp_path}/documents.parquet")
    return f"file://{tmp_path}"


def test_whole_result(spark, tmp_path):
    r = random.Random(1)
    often, seldom = [f"Common line {i} É " for i in range(6)], [f"line {i}" for i in range(400)]
    shape = lambda x: r.choice(["", " ", "\t", "\r"]) + r.choice([str.upper, str.lower, str])(x) + r.choice(["", "  ", "\x0b"])
    texts = ["\n".join(shape(r.choice(often if r.random() < 0.4 else seldom)) for _ in range(r.randint(1, 12))) for _ in range(120)]
    texts += [None, "", "\n", "\n\n \n", "only once\nonly once\n" * 20, "Common line 0 É \n" * 3000, "x" * 200_000 + "\nCommon line 1 É ", "nine\ntimes"]
    texts += ["nine"] * 8 + ["nine ", "ten"] + [" TEN "] * 9
    want = plain(texts)
    got = {x["doc_id"]: (x["n_lines"], x["n_dropped"], x["kept_sha256"]) for x in QUERIES["op12_lines"](spark, folder(spark, tmp_path, texts)).collect()}
    assert got == {i: (n, gone, hashlib.sha256(left.encode()).hexdigest()) for i, (n, gone, left) in enumerate(want)}
    assert want[-1][1] == 1 and want[-12][1] == 0  # ten documents hold "ten", nine hold "nine"


def test_texts_come_back_and_bars_are_parameters(spark):
    rows = [(1, "ab\ncd"), (1, "ab\nx"), (None, "AB\n\ncd"), (2, "e\ne\ne")]
    docs = spark.createDataFrame([(i, t, 0, 0, "s") for i, t in rows], "doc_id long, text string, part int, row int, hashes string")
    got = lines.drop_lines(docs, least_documents=2, least_length=2)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256", "text"]
    want = [(i, *x) for (i, _), x in zip(rows, plain([t for _, t in rows], 2, 2))]
    assert sorted((str(x["doc_id"]), x["n_lines"], x["n_dropped"], x["text"]) for x in got.collect()) == sorted((str(i), *x) for i, *x in want)


def test_empty_table(spark):
    assert lines.drop_lines(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_texts_are_not_shuffled(spark, tmp_path, monkeypatch):
    """One bucket for each input part; the join by (part, row) has no exchange above the texts."""
    plans = []
    real = lines.materialize
    monkeypatch.setattr(lines, "materialize", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), real(df, name))[1])
    docs = spark.read.parquet(folder(spark, tmp_path, [f"a\nb{i}" for i in range(50)]) + "/documents.parquet")
    lines.drop_lines(docs).collect()
    above = plans[0].split("ShuffledHashJoin")[1]
    assert "Exchange" not in above[: above.index("FileScan")] and "SelectedBucketsCount" in above
    assert not spark.catalog.listTables()


def test_a_part_more_than_promised_shares_a_bucket(spark, monkeypatch):
    docs = spark.range(0, 60, 1, 6).select(F.col("id").alias("doc_id"), F.concat(F.lit("same\n"), F.col("id").cast("string")).alias("text"))
    monkeypatch.setattr(common, "BUCKETS", 4)
    assert {x["text"] for x in lines.drop_lines(docs).collect()} == {str(i) for i in range(60)}


def test_part_numbers():
    assert common.part_numbers(37) == [common.part_number(i, 37) for i in range(37)]

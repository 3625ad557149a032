"""The pipeline on a small folder of tables."""

from __future__ import annotations

import pytest

pytest.importorskip("public_tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from tests.llm.test_operators import prose  # noqa: E402


def test_stages(spark, tmp_path):
    good = [prose(150, 900 + i) for i in range(40)]
    bad = ["\n".join("BUY NOW!! $$$ " * 4 for _ in range(8)) + prose(10, 990 + i) for i in range(20)]
    texts = [*good, *bad, good[0], good[1] + " mail me at a.b@c.example.com"]
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in enumerate(texts)]
    names = "doc_id long, text string, lang string, source string, n_chars long"
    base = f"file://{tmp_path}"
    spark.createDataFrame(rows, names).write.parquet(f"{base}/documents.parquet")
    spark.createDataFrame([(i, int(i < 40 or i >= 60)) for i in range(62)], "doc_id long, quality int").write.parquet(f"{base}/labels.parquet")
    docs, counts = spark.read.parquet(f"{base}/documents.parquet"), {}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "privacy", "mixture", "tokens"]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, base)
        out.write.parquet(f"{base}/{name}")
        before, docs = docs, spark.read.parquet(f"{base}/{name}")
        counts[name] = docs.count()
        if name != "tokens":
            assert docs.dtypes == before.dtypes
        if name == "privacy":
            assert docs.where("text LIKE '%@c.example%'").count() == 0
    kept = {r["doc_id"] for r in spark.read.parquet(f"{base}/quality").collect()}
    assert kept == {*range(40), 60, 61}
    assert 60 not in {r["doc_id"] for r in spark.read.parquet(f"{base}/near_duplicates").collect()}
    assert counts["privacy"] == counts["near_duplicates"] and counts["tokens"] == counts["mixture"]


EDGE = "doc_id long, text string, lang string, source string, n_chars long, found string, part int, row int, pattern string, size long, u long"


def edge_rows(kind):
    own = [(None, "Some text here.", None, None, None), (7, None, "en", "a", 0), (7, None, "en", "a", 0), (8, "", "xx", None, 0), (9, "a.b@c.example.com " + prose(60, 5), "en", "a", 5), (9, "a.b@c.example.com " + prose(60, 5), "en", "a", 5), (None, prose(60, 6), "de", "b", 5)]
    return [(*x, "f", 1, 2, "p", 3, 4) for x in (own if kind == "odd" else [])]


@pytest.mark.parametrize("kind", ["odd", "empty"])
@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_nulls_repeats_and_clashing_names(spark, tmp_path, name, kind):
    base, rows = f"file://{tmp_path}", edge_rows(kind)
    spark.createDataFrame([(9, 1), (None, 0), (8, None)] if rows else [], "doc_id long, quality int").write.parquet(f"{base}/labels.parquet")
    docs = spark.createDataFrame(rows, EDGE)
    docs.write.parquet(f"{base}/docs")
    docs = spark.read.schema(EDGE).parquet(f"{base}/docs")
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, base)
    got = out.collect()
    if name != "tokens":
        assert out.dtypes == docs.dtypes
    assert (len(got) == 0) == (not rows)
    if name == "privacy" and rows:
        assert sorted(str(r["doc_id"]) for r in got) == sorted(str(r[0]) for r in rows) and not any("@c.example" in (r["text"] or "") for r in got)
        assert [r["text"] for r in got if r["doc_id"] == 7] == [None, None]
    if name == "near_duplicates" and rows:
        assert len(got) == len({r[1] or "" for r in rows})
    if name == "mixture" and rows:
        assert sum(r["doc_id"] == 9 for r in got) % 2 == 0  # repeats come equally often
    if name == "tokens" and rows:
        assert len(got) == len(rows) and {r["n_tokens"] for r in got if r["doc_id"] in (7, 8)} == {0}

"""Hard negatives against all pairs."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tempora.llm import negatives
from tempora.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, shift=True, anchor=lambda i: i % 50 == 0, k=5, m=3, low=50, high=95):
    rows = [(i, v, label) for i, v, label in rows if label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    dims = max((len(v) for _, v, _ in rows), default=0)
    x = np.array([[*np.floor(256 * np.array(v, np.float32).astype(float)), *[0] * (dims - len(v))] for _, v, _ in rows]).reshape(len(rows), dims)
    ids = np.array([2**63 - 1 if i is None else i for i, _, _ in rows])
    label = np.array([(lab + 1) % 10 if shift and i is not None and i % 7 == 0 else lab for i, _, lab in rows])
    out = []
    for a, (i, _, _) in enumerate(rows):
        if i is None or not anchor(i):
            continue
        score = (x @ x[a]).astype(np.int64)
        order = np.lexsort((ids, -score))
        others = order[label[order] != label[a]]
        for p in [j for j in order if j != a and label[j] == label[a]][:k]:
            fit = others[(low * score[p] <= 100 * score[others]) & (100 * score[others] <= high * score[p])][:m]
            told = lambda j: None if ids[j] == 2**63 - 1 else int(ids[j])  # noqa: B023, E731
            out += [(int(i), told(p), n + 1, told(j), int(score[p]), int(score[j])) for n, j in enumerate(fit)]
    return sorted(out, key=repr)


def rows_of(n, dims, seed, centres=12):
    """Clusters, a block of equal vectors, ties."""
    r = np.random.default_rng(seed)
    middle = r.normal(size=(centres, dims))
    x = middle[r.integers(centres, size=n)] + 0.3 * r.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[n // 2 : n // 2 + n // 3] = x[0]
    x = np.round(x * 16) / 16
    return [(i, [float(v) for v in x[i]], int(r.integers(4))) for i in range(n)]


@pytest.fixture
def small(monkeypatch):
    """Many cells, blocks and leaves from few rows."""
    for name, size in {"BLOCK": 60, "LEAF": 8, "PACK": 16}.items():
        monkeypatch.setattr(negatives, name, size)


def told(frame):
    return sorted((tuple(x) for x in frame.collect()), key=repr)


def test_whole_result(spark, tmp_path, small):
    rows = rows_of(900, 12, 1)
    rows += [(901, None, 1), (902, [1.0] * 12, None), (903, [float("nan")] * 12, 1), (904, [float("inf")] * 12, 1), (905, [None] * 12, 1), (950, [], 1), (1000, [0.0] * 12, 2), (1001, [0.5] * 3, 2), (1050, [-0.5] * 12, 3), (None, rows[0][1], 0), (None, rows[3][1], 1)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    want = plain(rows)
    assert len(want) > 150
    assert told(QUERIES["op11_negatives"](spark, f"file://{tmp_path}")) == want


def test_other_windows_repeats_and_names(spark, small):
    rows = rows_of(300, 6, 4) + [(10, [3.0, 2.0, 1.0, 0.0, -1.0, -2.5], 1)] * 3 + [(20, [9.0] * 6, 1), (20, [-9.0] * 6, 2)]
    frame = spark.createDataFrame([(*x, 0, 0.0) for x in rows], SCHEMA + ", row int, norm double")
    got = negatives.mine(negatives.vectors(frame), F.col("id") % 10 == 0, positives=4, negatives=6, low=0, high=100)
    assert told(got) == plain(rows, False, lambda i: i % 10 == 0, 4, 6, 0, 100)


def test_empty_tables(spark):
    for rows in ([], [(50, None, 1)], [(50, [1.0], 1)]):
        assert negatives.mine(negatives.vectors(spark.createDataFrame(rows, SCHEMA)), F.col("id") % 50 == 0).count() == 0


def test_leaves_are_skipped():
    """Clusters far apart: a search reads the leaves that its annulus reaches, and no others."""
    r = np.random.default_rng(3)
    x = np.floor(np.repeat(r.normal(size=(16, 8)) * 400, 64, 0) + r.normal(size=(1024, 8)) * 4)
    norm = (x**2).sum(1)
    tree, order, picked = negatives.plant(x, norm, norm.max(), 16)
    assert sorted(order.tolist()) == list(range(1024)) and len(set(picked.tolist())) == 15
    near, far = tree.bounds(x, norm)
    d = np.sqrt(np.maximum(norm.max() + norm[:, None] - 2 * x @ x[order].T, 0)).reshape(1024, 16, 64)
    assert (near <= d.min(2) + 1e-3).all() and (far >= d.max(2) - 1e-3).all()
    best = np.sort(d.reshape(1024, -1), 1)[:, 4]
    assert (near <= best[:, None]).mean() < 0.5


def test_recall_over_all_rows_is_one(spark, small):
    rows = rows_of(400, 24, 9, centres=400)
    base = negatives.materialize(negatives.vectors(spark.createDataFrame(rows, SCHEMA)), "base")
    over = negatives.index(base)
    assert over.cells.depth and base.count() == 400
    inf = F.lit(float("inf"))
    found = negatives.search(base.select(F.col("row").alias("q"), "row", "label", F.lit(True).alias("same"), "vec", "norm", (-inf).alias("least"), inf.alias("most")), over, 3)
    x = np.array([np.floor(256 * np.array(v)) for _, v, _ in rows])
    label, got = np.array([lab for *_, lab in rows]), {}
    names = {r["row"]: r["id"] for r in base.collect()}
    for r in found.collect():
        got.setdefault(names[r["q"]], {})[r["n"]] = r["id"]
    for i in range(400):
        order = np.lexsort((np.arange(400), -(x @ x[i])))
        assert list(map(got[i].get, (1, 2, 3))) == [j for j in order.tolist() if j != i and label[j] == label[i]][:3]

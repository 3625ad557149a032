"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are its own shape and that of the lines before and after it; two
labels are chained by transition weights. Forward-backward gives each line's marginal of being good, and the
marginals weighted by line length give the document's score. The field is fitted by maximum likelihood on a
bounded sample of labelled documents whose lines all carry the document's label.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import documents
from tempora.llm.rules import COMMON

#: Labelled documents that the fit takes at most, and code points of them in all; steps of the fit; its L2 weight.
SAMPLE, SAMPLE_CHARS, STEPS, DECAY = 1_500, 10_000_000, 110, 1e-3
OWN, BESIDE = 15, 12
WIDTH = OWN + 2 * (BESIDE + 1)
_FREQUENT = {w.encode() for words in COMMON.values() for w in words}
_KIND = np.full(256, 0, np.uint8)
for _chars, _k in (("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("#*$%&<>", 2), ("|", 3), ("!", 4), ("0123456789", 5), (".,;:?", 6), (" \t\r\x0b\x0c", 7)):
    for _c in _chars:
        _KIND[ord(_c)] = _k
_KIND[128:192], _KIND[192:] = 9, 8


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(lines x WIDTH, line lengths). Blank lines are left out; a text without others is one blank line."""
    lines = [x for x in text.encode().split(b"\n") if x.strip()] or [b""]
    raw = np.frombuffer(b"\n".join(lines), np.uint8)
    size = np.array([len(x) for x in lines], float)
    at = np.repeat(np.arange(len(lines)), [len(x) + 1 for x in lines])[: len(raw)]
    share = np.bincount(at * 10 + _KIND[raw], minlength=10 * len(lines)).reshape(-1, 10)[:, 1:9] / np.maximum(size, 1)[:, None]
    own = np.zeros((len(lines), OWN))
    own[:, :8] = share
    seen: set[bytes] = set()
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words) or 1
        own[i, 8] = len(set(words)) / n
        own[i, 9] = line in seen
        own[i, 10] = len(_FREQUENT.intersection(words)) / n
        own[i, 11] = line[:1].isupper() or line[:1] >= b"\xc3"
        own[i, 12] = line[-1:] in (b".", b"!", b"?")
        own[i, 13] = len(line) / n / 10
        seen.add(line)
    own[:, 14] = np.log1p(size)
    out = np.zeros((len(lines), WIDTH))
    out[:, :OWN] = own
    out[1:, OWN : OWN + BESIDE] = own[:-1, :BESIDE]
    out[1:, OWN + BESIDE] = 1
    out[:-1, OWN + BESIDE + 1 : -1] = own[1:, :BESIDE]
    out[:-1, -1] = 1
    return out, size


def marginals(score: np.ndarray, length: np.ndarray, chain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(P(line is good), expected transition counts) of padded chains.

    score: chains x lines, log-odds of good; length: lines of each chain, in descending order; chain: 2 x 2
    transition weights. Vectors are over chains, the loop is over lines.
    """
    n, t = score.shape
    emit = np.stack([np.zeros_like(score), score], -1)
    step = np.exp(chain)
    live = [int(np.searchsorted(-length, -k, side="left")) for k in range(t + 1)]  # chains longer than k
    ahead, scale = np.zeros((n, t, 2)), np.zeros((n, t))
    top = emit.max(-1)
    lift = np.exp(emit - top[..., None])
    for k in range(t):
        m = live[k]
        a = lift[:m, k] if k == 0 else (ahead[:m, k - 1] @ step) * lift[:m, k]
        scale[:m, k] = a.sum(-1)
        ahead[:m, k] = a / scale[:m, k, None]
    back = np.ones((n, t, 2))
    pairs = np.zeros((2, 2))
    for k in range(t - 2, -1, -1):
        m = live[k + 1]
        right = lift[:m, k + 1] * back[:m, k + 1]
        back[:m, k] = (right @ step.T) / scale[:m, k + 1, None]
        pairs += np.einsum("ni,ij,nj->ij", ahead[:m, k] / scale[:m, k + 1, None], step, right)
    both = ahead * back
    return both[..., 1] / np.maximum(both.sum(-1), 1e-300), pairs


def _pad(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order, padded, lengths), longest first."""
    length = np.array([len(r) for r in rows])
    order = np.argsort(-length, kind="stable")
    out = np.zeros((len(rows), length.max(initial=0)))
    for i, j in enumerate(order):
        out[i, : length[j]] = rows[j]
    return order, out, length[order]


#: Chains of a fit or a scoring step that are padded together; sorting by length keeps the padding small.
GROUP = 256


def fit(texts: list[str], labels: list[int]) -> dict[str, np.ndarray]:
    """Weights by full-batch gradient steps with moment estimates; the same input gives the same weights."""
    if not texts:
        return {"mean": np.zeros(WIDTH), "sd": np.ones(WIDTH), "w": np.zeros(WIDTH), "bias": np.zeros(1), "chain": np.zeros((2, 2))}
    found = sorted(((features(t)[0], y) for t, y in zip(texts, labels)), key=lambda x: -len(x[0]))
    length, truth = np.array([len(x) for x, _ in found]), np.array([y for _, y in found])
    every = np.concatenate([x for x, _ in found])
    mean, sd = every.mean(0), every.std(0) + 1e-6
    every = (every - mean) / sd
    start = np.concatenate([[0], np.cumsum(length)])
    y = np.repeat(truth, length).astype(float)
    weight = np.repeat(1 / np.sqrt(length), length)
    theta, m, v = np.zeros(WIDTH + 5), np.zeros(WIDTH + 5), np.zeros(WIDTH + 5)
    for step in range(1, STEPS + 1):
        odds = every @ theta[:WIDTH] + theta[WIDTH]
        p, moved = np.zeros(len(y)), np.zeros((2, 2))
        for g in range(0, len(length), GROUP):
            own = range(g, min(g + GROUP, len(length)))
            _, padded, size = _pad([odds[start[i] : start[i + 1]] for i in own])
            q, pairs = marginals(padded, size, theta[WIDTH + 1 :].reshape(2, 2))
            for row, i in enumerate(own):
                p[start[i] : start[i + 1]] = q[row, : length[i]]
            moved += pairs
        real = np.diag([(length - 1)[truth == 0].sum(), (length - 1)[truth == 1].sum()])
        err = (y - p) * weight
        grad = np.concatenate([every.T @ err, [err.sum()], (real - moved).ravel() / max(1.0, np.sqrt(length.mean()))]) / len(length) - DECAY * theta
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad**2
        theta = theta + 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return {"mean": mean, "sd": sd, "w": theta[:WIDTH], "bias": theta[WIDTH : WIDTH + 1], "chain": theta[WIDTH + 1 :].reshape(2, 2)}


def score_texts(texts: list[str], model: dict[str, np.ndarray]) -> np.ndarray:
    """Length-weighted mean of the lines' marginals."""
    rows, sizes = [], []
    for t in texts:
        x, size = features(t)
        rows.append((x - model["mean"]) / model["sd"] @ model["w"] + model["bias"][0])
        sizes.append(np.maximum(size, 1))
    out = np.zeros(len(texts))
    order = np.argsort([-len(r) for r in rows], kind="stable")
    for g in range(0, len(order), GROUP):
        own = order[g : g + GROUP]
        _, padded, length = _pad([rows[i] for i in own])
        p, _ = marginals(padded, length, model["chain"])
        for row, i in enumerate(own):
            out[i] = np.average(p[row, : len(rows[i])], weights=sizes[i])
    return np.clip(out, 0, 1)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Fit on at most `sample` labelled rows, chosen by hash; rows whose crc32(key) mod 3 is 1 are held out.

    Texts are taken in order of that hash while they fit SAMPLE_CHARS code points; one that doesn't fit is passed over.
    Null labels and keys are left out; of rows that share a key the least label and the least text count. Without
    labelled rows, or from an empty table, every document scores one half.
    """
    crc = F.crc32(F.col(key).cast("string"))
    known = labels.where(F.col(label).isNotNull() & (crc % 3 != 1)).select(F.col(key).alias("key"), F.col(label).cast("int").alias("y")).groupBy("key").agg(F.min("y").alias("y"))
    picked = known.orderBy(F.xxhash64("key"), "key").limit(sample)  # bounded: at most `sample` rows are broadcast
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("t")).join(F.broadcast(picked), "key").groupBy("key", "y").agg(F.min("t").alias("t"))
    got, room = [], SAMPLE_CHARS
    for r in rows.orderBy(F.xxhash64("key"), "key").toLocalIterator():
        if len(r["t"]) <= room:
            room -= len(r["t"])
            got.append((r["t"], r["y"]))
    return fit([t for t, _ in got], [y for _, y in got])


def score(docs: DataFrame, model: dict[str, np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score of every row, in Arrow batches; a null text is scored as an empty one, repeated rows score alike.

    Nothing is shuffled. An empty table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score_texts([t or "" for t in b.column(1).to_pylist()], model)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(s, pa.float64())], names=["doc_id", "score"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, "doc_id long, score double")


def keep_good(docs: DataFrame, model: dict[str, np.ndarray], text: str = "text", bar: float = 0.5) -> DataFrame:
    """The rows of docs, all columns, that score at least bar; repeats stay or go together. A null text is scored as an
    empty one; an empty table gives an empty one."""
    names, schema = docs.columns, docs.schema
    at = names.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = score_texts([t or "" for t in b.column(at).to_pylist()], model)
            yield b.filter(pa.array(s >= bar))

    return docs.mapInArrow(run, schema)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    return score(docs, model).select("doc_id", held.alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))

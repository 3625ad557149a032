"""Near duplicates by SimHash and meet-in-the-middle ball hashing.

Two fingerprints at most RADIUS bits apart have a common variant within half the radius of both. Every fingerprint
emits its whole ball of half the radius, 2,081 variants of 64 bits, and fingerprints that meet on a variant are
verified and linked. Variants meet by their first bits: the shuffle carries a fingerprint once to each bucket of
first bits that its ball reaches, with the number of flips it has left, and the bucket writes out the variants.
A bucket that would hold too many is split by further bits, again and again. No link is lost, none is false.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import documents, materialize
from tempora.llm.components import components

SHINGLE, SEED, RADIUS = 4, 42, 4
#: Variants that a bucket should hold, and holds at most before it is split by STEP further bits.
BUCKET, CROWDED, STEP = 1 << 20, 1 << 23, 6
#: Groups in which the fingerprints of a class fetch its least id.
SALTS = 32
_ONE = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 majority bits of the shingles' hashes; texts without a word have 0."""
    words = text.encode().lower().split()
    if not words:
        return 0
    flat = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = [0, *ends[:-1].tolist()]
    stops = (ends - 1).tolist()
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    last = stops[shingle - 1 :] if len(words) >= shingle else stops[-1:]
    h = np.array([digest(flat[a:b], SEED) for a, b in zip(starts, last)], np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((_ONE[2 * ones > n]).sum(dtype=np.uint64)) if n else 0


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp and hash of the text (as signed longs) of every row; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t or "") for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array(fp), b.column(2)], names=["doc_id", "fp", "hash"])

    return docs.select(F.col(key).cast("long"), F.col(text), _text_hash(F.col(text))).mapInArrow(run, "doc_id long, fp long, hash long")


def _text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def flips(bits: int, most: int) -> list[np.ndarray]:
    """Masks over the low `bits` bits with 0, 1, ... `most` (at most 2) of them set."""
    one = _ONE[:bits]
    i, j = np.triu_indices(bits, 1)
    return [np.zeros(1, np.uint64), one, one[i] | one[j]][: most + 1]


DEALT = "bucket long, fp long, left int"


def deal(rows: DataFrame, depth: int, step: int) -> DataFrame:
    """DEALT rows at depth + step of those at depth: a bucket is the first bits of variants, left the flips that
    a fingerprint still has for the bits behind."""
    half = RADIUS // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        masks = flips(step, half)
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                bucket, fp, left = (c.to_numpy(zero_copy_only=False) for c in b.slice(at, 4096).columns)
                own = fp.view(np.uint64) << np.uint64(depth) >> np.uint64(64 - step)
                for n, some in enumerate(masks):
                    may = left >= n
                    to = (bucket[may].astype(np.uint64) << np.uint64(step))[:, None] | own[may][:, None] ^ some
                    k = len(some)
                    yield pa.RecordBatch.from_arrays([pa.array(to.ravel().view(np.int64)), pa.array(np.repeat(fp[may], k)), pa.array(np.repeat(left[may] - n, k).astype(np.int32))], names=["bucket", "fp", "left"])

    return rows.select("bucket", "fp", "left").mapInArrow(run, DEALT)


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least node that each of n nodes is linked to."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


def meet(fp: np.ndarray, left: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(a, b): indices of fingerprints of one bucket that share a variant, enough of them to connect all that do.

    Variants are brought together by a hash with the owner in its low bits; owners that meet are verified.
    """
    bits = np.uint64(max(1, len(fp).bit_length()))
    low = fp << np.uint64(depth) >> np.uint64(depth) if depth < 64 else np.zeros_like(fp)
    every = [np.zeros(0, np.uint64)]
    owner = np.arange(len(fp), dtype=np.uint64)
    for n, some in enumerate(flips(64 - depth, RADIUS // 2)):
        may = left >= n
        h = (low[may][:, None] ^ some) * np.uint64(0x9E3779B97F4A7C15)
        every.append((h >> bits << bits | owner[may][:, None]).ravel())
    h = np.sort(np.concatenate(every))
    who = (h & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    h >>= bits
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    run = np.cumsum(new) - 1
    pair = np.unique(who[np.flatnonzero(new)[run[~new]]] * len(fp) + who[~new])
    a, b = pair // len(fp), pair % len(fp)
    near = np.bitwise_count(fp[a] ^ fp[b]) <= RADIUS
    more = [(a[near], b[near])]
    if not near.all():  # a hash brought strangers together: compare all of each such run
        first, wrong = who[np.flatnonzero(new)], np.zeros(new.sum(), bool)
        strange = set(pair[~near].tolist())
        wrong[run[~new]] |= np.array([int(first[r]) * len(fp) + int(w) in strange for r, w in zip(run[~new], who[~new])], bool)
        for r in np.flatnonzero(wrong):
            own = np.unique(who[run == r])
            i, j = np.triu_indices(len(own), 1)
            ok = np.bitwise_count(fp[own[i]] ^ fp[own[j]]) <= RADIUS
            more.append((own[i[ok]], own[j[ok]]))
    return np.concatenate([x for x, _ in more]), np.concatenate([x for _, x in more])


def _linked(depth: int):
    def run(table: pa.Table) -> pa.Table:
        fp, left = table.column("fp").to_numpy().view(np.uint64), table.column("left").to_numpy()
        label = _labels(len(fp), *meet(fp, left, depth))
        to = np.flatnonzero(label != np.arange(len(fp)))
        return pa.table({"a": fp[label[to]].view(np.int64), "b": fp[to].view(np.int64)})

    return run


def links(fps: DataFrame) -> DataFrame:
    """a, b: distinct fingerprints that chains of links within the radius connect; together they connect all such."""
    ball = sum(map(len, flips(64, RADIUS // 2)))
    depth = min(48, max(STEP, (fps.count() * ball // BUCKET).bit_length()))
    rows = materialize(deal(fps.select(F.lit(0).cast("long").alias("bucket"), "fp", F.lit(RADIUS // 2).alias("left")), 0, depth), "simhash-dealt")
    found = None
    while True:
        sizes = np.cumsum([len(m) for m in flips(64 - depth, RADIUS // 2)] + [0] * 3)[:3].tolist()
        held = F.sum(F.element_at(F.array(*map(F.lit, sizes)), F.col("left") + 1))
        crowded = materialize(rows.groupBy("bucket").agg(held.alias("n")).where(F.col("n") > CROWDED).select("bucket"), "simhash-crowded")
        last = crowded.isEmpty()
        calm = rows if last else rows.join(crowded, "bucket", "left_anti")
        met = materialize(calm.groupBy("bucket").applyInArrow(_linked(depth), "a long, b long"), "simhash-met")
        found = met if found is None else found.union(met)
        if last:
            return found.distinct()
        step = min(STEP, 64 - depth)
        rows, depth = materialize(deal(rows.join(crowded, "bucket", "left_semi"), depth, step), "simhash-dealt"), depth + step


def _classed(rows: DataFrame) -> DataFrame:
    """rows (doc_id, fp, ...) with root, one fingerprint of their class, and component_id, its least doc_id.

    A class may hold a third of all fingerprints: its least id is added up before the shuffle, and its
    fingerprints fetch it in SALTS groups.
    """
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-fps")
    roots = components(links(fps))
    named = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    linked = named.where("root IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("fp"), F.lit(SALTS)).cast("int"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    alone = named.where("root IS NULL").select("fp", F.col("fp").alias("root"), F.col("least").alias("component_id"))
    whole = materialize(linked.join(least, ["root", "salt"]).select("fp", "root", "component_id").union(alone), "simhash-classes")
    return rows.join(whole, "fp")


def classes(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fp, component_id (least doc_id reachable) of every row.

    Null and blank texts share fingerprint zero and are linked like any other. Repeated rows all come back. A
    null key counts as greater than any. An empty table gives an empty result; other columns are not read.
    """
    rows = materialize(fingerprints(docs, key, text).select("doc_id", "fp"), "simhash-rows")
    return _classed(rows).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class, all columns: the one of the least key, of equal keys the one of the least text hash,
    of those that are alike in both the first by all columns as JSON.

    Different classes stay apart even where their rows share a key or have none; a null key counts as greater
    than any. A null text counts as empty. An empty table gives an empty one.
    """
    rows = materialize(fingerprints(docs, key, text), "simhash-rows")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "hash"))
    kept = _classed(rows).groupBy("root").agg(first.alias("m")).select(F.col("m.doc_id").alias("simhash_key"), F.col("m.hash").alias("simhash_hash"))
    times = rows.groupBy("doc_id", "hash").agg(F.count("*").alias("simhash_times"))
    keys = kept.join(times, kept["simhash_key"].eqNullSafe(times["doc_id"]) & (kept["simhash_hash"] == times["hash"]))
    keys = materialize(keys.select("simhash_key", "simhash_hash", "simhash_times"), "simhash-kept")
    mine = docs.join(keys, F.col(key).cast("long").eqNullSafe(F.col("simhash_key")) & (_text_hash(F.col(text)) == F.col("simhash_hash")))
    once = mine.where("simhash_times = 1").select(docs.columns)
    if keys.where("simhash_times > 1").isEmpty():
        return once
    row = F.struct(*docs.columns)
    again = mine.where("simhash_times > 1").groupBy("simhash_key", "simhash_hash").agg(F.min_by(row, F.to_json(row)).alias("simhash_row"))
    return once.unionByName(again.select("simhash_row.*"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = classes(documents(spark, sf_dir))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")

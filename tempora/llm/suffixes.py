"""Exact repeats of SPAN bytes by a difference cover, one suffix bucket at a time.

Positions of a document that fall in a difference cover modulo V are the sample: whatever the alignment of two equal
passages, one in every V positions is in both samples at once. Sampled suffixes are dealt to buckets by the hash
of their first LEAD = SPAN - V + 1 bytes, and a bucket is sorted at a time, so that memory is bounded by the
bucket. Suffixes whose lead is unique are settled. Ties get their rank in the sample - here only equality counts,
so a rank is the 64-bit hash of the long context [p - V + 1, p + SPAN), sent whole - and ties of equal rank settle all SPAN-byte
strings around them. Only where ranks of one lead differ, at the ends of repeats, are the strings themselves
compared, again bucket by bucket.

A block of documents sends a bucket each distinct key once; buckets answer with bits in the order of the keys,
which the block can work out again. Blocks stay where they were written; no text is shuffled.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import bucketed, documents, materialize, part_number, rows_of

SPAN, PRIME = 200, 11
V = PRIME * PRIME + PRIME + 1
LEAD = SPAN - V + 1
#: Bytes of text in a block (a longer document is a block of its own); keys of a bucket; least buckets.
BLOCK, BUCKET_KEYS, LEAST_BUCKETS = 2 << 20, 1_000_000, 64
_BASE = 0x9E3779B97F4A7C15 | 1
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)


def difference_cover(q: int = PRIME) -> np.ndarray:
    """Singer's perfect difference set modulo q*q + q + 1 for a prime q: powers of a primitive element of
    GF(q**3) whose leading coefficient is zero."""
    v = q * q + q + 1
    for a in range(q):
        for b in range(q):
            for c in range(1, q):
                x, found, n = (0, 0, 1), [], 0
                while True:
                    if n < v and x[0] == 0:
                        found.append(n)
                    x = ((x[1] + a * x[0]) % q, (x[2] + b * x[0]) % q, c * x[0] % q)
                    n += 1
                    if x == (0, 0, 1):
                        break
                if n == q**3 - 1:
                    return np.array(found)
    raise ValueError(q)


_IN_COVER = np.zeros(V, bool)
_IN_COVER[difference_cover()] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, kept for the worker's next block."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, BLOCK + 1)
        up, down = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up), np.cumprod(down)]
    return _POWERS


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Block:
    """The texts of a block, end to end, with prefix hashes of all."""

    def __init__(self, data: bytes, lengths: np.ndarray) -> None:
        self.raw = np.frombuffer(data, np.uint8)
        n = len(self.raw)
        self.stop = np.cumsum(lengths.astype(np.int64))
        self.start = self.stop - lengths
        up, self.down = _powers(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[self.raw] * up[:n], out=self.sums[1:])

    def hash(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of the bytes [a, b)."""
        return _mix((self.sums[b] - self.sums[a]) * self.down[a])

    def sample(self) -> None:
        """Sampled positions with their lead keys, context keys, and the range of string starts they stand for."""
        long = np.flatnonzero(self.stop - self.start >= SPAN)
        size = self.stop[long] - self.start[long] - LEAD + 1
        doc = np.repeat(long, size)
        ends = np.cumsum(size)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)
        pick = _IN_COVER[within % V]
        doc, within = doc[pick], within[pick]
        p = self.start[doc] + within
        low, high = np.maximum(self.start[doc], p - V + 1), np.minimum(self.stop[doc], p + SPAN)
        lead = self.hash(p, p + LEAD)
        context = _mix(self.hash(low, high) + ((p - low) * 1024 + (high - p)).astype(np.uint64))
        self.first, self.last = low, np.minimum(p, high - SPAN)
        self.keys, self.at, self.times = _distinct(lead, context)

    def spread(self, which: np.ndarray) -> np.ndarray:
        """Marks the starts of strings that the chosen sample positions stand for."""
        edge = np.zeros(len(self.raw) + 1, np.int32)
        np.add.at(edge, self.first[which], 1)
        np.add.at(edge, self.last[which] + 1, -1)
        return np.cumsum(edge[:-1]) > 0

    def settle(self, status: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(starts known to repeat, starts still to be compared) from the answers to the distinct keys."""
        mine = status[self.at]
        fits = self.first <= self.last
        return self.spread((mine >= 2) & fits), self.spread(((mine == 1) | (mine == 3)) & fits)


def _distinct(lead: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct pairs in order, the pair of each position, occurrences of each pair)."""
    order = np.lexsort((context, lead))
    a, b = lead[order], context[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    which = np.cumsum(new) - 1
    at = np.empty(len(order), np.int64)
    at[order] = which
    return np.stack([a[new], b[new]], 1), at, np.bincount(which, minlength=int(new.sum()))


def _deal(lead: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket of the sorted keys begins, and where the last one ends."""
    bucket = (lead >> np.uint64(48)) * np.uint64(buckets) >> np.uint64(16)
    return np.searchsorted(bucket, np.arange(buckets + 1))


MESSAGE = "bucket int, part int, block int, payload binary"
_MESSAGE = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("block", pa.int32()), ("payload", pa.binary())])
BLOCKS = "part int, block int, doc_ids binary, known binary, lengths binary, data binary"
_BLOCKS = pa.schema([("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.binary()), ("known", pa.binary()), ("lengths", pa.binary()), ("data", pa.binary())])


def blocks_of(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """Documents of an input part, in its order, packed in rows of about BLOCK bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block = part_number(TaskContext.get().partitionId(), parts), 0
        ids, texts, size = [], [], 0

        def row() -> pa.RecordBatch:
            cols = [[part], [block], [np.array([i or 0 for i in ids], "<i8").tobytes()], [bytes(i is not None for i in ids)], [np.array([len(t) for t in texts], "<i8").tobytes()], [b"".join(texts)]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _BLOCKS)], schema=_BLOCKS)

        for b in batches:
            for i, t in zip(b.column(0).cast(pa.int64()).to_pylist(), b.column(1).to_pylist()):
                raw = (t or "").encode()
                if texts and size + len(raw) > BLOCK:
                    yield row()
                    ids, texts, size, block = [], [], 0, block + 1
                ids.append(i)
                texts.append(raw)
                size += len(raw)
        if texts:
            yield row()

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, BLOCKS)


def _load(r: dict) -> Block:
    block = Block(r["data"], np.frombuffer(r["lengths"], "<i8"))
    block.sample()
    return block


def _send(part: int, block: int, buckets: int, lead: np.ndarray, payload) -> Iterator[tuple]:
    edge = _deal(lead, buckets)
    for k in np.flatnonzero(edge[1:] > edge[:-1]).tolist():
        yield k, part, block, payload(slice(edge[k], edge[k + 1]))


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [()] * 4, _MESSAGE)], schema=_MESSAGE)


def lead_messages(blocks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            x = _load(r)
            six = np.ascontiguousarray(x.keys[:, 0]).view(np.uint8).reshape(-1, 8)[:, :6]
            rank, more = x.keys[:, 1].astype("<u8"), x.times > 1
            body = lambda s: np.ascontiguousarray(six[s]).tobytes() + rank[s].tobytes() + np.packbits(more[s]).tobytes()  # noqa: B023, E731
            yield _messages(list(_send(r["part"], r["block"], buckets, x.keys[:, 0], body)))

    return blocks.mapInArrow(run, MESSAGE)


def _reply(table: pa.Table, sizes: list[int], answer: np.ndarray) -> pa.Table:
    cut = np.split(answer, np.cumsum(sizes)[:-1])
    return table.set_column(3, "payload", pa.array([zlib.compress(a.astype(np.uint8).tobytes(), 1) for a in cut], pa.binary()))


def answer_leads(table: pa.Table) -> pa.Table:
    """0: the lead is unique; 2: all of its lead have their rank twice; else 3, or 1 where its own rank is unique."""
    six, rank, times, sizes = [], [], [], []
    for p in table.column("payload").to_pylist():
        n = next(n for n in (len(p) * 8 // 113 + d for d in range(-1, 3)) if 14 * n + (n + 7) // 8 == len(p))
        raw = np.frombuffer(p, np.uint8)
        eight = np.zeros((n, 8), np.uint8)
        eight[:, :6] = raw[: 6 * n].reshape(n, 6)
        six.append(eight.view("<u8").ravel())
        rank.append(np.frombuffer(p, "<u8", n, 6 * n))
        times.append(np.unpackbits(raw[14 * n :], count=n).astype(np.int64) + 1)
        sizes.append(n)
    lead, ranks, times = np.concatenate(six), np.concatenate(rank), np.concatenate(times)
    order = np.lexsort((ranks, lead))
    a, b = lead[order], ranks[order]
    new_lead, new_pair = np.ones(len(a), bool), np.ones(len(a), bool)
    new_lead[1:] = a[1:] != a[:-1]
    new_pair[1:] = new_lead[1:] | (b[1:] != b[:-1])
    pair, group = np.cumsum(new_pair) - 1, np.cumsum(new_lead) - 1
    twice = np.bincount(pair, times[order])[pair] > 1
    shared = np.bincount(group, times[order])[group] > 1
    whole = np.bincount(group, ~twice)[group] == 0
    out = np.empty(len(a), np.uint8)
    out[order] = np.where(~shared, 0, np.where(whole, 2, np.where(twice, 3, 1)))
    return _reply(table, sizes, out)


def answer_strings(table: pa.Table) -> pa.Table:
    """1 where a string of SPAN bytes occurs twice or more."""
    keys, sizes = [], []
    for p in table.column("payload").to_pylist():
        n = next(n for n in (len(p) * 8 // 65 + d for d in range(-1, 3)) if 8 * n + (n + 7) // 8 == len(p))
        keys.append(np.stack([np.frombuffer(p, "<u8", n), np.unpackbits(np.frombuffer(p, np.uint8)[8 * n :], count=n).astype(np.uint64) + np.uint64(1)], 1))
        sizes.append(n)
    every = np.concatenate(keys)
    _, at = np.unique(every[:, 0], return_inverse=True)
    return _reply(table, sizes, np.bincount(at, every[:, 1].astype(np.int64))[at] > 1)


def ask(messages: DataFrame, answer, parts: int) -> DataFrame:
    """part, replies: what the buckets answer to each part's blocks."""
    replies = messages.groupBy("bucket").applyInArrow(answer, MESSAGE)
    return materialize(replies.repartition(parts, "part").groupBy("part").agg(F.collect_list(F.struct("block", "bucket", "payload")).alias("replies")), "suffix-replies")


def _with(blocks: DataFrame, replies: DataFrame, name: str, parts: int) -> DataFrame:
    """blocks with their own replies in order of bucket; blocks stay in their buckets of the table."""
    side = replies.repartition(parts, "part").withColumnRenamed("replies", name).hint("shuffle_hash")
    own = F.array_sort(F.transform(F.filter(name, lambda r: r["block"] == F.col("block")), lambda r: F.struct(r["bucket"], r["payload"])))
    return blocks.join(side, "part", "left").withColumn(name, own)


def _bits(replies: list[dict] | None) -> np.ndarray:
    return np.frombuffer(b"".join(zlib.decompress(r["payload"]) for r in replies or ()), np.uint8)


def _open(x: Block, r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts known to repeat, open starts, hashes of their strings), given the answers to the leads."""
    bits = _bits(r["leads"])
    if not len(bits):
        bits = np.zeros(len(x.keys), np.uint8)
    known, todo = x.settle(bits)
    at = np.flatnonzero(todo)
    return known, at, x.hash(at, at + SPAN)


def string_messages(blocks: DataFrame, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            if not any(any(zlib.decompress(m["payload"])) for m in r["leads"] or ()):
                continue
            _, _, strings = _open(_load(r), r)
            keys, times = np.unique(strings, return_counts=True)
            body = lambda s: keys[s].astype("<u8").tobytes() + np.packbits(times[s] > 1).tobytes()  # noqa: B023, E731
            yield _messages(list(_send(r["part"], r["block"], buckets, keys, body)))

    return blocks.mapInArrow(run, MESSAGE)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def _removed(r: dict) -> tuple[np.ndarray, Block]:
    """Marks the bytes of a block that a repeated string covers."""
    x = _load(r)
    known, at, strings = _open(x, r)
    bits = _bits(r["strings"])
    if len(bits):
        _, which = np.unique(strings, return_inverse=True)
        known[at[bits[which] > 0]] = True
    edge = np.zeros(len(x.raw) + 1, np.int32)
    starts = np.flatnonzero(known)
    edge[starts] += 1
    edge[starts + SPAN] -= 1
    return np.cumsum(edge[:-1]) > 0, x


def results(blocks: DataFrame, kept: bool) -> DataFrame:
    """RESULT rows; kept adds the remaining bytes as `text`."""
    schema = RESULT + (", text string" if kept else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in rows_of(batches):
            gone, x = _removed(r)
            out = []
            for i, has, a, z in zip(np.frombuffer(r["doc_ids"], "<i8").tolist(), r["known"], x.start.tolist(), x.stop.tolist()):
                g = gone[a:z]
                left = x.raw[a:z][~g].tobytes()
                spans = int(g[0]) + int((g[1:] & ~g[:-1]).sum()) if z > a else 0
                out.append((i if has else None, z - a, int(g.sum()), spans, hashlib.sha256(left).hexdigest(), *([left.decode(errors="replace")] if kept else [])))
            kinds = [pa.int64()] * 4 + [pa.string()] * (2 if kept else 1)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[f.split(" ")[0] for f in schema.split(", ")])

    return blocks.mapInArrow(run, schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", kept: bool = False) -> DataFrame:
    """What is left of every document without the bytes that any repeated SPAN-byte string covers.

    A null text is empty. Documents shorter than SPAN lose nothing. Repeated rows count as repeats of each
    other and all come back. An empty table gives an empty result; other columns are not read. With kept, the
    remaining bytes come back as `text`; where a cut falls inside a character, its rest becomes U+FFFD.
    """
    parts = max(1, docs.select(F.col(key).cast("long"), F.col(text)).rdd.getNumPartitions())
    blocks, _ = bucketed(blocks_of(docs, key, text, parts), parts, "suffix-blocks")
    total = blocks.select(F.coalesce(F.sum(F.length("data")), F.lit(0)).alias("n")).first()["n"]
    buckets = min(1 << 16, max(LEAST_BUCKETS, int(total * (PRIME + 1) / V) // BUCKET_KEYS))
    leads = ask(lead_messages(blocks, buckets), answer_leads, parts)
    one = _with(blocks, leads, "leads", parts)
    strings = ask(string_messages(one, buckets), answer_strings, parts)
    return results(_with(one, strings, "strings", parts), kept)


def op4_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))

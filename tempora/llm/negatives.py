"""Hard-negative mining: windows of scores as annuli around an anchor, searched by vantage-point trees.

Vectors get one more component that gives all of them the norm of the longest, anchors a zero. A greater inner product
is then a smaller distance, and a window of scores an annulus around the anchor. A small tree over a bounded sample
deals all vectors out to cells; a cell's vectors go to blocks of about BLOCK rows, each with a tree of its own, and
every vector is indexed. A tree keeps, for each leaf, the least and greatest distance of its rows from the vantage points
above it: by the triangle inequality these tell how near to a query, and how far, its rows may be.

A search asks each query's nearest cell first. What it finds there bounds the distance that still counts, and only
cells and leaves that reach into the annulus within that bound are asked, the nearest first, in waves that double.
Distances only rule out; what is found is compared by exact integer scores.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.llm.common import bucketed, discard, materialize, rows_of

#: Rows of a block and of a leaf, about; queries that meet a block at once.
BLOCK, LEAF, PACK = 4096, 128, 1024
#: The sample that the cells' tree is fitted on: numbers in all, and rows at most. Cells at most.
SAMPLE_NUMBERS, SAMPLE_ROWS, CELLS = 1 << 20, 4096, 256
#: Buckets of the index at most.
BUCKETS = 4096
#: Squared norms from here on are beyond exact sums of products; times the rows of a leaf they still fit a long.
TOO_LONG = float(1 << 53)
#: Part of the longest norm by which a distance may be off.
SLACK = 1e-6
NONE = np.iinfo(np.int64).max


def vectors(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """row, id, label, vec (components times 256, floored), norm (squared) of the rows that take part.

    Out are rows with a null label, a null vector or a component that is null or not finite; so are vectors of a
    squared norm of 2**53 or more, whose scores would not be exact. A null key counts as the greatest.
    """
    x = F.transform(F.col(vector), lambda v: F.floor(256 * v.cast("double")))
    known = F.col(label).isNotNull() & F.col(vector).isNotNull()
    bad = F.exists(F.col(vector), lambda v: v.isNull() | F.isnan(v.cast("double")) | (F.abs(v.cast("double")) >= 2.0**20))
    norm = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v * v)
    taken = rows.where(known).where(~bad).select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(key).cast("long"), F.lit(NONE)).alias("id"), F.col(label).cast("long").alias("label"), F.transform(x, lambda v: v.cast("double")).alias("vec"))
    return taken.withColumn("norm", norm).where(F.col("norm") < TOO_LONG)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """Vectors as rows; a short one ends in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (sizes == dims).all():
        return flat.reshape(len(column), dims)
    out = np.zeros((len(column), dims))
    at = np.repeat(np.arange(len(column)), sizes)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def _root(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(x, 0.0))


@dataclass
class Tree:
    """The last level of a vantage-point tree: 2**depth leaves, and their distances from the points above them.

    points: the vantage points in heap order; ups: their added component; low, high: of each leaf, level by level.
    splits: the distance up to which a node's rows go left. top: the greatest squared norm.
    """

    depth: int
    points: np.ndarray
    ups: np.ndarray
    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    top: float

    def above(self) -> np.ndarray:
        """The nodes above each leaf, from the root on."""
        leaf = np.arange(1 << self.depth) + (1 << self.depth)
        return np.stack([leaf >> (self.depth - level) for level in range(self.depth)], 1) - 1 if self.depth else np.zeros((1, 0), np.int64)

    def bounds(self, query: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(nearest, farthest) that a row of each leaf may be to each query."""
        n = len(query), 1 << self.depth
        near, far = np.zeros(n), np.full(n, np.inf)
        if self.depth:
            d = _root(self.top + norm[:, None] - 2 * query @ self.points.T)
            for level, node in enumerate(self.above().T):
                own = d[:, node]
                near = np.maximum(near, np.maximum(own - self.high[:, level], self.low[:, level] - own))
                far = np.minimum(far, own + self.high[:, level])
        return near, far

    def deal(self, x: np.ndarray, norm: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(leaf, distances from the nodes above it) of each of x."""
        d = _root(2 * self.top - 2 * (x @ self.points.T + _root(self.top - norm)[:, None] * self.ups)) if self.depth else np.zeros((len(x), 0))
        node, each, own = np.zeros(len(x), np.int64), np.arange(len(x)), []
        for _ in range(self.depth):
            own.append(d[each, node])
            node = 2 * node + 1 + (own[-1] > self.splits[node])
        return node - ((1 << self.depth) - 1), np.stack(own, 1) if own else d


def plant(x: np.ndarray, norm: np.ndarray, top: float, leaves: int) -> tuple[Tree, np.ndarray, np.ndarray]:
    """A tree over x of so many leaves, a power of two and at most the rows; the order in which leaves are slices of
    the rows; the rows that are vantage points.

    A node's rows are sorted by distance from its vantage point and halved, so that copies part too; the point is
    the farthest from the one above.
    """
    depth = leaves.bit_length() - 1
    n, order, up = len(x), np.arange(len(x)), _root(top - norm)
    picked, splits = np.zeros(leaves - 1, np.int64), np.zeros(leaves - 1)
    low, high = np.zeros((leaves, depth)), np.zeros((leaves, depth))
    for level in range(depth):
        for i in range(1 << level):
            a, middle, z = n * i >> level, n * (2 * i + 1) >> (level + 1), n * (i + 1) >> level
            own, node = order[a:z], (1 << level) - 1 + i
            picked[node] = p = own[-1]
            d = _root(2 * top - 2 * (x[own] @ x[p] + up[own] * up[p]))
            by = np.argsort(d, kind="stable")
            order[a:z], d, middle = own[by], d[by], middle - a
            splits[node] = d[middle - 1]
            span = 1 << (depth - level - 1)
            for half, part in ((0, d[:middle]), (1, d[middle:])):
                leaf = slice((2 * i + half) * span, (2 * i + half + 1) * span)
                low[leaf, level], high[leaf, level] = part[0], part[-1]
    return Tree(depth, x[picked], up[picked], splits, low, high, top), order, picked


def _leaves(rows: int, size: int, most: int) -> int:
    """A power of two of leaves that hold `size` rows or more."""
    return 1 << max(1, min(rows // size, most)).bit_length() - 1


INDEX = "part int, top double, rows binary, ids binary, labels binary, vecs binary, edges binary, picked binary, low binary, high binary"
_INDEX = pa.schema([("part", pa.int32()), ("top", pa.float64()), *[(f.split(" ")[0], pa.binary()) for f in INDEX.split(", ")[2:]]])


def _planted(dims: int, top: float):
    """A block of vectors as one row of INDEX."""

    def run(table: pa.Table) -> pa.Table:
        x, norm = _matrix(table.column("vec"), dims), table.column("norm").to_numpy()
        ids, rows = table.column("id").to_numpy(), table.column("row").to_numpy()
        first = np.lexsort((rows, ids))
        x, norm = x[first], norm[first]
        tree, order, picked = plant(x, norm, top, _leaves(len(x), LEAF, len(x)))
        edges = np.array([len(x) * i >> tree.depth for i in range((1 << tree.depth) + 1)])
        for a, z in zip(edges, edges[1:]):
            order[a:z].sort()  # by id within a leaf
        place = np.empty(len(x), np.int64)
        place[order] = np.arange(len(x))
        whole = lambda v: v.astype("<i8").tobytes()
        cols = [rows[first][order], ids[first][order], table.column("label").to_numpy()[first][order]]
        row = [table.column("part")[0].as_py(), top, *map(whole, cols), x[order].astype("<i4").tobytes(), whole(edges), whole(place[picked]), tree.low.tobytes(), tree.high.tobytes()]
        return pa.Table.from_arrays([pa.array([v], f.type) for v, f in zip(row, _INDEX)], schema=_INDEX)

    return run


class Block:
    """A block read back from the index."""

    def __init__(self, r: dict) -> None:
        whole = lambda name: np.frombuffer(r[name], "<i8")
        self.rows, self.ids, self.labels, self.edges = map(whole, ("rows", "ids", "labels", "edges"))
        self.x = np.frombuffer(r["vecs"], "<i4").reshape(len(self.ids), -1).astype(np.float64)
        depth, picked = (len(self.edges) - 1).bit_length() - 1, whole("picked")
        edge = lambda name: np.frombuffer(r[name]).reshape(1 << depth, depth)
        up = _root(r["top"] - (self.x[picked] ** 2).sum(1))
        self.tree = Tree(depth, self.x[picked], up, np.zeros(0), edge("low"), edge("high"), r["top"])

    def search(self, q: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, score, id): the first k rows, by score downwards and id, of each query's window that its condition
        on the label admits; q["bound"]: a score that k rows elsewhere are known to reach."""
        near, far = self.tree.bounds(q["vec"], q["norm"])
        distance = lambda score: _root(self.tree.top + q["norm"] - 2 * score)
        slack = SLACK * np.sqrt(self.tree.top)
        inner = distance(np.where(np.isinf(q["most"]), 0, q["most"]))
        inner[np.isinf(q["most"])] = 0
        near = np.maximum(near, inner[:, None])
        leaves = np.argsort(near, 1, kind="stable")
        near = np.take_along_axis(near, leaves, 1)
        reaches = np.take_along_axis(far, leaves, 1) >= inner[:, None] - slack
        n = len(near)
        bound = np.maximum(q["bound"], q["least"])
        found = (np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        at, width = 0, 1
        while at < leaves.shape[1]:
            outer = distance(np.where(np.isinf(bound), 0, bound))
            outer[np.isinf(bound)] = np.inf
            open_ = (near[:, at : at + width] <= outer[:, None] + slack) & reaches[:, at : at + width]
            if not (near[:, at] <= outer + slack).any():
                break
            who, which = np.nonzero(open_)
            leaf = leaves[who, at + which]
            by = np.argsort(leaf, kind="stable")
            more = [found]
            for own in np.split(by, np.flatnonzero(np.diff(leaf[by])) + 1):
                if len(own):
                    more.append(self._scored(q, who[own], int(leaf[own[0]]), bound, k))
            found = _first(*map(np.concatenate, zip(*more)), k)
            full = np.bincount(found[0], minlength=n) >= k
            last = np.searchsorted(found[0], np.arange(n), "right") - 1
            if len(found[0]):
                bound = np.where(full, np.maximum(bound, found[1][last]), bound)
            at, width = at + width, 2 * width
        return found

    def _scored(self, q: dict[str, np.ndarray], who: np.ndarray, leaf: int, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a, z = self.edges[leaf], self.edges[leaf + 1]
        score = q["vec"][who] @ self.x[a:z].T
        fits = ((self.labels[a:z] == q["label"][who][:, None]) == q["same"][who][:, None]) & (score >= bound[who][:, None]) & (score <= q["most"][who][:, None]) & (self.rows[a:z] != q["row"][who][:, None])
        some = np.flatnonzero(fits.any(1))
        size = z - a
        # rows of a leaf stand by id: an earlier place wins a tie
        order = np.where(fits[some], score[some].astype(np.int64) * size + (size - 1 - np.arange(size)), -NONE)
        at = np.argpartition(order, max(0, size - k), 1)[:, -k:]
        row, col = np.repeat(some, at.shape[1]), at.ravel()
        good = fits[row, col]
        row, col = row[good], col[good]
        return who[row], score[row, col], self.ids[a + col]


def _first(who: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k of each query, by score downwards and id."""
    by = np.lexsort((ids, -score, who))
    who, score, ids = who[by], score[by], ids[by]
    place = np.arange(len(who)) - np.searchsorted(who, who, "left")
    return who[place < k], score[place < k], ids[place < k]


@dataclass
class Index:
    """Blocks by part in a bucketed table, the cells' tree, and the parts of a cell: blocks[c] from first[c] on."""

    table: DataFrame
    path: str
    cells: Tree
    first: np.ndarray
    blocks: np.ndarray
    dims: int


def index(rows: DataFrame) -> Index:
    """Of materialized vectors(). The tree of the cells is fitted on the rows of the least hashes; all are indexed."""
    told = rows.agg(F.count("*").alias("n"), F.max("norm").alias("top"), F.max(F.size("vec")).alias("dims")).first()
    n, top, dims = told["n"], told["top"] or 0.0, told["dims"] or 0
    some = rows.orderBy(F.xxhash64("id", "row")).limit(min(SAMPLE_ROWS, max(64, SAMPLE_NUMBERS // max(1, dims)))).select("vec", "norm").toArrow()
    tree, _, _ = plant(_matrix(some.column("vec"), dims), some.column("norm").to_numpy(), top, _leaves(n, BLOCK, min(CELLS, len(some) // 16)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            leaf, far = tree.deal(_matrix(b.column("vec"), dims), b.column("norm").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf.astype(np.int32)), pa.array(list(far), pa.list_(pa.float64()))], names=[*b.schema.names, "cell", "far"])

    dealt = materialize(rows.mapInArrow(deal, "row long, id long, label long, vec array<double>, norm double, cell int, far array<double>"), "vantage-cells")
    sizes, tree.low[:], tree.high[:] = np.zeros(1 << tree.depth, np.int64), np.inf, -np.inf
    edges = [f(F.col("far")[i]).alias(f"{name}{i}") for i in range(tree.depth) for f, name in ((F.min, "low"), (F.max, "high"))]
    for r in dealt.groupBy("cell").agg(F.count("*").alias("n"), *edges).collect():  # at most CELLS rows
        sizes[r["cell"]] = r["n"]
        for i in range(tree.depth):
            tree.low[r["cell"], i], tree.high[r["cell"], i] = r[f"low{i}"], r[f"high{i}"]
    blocks = -(-sizes // BLOCK)
    first = np.cumsum(blocks) - blocks
    ints = lambda a: F.get(F.array(*[F.lit(int(v)) for v in a]), F.col("cell"))
    parted = dealt.withColumn("part", (ints(first) + F.pmod(F.xxhash64("row"), F.greatest(ints(blocks), F.lit(1)))).cast("int"))
    built = parted.select("part", "row", "id", "label", "vec", "norm").groupBy("part").applyInArrow(_planted(dims, top), INDEX)
    buckets = int(min(BUCKETS, max(1, blocks.sum())))
    table, path = bucketed(built.repartition(buckets, "part"), buckets, "vantage-index", listed=False)
    discard(dealt)
    return Index(table, path, tree, first, blocks, dims)


QUERY = "q long, row long, label long, same boolean, vec array<double>, norm double, least double, most double, bound double"
_FIELDS = [f.split(" ")[0] for f in QUERY.split(", ")]
FOUND = "q long, score double, id long"


def _arrays(b: pa.RecordBatch | pa.StructArray, dims: int) -> dict[str, np.ndarray]:
    get = b.column if isinstance(b, pa.RecordBatch) else b.field
    return {f: _matrix(get(f), dims) if f == "vec" else get(f).to_numpy(zero_copy_only=False) for f in _FIELDS}


def _sent(queries: DataFrame, over: Index, home: bool) -> DataFrame:
    """queries with the part of each block that they have to ask: those of the nearest cell, or of all others that
    reach into the annulus as far as the bound allows."""
    cells, first, blocks, dims = over.cells, over.first, over.blocks, over.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slack = SLACK * np.sqrt(cells.top)
        for b in batches:
            q = _arrays(b, dims)
            near, far = cells.bounds(q["vec"], q["norm"])
            inner, outer = (_root(cells.top + q["norm"] - 2 * np.where(np.isinf(q[x]), 0, q[x])) for x in ("most", "bound"))
            inner[np.isinf(q["most"])], outer[np.isinf(q["bound"])] = 0, np.inf
            near = np.where(blocks > 0, np.maximum(near, inner[:, None]), np.inf)
            nearest = np.zeros(near.shape, bool)
            nearest[np.arange(len(near)), near.argmin(1)] = True
            ask = nearest if home else ~nearest & (blocks > 0) & (near <= outer[:, None] + slack) & (far >= inner[:, None] - slack)
            who, cell = np.nonzero(ask)
            times = blocks[cell]
            part = np.repeat(first[cell], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            to = pa.array(np.repeat(who, times))
            yield pa.RecordBatch.from_arrays([*[c.take(to) for c in b.columns], pa.array(part.astype(np.int32))], names=[*b.schema.names, "part"])

    return queries.select(_FIELDS).mapInArrow(run, QUERY + ", part int")


def _asked(sent: DataFrame, over: Index, k: int, packs: int) -> DataFrame:
    """FOUND: of every query and block the first k."""
    pack = sent.groupBy("part", F.pmod(F.xxhash64("q"), F.lit(packs)).alias("pack")).agg(F.collect_list(F.struct(_FIELDS)).alias("queries"))
    pairs = pack.join(over.table, "part").select("queries", *[f for f in over.table.columns if f != "part"])
    dims = over.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block = Block({f: b.column(f)[i].as_py() for f in b.schema.names if f != "queries"})
                q = _arrays(b.column("queries")[i].values, dims)
                who, score, ids = block.search(q, k)
                yield pa.RecordBatch.from_arrays([pa.array(q["q"][who]), pa.array(score), pa.array(ids)], names=["q", "score", "id"])

    return pairs.mapInArrow(run, FOUND)


def search(queries: DataFrame, over: Index, k: int) -> DataFrame:
    """q, n (from 1), score, id: for every query (columns of QUERY without bound) the first k rows of the index by
    score downwards, then id, other than its own row, whose score lies in [least, most] and whose label is its own
    (same) or another. Exact."""
    queries = materialize(queries.withColumn("bound", F.col("least")), "vantage-queries")
    packs = -(-queries.count() // PACK) or 1
    first = materialize(_asked(_sent(queries, over, True), over, k, packs), "vantage-found")
    order = Window.partitionBy("q").orderBy(F.col("score").desc(), "id")
    if over.cells.depth:
        best = first.withColumn("n", F.row_number().over(order)).where(F.col("n") == k).select("q", F.col("score").alias("kth"))
        told = queries.join(best, "q", "left").withColumn("bound", F.coalesce("kth", "bound"))
        first = first.union(_asked(_sent(told, over, False), over, k, packs))
    out = materialize(first.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("q", "n", "score", "id"), "vantage-best")
    discard(queries)
    return out


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: those of vectors(). For each row that meets `anchor` and each of the first `positives` other rows of its
    label, the first `negatives` rows of other labels whose score is low to high percent of the positive's. Scores are
    integer inner products, higher ones come first, ties go to the smaller id. Rows are told apart as rows: repeats
    of an anchor are its positives, and each is an anchor. A shorter vector counts as one that ends in zeros. An anchor
    without a positive, or a positive without a negative, has no row; nor has an empty table.
    """
    rows = materialize(rows, "vantage-rows")
    over = index(rows)
    asking = materialize(rows.where(anchor).select(F.col("row").alias("q"), "row", F.col("id").alias("anchor_id"), "label", "vec", "norm"), "vantage-anchors")
    inf = F.lit(float("inf"))
    near = search(asking.select("q", "row", "label", F.lit(True).alias("same"), "vec", "norm", (-inf).alias("least"), inf.alias("most")), over, positives)
    score = F.col("score").cast("long")
    pairs = near.where("score >= 0").select("q", (F.col("q") * positives + F.col("n") - 1).alias("pair"), F.col("id").alias("positive_id"), score.alias("positive_score"))
    told = asking.join(pairs, "q")
    least, most = F.expr(f"(positive_score * {low} + 99) div 100"), F.expr(f"positive_score * {high} div 100")
    wanted = told.select(F.col("pair").alias("q"), "row", "label", F.lit(False).alias("same"), "vec", "norm", least.cast("double").alias("least"), most.cast("double").alias("most")).where("least <= most")
    hard = search(wanted, over, negatives).select(F.col("q").alias("pair"), F.col("n").alias("rank"), F.col("id").alias("negative_id"), score.alias("negative_score"))
    out = told.select("anchor_id", "pair", "positive_id", "positive_score").join(hard, "pair")
    known = lambda c: F.nullif(F.col(c), F.lit(NONE)).alias(c)
    return out.select(known("anchor_id"), known("positive_id"), "rank", known("negative_id"), "positive_score", "negative_score")


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    moved = F.when((F.col("id") != NONE) & (F.col("id") % 7 == 0), (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", moved), (F.col("id") != NONE) & (F.col("id") % 50 == 0))

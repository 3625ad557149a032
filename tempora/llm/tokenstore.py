"""A content-addressed store of token ids.

Each document's ids, with an end id, are cut into chunks where a rolling hash over the last ids says so, so that
equal passages give equal chunks wherever they stand. A chunk is named by its hash and stored once. A document's
recipe lists its chunk names in order, under the root of their Merkle tree; a manifest holds a root for every
SHARD documents in a row, and a head counts the documents and ids of all.

Tables of a store: chunks (name, ids), recipes (in ascending order of doc_id, with the position of the document in
the stream of all ids), manifest, head (with the bytes of an id). Reading starts from the recipes: it fetches chunks by name, and fails if a
chunk, a document or a shard is missing or other than its name or root says.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tempora.llm.bpe import SPACE, byte_symbols
from tempora.llm.common import discard, documents, materialize, scratch

END, REMEMBERED = 2, 1_200_000
#: Ids under the rolling hash are 2**WINDOW_STEPS; a cut where its low bits are zero; least and most ids of a chunk.
WINDOW_STEPS, CUT_MASK, LEAST, MOST = 4, np.uint64(511), 64, 4096
NAME = 16
#: Ranges of doc_id that running totals are computed in; documents under a root of the manifest.
RANGES, SHARD = 1024, 4096
#: White space that isn't ASCII's or splits otherwise; texts with it, or with a zero byte, are cut with care.
_RARE = re.compile(r"[\x00\x1c-\x1f\x85\xa0  -     　]")
_EDGE = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])")
#: Fixed value: the pre-tokens of the byte-level tokenizer.
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
_BLANK, _ALNUM, _SIGN = np.zeros((3, 256), bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_ALNUM[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = True
_SIGN[33:127] = ~_ALNUM[33:127]
#: Masks of the first 0 to 8 bytes of a little-endian number.
_FIRST = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-spread 64-bit value of each number."""
    x = x.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Encoder:
    """The tokenizers library's ids. Texts are cut where pre-tokens always begin - before white space that follows
    something else, and before a sign that follows an ASCII letter or digit. The distinct pieces of a block are found by their bytes, and each is encoded once, by the
    library's model, and remembered."""

    def __init__(self, path: str) -> None:
        self.inner = Tokenizer.from_file(path)
        self.model = self.inner.model
        self.kind = np.dtype("<u2" if self.inner.get_vocab_size() <= 1 << 16 else "<u4")
        self.stand = dict(enumerate(byte_symbols()))
        self.ids: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.gear = mixed(np.arange(max(1 << 16, self.inner.get_vocab_size())))

    def learn(self, piece: bytes) -> bytes:
        """Ids of a piece as bytes; the generation before last is forgotten."""
        found = self.old.get(piece)
        if found is None:
            text, tokenize, stand = piece.decode(), self.model.tokenize, self.stand
            if text[1:].isalpha() and (text[0] == " " or text[0].isalpha()):
                ascii_ = len(text) == len(piece)
                out = tokenize((stand[32] + text[1:] if text[0] == " " else text) if ascii_ else piece.decode("latin-1").translate(stand))
            else:
                out = [t for w in PIECE.findall(text) for t in tokenize(w.encode().decode("latin-1").translate(stand))]
            found = array(self.kind.char, [t.id for t in out]).tobytes()
        if len(self.ids) >= REMEMBERED // 2:
            self.old, self.ids = self.ids, {}
        self.ids[piece] = found
        return found

    def pieces(self, data: bytes, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(first byte of each piece, which distinct piece it is, the distinct pieces) of texts laid end to end.

        Pieces of up to 24 bytes are told apart by three numbers that hold all their bytes; longer ones by a
        dictionary. Equal pieces are brought together by a sort of hashes, then compared whole.
        """
        raw = np.frombuffer(data + bytes(24), np.uint8)
        blank, sign = _BLANK[raw[: len(data)]], _SIGN[raw[: len(data)]]
        mark = np.zeros(len(data), bool)
        mark[1:] = (blank[1:] & ~blank[:-1]) | (sign[1:] & _ALNUM[raw[: len(data) - 1]])
        mark[begin] = True
        start = np.flatnonzero(mark)
        size = np.diff(np.append(start, len(data)))
        at = np.ndarray((len(data) + 17,), "<u8", raw, 0, (1,))  # the 8 bytes from every byte on
        keys = [at[start + 8 * k] & _FIRST[np.clip(size - 8 * k, 0, 8)] for k in range(3)]
        h = mixed(keys[0] ^ mixed(keys[1] ^ mixed(keys[2])))
        bits = np.uint64(max(20, len(h).bit_length()))
        h = np.sort(h >> bits << bits | np.arange(len(h), dtype=np.uint64))  # by hash, the place in the low bits
        place = (h & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
        new = np.ones(len(h), bool)
        new[1:] = h[1:] >> bits != h[:-1] >> bits
        which, first = np.empty(len(h), np.int64), place[new]
        which[place] = np.cumsum(new) - 1
        same = size <= 24
        for k in keys:
            same &= k == k[first][which]
        distinct = [data[i:j] for i, j in zip(start[first].tolist(), (start + size)[first].tolist())]
        odd = np.flatnonzero(~same).tolist()  # few: long pieces, and two that share a hash
        told = {p: j for j, p in enumerate(distinct)} if odd else {}
        for i in odd:
            piece = data[start[i] : start[i] + size[i]]
            if (j := told.get(piece)) is None:
                j = told[piece] = len(distinct)
                distinct.append(piece)
            which[i] = j
        return start, which, distinct

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts end to end, each with the end id; where each text's ids stop)."""
        raw = [b"" if "<|" in t or _RARE.search(t) else t.encode() for t in texts]
        length = np.array([len(r) for r in raw], np.int64)
        stop = np.cumsum(length)
        data = b"".join(raw)
        owned = np.zeros(0, np.int64)
        total = np.zeros(len(texts) + 1, np.int64)
        if data:
            start, which, distinct = self.pieces(data, (stop - length)[length > 0])
            known = self.ids.get
            table = [known(p) or self.learn(p) for p in distinct]
            flat = np.frombuffer(b"".join(table), self.kind)
            n = np.array([len(t) for t in table], np.int64) // self.kind.itemsize
            size = n[which]
            owner = np.searchsorted(stop, start, side="right")
            total[1:] = np.bincount(owner, size, len(texts))
            owned = flat[np.repeat((np.cumsum(n) - n)[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        other = {i: self._with_care(t) for i, t in enumerate(texts) if not raw[i] and t}
        for i, ids in other.items():
            total[i + 1] = len(ids)
        edge = np.cumsum(total + 1) - 1  # of ids and end ids before each text
        out = np.full(edge[-1], END, self.kind)
        room = np.ones(len(out), bool)
        room[edge[1:] - 1] = False
        for i, ids in other.items():
            out[edge[i] : edge[i] + len(ids)] = ids
            room[edge[i] : edge[i] + len(ids)] = False
        out[room] = owned
        return out, edge[1:]

    def _with_care(self, text: str) -> list[int]:
        """Texts with special tokens go to the library whole; of the others with rare white space each piece does."""
        if "<|" in text:
            return self.inner.encode(text, add_special_tokens=False).ids
        parts = [p.encode() for p in _EDGE.split(text)]
        return np.frombuffer(b"".join(self.ids.get(p) or self.learn(p) for p in parts), self.kind).tolist()

    def cuts(self, ids: np.ndarray, stops: np.ndarray) -> list[list[int]]:
        """Where the chunks of each text end. The hash looks at 16 ids, fewer than a chunk has, so that those of
        the text before never count."""
        h = self.gear[ids]
        for k in range(WINDOW_STEPS):
            n = 1 << k
            if len(h) > n:
                h[n:] = h[n:] + (h[:-n] << np.uint64(n))
        marks = np.flatnonzero((h & CUT_MASK) == 0) + 1
        at, out, begin = np.searchsorted(marks, stops, side="right").tolist(), [], 0
        marks, last = marks.tolist(), 0
        for stop, upto in zip(stops.tolist(), at):
            own = []
            for c in [*marks[last:upto], stop]:
                while c - begin > MOST:
                    begin += MOST
                    own.append(begin)
                if c - begin >= LEAST or c == stop > begin:
                    own.append(c)
                    begin = c
            out.append(own)
            last = upto
        return out


_MADE: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One for each Python worker and file."""
    if path not in _MADE:
        _MADE[path] = Encoder(path)
    return _MADE[path]


def name_of(chunk: bytes) -> bytes:
    return hashlib.blake2b(chunk, digest_size=NAME).digest()


def merkle(names: bytes) -> bytes:
    """Root over names laid end to end; levels pair up neighbours, an odd last one moves up."""
    row = [names[i : i + NAME] for i in range(0, len(names), NAME)] or [name_of(b"")]
    while len(row) > 1:
        row = [name_of(b"".join(row[i : i + 2])) if i + 1 < len(row) else row[i] for i in range(0, len(row), 2)]
    return row[0]


#: Documents, and code points of them, that are encoded together.
BLOCK_DOCS, BLOCK_CHARS = 3_000, 6_000_000
CUT = "doc_id long, n_tokens long, root binary, names array<binary>, fresh array<struct<name:binary,ids:binary>>"
_FRESH = pa.struct([("name", pa.binary()), ("ids", pa.binary())])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[int | None, str]]]:
    held, size = [], 0
    for b in batches:
        for doc, text in zip(b.column(0).cast(pa.int64()).to_pylist(), b.column(1).to_pylist()):
            if held and (len(held) == BLOCK_DOCS or size + len(text or "") > BLOCK_CHARS):
                yield held
                held, size = [], 0
            held.append((doc, text or ""))
            size += len(text or "")
    if held:
        yield held


def cut_up(docs: DataFrame, path: str, key: str, text: str) -> DataFrame:
    """A CUT row for each document: its chunk names, and the chunks that its block shows for the first time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for held in _blocks(batches):
            ids, stops = enc.encode([t for _, t in held])
            raw, width, begin, seen = ids.tobytes(), ids.itemsize, 0, set()
            names, fresh, chunks, n_names, n_fresh, roots = [], [], [], [0], [0], []
            for ends in enc.cuts(ids, stops):
                for stop in ends:
                    chunk = raw[width * begin : width * stop]
                    names.append(name := name_of(chunk))
                    if name not in seen:
                        seen.add(name)
                        fresh.append(name)
                        chunks.append(chunk)
                    begin = stop
                roots.append(merkle(b"".join(names[n_names[-1] :])))
                n_names.append(len(names))
                n_fresh.append(len(fresh))
            new = pa.StructArray.from_arrays([pa.array(fresh, pa.binary()), pa.array(chunks, pa.binary())], fields=list(_FRESH))
            cols = [pa.array([i for i, _ in held], pa.int64()), pa.array(np.diff(stops, prepend=0)), pa.array(roots, pa.binary()), pa.ListArray.from_arrays(pa.array(n_names, pa.int32()), pa.array(names, pa.binary())), pa.ListArray.from_arrays(pa.array(n_fresh, pa.int32()), new)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "n_tokens", "root", "names", "fresh"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, CUT)


def running_start(rows: DataFrame) -> DataFrame:
    """rows with `start`, the ids of all documents before, and `shard`: ranges of doc_id first, then within."""
    bounds = rows.approxQuantile("doc_id", [i / RANGES for i in range(1, RANGES)], 1 / (4 * RANGES))  # nulls are left out
    at = F.lit(-1)
    if bounds:
        edges = F.lit(sorted({int(b) for b in bounds}))
        at = F.coalesce(F.size(F.filter(edges, lambda e: e <= F.col("doc_id"))), F.lit(-1))
    ranged = materialize(rows.withColumn("range", at), "store-ranges")
    sums = sorted((r["range"], r["n"]) for r in ranged.groupBy("range").agg(F.sum("n_tokens").alias("n")).collect())  # at most RANGES + 1 rows
    before, total = [], 0
    for k, n in sums:
        before.append((k, total))
        total += n
    offsets = rows.sparkSession.createDataFrame(before, "range int, before long")
    order = Window.partitionBy("range").orderBy(F.col("doc_id").asc_nulls_first(), "root")
    own = F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1))
    shard = F.floor((F.row_number().over(order) - 1) / SHARD).cast("int")
    return ranged.join(F.broadcast(offsets), "range").withColumns({"start": F.col("before") + F.coalesce(own, F.lit(0)), "shard": shard}).drop("before")


MANIFEST = "range int, shard int, first long, n_docs long, n_tokens long, root binary"


def shards(recipes: DataFrame) -> DataFrame:
    """A MANIFEST row for every shard, from its recipes alone."""
    listed = recipes.groupBy("range", "shard").agg(F.min("start").alias("first"), F.count("*").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.array_sort(F.collect_list(F.struct("start", "root"))).alias("x"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            roots = [merkle(b"".join(own)) for own in b.column(5).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(roots, pa.binary())], names=["range", "shard", "first", "n_docs", "n_tokens", "root"])

    return listed.select("range", "shard", "first", "n_docs", "n_tokens", F.col("x.root").alias("roots")).mapInArrow(run, MANIFEST)


def build(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> dict[str, DataFrame]:
    """Write the store of docs; its tables chunks, recipes, manifest, head.

    A null text has the end id alone. Repeated rows have recipes of their own and share all chunks. Null keys
    come first in the stream; rows of one key stand in the order of their roots. An empty table gives empty
    tables; other columns are not read. path: the tokenizer's file, which every executor can open.
    """
    spark = docs.sparkSession
    cut = materialize(cut_up(docs, path, key, text), "store-cut")
    fresh = cut.select(F.explode("fresh").alias("x")).select("x.name", "x.ids")
    chunks = materialize(fresh.repartition("name").dropDuplicates(["name"]), "store-chunks")
    placed = running_start(cut.drop("fresh")).select("range", "shard", "doc_id", "start", "n_tokens", "root", "names")
    recipe_path = scratch(spark, "store-recipes")
    placed.repartitionByRange("range").sortWithinPartitions("range", "start").write.option("compression", "zstd").parquet(recipe_path)
    recipes = spark.read.schema(placed.schema).parquet(recipe_path)
    manifest = materialize(shards(recipes), "store-manifest")
    head = materialize(recipes.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"), F.lit(encoder(path).kind.itemsize).alias("width")), "store-head")
    discard(cut)
    return {"chunks": chunks, "recipes": recipes, "manifest": manifest, "head": head}


def verify(store: dict[str, DataFrame]) -> None:
    """Raise ValueError unless every shard's recipes give its root, and all shards together the head's counts."""
    now, kept = shards(store["recipes"]).alias("now"), store["manifest"].alias("kept")
    same = [F.col(f"now.{c}").eqNullSafe(F.col(f"kept.{c}")) for c in ("first", "n_docs", "n_tokens", "root")]
    ok = same[0] & same[1] & same[2] & same[3]
    both = now.join(kept, [F.col("now.range") == F.col("kept.range"), F.col("now.shard") == F.col("kept.shard")], "full")
    told = both.agg(F.count_if(~ok).alias("bad"), F.coalesce(F.sum("now.n_docs"), F.lit(0)).alias("n_docs"), F.coalesce(F.sum("now.n_tokens"), F.lit(0)).alias("n_tokens")).first()
    head = store["head"].first()
    if told["bad"] or head is None or (told["n_docs"], told["n_tokens"]) != (head["n_docs"], head["n_tokens"]):
        raise ValueError(f"{told['bad']} shards don't match their roots; {told['n_docs']} of {head and head['n_docs']} documents are there")


BACK = "doc_id long, start long, n_tokens long, ids_crc32 long"


def read(store: dict[str, DataFrame]) -> DataFrame:
    """BACK rows of every document: rebuilt from its recipe's chunks, whose names must give the recipe's root.

    A document's start is its identity, as every document has an id at least. Its recipe comes first, its chunks
    follow in order and are taken up one by one; beside its ids a chunk carries only its place.
    """
    verify(store)
    width = store["head"].first()["width"]
    listed = store["recipes"].select("start", F.posexplode("names").alias("pos", "name"))
    found = listed.join(store["chunks"], "name", "left").select("start", "pos", "ids")
    heads = store["recipes"].select("start", F.lit(-1).alias("pos"), "doc_id", "n_tokens", "root")
    met = found.unionByName(heads, allowMissingColumns=True).repartition("start").sortWithinPartitions("start", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recipe, ids, out = None, [], []

        def close() -> None:
            doc, start, n, root = recipe
            flat = np.frombuffer(b"".join(ids), f"<u{width}").astype("<u4")
            if merkle(b"".join(map(name_of, ids))) != root or len(flat) != n:
                raise ValueError(f"document {doc} doesn't match its root")
            out.append((doc, start, n, zlib.crc32(flat.tobytes())))

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*out) if out else [()] * 4)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

        for b in batches:
            for start, pos, chunk, doc, n, root in zip(*(c.to_pylist() for c in b.columns)):
                if pos < 0:
                    if recipe:
                        close()
                    recipe, ids = (doc, start, n, root), []
                elif chunk is None or recipe is None or recipe[1] != start:
                    raise ValueError(f"a chunk or the recipe of the document at {start} is missing")
                else:
                    ids.append(chunk)
            yield batch()
            out.clear()
        if recipe:
            close()
            yield batch()

    return met.select("start", "pos", "ids", "doc_id", "n_tokens", "root").mapInArrow(run, BACK)


def op1_tokenstore(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = build(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))
    return read(store).select("doc_id", "start", "n_tokens", "ids_crc32")

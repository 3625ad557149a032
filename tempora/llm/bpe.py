"""BPE encoding and decoding with a segment tree over adjacent pair ranks.

A word's symbols stand at the leaves' positions; a leaf holds the rank of the pair that begins there, the root the
leftmost pair of lowest rank. A merge changes three leaves, each a logarithmic update, until the root holds no
pair. Words of up to LOCKSTEP symbols are merged together, one tree a row; longer ones alone. Encoded words are
remembered in each Python worker, up to REMEMBERED of them in two generations.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import documents

LOCKSTEP, REMEMBERED = 64, 300_000
#: White space and pre-tokens of the word tokenizer.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
PIECE = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{SPACE}\p{{L}}\p{{N}}]+")
SPACES = regex.compile(rf"[{SPACE}]+")
NONE = 1 << 62


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte: itself where printable, else the next code point from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A tokenizer of the file's kind: NFC, lower case, pre-tokens, byte symbols, word ends."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        self.end = spec["model"].get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.token = np.full(1 + max([*vocab.values(), *self.special.values()]), "", object)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = t
        self.width = len(vocab)
        stand = byte_symbols()
        self.first = np.array([vocab[s] for s in stand], np.int64)
        self.last = np.array([vocab[s + self.end] for s in stand], np.int64)
        pairs = [x.split(" ") if isinstance(x, str) else x for x in merges]
        key = np.array([vocab[a] * self.width + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.order = np.argsort(key)
        self.keys = key[self.order]
        self.rank = {int(k): r for r, k in enumerate(key)}
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.old: tuple[dict, dict] = ({}, {})

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where the two don't merge."""
        key = a * self.width + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.order[at], NONE)

    def symbols(self, word: str) -> np.ndarray:
        raw = np.frombuffer(word.encode(), np.uint8)
        out = self.first[raw]
        out[-1] = self.last[raw[-1]]
        return out

    def merge_together(self, words: list[np.ndarray], size: int) -> list[np.ndarray]:
        """Merge words of at most `size` symbols, a power of two; row w of the trees belongs to word w."""
        n = len(words)
        count = np.array([len(w) for w in words])
        sym = np.full((n, size + 1), -1, np.int64)
        for i, w in enumerate(words):
            sym[i, : len(w)] = w
        after = np.broadcast_to(np.arange(1, size + 2), (n, size + 1)).copy()
        before = np.broadcast_to(np.arange(-1, size), (n, size + 1)).copy()
        tree = np.full((n, 2 * size), NONE, np.int64)
        place = np.arange(size)
        rank = self.ranks(sym[:, :size], sym[:, 1:])
        rank[place[None, :] >= count[:, None] - 1] = NONE
        tree[:, size:] = np.where(rank < NONE, rank * size + place, NONE)
        for level in range(size.bit_length() - 1, 0, -1):
            lo, hi = 1 << level - 1, 1 << level
            tree[:, lo:hi] = np.minimum(tree[:, 2 * lo : 2 * hi : 2], tree[:, 2 * lo + 1 : 2 * hi : 2])

        def put(row: np.ndarray, leaf: np.ndarray, value: np.ndarray) -> None:
            node = leaf + size
            tree[row, node] = value
            while size > 1 and node[0] > 1:
                node = node >> 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])

        row = np.flatnonzero(tree[:, 1] < NONE)
        while len(row):
            top = tree[row, 1]
            i, r = top % size, top // size
            j = after[row, i]
            k = after[row, j]
            sym[row, i] = self.made[r]
            sym[row, j] = -2
            after[row, i] = k
            inside = k < count[row]
            before[row[inside], k[inside]] = i[inside]
            put(row, j, np.full(len(row), NONE))
            right = np.where(inside, self.ranks(sym[row, i], sym[row, np.minimum(k, size)]), NONE)
            put(row, i, np.where(right < NONE, right * size + i, NONE))
            p = before[row, i]
            has = p >= 0
            if has.any():
                own, q = row[has], p[has]
                left = self.ranks(sym[own, q], sym[own, i[has]])
                put(own, q, np.where(left < NONE, left * size + q, NONE))
            row = row[tree[row, 1] < NONE]
        return [s[:c][s[:c] >= 0] for s, c in zip(sym, count)]

    def merge_alone(self, word: np.ndarray) -> np.ndarray:
        """The same for one long word."""
        n = len(word)
        size = 1 << (n - 1).bit_length()
        sym, after, before = word.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [NONE] * (2 * size)
        get, width, made = self.rank.get, self.width, self.made
        for i in range(n - 1):
            r = get(sym[i] * width + sym[i + 1])
            if r is not None:
                tree[size + i] = r * size + i
        for node in range(size - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])

        def put(leaf: int, value: int) -> None:
            node = leaf + size
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    return
                tree[node] = low

        def pair(i: int, j: int) -> int:
            r = get(sym[i] * width + sym[j])
            return NONE if r is None else r * size + i

        while tree[1] < NONE:
            r, i = divmod(tree[1], size)
            j = after[i]
            k = after[j]
            sym[i], sym[j] = int(made[r]), -1
            after[i] = k
            put(j, NONE)
            put(i, pair(i, k) if k < n else NONE)
            if k < n:
                before[k] = i
            if before[i] >= 0:
                put(before[i], pair(before[i], i))
        return np.array([s for s in sym if s >= 0], np.int64)

    def learn(self, chunks: set[str]) -> None:
        """Encode the blank-free chunks that are not remembered yet."""
        parts = {c: PIECE.findall(c) for c in chunks}
        need = {w for ws in parts.values() for w in ws} - self.words.keys()
        for w in need & self.old[1].keys():
            self.words[w] = self.old[1][w]
        new = sorted(need - self.words.keys(), key=lambda w: len(w.encode()))
        done: list[np.ndarray] = []
        short = [self.symbols(w) for w in new]
        at = 0
        while at < len(new):
            size = max(2, 1 << (len(short[at]) - 1).bit_length())
            if size > LOCKSTEP:
                done += map(self.merge_alone, short[at:])
                break
            stop = at
            while stop < len(new) and len(short[stop]) <= size and stop - at < 20_000:
                stop += 1
            done += self.merge_together(short[at:stop], size)
            at = stop
        for w, ids in zip(new, done):
            self.words[w] = ids.astype("<u4").tobytes()
        for c, ws in parts.items():
            self.known[c] = self.words[ws[0]] if len(ws) == 1 else b"".join(map(self.words.__getitem__, ws))

    def remember(self, need: set[str]) -> None:
        """All chunks are in known afterwards. The generation before last is forgotten."""
        if max(len(self.known) + len(need), len(self.words)) > REMEMBERED // 2 and self.known:
            self.old, self.known, self.words = (self.known, self.words), {}, {}
        new = need - self.known.keys()
        back = new & self.old[0].keys()
        for c in back:
            self.known[c] = self.old[0][c]
        if new := new - back:
            self.learn(new)

    def chunks(self, text: str) -> list[str]:
        """Normalised text between white space."""
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        text = (text.replace("Σ", "σ") if "Σ" in text else text).lower()
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):
            return [c for c in SPACES.split(text) if c]
        return text.split()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as little-endian 32-bit numbers."""
        plain = []
        for t in texts:
            bits = self.cut.split(t) if "<|" in t else [t]
            plain.append([b if b in self.special else self.chunks(b) for b in bits if b])
        self.remember({c for bits in plain for b in bits if not isinstance(b, str) for c in b})
        of = self.known.__getitem__
        return [b"".join(self.special[b].to_bytes(4, "little") if isinstance(b, str) else b"".join(map(of, b)) for b in bits) for bits in plain]

    def decode(self, ids: bytes) -> str:
        """The text that ids stand for: their tokens, joined as the file's missing decoder leaves them."""
        return " ".join(self.token[np.frombuffer(ids, "<u4")])


_MADE: dict[str, WordBpe] = {}


def tokenizer(path: str) -> WordBpe:
    """One for each Python worker and file, so that what it remembers outlasts a task."""
    if path not in _MADE:
        _MADE[path] = WordBpe(path)
    return _MADE[path]


def encoded(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids of every row - or the digests of the ids and of the text that they decode to.

    A null text has no ids. Repeated rows all come back; an empty table gives an empty result; other columns
    are not read. path: the tokenizer's file, which every executor can open.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tokenizer(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                b = whole.slice(at, 500)
                got = bpe.encode([t or "" for t in b.column(1).to_pylist()])
                n = pa.array([len(i) // 4 for i in got], pa.int64())
                if digests:
                    cols = [pa.array([hashlib.sha256(i).hexdigest() for i in got], pa.string()), pa.array([hashlib.sha256(bpe.decode(i).encode()).hexdigest() for i in got], pa.string())]
                else:
                    cols = [pa.array([np.frombuffer(i, "<i4") for i in got], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), n, *cols], names=["doc_id", "n_tokens", *(["ids_sha256", "decoded_sha256"] if digests else ["ids"])])

    kind = "ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>"
    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, f"doc_id long, n_tokens long, {kind}")


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoded(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), digests=True)

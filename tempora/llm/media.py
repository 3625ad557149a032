"""Media columns by signature sniffing.

An Aho-Corasick automaton over magic bytes finds every place where a media file could begin. A validator of the
format then walks its structure - chunk lengths, checksums, dimensions - and gives the true length, or refuses.
What is confirmed corrects a wrong declared type, and media inside other bytes are carved out.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tempora.llm.common import documents, materialize

#: Magic bytes, how far into the file they stand, and the media type they hint at.
SIGNATURES = [
    (b"\x89PNG\r\n\x1a\n", 0, "image/png"),
    (b"GIF87a", 0, "image/gif"),
    (b"GIF89a", 0, "image/gif"),
    (b"\xff\xd8\xff", 0, "image/jpeg"),
    (b"BM", 0, "image/bmp"),
    (b"WAVEfmt ", 8, "audio/wav"),
    (b"WEBPVP8", 8, "image/webp"),
    (b".snd", 0, "audio/basic"),
    (b"P5\n", 0, "image/x-portable-graymap"),
]


def _png(b: bytes, at: int) -> int | None:
    pos, first = at + 8, True
    while pos + 12 <= len(b):
        size, kind = struct.unpack_from(">I4s", b, pos)
        end = pos + 12 + size
        if end > len(b) or first != (kind == b"IHDR") or zlib.crc32(b[pos + 4 : end - 4]) != struct.unpack_from(">I", b, end - 4)[0]:
            return None
        if kind == b"IEND":
            return end - at
        pos, first = end, False
    return None


def _gif(b: bytes, at: int) -> int | None:
    if at + 13 > len(b):
        return None
    pos = at + 13 + (3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 128 else 0)
    images = 0
    while pos < len(b):
        mark = b[pos]
        if mark == 0x3B:
            return pos + 1 - at if images else None
        if mark == 0x2C and pos + 10 <= len(b):
            images += 1
            pos += 11 + (3 << ((b[pos + 9] & 7) + 1) if b[pos + 9] & 128 else 0)
        elif mark == 0x21:
            pos += 2
        else:
            return None
        while pos < len(b) and b[pos]:
            pos += b[pos] + 1
        pos += 1
    return None


def _jpeg(b: bytes, at: int) -> int | None:
    pos, frame = at + 2, False
    while pos + 4 <= len(b) and b[pos] == 0xFF:
        mark, size = b[pos + 1], struct.unpack_from(">H", b, pos + 2)[0]
        if mark < 0xC0 or size < 2:
            return None
        frame |= 0xC0 <= mark <= 0xC2
        pos += 2 + size
        if mark == 0xDA:
            while frame and 0 <= (pos := b.find(b"\xff", pos)) < len(b) - 1:
                if b[pos + 1] == 0xD9:
                    return pos + 2 - at
                if b[pos + 1] and not 0xD0 <= b[pos + 1] <= 0xD7:
                    break
                pos += 2
            if not frame or pos < 0:
                return None
    return None


def _bmp(b: bytes, at: int) -> int | None:
    if at + 54 > len(b):
        return None
    size, _, data, head, width, height, planes, bits = struct.unpack_from("<IIIIiiHH", b, at + 2)
    rows = abs(height) * ((width * bits + 31) // 32 * 4) if width > 0 else -1
    return size if planes == 1 and head in (40, 108, 124) and bits in (1, 4, 8, 16, 24, 32) and rows > 0 and data + rows == size and at + size <= len(b) else None


def _riff(b: bytes, at: int) -> int | None:
    if b[at : at + 4] != b"RIFF":
        return None
    end = at + 8 + struct.unpack_from("<I", b, at + 4)[0]
    pos = at + 12
    if end > len(b):
        return None
    seen = set()
    while pos + 8 <= end:
        name, n = struct.unpack_from("<4sI", b, pos)
        if name == b"fmt " and n >= 16:
            code, channels, rate, speed, align, bits = struct.unpack_from("<HHIIHH", b, pos + 8)
            if code not in (1, 3, 6, 7, 0xFFFE) or align != channels * bits // 8 or speed != rate * align:
                return None
        seen.add(name)
        pos += 8 + n + n % 2
    whole = b[at + 8 : at + 12] != b"WAVE" or {b"fmt ", b"data"} <= seen
    return end - at if pos == end and whole else None


def _au(b: bytes, at: int) -> int | None:
    if at + 24 > len(b):
        return None
    data, size, code, rate, channels = struct.unpack_from(">IIIII", b, at + 4)
    return data + size if data >= 24 and data % 8 == 0 and 1 <= code <= 27 and 0 < rate <= 384_000 and 1 <= channels <= 64 and at + data + size <= len(b) else None


def _pgm(b: bytes, at: int) -> int | None:
    parts = b[at : at + 64].split(b"\n", 3)
    try:
        width, height = map(int, parts[1].split(b" "))
        if len(parts) < 4 or parts[2] != b"255" or width < 1 or height < 1:
            return None
    except (ValueError, IndexError):
        return None
    size = sum(len(p) + 1 for p in parts[:3]) + width * height
    return size if at + size <= len(b) else None


VALIDATORS = {"image/png": _png, "image/gif": _gif, "image/jpeg": _jpeg, "image/bmp": _bmp, "audio/wav": _riff, "image/webp": _riff, "audio/basic": _au, "image/x-portable-graymap": _pgm}


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for magic, off, kind in SIGNATURES:
        a.add_word(magic.decode("latin-1"), (len(magic) - 1 + off, kind))
    a.make_automaton()
    return a


def sniff(content: bytes, machine: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(start, length, type) of the outermost confirmed media, in order; a file's own insides are skipped."""
    hits = sorted((end - back, kind) for end, (back, kind) in machine.iter(content.decode("latin-1")) if end >= back)
    out, free = [], 0
    for start, kind in hits:
        if start >= free and (size := VALIDATORS[kind](content, start)):
            out.append((start, size, kind))
            free = start + size
    return out


def _wav(p: bytes) -> bytes:
    """8-bit mono samples; a pad byte keeps chunks even."""
    pad = len(p) % 2
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(p) + pad, b"WAVE", b"fmt ", 16, 1, 1, 8000, 8000, 1, 8, b"data", len(p)) + p + bytes(pad)


def _bitmap(p: bytes) -> bytes:
    """8-bit grey rows of 576 samples."""
    grey = b"".join(bytes((i, i, i, 0)) for i in range(256))
    return struct.pack("<2sIIIIiiHHIIiiII", b"BM", 1078 + len(p), 0, 1078, 40, 576, -(len(p) // 576), 1, 8, 0, len(p), 2835, 2835, 256, 0) + grey + p


def _image(p: bytes) -> bytes:
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    rows = b"".join(b"\0" + p[i : i + 576] for i in range(0, len(p), 576))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 576, len(p) // 576, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows, 1)) + chunk(b"IEND", b"")


def samples(content: bytes, kind: str) -> bytes:
    """The 8-bit samples of a file that store() made, as sniffed."""
    if kind == "audio/wav":
        return content[44 : 44 + struct.unpack_from("<I", content, 40)[0]]
    if kind == "image/bmp":
        return content[1078:]
    pos, data = 8, []
    while pos < len(content):
        size, name = struct.unpack_from(">I4s", content, pos)
        if name == b"IDAT":
            data.append(content[pos + 8 : pos + 8 + size])
        pos += 12 + size
    rows = zlib.decompress(b"".join(data))
    return b"".join(rows[i + 1 : i + 577] for i in range(0, len(rows), 577))


#: The formats that payloads are stored in, dealt by content; what is declared is always the first, so that
#: two thirds of the declared types are wrong and must be corrected.
FORMATS = (("audio/wav", _wav), ("image/bmp", _bitmap), ("image/png", _image))
UNIT = 576


def pad(raw: bytes) -> bytes:
    """raw with bytes 255 up to a positive multiple of UNIT."""
    return raw + b"\xff" * (-len(raw) % UNIT if raw else UNIT)


_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("type", T.StringType()), T.StructField("carved", T.BinaryType())])
MEDIA = "doc_id long, n_bytes long, declared string, media binary"


def store(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Each text, a null one as empty, as a media file. Equal texts give equal files.

    Repeated rows all come back, null keys too; an empty table gives an empty result; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [(t or "").encode() for t in b.column(1).to_pylist()]
            media = [FORMATS[zlib.crc32(r) % len(FORMATS)][1](pad(r)) for r in raw]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), pa.array([len(r) for r in raw], pa.int64()), pa.array([FORMATS[0][0]] * len(raw)), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "declared", "media"])

    return docs.select(F.col(key).cast("long"), F.col(text)).mapInArrow(run, MEDIA)


def sniffed(media: DataFrame, content: str = "media", declared: str = "declared") -> DataFrame:
    """media with `found`: array of (start, length, type, carved) and `corrected`, the type that the bytes prove.

    corrected is the declared type where nothing is confirmed at the first byte; carved holds media that do
    not fill the whole content. Null contents have no media; empty tables give empty results; repeated rows all come
    back. Columns named found or corrected make room for the new ones.
    """
    kept = media.drop("found", "corrected")
    held = kept.columns
    schema = T.StructType([*kept.schema, T.StructField("corrected", T.StringType()), T.StructField("found", T.ArrayType(_SPAN))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("carved", pa.binary())]))
        for b in batches:
            found, right = [], []
            for c, d in zip(b.column(held.index(content)).to_pylist(), b.column(held.index(declared)).to_pylist()):
                spans = sniff(c or b"", machine)
                right.append(spans[0][2] if spans and spans[0][0] == 0 else d)
                found.append([{"start": s, "length": n, "type": k, "carved": None if n == len(c) else c[s : s + n]} for s, n, k in spans])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(right, pa.string()), pa.array(found, kind)], names=[*b.schema.names, "corrected", "found"])

    return kept.mapInArrow(run, schema)


def digest(found: DataFrame) -> DataFrame:
    """What is read back of every stored file: payload digests and a feature string. Needs the columns of sniffed(store());
    repeated rows all come back, an empty table gives an empty result."""
    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, corrected boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.select(["doc_id", "n_bytes", "declared", "media", "corrected", "found"]).to_pylist():
                p = samples(r["media"], r["corrected"])
                sha = hashlib.sha256(p).hexdigest()
                spans = ";".join(f"{f['type']}@{f['start']}+{f['length']}" for f in r["found"])
                out.append((r["doc_id"], r["n_bytes"], len(p), sha, zlib.crc32(p[-32:]), len(r["media"]), hashlib.sha256(r["media"]).hexdigest(), f"{r['corrected']};rows={len(p) // UNIT};mean={sum(p) / len(p):.4f};{spans}", r["corrected"] != r["declared"]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
            cols = list(zip(*out)) or [()] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "corrected"])

    return found.mapInArrow(run, schema)


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = materialize(store(documents(spark, sf_dir)), "media")
    return digest(sniffed(stored))

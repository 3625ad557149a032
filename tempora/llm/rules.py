"""Quality rules: base counts, and the divergence of a document's histograms from its language's.

For every document two histograms are counted: character classes and common words. Those of all documents of a
language add up to the language's reference. A document is kept if the Jensen-Shannon distances to the
reference stay under their bars; a histogram of fewer than the least number of characters or words decides
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tempora.llm.common import documents, materialize

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
#: Frequent words of each language; the histogram has a bin for each and one for all others.
COMMON = {
    "en": "the of and to in a is that for it on was as with be by at this from or are not have an had but which you all were".split(),
    "de": "der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "fr": "de la le et les des en un du une que est pour qui dans par plus pas au sur ne se ce il sont avec son aux ou comme".split(),
    "es": "de la que el en y a los se del las un por con no una su para es al lo como más o pero sus le ha me si".split(),
}
N_WORDS, N_CLASSES = 30, 9
#: Least characters and words for a verdict; bars of the two distances.
LEAST_CHARS, LEAST_WORDS, CHAR_BAR, WORD_BAR = 200, 200, 0.32, 0.24

_CLASS = np.full(256, 8, np.uint8)  # 8: other
for _c in range(256):
    _CLASS[_c] = 0 if 97 <= _c <= 122 else 1 if 65 <= _c <= 90 else 2 if 48 <= _c <= 57 else 3 if chr(_c) in SPACES else 4 if chr(_c) in SYMBOLS else 5 if chr(_c) in ".,;:?'\"()-" else 6 if chr(_c) == "!" else 7 if _c >= 192 else 8 if _c < 128 else 9

FIELDS = pa.schema(
    [("doc_id", pa.int64()), ("lang", pa.string()), ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()), ("classes", pa.list_(pa.int64())), ("common", pa.list_(pa.int64()))]
)


def repeated_words(words: list[bytes]) -> tuple[int, dict[bytes, int], np.ndarray]:
    """Words inside 3-word windows that occur more than once; the number of each distinct word; its occurrences."""
    names = {w: i for i, w in enumerate(dict.fromkeys(words))}
    ids = np.fromiter(map(names.__getitem__, words), np.int64, len(words))
    counts = np.bincount(ids, minlength=len(names))
    if len(ids) < 4 or len(names) == len(ids):
        return 0, names, counts
    _, pairs = np.unique(ids[:-1] * len(names) + ids[1:], return_inverse=True)
    _, at, times = np.unique(pairs[:-1] * len(names) + ids[2:], return_inverse=True, return_counts=True)
    hit = times[at] > 1
    mark = np.zeros(len(ids), bool)
    for k in range(3):
        mark[k : k + len(hit)] |= hit
    return int(mark.sum()), names, counts


def describe(text: str, lang: str | None) -> tuple:
    raw = text.encode()
    words = raw.split()
    repeats, names, counts = repeated_words(words)
    lines = [x for x in text.split("\n") if x.encode().split()]
    classes = np.bincount(_CLASS[np.frombuffer(raw, np.uint8)], minlength=10)[:N_CLASSES] if raw else np.zeros(N_CLASSES, int)
    known = [sum(int(counts[names[x]]) for x in (w.encode(), w.capitalize().encode()) if x in names) for w in COMMON.get(lang or "", [])]
    common = known + [0] * (N_WORDS - len(known)) + [len(words) - sum(known)]
    chars = len(text) - sum(map(text.count, SPACES))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeats, classes.tolist(), common


def count(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts and histograms of every row, in Arrow batches; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs = b.column(2).to_pylist()
            rows = [describe(t or "", x) for t, x in zip(b.column(1).to_pylist(), langs)]
            cols = [list(c) for c in zip(*rows)] if rows else [[] for _ in range(7)]
            yield pa.RecordBatch.from_arrays([b.column(0).cast(pa.int64()), b.column(2)] + [pa.array(c, f.type) for c, f in zip(cols, list(FIELDS)[2:])], schema=FIELDS)

    kinds = "doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, classes array<long>, common array<long>"
    return docs.select(F.col(key).cast("long"), F.col(text), F.col(lang).cast("string")).mapInArrow(run, kinds)


def references(counted: DataFrame) -> DataFrame:
    """lang, ref_classes, ref_common: summed over all documents of the language; one small row for each."""
    add = lambda c, n: F.array(*[F.sum(F.col(c)[i]) for i in range(n)]).alias(f"ref_{c}")
    return counted.groupBy(F.col("lang").alias("ref_lang")).agg(add("classes", N_CLASSES), add("common", N_WORDS + 1))


def divergence(a: Column, b: Column) -> Column:
    """Jensen-Shannon distance of two histograms, 0 to 1; null if one is empty."""
    total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda s, v: s + v)
    half = lambda p, m: F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)
    ta, tb = total(a), total(b)
    parts = F.zip_with(a, b, lambda x, y: half(x / ta, (x / ta + y / tb) / 2) + half(y / tb, (x / ta + y / tb) / 2))
    js = F.aggregate(parts, F.lit(0.0), lambda s, v: s + v) / 2
    return F.when((ta > 0) & (tb > 0), F.sqrt(F.greatest(js, F.lit(0.0))))


#: Languages up to which the references are broadcast; beyond, they are joined by a shuffle.
SMALL_LANGS = 10_000


def judge(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Counts, both distances, base_failed and kept for every row.

    A null text is empty: it has no words and fails. Documents of a null language share a reference, as do
    those of a language without listed words (all their words are in one bin, which decides nothing).
    Repeated rows are judged alike. An empty table gives an empty result; other columns are not read.
    """
    counted = materialize(count(docs, key, text, lang), "rule-counts")
    refs = materialize(references(counted), "rule-refs")
    small = refs.limit(SMALL_LANGS + 1).count() <= SMALL_LANGS
    both = counted.join(F.broadcast(refs) if small else refs, F.col("lang").eqNullSafe(F.col("ref_lang")), "left")
    chars = F.when(F.col("word_chars") >= LEAST_CHARS, divergence(F.col("classes"), F.col("ref_classes")))
    words = F.when(F.col("n_words") >= LEAST_WORDS, divergence(F.col("common"), F.col("ref_common")))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    near = (F.coalesce(chars, F.lit(0.0)) <= CHAR_BAR) & (F.coalesce(words, F.lit(0.0)) <= WORD_BAR)
    return both.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & near).alias("kept"), chars.alias("class_distance"), words.alias("word_distance"))


def op8_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(documents(spark, sf_dir))

"""Registered queries against plain versions of their whole result."""

from __future__ import annotations

import math
import random
import re

import pytest

pytest.importorskip("public_tokenizers")

from pyspark.sql import functions as F  # noqa: E402

from tempora.llm import media, mixing, rules, secrets  # noqa: E402
from tempora.llm.common import co_located, in_parts  # noqa: E402
from tempora.llm.queries import QUERIES  # noqa: E402

BLANK = r"\x20\x09-\x0D"


def distance(a, b):
    if not sum(a) or not sum(b):
        return None
    p, q = [x / sum(a) for x in a], [x / sum(b) for x in b]
    half = lambda u, v: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(u, v) if x)
    return math.sqrt(max(0.0, (half(p, q) + half(q, p)) / 2))


def classes(text):
    """Character classes over the bytes of UTF-8; bytes that only continue a character count nowhere."""
    out = [0] * 9
    for b in text.encode():
        c = chr(b)
        if b >= 192:
            out[7] += 1
        elif b < 128:
            out[0 if "a" <= c <= "z" else 1 if "A" <= c <= "Z" else 2 if c.isdigit() else 3 if c in " \t\n\r\x0b\x0c" else 4 if c in "#*$%&|<>" else 5 if c in ".,;:?'\"()-" else 6 if c == "!" else 8] += 1
    return out


def common(words, lang):
    listed = rules.COMMON.get(lang or "", [])
    bins = [sum(w in (x, x.capitalize()) for w in words) for x in listed] + [0] * (30 - len(listed))
    return [*bins, len(words) - sum(bins)]


def test_op8_keeps_what_a_plain_version_keeps(spark, tmp_path):
    r = random.Random(3)
    own = ["".join(r.choice("abcdefgh") for _ in range(r.randint(3, 9))) for _ in range(3000)]
    prose = lambda lang, n: " ".join(r.choice(rules.COMMON[lang]).capitalize() if r.random() < 0.05 else r.choice(rules.COMMON[lang]) if r.random() < 0.5 else r.choice(own) + r.choice(["", ",", "é."]) for _ in range(n))
    rows = [(prose(lang, r.randint(40, 400)), lang) for lang in ("en", "de") for _ in range(25)]
    rows += [(" ".join(r.choice(own) for _ in range(300)), "en"), (" ".join("".join(r.choice("0123456789#$!") for _ in range(6)) for _ in range(300)), "en"), (prose("en", 300), "de"), ("a b c " * 200, "en"), (None, "en"), ("", None), (prose("fr", 250), None), (prose("en", 250), "xx")]
    rows.append(rows[0])
    spark.createDataFrame([(i, *x) for i, x in enumerate(rows)], "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    words = [re.findall(rf"[^{BLANK}]+", t or "") for t, _ in rows]
    hists = [(classes(t or ""), common(w, lang)) for (t, lang), w in zip(rows, words)]
    refs = {}
    for (_, lang), h in zip(rows, hists):
        refs[lang] = [[x + y for x, y in zip(a, b)] for a, b in zip(refs[lang], h)] if lang in refs else h
    want = {}
    for i, ((_, lang), w, (cls, com)) in enumerate(zip(rows, words, hists)):
        three = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice = {x for x in three if three.count(x) > 1} if len(set(three)) < len(three) else set()
        repeats = len({k + d for k, x in enumerate(three) if x in twice for d in range(3)})
        failed = len(w) < 50 or 100 * repeats > 50 * len(w)
        by_class = distance(cls, refs[lang][0]) if sum(map(len, w)) >= rules.LEAST_CHARS else None
        by_word = distance(com, refs[lang][1]) if len(w) >= rules.LEAST_WORDS else None
        want[i] = (failed, not failed and (by_class or 0) <= rules.CHAR_BAR and (by_word or 0) <= rules.WORD_BAR)
    got = {x["doc_id"]: (x["base_failed"], x["kept"]) for x in QUERIES["op8_rules"](spark, str(tmp_path)).collect()}
    assert got == want
    assert {kept for failed, kept in want.values() if not failed} == {True, False}  # the method decides too


def test_op9_overlapping_sources_are_routed(spark):
    """Documents of both sources go where words are short; each source gets its target from those that may serve it."""
    rows = [(i, "w " * 5, ["a"]) for i in range(400)] + [(1000 + i, "w " * 5, ["b"]) for i in range(40)] + [(2000 + i, "w " * 5, ["b", "a", "a"]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, sources array<string>")
    weights = lambda names: {"a": 1.0, "b": 1.0}
    got = mixing.mix(docs, F.col("sources"), weights=weights).groupBy("pattern").agg(F.sum("taken").alias("taken"), F.max("copies").alias("copies")).collect()
    taken = {tuple(x["pattern"]): x["taken"] for x in got}
    # 3,200 words, 1,600 for each source: b has 200 of its own, so that a's and the shared 1,000 must serve without favour
    total = 3200
    best = min(
        (sum(sum(k * max(0, min(n, t - k * n)) for k in range(3)) for n, t in ((2000, a), (200, b), (1000, ab))), a, b, ab)
        for a in range(0, 1601, 100) for b in range(0, 601, 100) for ab in range(0, 3001, 100) if a + b + ab == total and a <= 1600 and b <= 1600 and a + ab >= 1600
    )
    cost = sum(sum(k * max(0, min(n, t - k * n)) for k in range(3)) for n, t in ((2000, taken[("a",)]), (200, taken[("b",)]), (1000, taken[("a", "b")])))
    assert abs(sum(taken.values()) - total) <= 15 and taken[("a",)] <= 1605
    assert abs(cost - best[0]) <= 30


def test_op9_takes_what_its_sources_are_given(spark, tmp_path):
    """Sizes, source sizes and targets against a plain version; every sum as near as whole documents allow."""
    r = random.Random(11)
    texts = [" ".join("w" for _ in range(n)) for n in [0, 0, 1, 2, 3] + [int(r.paretovariate(0.7)) + 5 for _ in range(700)]]
    rows = [(i, t + r.choice(["", " ", "\n"]), r.choice(["a", "a", "a", "b", "c", "ü", None])) for i, t in enumerate(texts)] + [(None, None, "a"), (3, "w w", "d"), (3, "w w", "d")]
    spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    words = lambda t: len(re.findall(rf"[^{BLANK}]+", t or ""))
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(words(t) for _, t, x in rows if x == s) for s in names}
    weight, target, left, open_ = {s: 1 + i % 3 for i, s in enumerate(names)}, {}, float(sum(size.values())), list(names)
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = [s for s in open_ if per * weight[s] > 3 * size[s]]
        target |= {s: 3 * size[s] if over else per * weight[s] for s in over or open_}
        if not over:
            break
        left -= sum(3 * size[s] for s in over)
        open_ = [s for s in open_ if s not in over]
    got = QUERIES["op9_mixing"](spark, str(tmp_path)).collect()
    again = QUERIES["op9_mixing"](spark, str(tmp_path)).collect()
    key = lambda x: tuple(map(str, x))
    assert sorted(map(tuple, got), key=key) == sorted(map(tuple, again), key=key)
    source = {i: s for i, _, s in rows if i is not None and i != 3}
    assert sorted(x["size"] for x in got) == sorted(words(t) for _, t, _ in rows)
    for s in names:
        own = [x for x in got if source.get(x["doc_id"], "?") == s]
        assert all(x["source_size"] == size[s] and abs(x["target"] - target[s]) < 1e-6 and x["taken"] <= 3 * x["size"] for x in own)
        assert all(x["size"] == 0 or x["taken"] % x["size"] == 0 for x in own)
        if s not in ("a", "d"):  # their rows of one key can't be told apart here
            base = min(x["taken"] // x["size"] for x in own if x["size"])
            missing = round(target[s]) - sum(x["taken"] for x in own)
            assert all(abs(missing - x["size"]) >= abs(missing) for x in own if x["size"] and x["taken"] == base * x["size"])


def test_op10_second_version_reads_the_ledger(spark, tmp_path, monkeypatch):
    """The second scan of the query sees only blobs that the first one has not; texts stay in their buckets."""
    rows = [(i, f"token = abcdefghijkl{i // 4}") for i in range(40)] + [(None, None), (41, None)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    seen, plans = [], []
    real = secrets._unseen

    def unseen(table, parts, before):
        out = real(table, parts, before)
        seen.append(sorted(r["blob"] for r in out.select("blob").collect()))
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(secrets, "_unseen", unseen)
    got = QUERIES["op10_secrets"](spark, str(tmp_path)).collect()
    assert len(got) == 42 and sum(x["n_assign"] for x in got) == 40
    assert len(seen[0]) == 10 and len(seen[1]) == 1  # even keys hold every text but the null one
    for plan in plans:
        above = plan.split("ShuffledHashJoin")[1]
        assert "Exchange" not in above[: above.index("FileScan")]


def test_co_located_setting_comes_back(spark):
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    with pytest.raises(ZeroDivisionError), co_located(spark):
        raise ZeroDivisionError
    assert spark.conf.get(name) == before
    table, parts, _ = in_parts(spark.range(0, 10, 1, 3).withColumnRenamed("id", "k"), "t")
    assert parts == 3 and table.select("part", "row").distinct().count() == 10 and table.select("part").distinct().count() == 3


def test_op2_features_and_clashing_names(spark):
    docs = spark.createDataFrame([(1, "abc", "x", True), (2, None, "y", False)], "doc_id long, text string, found string, corrected boolean")
    stored = media.store(docs).withColumn("found", F.lit("mine")).withColumn("corrected", F.lit(True)).withColumn("n, odd name", F.lit(1))
    got = {r["doc_id"]: r for r in media.sniffed(stored).collect()}
    assert all(r["corrected"] in {k for k, _ in media.FORMATS} and r["found"][0]["start"] == 0 and r["n, odd name"] == 1 for r in got.values())
    told = {r["doc_id"]: r["feature"] for r in media.digest(media.sniffed(stored)).collect()}
    for i, raw in ((1, b"abc"), (2, b"")):
        p = raw + b"\xff" * (576 - len(raw))
        kind = got[i]["corrected"]
        assert told[i] == f"{kind};rows=1;mean={sum(p) / 576:.4f};{kind}@0+{len(got[i]['media'])}"

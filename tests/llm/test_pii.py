"""Discovery of personal data against a plain version, and long awkward texts."""

from __future__ import annotations

import math
import random
import re

import pytest

pytest.importorskip("public_tokenizers")

from tempora.llm import pii  # noqa: E402

WORD = r"[^\x20\x09-\x0D]"


def plain_bootstrap(entities, candidates):
    """The graph and its scores in dictionaries."""
    shape = lambda x: re.sub(r"[^\W\d_]+", "a", re.sub("[0-9]", "9", x))
    edges = {(p, i) for i, left, right in [e[1:] for e in entities] + candidates if i for p in (left and f"L:{left}", right and f"R:{right}", left and right and f"B:{left} {right}", f"S:{shape(i)}") if p}
    seeds = {(i, k): 1.0 for k, i, _, _ in entities}
    known_instances = {i for i, _ in seeds}
    conf = dict(seeds)
    for _ in range(pii.ROUNDS):
        good = {}
        for p in {p for p, _ in edges}:
            own = [i for q, i in edges if q == p]
            for k in pii.PATTERNS:
                s = sum(conf.get((i, k), 0) for i in own)
                if s >= pii.SUPPORT and s / len(own) >= pii.PATTERN_BAR:
                    good[p, k] = s / len(own)
        told = {}
        for (p, k), share in good.items():
            for q, i in edges:
                if q == p and i not in known_instances:
                    told[i, k] = told.get((i, k), 0) + math.log(1 - min(share, 0.999))
        best = {}
        for (i, k), x in sorted(told.items(), key=lambda y: y[0][1]):
            c = 1 - math.exp(x)
            if c >= 0.5 and c > best.get(i, ("", 0))[1]:
                best[i] = (k, c)
        conf = seeds | {(i, k): c for i, (k, c) in best.items()}
    return {(i, k): round(c, 9) for (i, k), c in conf.items() if i not in known_instances and c >= pii.INSTANCE_BAR}


def test_bootstrap_equals_the_plain_version(spark):
    r = random.Random(8)
    entities, candidates = [], []
    for n in range(120):
        kind = r.choice(list(pii.PATTERNS))
        entities.append((kind, f"{kind[0]}{r.randrange(60)}", r.choice([f"{kind}-before", "the", ""]), r.choice([f"after-{kind}", "the", ""])))
    for n in range(150):
        kind = r.choice([*pii.PATTERNS, "none", "none"])
        candidates.append((f"{kind[0]}{r.randrange(100)}", r.choice([f"{kind}-before", "the", f"{kind}-before"]), r.choice([f"after-{kind}", "of", ""])))
    want = plain_bootstrap(entities, candidates)
    got = pii.bootstrap(spark.createDataFrame(entities, "kind string, instance string, left string, right string"), spark.createDataFrame(candidates, "instance string, left string, right string"))
    assert want and {(x["instance"], x["kind"]): round(x["conf"], 9) for x in got.collect()} == want


def test_identifiers_with_blanks_and_long_neighbours(spark):
    far = "n" * 300
    known = [f"call {far} +1 (555) 010-{1000 + i} {far} now" for i in range(8)]
    rows = [*known, f"call {far} 555 0199 77 {far} now", f"call {far} 555-0199-78  {far} now", "4 5 6", None, ""]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string")
    _, added = pii.find(table)
    spans = sorted((s["start"], s["end"], s["kind"]) for r in added.collect() for s in r["added"])
    at = len(f"call {far} ")
    assert spans.count((at, at + 11, "phone")) == 2 and all(at <= a < b <= at + 11 for a, b, _ in spans)  # words of the run may be found too
    out = {r["doc_id"]: r["text"] for r in pii.redact(table).collect()}
    assert out[8] == f"call {far} <PHONE> {far} now" and out[10] == "4 5 6" and out[11] is None


@pytest.mark.parametrize("piece", ["a.", "7", "1.", "-1 ", "+1 (", "@", "a@b.", "4 ", "% ", "x"])
def test_a_megabyte_of_one_thing(spark, piece):
    text = "x@" + piece * (400_000 // len(piece)) + " a.b@c.example 10.1.1.1"
    table = spark.createDataFrame([(1, text)], "doc_id long, text string")
    base = pii.find(table)[0].first()["base"]
    assert {("email", len(text) - 22), ("ip", len(text) - 8)} <= {(s["kind"], s["start"]) for s in base}


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, blob string, kind string")
    assert pii.redact(none).count() == 0 and pii.redact(none).columns == none.columns and pii.find(none)[1].count() == 0

"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

from tempora.llm import conversations
from tempora.llm.queries import QUERIES

WHITE = " \t\n\x0b\x0c\r"
WHOLE, BEGUN = re.compile(r"(s?(ua)+)?\Z"), re.compile(r"(s|s?(ua)+|s?(ua)*u)?\Z")


def initial(role):
    return role[:1] or " "


def cheapest(rows):
    """(cost, audit, lines) of the least (cost, audit) among all edits, by uniform-cost search over whole strings."""
    heap, seen = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, roles, out = heapq.heappop(heap)
        if i == len(rows) and WHOLE.match(roles):
            return cost, audit, out
        if (i, roles) in seen:
            continue
        seen.add((i, roles))
        steps = [(5, "I", i, g, (g, "")) for g in ("user", "assistant")]
        if i < len(rows):
            role, text, fault = rows[i]
            steps.append((2, "D", i + 1, None, None))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                steps.append((more, "K", i + 1, role, (role, text)))
                steps += [(1 + more, "R", i + 1, g, (g, text)) for g in ("user", "assistant")]
        for price, letter, to, role, line in steps:
            now = roles if role is None else roles + initial(role)
            if BEGUN.match(now):
                heapq.heappush(heap, (cost + price, audit + letter, to, now, out if line is None else (*out, line)))


def plain(rows, damage=True):
    held = {}
    for conv, turn, role, text in rows:
        told = lambda x: " " if x is None else str(x)
        own, lot, role, text = held.setdefault(conv, []), zlib.crc32(f"{told(conv)}:{told(turn)}".encode()) % 20 if damage else 9, told(role), told(text)
        text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
        own += [((turn is not None, turn or 0), "user" if lot == 4 else role, text, turn)] * (0 if lot == 0 else 2 if lot == 3 else 1)
    out = {}
    for conv, own in held.items():
        own.sort(key=lambda x: (*x[:2], hashlib.sha256(x[2].encode()).hexdigest()))
        before, marked = set(), []
        for _, role, text, _ in own:
            bare = text.strip(WHITE)
            marked.append((role, text, "blank" if not bare else "duplicate" if (role, text) in before else "truncated" if bare[-1] not in ".!?" else ""))
            before.add((role, text))
        turns = {x[3] for x in own} - {None}
        roles = [initial(r) for r, _, _ in marked]
        cost, audit, lines = cheapest(marked)
        count = lambda f: sum(x[2] == f for x in marked)  # noqa: B023, E731
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, lines)
    return out


def some(seed, conversations_, most=7):
    r = random.Random(seed)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", "usher", "", None], ["One.", "Two!", "Three", "cut ", " \t\n", "", None, "Is it? \x0b", "é.\n\n"]
    rows = [(c, r.choice([i, i, i, i + 3, None]), r.choice(roles[:4] if r.random() < 0.7 else roles), r.choice(texts) if r.random() < 0.5 else f"t{r.random()}.") for c in conversations_ for i in range(r.randint(1, most))]
    return rows + r.sample(rows, len(rows) // 20)  # rows that repeat as they are


def test_whole_result(spark, tmp_path):
    rows = some(5, [None, *range(150)]) + [(900 + c, t, "user", "x.") for c in range(30) for t in range(1)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4).write.parquet(f"file://{tmp_path}/conversations.parquet")
    want = {c: (*x, hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest()) for c, (*x, lines) in plain(rows).items()}
    got = QUERIES["op13_conversations"](spark, f"file://{tmp_path}").collect()
    names = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {x["conv_id"]: tuple(x[n] for n in names) for x in got} == want and len(got) == len(want)
    assert any(x[6] == "" for x in want.values())  # some conversation lost all rows


def test_repaired_rows(spark):
    rows = some(8, range(60))
    frame = spark.createDataFrame([(*x, "z", 1) for x in rows], "conv_id long, turn long, role string, text string, letter string, salt int")
    got = {}
    for x in sorted(conversations.repair(frame).collect(), key=lambda x: (x["conv_id"], x["pos"])):
        got.setdefault(x["conv_id"], []).append((x["role"], x["text"]))
    assert got == {c: list(x[-1]) for c, x in plain(rows, damage=False).items() if x[-1]}


def test_solve_against_search():
    r = random.Random(2)
    for _ in range(400):
        signature = "".join(r.choice("suaoSUAO--uaua") for _ in range(r.randint(0, 8)))
        role = {"s": "system", "u": "user", "a": "assistant", "o": "tool", "-": "user"}
        rows = [(role[x.lower()], str(i), "blank" if x == "-" else "truncated" if x.isupper() else "") for i, x in enumerate(signature)]
        assert conversations.solve(signature) == cheapest(rows)[:2], signature


def test_a_long_conversation_streams(spark):
    """One conversation of most rows: no recursion by row, no group in memory."""
    n = 20_000
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"line {i}.") for i in range(n)] + [(2, 0, "user", "a."), (2, 1, "assistant", "b.")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = conversations.undamaged(frame)
    assert {x["conv_id"]: (x["cost"], x["audit"]) for x in conversations.audits(made).collect()} == {1: (0, "K" * n), 2: (0, "KK")}
    assert conversations.repair(frame).where("conv_id = 1").count() == n


def test_empty_table(spark):
    assert conversations.damaged_repairs(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0

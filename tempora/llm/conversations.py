"""Conversation structure repair by signature.

A conversation's rows, in order, are written as a string with one letter a row: the row's role initial crossed with
its first fault. The string settles every count, and what of it matters to a repair is its signature. Each distinct
signature is solved once, by memoised recursion; its audit - one letter an edit - goes back to all conversations
that share it, and their rows are read in order beside the audit, which replays the edits. Rows stream through both
passes sorted: a task holds a letter a row of the conversation it is in, and one batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.llm.common import materialize

#: What a row's letter stands for. Rows of initials s, u, a and of any other, by their first fault.
SOUND, BLANKS, REPEATS, CUT = "suao", "1234", "5678", "SUAO"
FAULTS = {"blank": BLANKS, "duplicate": REPEATS, "truncated": CUT}
WHITE = "\x20\t\n\x0b\x0c\r"
#: What an edit costs, and what a truncated row adds that stays.
KEEP, REROLE, DELETE, INSERT, UNMENDED = 0, 1, 2, 5, 5
#: Rows of a conversation that are alike in their signature meet its audit in so many groups.
SALTS = 32
ORDER = ["turn_", "role_", "hash_", "copy_"]


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role_, text_, copy_, gone_ of every row, as the numbers of conv_id and turn damage it."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(told("conv_id"), F.lit(":"), told("turn"))) % 20
    text = F.when(lot == 1, "").when(lot == 2, F.regexp_replace(told("text"), "[.!?]", "")).otherwise(told("text"))
    copies = F.when(lot == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", F.when(lot == 4, "user").otherwise(told("role")).alias("role_"), text.alias("text_"), F.explode(copies).alias("copy_"), (lot == 0).alias("gone_"))


def undamaged(rows: DataFrame) -> DataFrame:
    """The same columns of rows as they are; a null role or text is one space."""
    told = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select("conv_id", "turn", told("role").alias("role_"), told("text").alias("text_"), F.lit(0).alias("copy_"), F.lit(False).alias("gone_"))


def _lettered(rows: DataFrame) -> DataFrame:
    """conv_id, turn_, letter of every row that ORDER and conv_id name; the letter of one that is gone is null."""
    last = F.right(F.rtrim(F.col("text_"), F.lit(WHITE)), F.lit(1))
    narrow = rows.select("conv_id", F.col("turn").alias("turn_"), "role_", F.sha2("text_", 256).alias("hash_"), "copy_", "gone_", (last == "").alias("blank"), (~last.isin(*".!?")).alias("cut"))
    # a text that one conversation repeats without end is told apart by role and text first
    nth = F.row_number().over(Window.partitionBy("conv_id", "role_", "hash_", "gone_").orderBy("turn_", "copy_"))
    rows = narrow.withColumn("again", nth > 1)
    which = F.when(F.col("blank"), F.lit(BLANKS)).when(F.col("again"), F.lit(REPEATS)).when(F.col("cut"), F.lit(CUT)).otherwise(F.lit(SOUND))
    at = F.instr(F.lit(SOUND[:3]), F.when(F.col("role_") != "", F.substring("role_", 1, 1)).otherwise(" "))
    letter = F.substring(which, F.when(at > 0, at).otherwise(4), F.lit(1))
    return rows.select("conv_id", *ORDER, "again", F.when(~F.col("gone_"), letter).alias("letter"))


FOUND = "conv_id long, gaps long, letters string"


def _strings(lettered: DataFrame) -> DataFrame:
    """FOUND of every conversation: its letters in order, and the turns that it lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, letters, first, last, turns = (), bytearray(), None, None, 0
        done: list[tuple] = []
        gaps = lambda: 0 if first is None else last - first + 1 - turns
        for b in batches:
            for conv, turn, letter in zip(*(b.column(i).to_pylist() for i in range(3))):
                if now != (conv,):
                    if now:
                        done.append((*now, gaps(), letters.decode()))
                    now, letters, first, last, turns = (conv,), bytearray(), None, None, 0
                if letter is None:
                    continue
                letters += letter.encode()
                if turn is not None and turn != last:
                    first, last, turns = turn if first is None else first, turn, turns + 1
            yield _batch(done, FOUND)
            done = []
        if now:
            yield _batch([(*now, gaps(), letters.decode())], FOUND)

    ordered = lettered.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER, "again")
    return ordered.select("conv_id", "turn_", "letter").mapInArrow(run, FOUND)


_KINDS = {"long": pa.int64(), "string": pa.string()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [f.split(" ") for f in schema.split(", ")]
    cols = zip(*rows) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, (_, k) in zip(cols, names)], names=[n for n, _ in names])


#: States are nothing yet, after s, after u, after a; where a role leads from each.
_NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
#: The role that an edit may give in each state.
_GIVEN = ("u", "u", "a", "u")
_ENDS = (0, 3)


def solve(signature: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest edits, of equal cost the ASCII-least audit.

    signature: a letter of SOUND or CUT for a row that may stay, - for one that must go. best(state) is the least
    (cost, letter) that mends the rows from i on; it is asked from the end, so that a call needs what is known of the
    rows behind and at most a few inserts. Of those rows the costs stay only until the row ahead is settled, of all
    rows a letter for each state. No two edits of one letter are open in a state, so that letters alone settle ties.
    """
    n = len(signature)
    chosen = [bytearray(n + 1) for _ in _NEXT]
    behind: list[float] = []
    for i in range(n, -1, -1):
        known: dict[tuple[int, int], tuple[float, str]] = {}

        def rest(state: int) -> tuple[float, str]:
            """The least that takes row i now."""
            if i == n:  # noqa: B023
                return (0 if state in _ENDS else float("inf")), " "
            letter = signature[i]  # noqa: B023
            may = [(DELETE + behind[state], "D")]
            if letter != "-":
                extra, role = UNMENDED * letter.isupper(), letter.lower()
                if role in _NEXT[state]:
                    may.append((KEEP + extra + behind[_NEXT[state][role]], "K"))
                may.append((REROLE + extra + behind[_NEXT[state][_GIVEN[state]]], "R"))
            return min(may)

        def best(state: int, inserts: int = 0) -> tuple[float, str]:
            """The least, inserts included: after three, a state comes again that was open before."""
            if (state, inserts) not in known:  # noqa: B023
                more = [(INSERT + best(_NEXT[state][_GIVEN[state]], inserts + 1)[0], "I")] if inserts < 3 else []
                known[state, inserts] = min([rest(state), *more])  # noqa: B023
            return known[state, inserts]  # noqa: B023

        found = [best(state) for state in range(len(_NEXT))]
        behind = [cost for cost, _ in found]
        for state, (_, letter) in enumerate(found):
            chosen[state][i] = ord(letter)
    audit, i, state = bytearray(), 0, 0
    while (letter := chr(chosen[state][i])) != " ":
        audit.append(ord(letter))
        if letter == "K":
            state = _NEXT[state][signature[i].lower()]
        elif letter in "IR":
            state = _NEXT[state][_GIVEN[state]]
        i += letter != "I"
    return int(behind[0]), audit.decode()


SOLVED = "signature string, cost long, audit string"


def _solved(signatures: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield _batch([(s, *solve(s)) for s in b.column(0).to_pylist()], SOLVED)

    return signatures.mapInArrow(run, SOLVED)


def _count(letters: str) -> Column:
    return F.length(F.regexp_replace("letters", f"[^{letters}]", "")).cast("long")


def _illegal() -> Column:
    """Neighbours whose initials are not su, ua or au."""
    roles = F.translate("letters", BLANKS + REPEATS + CUT, SOUND * 3)
    # every place where a legal pair begins, found without taking a letter twice
    legal = F.size(F.regexp_extract_all(roles, F.lit("(?:s(?=u))|(?:u(?=a))|(?:a(?=u))"), F.lit(0)))
    return (F.greatest(F.length("letters") - 1, F.lit(0)) - legal).cast("long")


def audits(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit of every conversation of `rows`, which are
    those of damaged() or undamaged()."""
    found = materialize(_strings(_lettered(rows)), "conversation-letters")
    signature = F.translate("letters", BLANKS + REPEATS, "-" * 8)
    counted = found.select("conv_id", "gaps", *[_count(x).alias(name) for name, x in FAULTS.items()], _illegal().alias("illegal"), signature.alias("signature"))
    solved = materialize(_solved(counted.select("signature").distinct()), "conversation-audits")
    salted = solved.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    mine = counted.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    return mine.join(salted, ["signature", "salt"]).drop("salt", "signature")


def _line(role: str, text: str) -> bytes:
    return f"{role}:{text}".encode()


class _Replay:
    """The edits of one conversation, row by row: yields the repaired (role, text) in order."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, 0

    def _given(self) -> str:
        role = _GIVEN[self.state]
        self.state = _NEXT[self.state][role]
        return {"u": "user", "a": "assistant"}[role]

    def inserts(self) -> Iterator[tuple[str, str]]:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self.at += 1
            yield self._given(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserts()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.state = _NEXT[self.state][role[0]]
            yield role, text
        elif edit == "R":
            yield self._given(), text


TOLD = "conv_id long, repaired_sha256 string"
REPAIRED = "conv_id long, pos long, role string, text string"


def _replayed(rows: DataFrame, audited: DataFrame, digest: bool) -> DataFrame:
    """TOLD of every conversation, or REPAIRED rows. A conversation's audit comes ahead of its rows."""
    schema = TOLD if digest else REPAIRED
    lines = rows.where("NOT gone_").select("conv_id", F.lit(1).alias("kind_"), F.col("turn").alias("turn_"), "role_", F.sha2("text_", 256).alias("hash_"), "copy_", "text_")
    heads = audited.select("conv_id", F.lit(0).alias("kind_"), F.lit(None).cast("long").alias("turn_"), F.lit("").alias("role_"), F.lit("").alias("hash_"), F.lit(0).alias("copy_"), F.col("audit").alias("text_"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, replay, hashed, n = None, None, None, 0
        out: list[tuple] = []

        def take(lines: Iterator[tuple[str, str]]) -> None:
            nonlocal n
            for role, text in lines:
                if digest:
                    hashed.update((b"\n" if n else b"") + _line(role, text))
                else:
                    out.append((conv, n, role, text))
                n += 1

        def close() -> None:
            take(replay.inserts())
            if digest:
                out.append((conv, hashed.hexdigest()))

        for b in batches:
            for own, kind, role, text in zip(*(b.column(i).to_pylist() for i in range(4))):
                if kind == 0:
                    if replay:
                        close()
                    conv, replay, hashed, n = own, _Replay(text), hashlib.sha256(), 0
                else:
                    take(replay.row(role, text))
            yield _batch(out, schema)
            out = []
        if replay:
            close()
            yield _batch(out, schema)

    ordered = heads.unionByName(lines).repartition("conv_id").sortWithinPartitions("conv_id", "kind_", *ORDER)
    return ordered.select("conv_id", "kind_", "role_", "text_").mapInArrow(run, schema)


def _typed(conversations: DataFrame) -> DataFrame:
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string"))


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, pos, role, text: every conversation after the cheapest edits, rows numbered from 0.

    Rows go by turn (nulls first), then role, hash of the text. A null role or text is one space. An empty role has
    no initial and can't be kept as it is. Rows without a conv_id are one conversation. A conversation of which
    nothing is left has no row. An empty table gives an empty one; other columns, whatever their names, are not read.
    """
    rows = undamaged(_typed(conversations))
    return _replayed(rows, materialize(audits(rows), "conversation-audited"), digest=False)


def damaged_repairs(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation that
    damaged() and then repair() go through; the same holds for nulls, ties, repeated rows and empty tables."""
    rows = damaged(_typed(conversations))
    audited = materialize(audits(rows), "conversation-audited")
    digests = _replayed(rows, audited, digest=True).withColumnRenamed("conv_id", "conv_id_")
    return audited.join(digests, audited["conv_id"].eqNullSafe(digests["conv_id_"])).drop("conv_id_")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_repairs(spark.read.parquet(f"{sf_dir}/conversations.parquet"))

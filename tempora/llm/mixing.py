"""Mixing sources to target weights by min-cost flow over membership patterns.

Documents are aggregated by the set of sources they belong to. Words flow from each pattern to the sources in
it; the first copy of a pattern's words is free, every further copy costs one more than the last (a convex
cost), so repetition is spread evenly. Sources take at most their target. Only the aggregates - one row per
pattern - reach the driver; documents are then chosen on the cluster by a seeded hash.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tempora.llm.common import BLANK, bind, documents, materialize

#: Most copies of a document, and most patterns that may reach the driver.
MAX_COPIES, MAX_PATTERNS = 3, 100_000
LEVEL_BITS = 12
#: Documents of a grade that may follow its cut, and documents that may be added at the end.
NEXT, PICKS = 8, 8
UNIT = "struct<grade:int,u:bigint,n:bigint>"
CUTS, FILL, UNITS = "array<struct<grade:int,cut:bigint>>", "array<struct<grade:int,u:bigint>>", f"array<{UNIT}>"


def word_count(text: Column) -> Column:
    """Number of words; null and blank texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{BLANK}]+")), F.lit(0)).cast("long")


def water_fill(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = MAX_COPIES) -> list[float]:
    """Share total by weight; no share exceeds most times its size, the excess goes to the others by weight."""
    out, open_, left = [0.0] * len(sizes), list(range(len(sizes))), float(total)
    while open_:
        per = left / sum(weights[i] for i in open_)
        over = [i for i in open_ if per * weights[i] > most * sizes[i]]
        for i in over or open_:
            out[i] = float(most * sizes[i]) if over else per * weights[i]
        if not over:
            break
        left -= sum(most * sizes[i] for i in over)
        open_ = [i for i in open_ if i not in set(over)]
    return out


def min_cost_flow(supplies: Sequence[int], members: Sequence[Sequence[int]], quotas: Sequence[int], copies: int = MAX_COPIES) -> list[dict[int, int]]:
    """Words that each pattern sends to each of its sources: maximal, and of least total repetition cost.

    supplies: words of each pattern; members: its sources; quotas: what each source takes at most.
    Successive shortest paths with potentials; k-th copy of a pattern's words costs k - 1 each.
    """
    p, s = len(supplies), len(quotas)
    src, snk = p + s, p + s + 1
    graph: list[list[list[int]]] = [[] for _ in range(p + s + 2)]  # to, capacity, cost, index of the reverse arc

    def arc(a: int, b: int, cap: int, cost: int) -> None:
        graph[a].append([b, cap, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for i, size in enumerate(supplies):
        for k in range(copies):
            arc(src, i, size, k)
        for j in members[i]:
            arc(i, p + j, copies * size, 0)
    for j, quota in enumerate(quotas):
        arc(p + j, snk, quota, 0)
    height = [0] * len(graph)
    while True:
        dist, via = {src: 0}, {}
        queue = [(0, src)]
        while queue:
            d, a = heapq.heappop(queue)
            if d > dist[a]:
                continue
            for k, (b, cap, cost, _) in enumerate(graph[a]):
                if cap and (e := d + cost + height[a] - height[b]) < dist.get(b, 1 << 62):
                    dist[b], via[b] = e, (a, k)
                    heapq.heappush(queue, (e, b))
        if snk not in dist:
            break
        far = max(dist.values())
        height = [h + dist.get(a, far) for a, h in enumerate(height)]
        push, a = 1 << 62, snk
        while a != src:
            a, k = via[a]
            push = min(push, graph[a][k][1])
        a = snk
        while a != src:
            b, k = via[a]
            graph[b][k][1] -= push
            graph[a][graph[b][k][3]][1] += push
            a = b
    return [{b - p: copies * supplies[i] - cap for b, cap, _, _ in graph[i] if p <= b < p + s and copies * supplies[i] > cap} for i in range(p)]


def plan(spark: SparkSession, patterns: list[tuple[list[str | None], int]], weights: dict[str | None, float]) -> tuple[dict, dict, list]:
    """(size of each source, its target, words to take of each pattern). patterns: (sources, words)."""
    names = sorted({x for who, _ in patterns for x in who}, key=lambda x: (x is None, x or ""))
    at = {x: i for i, x in enumerate(names)}
    sizes = [0] * len(names)
    for who, words in patterns:
        for x in who:
            sizes[at[x]] += words
    total = sum(words for _, words in patterns)
    targets = water_fill(sizes, [weights[x] for x in names], total)
    sent = min_cost_flow([w for _, w in patterns], [[at[x] for x in who] for who, _ in patterns], [round(t) for t in targets])
    return dict(zip(names, sizes)), dict(zip(names, targets)), [sum(f.values()) for f in sent]


def cycle_weights(names: list[str | None]) -> dict[str | None, float]:
    """1, 2, 3, repeating, in code point order, null last."""
    return {x: 1 + i % 3 for i, x in enumerate(sorted(names, key=lambda x: (x is None, x or "")))}


def _pattern(membership: Column | None) -> Column:
    return F.array_sort(F.array_distinct(membership if membership is not None else F.array(F.col("source"))))


def _hash(seed: int, key: str) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1)


def _grade(size: Column) -> Column:
    """Sizes of one power of two are one grade; -1 for none."""
    return F.when(size > 0, F.length(F.bin(size)) - 1).otherwise(-1)


def decide(rows: DataFrame, weights=cycle_weights) -> DataFrame:
    """One row per pattern (at most MAX_PATTERNS): mix_pattern, base copies for all, cuts and fill for one more,
    source_size and target of its first source. rows: pattern, size, u."""
    spark = rows.sparkSession
    found = rows.groupBy("pattern").agg(F.sum("size").alias("words")).limit(MAX_PATTERNS + 1).collect()
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    found = sorted(((list(r["pattern"]), r["words"]) for r in found), key=lambda x: [(v is None, v or "") for v in x[0]])
    sizes, targets, words = plan(spark, found, weights(list({x for who, _ in found for x in who})))
    kind = T.StructType([T.StructField("mix_pattern", T.ArrayType(T.StringType())), T.StructField("base", T.LongType()), T.StructField("rest", T.LongType()), T.StructField("words", T.LongType()), T.StructField("source_size", T.LongType()), T.StructField("target", T.DoubleType())])
    table = [(who, w // n if n else 0, w % n if n else 0, n, sizes[who[0]] if who else 0, targets[who[0]] if who else 0.0) for (who, n), w in zip(found, words)]
    plans = spark.createDataFrame(table, kind)
    dealt = rows.where("size > 0").join(F.broadcast(plans.where("rest > 0").select("mix_pattern", "rest")), rows["pattern"].eqNullSafe(F.col("mix_pattern"))).drop("mix_pattern")
    cut = thresholds(dealt.withColumn("grade", _grade(F.col("size"))))
    # rows without words go with their share of the pattern
    blank = F.array(F.struct(F.lit(-1).alias("grade"), F.floor(F.col("rest") / F.greatest("words", F.lit(1)) * float(1 << 62) * 2).cast("long").alias("cut")))
    told = plans.join(cut, plans["mix_pattern"].eqNullSafe(cut["cut_pattern"]), "left")
    return materialize(told.select("mix_pattern", "base", "source_size", "target", F.concat(blank, F.coalesce("cuts", F.array().cast(CUTS))).alias("cuts"), F.coalesce("fill", F.array().cast(FILL)).alias("fill")), "mix-plan")


def _copies(size: Column) -> Column:
    """Copies of a row by its grade and its hash u."""

    def copies(grade: Column) -> Column:
        cut = F.get(F.filter("cuts", lambda c: c["grade"] == grade), F.lit(0))["cut"]
        more = F.coalesce(F.col("u") <= cut, F.lit(False)) | F.exists("fill", lambda f: (f["grade"] == grade) & (f["u"] == F.col("u")))
        return F.col("base") + F.when(more, 1).otherwise(0)

    return bind(_grade(size), copies)


def sizes_of(docs: DataFrame, membership: Column | None = None, seed: int = 7, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, pattern, size, u (seeded hash) of every row, written once: texts are read a single time."""
    return materialize(docs.select(F.col(key).alias("doc_id"), _pattern(membership).alias("pattern"), word_count(F.col(text)).alias("size"), _hash(seed, key).alias("u")), "mix-sizes")


def mix(docs: DataFrame, membership: Column | None = None, seed: int = 7, weights=cycle_weights, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, pattern (sources, sorted), size, source_size and target (of the first source), copies, taken.

    Nulls: a null text has size 0 and is taken 0 times or more with 0 words; null sources form a source of
    their own, last in order. Equal rows get equal copies. An empty table gives an empty result. Other columns
    are ignored, whatever their names.
    """
    rows = sizes_of(docs, membership, seed, key, text)
    plans = decide(rows, weights)
    whole = rows.join(F.broadcast(plans), rows["pattern"].eqNullSafe(plans["mix_pattern"]))
    return whole.select("doc_id", "pattern", "size", "source_size", "target", _copies(F.col("size")).alias("copies"), (_copies(F.col("size")) * F.col("size")).alias("taken"))


def repeat(docs: DataFrame, membership: Column | None = None, seed: int = 7, weights=cycle_weights, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of docs, all columns, as often as the mix takes them; only the plan of the patterns is joined.

    Rows that repeat come equally often. A null text has no words; such rows come with their pattern's share. An empty
    table gives an empty one.
    """
    plans = decide(sizes_of(docs, membership, seed, key, text), weights)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), _pattern(membership).alias("pattern"), _hash(seed, key).alias("u"))
    often = packed.join(F.broadcast(plans), packed["pattern"].eqNullSafe(plans["mix_pattern"]))
    n = bind(word_count(F.col("row")[text]), _copies)  # words are counted once
    return often.select("row", F.explode(F.array_repeat(F.lit(1), n.cast("int")))).select("row.*")


def _same(a: DataFrame, b: DataFrame, *more: Column) -> Column:
    out = a["pattern"].eqNullSafe(b["p"]) & (a["grade"] == b["g"])
    for m in more:
        out &= m
    return out


_OWN = ["pattern", "grade"]


def _cuts(rows: DataFrame, gaps: DataFrame) -> DataFrame:
    """pattern, grade, cut, taken: of every grade the rows whose hash is at most cut hold the grade's share of the gap,
    or lack less of it than the next row has. rows: pattern, grade, u, size; gaps: pattern, gap.

    Two histograms narrow the hash range, so that no window ever holds more than a histogram's rows or a 2**-24th of a
    grade; rows of one hash go together.
    """
    grades = rows.groupBy(*_OWN).agg(F.sum("size").alias("n"))
    words = grades.groupBy(F.col("pattern").alias("q")).agg(F.sum("n").alias("words"))
    gap = gaps.select(F.col("pattern").alias("p"), "gap")
    shares = grades.join(words, grades["pattern"].eqNullSafe(words["q"])).join(gap, grades["pattern"].eqNullSafe(gap["p"]))
    shares = materialize(shares.select("pattern", "grade", F.least("n", F.floor(F.col("n") * (F.col("gap") / F.col("words"))).cast("long")).alias("left")), "mix-shares")
    goal = shares.select(F.col("pattern").alias("p"), F.col("grade").alias("g"), "left", F.lit(0).cast("long").alias("before")).where("left > 0")
    level = rows.select("pattern", "grade", "u", "size")
    for done in (63 - LEVEL_BITS, 63 - 2 * LEVEL_BITS):
        b = F.shiftright("u", done)
        hist = level.groupBy(*_OWN, b.alias("b")).agg(F.sum("size").alias("n"))
        run = hist.withColumn("run", F.sum("n").over(Window.partitionBy(*_OWN).orderBy("b")))
        edge = run.join(goal, _same(run, goal)).where("before + run - n < left AND before + run >= left")
        goal = materialize(edge.select("p", "g", "left", (F.col("before") + F.col("run") - F.col("n")).alias("before"), F.col("b").alias("edge")), "mix-edges")
        level = level.join(goal.select("p", "g", "edge"), _same(level, goal, b == goal["edge"])).select("pattern", "grade", "u", "size")
    last = level.groupBy(*_OWN, "u").agg(F.sum("size").alias("n"))
    run = last.withColumn("run", F.sum("n").over(Window.partitionBy(*_OWN).orderBy("u")))
    met = run.join(goal, _same(run, goal))
    fits = F.col("before") + F.col("run") <= F.col("left")
    best = met.groupBy("p", "g").agg(F.coalesce(F.max(F.when(fits, F.col("u"))), F.min("u") - 1).alias("cut"), (F.first("before") + F.coalesce(F.max(F.when(fits, F.col("run"))), F.lit(0))).alias("taken"))
    out = shares.join(best, _same(shares, best), "left")
    return materialize(out.select("pattern", "grade", F.coalesce("cut", F.lit(-1).cast("long")).alias("cut"), F.coalesce("taken", F.lit(0).cast("long")).alias("taken")), "mix-cuts")


def _first_units(units: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first `most` units of each group; what is behind them is dropped before the shuffle, too."""
    return units.withColumn("nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("nth") <= most).drop("nth")


def _state(gap: Column, picked: Column) -> Column:
    return F.struct(gap.alias("gap"), picked.alias("picked"))


def _fits(s: Column, x: Column) -> Column:
    """The state after a document that fits the gap."""
    return F.when(x["x"]["n"] <= s["gap"], _state(s["gap"] - x["x"]["n"], F.concat(s["picked"], F.array(x["x"])))).otherwise(s)


def _nearest(s: Column, _: Column) -> Column:
    """The state after the document of `sized` that brings the sum nearest, if any brings it nearer."""
    free = F.filter("sized", lambda x: ~F.array_contains(s["picked"], x) & (F.abs(s["gap"] - x["n"]) < F.abs(s["gap"])))
    best = F.array_min(F.transform(free, lambda x: F.struct(F.abs(s["gap"] - x["n"]).alias("d"), x.alias("x"))))["x"]
    return F.when(F.size(free) > 0, _state(s["gap"] - best["n"], F.concat(s["picked"], F.array(best)))).otherwise(s)


def _open_units(dealt: DataFrame, told: DataFrame) -> DataFrame:
    """pattern, grade, u, n of what neither a cut nor a pick has taken, in patterns that still lack words."""
    lacking = told.where("gap > 0").select(F.col("pattern").alias("p"), "gap", "cuts", "picked")
    cut = F.get(F.filter("cuts", lambda c: c["grade"] == F.col("grade")), F.lit(0))["cut"]
    met = dealt.join(F.broadcast(lacking), dealt["pattern"].eqNullSafe(lacking["p"])).where(F.col("u") > F.coalesce(cut, F.lit(-1)))
    free = met.where(~F.exists("picked", lambda x: (x["grade"] == F.col("grade")) & (x["u"] == F.col("u"))))
    return free.groupBy(*_OWN, "u").agg(F.sum("size").alias("n"))


def thresholds(dealt: DataFrame) -> DataFrame:
    """cut_pattern, cuts, fill: rows whose hash is at most the cut of their grade, or is in fill, hold about `rest` words.

    Each grade of sizes gives its share of rest, so that long and short documents are as likely to be taken. What is
    left open is filled from the largest grade down by the next documents that fit; a grade whose next one doesn't
    is done, and the others share what is still open. So a round ends at least one grade, and most mixes take two.
    At the end, of all sizes under twice the gap, whichever document brings the sum nearest is added, until none does.
    """
    told = dealt.groupBy("pattern").agg(F.first("rest").alias("gap")).select("pattern", "gap", F.array().cast(CUTS).alias("cuts"), F.array().cast(UNITS).alias("picked"))
    told, rows, unit = materialize(told, "mix-told"), dealt, F.struct("grade", "u", "n")
    while True:
        cuts = _cuts(rows, told)
        new = cuts.groupBy(F.col("pattern").alias("p")).agg(F.sum("taken").alias("taken"), F.array_sort(F.collect_list(F.struct("grade", "cut"))).alias("new"))
        old = F.filter("cuts", lambda c: ~F.exists("new", lambda d: d["grade"] == c["grade"]))
        told = told.join(new, told["pattern"].eqNullSafe(new["p"]), "left").select("pattern", (F.col("gap") - F.coalesce("taken", F.lit(0))).alias("gap"), F.when(F.col("new").isNull(), F.col("cuts")).otherwise(F.concat(old, "new")).alias("cuts"), "picked")
        told = materialize(told, "mix-told")
        near = _first_units(_open_units(dealt, told), _OWN, ["u"], NEXT).groupBy(F.col("pattern").alias("p")).agg(F.array_sort(F.collect_list(F.struct((-F.col("grade")).alias("o"), "u", unit.alias("x")))).alias("next"))
        both = told.join(near, told["pattern"].eqNullSafe(near["p"]), "left").withColumn("next", F.coalesce("next", F.array().cast(f"array<struct<o:int,u:bigint,x:{UNIT}>>")))
        both = both.withColumn("s", F.aggregate("next", _state(F.col("gap"), F.col("picked")), _fits)).select("pattern", "cuts", "s.gap", "s.picked", "next")
        free = F.filter("next", lambda x: ~F.array_contains("picked", x["x"]))
        # a grade goes on if its next document fits, or if all that were looked at have been taken
        fit = F.filter(F.transform("next", lambda x: x["x"]["grade"]), lambda g: F.exists(free, lambda x: (x["x"]["grade"] == g) & (x["x"]["n"] <= F.col("gap"))) | ((F.size(F.filter("next", lambda x: x["x"]["grade"] == g)) == NEXT) & ~F.exists(free, lambda x: x["x"]["grade"] == g) & (F.col("gap") > 0)))
        told = materialize(both.select("pattern", "gap", "cuts", "picked", F.array_distinct(fit).alias("open")), "mix-told")
        again = told.where("gap > 0 AND size(open) > 0").select(F.col("pattern").alias("p"), "open")
        if again.isEmpty():
            break
        units = _open_units(dealt, told)
        rows = materialize(units.join(F.broadcast(again), units["pattern"].eqNullSafe(again["p"]) & F.array_contains("open", F.col("grade"))).select("pattern", "grade", "u", F.col("n").alias("size")), "mix-open")
        told = told.drop("open")
    gap = told.where("gap > 0").select(F.col("pattern").alias("q"), F.col("gap").alias("g"))
    small = _open_units(dealt, told.drop("open")).join(gap, F.col("pattern").eqNullSafe(F.col("q"))).where(F.col("n") < 2 * F.col("g")).select("pattern", "grade", "u", "n")
    sized = _first_units(small, ["pattern", "n"], ["grade", "u"], PICKS).groupBy(F.col("pattern").alias("p")).agg(F.array_sort(F.collect_list(unit)).alias("sized"))
    last = told.join(sized, told["pattern"].eqNullSafe(sized["p"]), "left").withColumn("sized", F.coalesce("sized", F.array().cast(UNITS)))
    last = last.withColumn("s", F.aggregate(F.sequence(F.lit(1), F.lit(PICKS)), _state(F.col("gap"), F.col("picked")), _nearest))
    return last.select(F.col("pattern").alias("cut_pattern"), "cuts", F.transform("s.picked", lambda x: F.struct(x["grade"].alias("grade"), x["u"].alias("u"))).alias("fill"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")

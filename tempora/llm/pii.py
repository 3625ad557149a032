"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Entities that the base patterns find are the seeds. They induce lexical patterns: the word before, the word
after, both together, and the entity's own shape. Patterns and the identifier-like strings they go with form a
bipartite graph, scored in rounds: a pattern is as good as the share of its distinct instances that belong to the
kind, an instance as good as its patterns together (noisy-or). Instances above the bar become new entities;
their places are added to the base spans.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tempora.llm.common import BLANK, discard, documents, materialize, regex_spans, span_string

_LOCAL = r"[A-Za-z0-9._%+-]"
#: The base pattern of each kind, in the order in which kinds are listed. They find what the plain
#: forms find; look-behinds and possessive quantifiers keep long runs linear and off the stack.
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A word that might be part of an identifier: it has a digit or an at sign. Runs are two or more of them in a row.
_ODD = rf"[^{BLANK}0-9@]*+[0-9@][^{BLANK}]*+"
CANDIDATE = rf"(?<![^{BLANK}]){_ODD}"
RUNS = rf"(?<![^{BLANK}]){_ODD}(?:[{BLANK}]++{_ODD})++"

#: Rounds; least share of a pattern's instances, least number of distinct known ones; least confidence of an instance.
ROUNDS, PATTERN_BAR, SUPPORT, INSTANCE_BAR = 3, 0.8, 5, 0.9
MARKS = "array<struct<rank:int,start:int,end:int,kind:string>>"
SEEN = "array<struct<kind:string,instance:string,left:string,right:string,rank:int,start:int,end:int>>"
#: Rows of added spans, and the spans in them, up to which they are broadcast.
SMALL_ROWS, SMALL_SPANS = 10_000, 100_000


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    value = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substr(back, i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(F.transform(value, lambda v: F.when(v > 9, v - 9).otherwise(v)), F.lit(0), lambda a, v: a + v) % 10 == 0


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        part = lambda x: F.regexp_replace(x, "^0+", "")
        return F.forall(F.split(found, r"\."), lambda x: (F.length(part(x)) <= 3) & (F.concat(F.lit("0"), F.left(part(x), F.lit(3))).cast("int") <= 255))
    if kind == "card":
        n = F.length(_digits(found))
        return F.when((n >= 16) & (n <= 19), _luhn(_digits(found))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _screen(kind: str, text: Column) -> Column:
    """Cheap: false only where the kind's pattern can't match."""
    if kind in ("email", "phone"):
        return F.contains(text, F.lit("@" if kind == "email" else "+"))
    return text.rlike(r"[0-9]\.[0-9]" if kind == "ip" else "[0-9]")


def _instance(found: Column) -> Column:
    """A word without the punctuation around it, in lower case."""
    return F.lower(F.regexp_replace(found, r"^[^0-9A-Za-z@+(]++|(?<![^0-9A-Za-z])[^0-9A-Za-z]++$", ""))


def _seen(spans: Column, kind: str | None, rank: int) -> Column:
    """Spans with the whole words before and after them; '' at the ends of a text."""
    left = lambda s: F.lower(F.regexp_extract(s["left"], rf"(?<![^{BLANK}])([^{BLANK}]++)[{BLANK}]*+$", 1))
    right = lambda s: F.lower(F.regexp_extract(s["right"], rf"^[^{BLANK}]*+[{BLANK}]++([^{BLANK}]++)", 1))
    return F.transform(
        spans,
        lambda s: F.struct(
            F.lit(kind).cast("string").alias("kind"), (F.lower(s["found"]) if kind else _instance(s["found"])).alias("instance"), left(s).alias("left"), right(s).alias("right"),
            F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"),
        ),
    )


def base_entities(text: Column) -> Column:
    """Base spans with their contexts, by kind as listed, then start."""
    each = [_seen(F.filter(regex_spans(text, p, _screen(kind, text)), lambda s: _valid(kind, s["found"])), kind, rank) for rank, (kind, p) in enumerate(PATTERNS.items())]
    return F.concat(*each)


def candidates_of(text: Column) -> Column:
    """Words with a digit or an at sign, and runs of such words, with their contexts."""
    some = text.rlike("[0-9@]")
    return F.concat(_seen(regex_spans(text, CANDIDATE, some), None, -1), _seen(regex_spans(text, RUNS, some), None, -1))


def shape(instance: Column) -> Column:
    """The instance with a 9 for every digit and one a for every run of letters."""
    return F.regexp_replace(F.regexp_replace(instance, "[0-9]", "9"), r"\p{L}++", "a")


def _edges(rows: DataFrame) -> DataFrame:
    """Distinct (pattern, instance) of known entities and candidates."""
    word = lambda tag, c: F.when(F.col(c) != "", F.concat(F.lit(f"{tag}:"), c))
    both = F.when((F.col("left") != "") & (F.col("right") != ""), F.concat(F.lit("B:"), "left", F.lit(" "), "right"))
    every = F.array_compact(F.array(word("L", "left"), word("R", "right"), both, F.concat(F.lit("S:"), shape(F.col("instance")))))
    return rows.where("instance <> ''").select("instance", F.explode(every).alias("pattern")).distinct()


def bootstrap(entities: DataFrame, candidates: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """instance, kind, conf of the identifiers that the base patterns miss.

    entities: kind, instance, left, right of the seeds; candidates: instance, left, right. The rows of the
    graph are distinct, so that a text repeated a million times counts once. An instance of several kinds goes to
    the likeliest, of equals to the first by name.
    """
    seeds = materialize(entities.select("instance", "kind").distinct().withColumn("conf", F.lit(1.0)), "pii-seeds")
    edges = materialize(_edges(entities.select("instance", "left", "right").union(candidates.select("instance", "left", "right"))), "pii-edges")
    totals = edges.groupBy("pattern").agg(F.count("*").alias("n"))
    conf, used = seeds, [edges]
    for _ in range(rounds):
        known = edges.join(conf, "instance").groupBy("pattern", "kind").agg(F.sum("conf").alias("s"))
        good = known.where(F.col("s") >= SUPPORT).join(totals, "pattern").where(F.col("s") / F.col("n") >= PATTERN_BAR).select("pattern", "kind", (F.col("s") / F.col("n")).alias("p"))
        told = edges.join(good, "pattern").groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.least("p", F.lit(0.999)))))).alias("conf"))
        new = told.join(seeds.select("instance").distinct(), "instance", "left_anti").where(F.col("conf") >= 0.5)
        best = new.groupBy("instance").agg(F.min_by(F.struct("kind", "conf"), F.struct(-F.col("conf"), F.col("kind"))).alias("x")).select("instance", "x.*")
        conf = materialize(seeds.unionByName(best), "pii-conf")
        used.append(conf)
    found = materialize(conf.join(seeds.select("instance").distinct(), "instance", "left_anti").where(F.col("conf") >= INSTANCE_BAR), "pii-found")
    for x in [*used, seeds]:
        discard(x)
    return found


def _free(places: DataFrame, base: DataFrame) -> DataFrame:
    """Places (blob, start, end, ...) that touch no base span (blob, start, end) of the same text.

    Both are put in one order by text: a place at its end, a base span at its start and after it. The greatest
    end of the base spans so far then tells whether one reaches into the place.
    """
    rows = places.withColumns({"at": F.col("end"), "order": F.lit(0)}).unionByName(base.select("blob", "start", "end", F.col("start").alias("at"), F.lit(1).alias("order")), allowMissingColumns=True)
    sofar = Window.partitionBy("blob").orderBy("at", "order").rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(F.col("order") == 1, F.col("end"))).over(sofar)
    return rows.withColumn("reach", reach).where("order = 0 AND (reach IS NULL OR reach <= start)").select(places.columns)


def find(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(key, blob, base spans of every row; blob, added spans of the texts that have some).

    A null text is empty and has no spans. Equal texts have equal spans; repeated rows and null keys are all
    kept. Other columns are not read. An empty table gives empty results.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), F.sha2(body, 256).alias("blob"), base_entities(body).cast(SEEN).alias("base"), candidates_of(body).cast(SEEN).alias("others"))
    rows = materialize(rows, "pii-rows")
    entities = rows.select("blob", F.explode("base").alias("x")).select("blob", "x.*").distinct()
    every = rows.select("blob", F.explode("others").alias("x")).select("blob", "x.*").drop("kind", "rank").distinct()
    places = materialize(_free(every, entities), "pii-places")
    found = bootstrap(entities, places)
    rank = F.element_at(F.create_map(*[v for i, k in enumerate(PATTERNS) for v in (F.lit(k), F.lit(i))]), found["kind"])
    hits = places.join(found.select("instance", "kind", rank.alias("rank")), "instance")
    added = hits.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("rank", "start", "end", "kind"))).alias("added"))
    marks = F.transform("base", lambda b: F.struct(b["rank"], b["start"], b["end"], b["kind"])).cast(MARKS)
    return rows.select("key", "blob", marks.alias("base")), added


def beside(added: DataFrame) -> DataFrame:
    """added, written, and broadcast if rows and spans are few; else it is joined by a shuffle."""
    added = materialize(added, "pii-added")
    spans = added.columns[-1]
    size = added.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size(spans)), F.lit(0)).alias("m")).first()
    return F.broadcast(added) if size["n"] <= SMALL_ROWS and size["m"] <= SMALL_SPANS else added


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span, base or added, replaced by its kind in angle brackets; a null text stays null.

    Repeated rows all come back, alike; an empty table gives an empty one; other columns stay as they are.
    """
    _, added = find(docs, key=text)
    body = F.coalesce(F.col(text), F.lit(""))
    marks = F.transform(base_entities(body), lambda b: F.struct(b["rank"], b["start"], b["end"], b["kind"])).cast(MARKS)
    named = added.select(F.col("blob").alias("_pii_blob"), F.col("added").alias("_pii_added"))
    joined = docs.join(beside(named), F.sha2(body, 256) == F.col("_pii_blob"), "left")
    return joined.withColumn(text, F.when(F.col(text).isNotNull(), _cut(F.col(text), F.concat(marks, F.coalesce("_pii_added", F.array().cast(MARKS)))))).select(docs.columns)


def _cut(text: Column, marks: Column) -> Column:
    """Overlapping spans are merged; the first one's kind names the gap."""
    order = F.array_sort(F.transform(marks, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["kind"].alias("kind"))))
    start = F.struct(F.lit(0).alias("pos"), F.lit("").alias("out"))

    def step(acc: Column, m: Column) -> Column:
        fresh = m["start"] >= acc["pos"]
        piece = F.concat(acc["out"], F.substr(text, acc["pos"] + 1, F.greatest(m["start"] - acc["pos"], F.lit(0))), F.lit("<"), F.upper(m["kind"]), F.lit(">"))
        return F.struct(F.greatest(acc["pos"], m["end"]).alias("pos"), F.when(fresh, piece).otherwise(acc["out"]).alias("out"))

    walked = F.aggregate(order, start, step, lambda acc: F.concat(acc["out"], F.substr(text, acc["pos"] + 1, F.length(text))))
    return F.when(F.size(order) > 0, walked).otherwise(text)


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, added = find(documents(spark, sf_dir))
    whole = rows.join(beside(added), "blob", "left")
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    every = F.array_sort(F.concat("base", F.coalesce("added", F.array().cast(MARKS))))
    return whole.select(F.col("key").alias("doc_id"), *map(n, PATTERNS), F.sha2(span_string(F.col("base")), 256).alias("base_sha256"), span_string(every).alias("spans"))

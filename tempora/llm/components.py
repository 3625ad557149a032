"""Connected components by contraction, for graphs that only fit the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tempora.llm.common import materialize


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of links (a, b; integers), root being one node of its component.

    In each round a node moves to the neighbour, or itself, of the least hash; links follow their ends, and
    loops and repeats go. The hash changes every round, so that no order of node numbers makes long chains;
    the links shrink by a constant factor on average. Every step is an aggregation or an equi-join of narrow
    rows; a node with many links is pre-aggregated on the map side.
    """
    links = materialize(links.select("a", "b").where("a <> b").distinct(), "links")
    moves: list[DataFrame] = []
    while links.limit(1).count():
        ends = links.select("a", "b").union(links.select(F.col("b"), F.col("a")))
        order = lambda c, k=len(moves): F.xxhash64(F.lit(k), F.col(c))
        best = ends.groupBy("a").agg(F.min(F.struct(order("b").alias("h"), F.col("b").alias("to"))).alias("m"))
        nearest = F.when(order("a") < F.col("m.h"), F.col("a")).otherwise(F.col("m.to"))
        move = materialize(best.select(F.col("a").alias("node"), nearest.alias("to")), "moves")
        moves.append(move)
        first = links.join(move.select(F.col("node").alias("a"), F.col("to").alias("a2")), "a")
        both = first.join(move.select(F.col("node").alias("b"), F.col("to").alias("b2")), "b")
        links = materialize(both.where("a2 <> b2").select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "links")
    if not moves:
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = moves[0].select("node", F.col("to").alias("root"))
    for move in moves[1:]:
        step = move.select(F.col("node").alias("root"), F.col("to").alias("next"))
        found = found.join(step, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found

"""The odds loop as a stream: a batch of fetches changes the parts of the store that its events and matches lie in.

Staged rows are added by day of their fetch; events, the quote history of each event and that of each match are cut
in hash parts. A history is a widest interval for each quote, so that the order in which fetches arrive, and a fetch that
comes twice, change nothing. A batch is published with its number by one rename: one that is repeated after a crash is
done once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tempora.operators.merge import widen
from tempora.plans import odds, staging
from tempora.store import Change, Store, part_of

RAW = "raw_id string, source string, endpoint string, request_params string, ingested_at timestamp, payload string"
STAGED = "raw_id string, fetched_at timestamp, event_id string, commence_time timestamp, home_team_name string, away_team_name string, bookmaker_key string, bookmaker_title string, market_key string, source_updated_at timestamp, outcome_role string, outcome_name string, price decimal(9,3)"
_HISTORY = "bookmaker_key string, market_key string, source_updated_at timestamp, home_price decimal(9,3), draw_price decimal(9,3), away_price decimal(9,3), first_seen_at timestamp, last_seen_at timestamp, bookmaker_title string"
QUOTES = f"event_id string, {_HISTORY}"
FACTS = f"match_id bigint, {_HISTORY}, is_complete boolean, overround double, home_prob_fair double, draw_prob_fair double, away_prob_fair double"
EVENTS = "event_id string, commence_time timestamp, home_team_name string, away_team_name string, described_at timestamp, match_id bigint, confidence double, note string"
#: Hash parts of events, event histories and match histories.
PARTS = 64


def _listed(part: DataFrame) -> list[str]:
    """Parts that occur: at most PARTS, or the days of a batch."""
    return sorted(r[0] for r in part.distinct().collect())


def _described(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """The newest description of each event, of the store's and the batch's."""
    told = ["commence_time", "home_team_name", "away_team_name"]
    both = stored.select("event_id", *told, "described_at").unionByName(fresh.select("event_id", *told, F.col("fetched_at").alias("described_at")))
    newest = both.groupBy("event_id").agg(F.max(F.struct("described_at", *told)).alias("d"))
    return newest.select("event_id", *[f"d.{c}" for c in told], "d.described_at")


def _settle(store: Store, fresh: DataFrame, fixtures: DataFrame, parts: int, touched: list[str]) -> dict[str, Change]:
    """Changes of events, event histories and match histories where events lie in the touched parts."""
    by_event = part_of("event_id", parts=parts)
    stored = store.read("odds_events", EVENTS, touched)
    described = _described(stored, fresh)
    settled = stored.where("match_id IS NOT NULL").select("event_id", "match_id", "confidence", "note")
    found = odds.resolve(described.join(settled, "event_id", "left_anti"), fixtures)  # a resolution that stands is kept
    resolved = described.join(settled, "event_id").select(found.columns).unionByName(found)
    quotes = widen(store.read("event_quotes", QUOTES, touched), odds.event_changes(fresh), ["event_id", *odds.QUOTE[1:]], "first_seen_at", "last_seen_at", ["bookmaker_title"])
    moved = found.select("event_id").union(fresh.select("event_id")).distinct()
    known = resolved.where("match_id IS NOT NULL").join(moved, "event_id", "left_semi").select("event_id", "match_id")
    told = quotes.join(known, "event_id").drop("event_id")
    by_match = part_of("match_id", parts=parts)
    at = _listed(known.select(by_match))
    facts = odds.merge(store.read("bookmaker_odds", FACTS, at), told)
    return {
        "odds_events": Change(resolved.withColumn("part", by_event), touched),
        "event_quotes": Change(quotes.withColumn("part", by_event), touched),
        "bookmaker_odds": Change(facts.withColumn("part", by_match), at),
    }


def absorb(store: Store, fetches: DataFrame, fixtures: DataFrame, batch: tuple[str, int] | None = None, parts: int = PARTS) -> str | None:
    """Stage the fetches that are new and merge them; None if the batch (name and number) is in the store already."""
    marks = {}
    if batch is not None:
        name, number = f"batch:{batch[0]}", batch[1]
        if int(store.manifest()["marks"].get(name, -1)) >= number:
            return None
        marks = {name: str(number)}
    day = F.date_format("ingested_at", "yyyy-MM-dd")
    days = _listed(fetches.where("ingested_at IS NOT NULL").select(day))
    place = f"{store.base}/{store.folder()}/batch"
    rows = staging.odds(fetches, store.read("staged_odds", STAGED, days))
    rows.write.parquet(place)  # parsed once
    fresh = store.spark.read.schema(STAGED).parquet(place)
    touched = _listed(fresh.select(part_of("event_id", parts=parts)))
    changes = {"staged_odds": Change(fresh.withColumn("part", F.date_format("fetched_at", "yyyy-MM-dd")))}
    changes |= _settle(store, fresh, fixtures, parts, touched) if touched else {}
    return store.publish(changes=changes, marks=marks)


def look_again(store: Store, fixtures: DataFrame, parts: int = PARTS) -> str | None:
    """Events that are still open, after the fixtures have changed; None if there are none."""
    touched = _listed(store.read("odds_events", EVENTS).where("match_id IS NULL").select(part_of("event_id", parts=parts)))
    if not touched:
        return None
    return store.publish(changes=_settle(store, store.spark.createDataFrame([], STAGED), fixtures, parts, touched))


def run(spark: SparkSession, raw_dir: str, store: Store, fixtures: DataFrame, checkpoint: str) -> StreamingQuery:
    """All fetches that have arrived, in micro-batches. A batch is known by the checkpoint and its number; fetches
    that another checkpoint has brought in are known by their raw_id."""
    stream = spark.readStream.schema(RAW).json(raw_dir)
    return stream.writeStream.foreachBatch(lambda df, n: absorb(store, df, fixtures, (checkpoint, n)) and None).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()

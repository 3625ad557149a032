"""Ranking pages: cells by patterns, checks by aggregation over all pages; and the links of any page."""

from __future__ import annotations

import html as entities
from datetime import date

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tempora.operators.latest import keep_latest, newest
from tempora.operators.merge import first_seen

#: Most rows of a page.
PAGE_ROWS = 50
COLUMNS = ["page", "ranking_date", "club_slug", "club_name", "country", "world_rank", "rating_points", "last_page", "error"]


@F.pandas_udf(T.StringType())
def _unescaped(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else entities.unescape(t))


def _between(text: Column, tag: str) -> Column:
    """What stands inside every element of a tag; such elements don't nest in these pages."""
    return F.regexp_extract_all(text, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)</{tag}>"), F.lit(1))


def _plain(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "<[^>]*>", ""))


def _link(row: Column, target: str, group: int) -> Column:
    """The first link of a row to target: its rest (1) or its text (2)."""
    return F.regexp_extract(row, rf'(?is)<a\b[^>]*\bhref="{target}([^"]*)"[^>]*>(.*?)</a>', group)


def _number(cell: Column) -> Column:
    return F.replace(_plain(cell), F.lit(","), F.lit("")).try_cast("int")


def clubs(pages: DataFrame, page: str = "page", html: str = "html") -> DataFrame:
    """A row for every ranked club as it is written, unchecked; a page without one keeps a row of nulls."""
    body = F.coalesce(F.col(html), F.lit(""))
    day = F.regexp_extract(body, r'(?is)<span\b[^>]*itemprop="dateModified"[^>]*>(.*?)</span>', 1)
    ends = F.transform(F.regexp_extract_all(body, F.lit(r'href="/ranking/world/([0-9]+)"'), F.lit(1)), lambda n: n.try_cast("int"))
    ranked = F.filter(_between(body, "tr"), lambda r: r.contains("/clubs-ranking/"))
    rows = pages.select(F.col(page).alias("page"), F.try_to_date(F.trim(_plain(day)), "d MMMM yyyy").alias("ranking_date"), F.greatest(F.lit(1), F.array_max(ends)).alias("last_page"), F.explode_outer(ranked).alias("row"))
    cells = _between(F.col("row"), "td")
    return rows.select(
        "page", "ranking_date", _link(F.col("row"), "/clubs-ranking/", 1).alias("club_slug"), _unescaped(_plain(_link(F.col("row"), "/clubs-ranking/", 2))).alias("club_name"),
        _unescaped(_plain(_link(F.col("row"), "/ranking/", 2))).alias("country"), _number(F.get(cells, F.lit(0))).alias("world_rank"), _number(F.get(cells, F.lit(2))).alias("rating_points"), "last_page",
    )


def parse_pages(pages: DataFrame, page: str = "page", html: str = "html") -> DataFrame:
    """Rows of all pages; a page that is refused - one broken row refuses it - gives one row with its error.

    The ranks of page n follow on from (n - 1) * PAGE_ROWS. A null page is refused like an empty one.
    """
    rows = clubs(pages, page, html)
    n = F.count("club_slug")
    broken = F.col("club_slug").isNotNull() & ~F.coalesce((F.col("club_slug") != "") & (F.col("club_name") != "") & (F.col("country") != "") & F.col("world_rank").isNotNull() & F.col("rating_points").isNotNull(), F.lit(False))
    start = (F.col("page") - 1) * PAGE_ROWS
    told = rows.groupBy("page").agg(
        F.when(F.count("ranking_date") == 0, "the page has no date").when((n < 1) | (n > PAGE_ROWS), F.concat(F.lit(f"a page has 1 to {PAGE_ROWS} rows, this one "), n.cast("string")))
        .when(F.bool_or(broken), "a ranking row is incomplete").when((F.min("world_rank") != F.first(start) + 1) | (F.max("world_rank") != F.first(start) + n) | (F.count_distinct("world_rank") != n), "ranks aren't contiguous")
        .when(F.count_distinct("club_slug") != n, "a club occurs twice").when(F.min("rating_points") <= 0, "points must be positive").alias("error")
    )
    good = rows.join(told.where("error IS NULL"), "page").select(COLUMNS)
    return good.unionByName(told.where("error IS NOT NULL"), allowMissingColumns=True).select(COLUMNS)


def one_edition(parsed: DataFrame, day: str | date | None = None) -> DataFrame:
    """One row, complete or not: all pages to the last are there, accepted, and of a single date, not after `day`."""
    seen = parsed.agg(F.count("error").alias("refused"), F.count_distinct("ranking_date").alias("dates"), F.max("ranking_date").alias("newest"), F.count_distinct("page").alias("pages"), F.max("last_page").alias("last_page"))
    known = F.lit(True) if day is None else F.col("newest") <= F.lit(str(day)).cast("date")
    return seen.withColumn("complete", F.coalesce((F.col("refused") == 0) & (F.col("dates") == 1) & (F.col("pages") == F.col("last_page")) & known, F.lit(False))).drop("newest")


PAGES = "page int, ranking_date date, payload_hash string, html string, observed_at timestamp, last_checked_date date, request_url string, run_id string"


def cached(stored: DataFrame, day: str | date) -> DataFrame:
    """page, html of the pages (PAGES) that were checked on `day` already: of each the newest capture."""
    today = stored.where(F.col("last_checked_date") == F.lit(str(day)).cast("date"))
    return keep_latest(today, ["page"], newest("observed_at", "payload_hash")).select("page", "html")


def to_fetch(stored: DataFrame, day: str | date, most: int) -> DataFrame:
    """page: those of the edition that no check of `day` has seen. Page 1 tells how many there are."""
    have = cached(stored, day)
    last = clubs(have.where("page = 1")).agg(F.least(F.lit(most), F.coalesce(F.max("last_page"), F.lit(1))).alias("last"))
    return last.select(F.explode(F.sequence(F.lit(1), "last")).alias("page")).join(have, "page", "left_anti")


def judged(parsed: DataFrame, day: str | date) -> DataFrame:
    """page, ranking_date, payload_hash, error of every parsed page, in the light of the others: a date after `day`, or
    another one than the first page's, refuses a page, and a refused page all that follow it."""
    rows = F.array_sort(F.collect_list(F.struct("world_rank", "club_slug", "club_name", "country", "rating_points")))
    pages = parsed.groupBy("page").agg(F.max("ranking_date").alias("ranking_date"), F.sha2(F.to_json(rows), 256).alias("payload_hash"), F.max("error").alias("error"))
    every = Window.partitionBy(F.lit(0))  # an edition's pages are few
    known = pages.withColumn("_first", F.min_by("ranking_date", "page").over(every))
    told = F.coalesce("error", F.when(F.col("ranking_date") > F.lit(str(day)).cast("date"), "the ranking's date lies ahead").when(~F.col("ranking_date").eqNullSafe(F.col("_first")), "the ranking changed between pages"))
    marked = known.withColumn("error", told).withColumn("_from", F.min(F.when(F.col("error").isNotNull(), F.col("page"))).over(every))
    return marked.withColumn("error", F.coalesce("error", F.when(F.col("page") > F.col("_from"), "a page before it is refused"))).drop("_first", "_from")


def absorb(stored: DataFrame, fetched: DataFrame, day: str | date) -> tuple[DataFrame, DataFrame]:
    """(stored pages with the good ones of `day`, judged() of the day's edition).

    fetched: page, html, observed_at, request_url, run_id. Pages that the day has seen already count with them. A
    page whose rows are known keeps its first capture, and is marked as checked; good pages before a refused one are
    kept, so that the next run goes on from there.
    """
    here = F.lit(str(day)).cast("date")
    edition = fetched.select("page", "html").unionByName(cached(stored, day).join(fetched.select("page"), "page", "left_anti"))
    told = judged(parse_pages(edition), day)
    good = fetched.join(told.where("error IS NULL").drop("error"), "page").withColumn("last_checked_date", here).select(stored.columns)
    return first_seen(stored, good, ["page", "ranking_date", "payload_hash"], "last_checked_date", "observed_at"), told


#: What a page shows nothing of: comments, scripts and styles.
_HIDDEN = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
#: A start tag of a link, whose attribute values may hold a >; and its target: quoted either way, or bare.
_ANCHOR = r"""(?is)<a\s(?:[^>"']|"[^"]*"|'[^']*')*>"""
_HREF = r"""(?is)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""


def links(pages: DataFrame, key: str, html: str) -> DataFrame:
    """key, pos (from 0) and href of every link of every page, by patterns.

    Comments, scripts and styles are left out, anchors without a target or with an empty one too. Entities are
    resolved; only targets that have any go through Python. A null page has no link.
    """
    shown = F.regexp_replace(F.coalesce(F.col(html), F.lit("")), _HIDDEN, " ")
    written = F.transform(F.regexp_extract_all(shown, F.lit(_ANCHOR), F.lit(0)), lambda a: F.regexp_extract(a, _HREF, 1))
    bare = F.transform(written, lambda h: F.when(h.rlike("^[\"']"), F.substring(h, F.lit(2), F.length(h) - 2)).otherwise(h))
    found = pages.select(key, F.posexplode(F.filter(bare, lambda h: h != "")).alias("pos", "href"))
    plain = found.where(~F.col("href").contains("&"))
    return plain.unionByName(found.where(F.col("href").contains("&")).withColumn("href", _unescaped("href")))

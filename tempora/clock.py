"""The pinned clock: 'now' is a parameter, so that a replay gives what the day gave."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Clock:
    """logical_date: the day that is processed; as_of: the moment that counts as now."""

    logical_date: date
    as_of: datetime

    @classmethod
    def at(cls, day: date | str, moment: datetime | None = None) -> Clock:
        """The end of the day unless a moment is given; naive moments are refused."""
        day = date.fromisoformat(day) if isinstance(day, str) else day
        if moment is not None and moment.tzinfo is None:
            raise ValueError("the pinned moment needs a time zone")
        return cls(day, (moment or datetime(day.year, day.month, day.day, 23, 59, 59, tzinfo=timezone.utc)).astimezone(timezone.utc))

    def now(self) -> Column:
        return F.lit(self.as_of.isoformat()).cast("timestamp")

    def today(self) -> Column:
        return F.lit(self.logical_date.isoformat()).cast("date")

"""What weather codes and states mean."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The forecast's weather codes.
CODES = {
    0: "Clear sky", 1: "Mainly clear", 2: "Partly cloudy", 3: "Overcast", 45: "Fog", 48: "Rime fog", 51: "Light drizzle", 53: "Drizzle", 55: "Dense drizzle",
    61: "Light rain", 63: "Rain", 65: "Heavy rain", 66: "Freezing rain", 67: "Heavy freezing rain", 71: "Light snow", 73: "Snow", 75: "Heavy snow", 77: "Snow grains",
    80: "Rain showers", 81: "Heavy rain showers", 82: "Violent rain showers", 85: "Snow showers", 86: "Heavy snow showers", 95: "Thunderstorm", 96: "Thunderstorm with hail", 99: "Thunderstorm with heavy hail",
}
#: Days ahead that a forecast reaches.
REACH_DAYS = 16
WHY = {
    "VENUE_UNKNOWN": "the home side's place is not known, and none is guessed", "NOT_CAPTURED": "played before a forecast was fetched; none can be fetched afterwards", "MISSING": "within reach of a forecast, but none was fetched: a gap that the checks report",
}


def _of(mapping: dict, key: Column) -> Column:
    table = F.create_map(*[F.lit(x) for item in mapping.items() for x in item])
    return F.try_element_at(table, key)


def description(code: Column) -> Column:
    """The code in words; null for a code that has none."""
    return _of(CODES, code.cast("int"))


def why_absent(status: Column, match_date: Column) -> Column:
    """Why a match has no forecast; null where it has one."""
    soon = F.concat(F.lit("forecasts reach 16 days ahead: from "), F.date_format(F.date_sub(match_date, REACH_DAYS - 1), "yyyy-MM-dd"))
    return F.when(status == "NOT_YET_AVAILABLE", soon).otherwise(_of(WHY, status))

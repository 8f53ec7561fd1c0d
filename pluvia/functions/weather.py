"""Unit conversions, calendar parts, seasons and location labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pluvia.schemas import KELVIN_OFFSET, NEUTRAL_TEMP_K

# Months of each season; the rest of the year is DJF.
SEASON_MONTHS = {"MAM": (3, 4, 5), "JJA": (6, 7, 8), "OND": (9, 10, 11)}
SEASONS = ("MAM", "JJA", "OND", "DJF")

# Lower latitude edge of each band, north to south, with its code.
REGION_BANDS = [(-1.0, "Coastal", 0), (-5.0, "Highland", 1), (-10.0, "Lake", 2)]
LAST_REGION = ("Arid", 3)

# Named points and boxes (lat from/to, lon from/to).
NAMED_BOXES = [
    ("Nairobi", 1.25, 1.25, 36.75, 36.75),
    ("Mombasa", -4.2, -3.8, 39.4, 39.8),
    ("Turkana", 3.0, 4.0, 35.0, 36.5),
]


def kelvin_to_celsius(kelvin: Column) -> Column:
    return kelvin - KELVIN_OFFSET


def celsius_to_kelvin(celsius: Column, default: float = NEUTRAL_TEMP_K) -> Column:
    return F.coalesce(celsius + KELVIN_OFFSET, F.lit(default))


def celsius_to_fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def temperature_bucket(celsius: Column, width: int = 10) -> Column:
    return F.floor(celsius / width)


def step_hours(step: Column) -> Column:
    """Whole hours of a day-time interval."""
    return F.extract(F.lit("DAY"), step) * 24 + F.extract(F.lit("HOUR"), step)


def season(month: Column) -> Column:
    label = F.lit("DJF")
    for name, months in SEASON_MONTHS.items():
        label = F.when(month.isin(*months), name).otherwise(label)
    return label


def season_flags(month: Column) -> dict[str, Column]:
    return {f"season_{s}": F.when(season(month) == s, 1).otherwise(0) for s in SEASONS}


def _band(lat: Column, pick: int) -> Column:
    out = F.lit(LAST_REGION[pick - 1])
    for band in reversed(REGION_BANDS):
        out = F.when(lat >= band[0], band[pick]).otherwise(out)
    return out


def region_band(lat: Column) -> Column:
    """Latitude band name; a null latitude falls into the last band."""
    return _band(lat, 1)


def region_code(lat: Column) -> Column:
    return _band(lat, 2)


def county_from_coord(lat: Column, lon: Column) -> Column:
    """Named point or box, else ``Region_<lat>_<lon>``."""
    label = F.concat(F.lit("Region_"), lat.cast("string"), F.lit("_"), lon.cast("string"))
    for name, lat0, lat1, lon0, lon1 in reversed(NAMED_BOXES):
        label = F.when(lat.between(lat0, lat1) & lon.between(lon0, lon1), name).otherwise(label)
    return label

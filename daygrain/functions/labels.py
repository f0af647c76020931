"""Category labels. Thresholds are parameters; the defaults are the usual ones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daygrain.functions.numeric import as_column

# Weather interpretation codes and their descriptions.
WEATHER_CODES = {
    0: "Clear sky",
    1: "Mainly clear",
    2: "Partly cloudy",
    3: "Overcast",
    45: "Fog",
    48: "Rime fog",
    51: "Light drizzle",
    53: "Moderate drizzle",
    55: "Dense drizzle",
    61: "Slight rain",
    63: "Moderate rain",
    65: "Heavy rain",
    71: "Slight snow",
    73: "Moderate snow",
    75: "Heavy snow",
    80: "Rain showers",
    81: "Moderate rain showers",
    82: "Violent rain showers",
    95: "Thunderstorm",
    96: "Thunderstorm with hail",
    99: "Severe thunderstorm",
}
UNKNOWN_CODE = "Unknown"

# The label sets of the model tables.
ANOMALY_CATEGORIES = ("Above Normal", "Below Normal", "Near Normal")
PERIOD_LABELS = ("Wet Period", "Dry Period", "Normal Period")
DRY_SPELL_LABELS = (
    "Rain Day",
    "Extended Dry Spell (7+ days)",
    "Short Dry Spell (3-6 days)",
    "Dry (1-2 days)",
)
SIGMA_FLAGS = ("Heat Anomaly", "Cold Anomaly", "Normal")
QUARTILE_LABELS = ("Cold Quarter", "Below Average", "Above Average", "Hot Quarter")


def decode_code(code: Column | str) -> Column:
    """Describe a weather code; codes outside the table and NULL are unknown."""
    entries = [F.lit(x) for pair in WEATHER_CODES.items() for x in pair]
    known = F.try_element_at(F.create_map(*entries), as_column(code))
    return F.coalesce(known, F.lit(UNKNOWN_CODE))


def anomaly_category(difference: Column, band: float = 2.0) -> Column:
    above, below, near = ANOMALY_CATEGORIES
    return F.when(difference > band, above).when(difference < -band, below).otherwise(near)


def period_label(rolling_sum: Column, wet_mm: float = 25.0) -> Column:
    """Label a rolling total. Takes the unrounded sum: 25.004 is wet."""
    wet, dry, normal = PERIOD_LABELS
    return F.when(rolling_sum > wet_mm, wet).when(rolling_sum == 0, dry).otherwise(normal)


def dry_spell_label(days: Column, short_from: int = 3, extended_from: int = 7) -> Column:
    rain, extended, short, dry = DRY_SPELL_LABELS
    return (
        F.when(days >= extended_from, extended)
        .when(days >= short_from, short)
        .when(days >= 1, dry)
        .otherwise(rain)
    )


#: Far above the rounding of a sum, far below any step of a measured value.
EDGE = 1e-9


def sigma_flag(value: Column, mean: Column, stddev: Column, k: float = 2.0) -> Column:
    """How a value lies to a band around the mean; on its edge is inside.

    Sums of doubles differ in their last bits with the order of adding, which is another
    in another plan. So an edge is as wide as ``EDGE`` of the numbers that it comes from.
    """
    heat, cold, normal = SIGMA_FLAGS
    reach = k * stddev
    edge = EDGE * (F.abs(mean) + F.abs(reach))
    return (
        F.when(value > mean + reach + edge, heat)
        .when(value < mean - reach - edge, cold)
        .otherwise(normal)
    )


def quartile_label(quartile: Column) -> Column:
    label = F.when(quartile == 1, QUARTILE_LABELS[0])
    for number, text in enumerate(QUARTILE_LABELS[1:], start=2):
        label = label.when(quartile == number, text)
    return label


def clean_label(label: Column | str) -> Column:
    """Drop the double quotes a forecast may carry around its series label."""
    return F.replace(as_column(label), F.lit('"'), F.lit(""))


def row_key(series: Column | str, time: Column | str) -> Column:
    """Text key of one observation, for example ``Boston_2026-03-04``."""
    return F.concat(as_column(series), F.lit("_"), as_column(time).cast("string"))

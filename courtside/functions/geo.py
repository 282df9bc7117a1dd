"""Distances and time-zone steps between arenas."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from courtside.functions.numeric import greatest_or_null, least_or_null, round_half_up

EARTH_RADIUS_MILES = 3958.8

# Zones from west to east, one hour apart.
ZONES_WEST_TO_EAST = [
    "America/Los_Angeles",
    "America/Denver",
    "America/Chicago",
    "America/New_York",
]


def great_circle_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Whole miles between two points; null when a coordinate is missing.

    The cosine is clamped on both ends, because acos outside [-1, 1] is NaN.
    """
    phi1, phi2 = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(phi1) * F.sin(phi2) + F.cos(phi1) * F.cos(phi2) * F.cos(F.radians(lon2 - lon1))
    clamped = greatest_or_null(F.lit(-1.0), least_or_null(F.lit(1.0), cosine))
    return round_half_up(F.acos(clamped) * EARTH_RADIUS_MILES, 0)


def zone_rank(zone: Column) -> Column:
    chain = F
    for rank, name in enumerate(ZONES_WEST_TO_EAST):
        chain = chain.when(zone == name, F.lit(rank))
    return chain.otherwise(F.lit(None)).cast("bigint")


def zone_shift(previous: Column, current: Column) -> Column:
    """Signed hours from one zone to the next; 0 when unchanged, first or unknown."""
    return F.coalesce(zone_rank(current) - zone_rank(previous), F.lit(0).cast("bigint"))

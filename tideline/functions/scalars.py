"""Scalar column expressions. All stay inside whole-stage code generation; none is a UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6_371_000.0

# Prefix of the map search link.
MAP_SEARCH_URL = "https://www.google.com/maps/search/?api=1&query="


def area_code(code: Column) -> Column:
    """First two characters of a five-character, zero-padded postal code."""
    return F.substring(F.lpad(code.cast("string"), 5, "0"), 1, 2)


def weekday_index(day: Column) -> Column:
    """0 = Monday .. 6 = Sunday."""
    return F.weekday(day).cast("tinyint")


def half_even(value: Column, digits: int) -> Column:
    """Round to ``digits`` decimals, ties to the even neighbour, in binary floating point as NumPy does."""
    factor = float(10**digits)
    return F.rint(value * F.lit(factor)) / F.lit(factor)


def units(value: Column, scale: int) -> Column:
    """A price as a whole number of ``1/scale`` units.

    Sums of units are exact, so means do not depend on the order in which tasks deliver rows.
    """
    return F.rint(value * F.lit(float(scale))).cast("bigint")


def flag_or_false(flag: Column) -> Column:
    """A 0/1 or boolean flag as BOOLEAN, missing = FALSE."""
    return F.coalesce(flag.cast("boolean"), F.lit(False))


def valid_code(code: Column) -> Column:
    """TRUE for exactly five digits (no trailing line break)."""
    return code.rlike(r"\A[0-9]{5}\z")


def scaled_coordinate(text: Column, factor: float = 100_000.0) -> Column:
    """A coordinate stored as text times ``factor``; empty or unreadable text is NULL."""
    return F.nullif(F.trim(text), F.lit("")).try_cast("double") / F.lit(factor)


def ref_spread(prev_price: Column, ref: Column, factor: float = 0.01) -> Column:
    """Yesterday's price minus the reference price brought to the same unit."""
    return (prev_price - ref * F.lit(factor)).cast("float")


def map_link(*parts: Column) -> Column:
    """Map search link of the non-NULL parts, percent-encoded (RFC 3986 unreserved set kept)."""
    query = F.url_encode(F.concat_ws(" ", *parts))
    for encoded, wanted in (("+", "%20"), ("*", "%2A"), ("%7E", "~")):
        query = F.replace(query, F.lit(encoded), F.lit(wanted))
    return F.concat(F.lit(MAP_SEARCH_URL), query)


def great_circle_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Haversine distance in metres between points given in degrees."""
    half_dlat = F.sin(F.radians(lat2 - lat1) / 2)
    half_dlon = F.sin(F.radians(lon2 - lon1) / 2)
    chord = half_dlat * half_dlat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_dlon * half_dlon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(chord, F.lit(1.0))))

"""Column expressions shared by readers, cohorts and reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from footfall import names as N


def json_text(properties: Column, key: str) -> Column:
    """Text of one JSON property; NULL when the key is missing or JSON null."""
    return F.get_json_object(properties, f"$.{key}")


def json_key_absent(properties: Column, key: str) -> Column:
    """True only when the key is missing: an explicit JSON null counts as present."""
    return ~F.coalesce(F.array_contains(F.json_object_keys(properties), key), F.lit(False))


def network_flag(text: Column) -> Column:
    """``'true'``/``'false'`` text to boolean; everything else counts as online."""
    return F.when(text == "false", F.lit(False)).otherwise(F.lit(True))


def is_offline(network: Column) -> Column:
    """``IS FALSE``: NULL is not offline."""
    return network.eqNullSafe(F.lit(False))


def is_online(network: Column) -> Column:
    return network.eqNullSafe(F.lit(True))


def in_range(moment: Column, start, end) -> Column:
    """Half-open time range; bounds are dates or timestamps."""
    return (moment >= F.lit(start)) & (moment < F.lit(end))


def starts_london(city: Column) -> Column:
    return F.lower(city).startswith(N.LONDON_PREFIX)


def contains_london(city: Column) -> Column:
    return F.lower(city).contains(N.LONDON_PREFIX)


def widen_london(latitude: Column, longitude: Column, city: Column) -> Column:
    """``London`` inside the wider box, else the given city.

    Coordinates are text; one that does not parse falls back to the city.
    """
    south, north, west, east = N.LONDON_BOX
    lat, lon = latitude.try_cast("double"), longitude.try_cast("double")
    inside = (lat > south) & (lat < north) & (lon > west) & (lon < east)
    return F.when(inside, F.lit(N.LONDON)).otherwise(city)


def normalize_city(city: Column) -> Column:
    """One of ``London``, ``ROW``, ``NOLOCATION``, ``UNKNOWN``."""
    return (
        F.when(city.isNull() | (city == "") | (city == N.NO_LOCATION), F.lit(N.NO_LOCATION))
        .when(city == N.UNKNOWN, F.lit(N.UNKNOWN))
        .when(contains_london(city), F.lit(N.LONDON))
        .otherwise(F.lit(N.REST_OF_WORLD))
    )


def known_city(city: Column) -> Column:
    return city.isNotNull() & ~city.isin(*N.UNKNOWN_PLACES)


def int_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("int"), F.lit(0))


def whole_number(text: Column) -> Column:
    """Integer of a JSON number's text, fractions cut toward zero; NULL if it is none."""
    number = text.try_cast("double")
    cut = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.when(~F.isnan(number) & (F.abs(number) < 9.0e18), cut).try_cast("int")


def epoch_to_timestamp(seconds: Column) -> Column:
    """Epoch seconds to a UTC timestamp cut to whole seconds."""
    return F.timestamp_seconds(F.floor(seconds))


def timestamp_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")


def micros_between(later: Column, earlier: Column) -> Column:
    """Exact distance in microseconds, the epoch of an interval."""
    return F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))


def whole_days_between(later: Column, earlier: Column) -> Column:
    """Whole 24-hour days in ``later - earlier``, cut toward zero."""
    return F.extract(F.lit("day"), later - earlier)


def last_day_label(date_end: Column) -> Column:
    """Inclusive last day of a half-open window."""
    return F.date_sub(date_end, 1)


def round_half_up(number: Column, digits: int) -> Column:
    """Decimal rounding, half away from zero."""
    return F.round(number.cast("decimal(38,12)"), digits)

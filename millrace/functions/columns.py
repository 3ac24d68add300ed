"""Column functions: time features, distance, parsing, text case, keys and hashes."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970; takes timestamps with and without zone (session zone UTC)."""
    return F.unix_seconds(ts.cast("timestamp"))


def cycle(value: Column, period: int, name: str) -> list[Column]:
    """A periodic number as sine and cosine columns."""
    angle = value * F.lit(2 * math.pi / period)
    return [F.sin(angle).alias(f"{name}_sin"), F.cos(angle).alias(f"{name}_cos")]


def time_features(ts: Column) -> list[Column]:
    """Weekday (Monday is 0), day of month and hour as points on circles of 7, 30 and 24."""
    return [
        *cycle(F.weekday(ts), 7, "day_of_week"),
        *cycle(F.dayofmonth(ts), 30, "day_of_month"),
        *cycle(F.hour(ts), 24, "hour"),
    ]


def add_time_features(df: DataFrame, ts: str) -> DataFrame:
    return df.select("*", *time_features(F.col(ts)))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in kilometres."""
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return F.asin(F.sqrt(F.least(F.greatest(a, F.lit(0.0)), F.lit(1.0)))) * F.lit(2.0 * EARTH_RADIUS_KM)


def add_live_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Features known only when asked: time of the request and distance from user to destination.

    One function for training and inference; it takes batch and streaming frames alike.
    """
    distance = haversine_km(
        F.col("user_latitude"), F.col("user_longitude"), F.col("latitude"), F.col("longitude")
    )
    return df.select("*", *time_features(F.col(ts)), distance.alias("distance"))


def parse_ts(col: Column, formats: Sequence[str]) -> Column:
    """The first format that fits; null when none does (bad text never fails the job)."""
    return F.coalesce(*[F.try_to_timestamp(col, F.lit(f)) for f in formats])


def days_since(col: Column, as_of: str) -> Column:
    return F.datediff(F.lit(as_of).cast("date"), col)


def capitalise(col: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(col.substr(1, 1)), F.lower(col.substr(F.lit(2), F.length(col))))


def rewrite_host(col: Column, base: str) -> Column:
    """Put ``base`` in place of scheme and host up to the first slash of the path."""
    return F.regexp_replace(col, r"https?://.*?/", base)


def map_values(col: Column, mapping: Mapping[object, object]) -> Column:
    """Replace listed values; anything else becomes null."""
    out = F.lit(None)
    for value, to in mapping.items():
        out = F.when(col == F.lit(value), F.lit(to)).otherwise(out)
    return out


def seeded_uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on key and seed only, not on the layout of the data."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 40)).cast("double") / F.lit(float(1 << 40))


def surrogate_id(*keys: Column) -> Column:
    """A 64-bit id that is the same however the rows are laid out."""
    return F.xxhash64(*keys)


def split_tags(text: str | None) -> list[str]:
    """Column names from a comma-separated tag."""
    return [t.strip() for t in (text or "").split(",") if t.strip()]


def any_rule(rules: Sequence[Column], hit: float, miss: float, base: float = 0) -> Column:
    """``base`` plus ``hit`` where at least one rule holds, else plus ``miss``; unknown rules do not hold."""
    found = F.lit(False)
    for rule in rules:
        found = found | F.coalesce(rule, F.lit(False))
    return F.lit(base) + F.when(found, hit).otherwise(miss)


def drawn_label(percent: Column, key: Column, seed: int) -> Column:
    """True for about ``percent`` of 100 rows, always for the same ones."""
    return seeded_uniform(key, seed) * 100 < percent


DRAW_BITS = 60


def drawn(seed: int, *names: str) -> Column:
    """A number below 2 ** DRAW_BITS drawn from the columns: the leading digits of an MD5 that other engines give as well."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.col(n).cast("string") for n in names])
    return F.conv(F.substring(F.md5(text), 1, DRAW_BITS // 4), 16, 10).cast("long")

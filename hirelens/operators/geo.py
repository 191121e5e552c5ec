"""Coordinates for places from a place table."""

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import place_name
from .lookup import lookup_join
from .staging import stage

# Fixed value: confidence of a place found in the place table.
CONFIDENCE_FOUND = 0.7


# From the whole place to the country alone: parts of a key, all of which a place must have beyond the first level.
LEVELS = (("city", "state", "country"), ("city", "country"), ("state", "country"), ("country",))


def geocode(df: DataFrame, places: DataFrame, fallback: bool = False) -> DataFrame:
    """Add ``lat, lon, geocode_confidence`` by looking up the place of each row.

    ``places`` has ``(place, lat, lon)``, where ``place`` is city, state and country
    joined by a comma and a blank, missing parts left out.  Of several rows of one place
    the one with the smallest latitude, then longitude counts, missing values last.
    Places not found, and rows without any part, get NULLs; every row comes back once.

    With ``fallback`` a place that is not found is looked up by city and country, then by state and country, then by
    country; ``geocode_level`` says which of the four was found (0: the whole place).
    """
    order = F.struct(F.col("lat").isNull(), "lat", F.col("lon").isNull(), "lon")
    once = places.filter(F.col("place").isNotNull()).groupBy(F.col("place").alias("_place")).agg(
        F.min_by(F.struct("lat", "lon"), order).alias("_at")
    )
    table = once.select("_place", "_at.lat", "_at.lon", F.lit(CONFIDENCE_FOUND).alias("geocode_confidence"))
    table = stage(table, "places")  # measured, then joined
    if fallback:
        return _by_levels(df, table)
    named = df.withColumn("_place", _name(LEVELS[0]))
    return lookup_join(named, table, "_place", how="left", spread_by=df.columns).drop("_place")


def _name(parts: Sequence[str]) -> Column:
    return F.nullif(place_name(*[F.col(p) if p in parts else F.lit(None) for p in LEVELS[0]]), F.lit(""))


def _by_levels(df: DataFrame, table: DataFrame) -> DataFrame:
    """Different places, not rows, are tried on all levels; each takes its first hit back to its rows."""
    key = F.to_json(F.array(*[F.coalesce(F.col(p), F.lit("")) for p in LEVELS[0]]))
    spots = df.select(key.alias("_spot"), *LEVELS[0]).dropDuplicates(["_spot"])
    whole = lambda parts: reduce(lambda a, b: a & b, [F.coalesce(F.col(p), F.lit("")) != "" for p in parts])
    keys = [F.when(whole(parts), _name(parts)) if level else _name(parts) for level, parts in enumerate(LEVELS)]
    tried = spots.select("_spot", F.posexplode(F.array(*keys)).alias("geocode_level", "_place")).filter("_place IS NOT NULL")
    hits = lookup_join(tried, table, "_place", spread_by=["_spot"])
    found = [c for c in table.columns if c != "_place"]
    best = hits.groupBy("_spot").agg(F.min("geocode_level").alias("geocode_level"), F.min_by(F.struct(*found), "geocode_level").alias("_hit"))
    known = stage(best.select("_spot", "_hit.*", "geocode_level"), "spots")  # measured, then joined
    return lookup_join(df.withColumn("_spot", key), known, "_spot", how="left", spread_by=df.columns).drop("_spot")

"""Joins against a table that is expected, but not assumed, to be small."""

from collections.abc import Sequence
from math import ceil

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024
SALTS = 32
# Rows of one task where a large table is dealt by key.
ROWS_PER_TASK = 500_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure ``df`` (one aggregate, one row back) against the broadcast bound."""
    text = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema if f.dataType.typeName() == "string"]
    width = F.lit(16 * len(df.columns))
    for size in text:
        width = width + size
    rows, size = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(width), F.lit(0))).first()
    return rows <= max_rows and size <= max_bytes


def deal_by_key(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, known to have about ``rows`` rows, over so many tasks that each sorts and groups about ``ROWS_PER_TASK``.

    Left alone, Spark fills a task by compressed bytes, which may be many millions of narrow rows.  Small tables stay as they are.
    """
    if rows <= ROWS_PER_TASK:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(2 * cores, ceil(rows / ROWS_PER_TASK)), *keys)


def lookup_join(
    facts: DataFrame,
    table: DataFrame,
    on: str,
    how: str = "inner",
    spread_by: Sequence[str] = (),
    small: bool | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join ``facts`` to ``table``, which has one row per value of ``on``.

    A table within the bound is broadcast, so the facts are not shuffled.  Beyond
    the bound both sides shuffle on the key and a salt: the facts take the salt
    from ``spread_by``, the table is repeated once per salt.  A key that holds a
    large share of the facts is then split over ``salts`` tasks.  Spark takes the repeated
    table for as small as the table itself and might still broadcast it: the hint rules that out.
    """
    if small is None:
        small = fits_broadcast(table)
    if small:
        return facts.join(F.broadcast(table), on, how)
    salted = facts.withColumn("_salt", F.pmod(F.xxhash64(*(spread_by or facts.columns)), F.lit(salts)).cast("int"))
    repeated = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated.hint("merge"), [on, "_salt"], how).drop("_salt")

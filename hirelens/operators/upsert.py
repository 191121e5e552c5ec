"""Keyed merges on plain tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key in the given order.

    The group limit Spark pushes below the shuffle keeps one candidate per key and
    task, so a key with very many copies does not travel.
    """
    w = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def upsert(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """``updates`` replace rows of ``target`` with the same key, NULLs included.

    Other target rows stay.  Only the update *keys* meet the target in a join, the
    update rows themselves are not shuffled.  Updates must have one row per key;
    pass ``order_by`` to keep the first of several.
    """
    keys = list(keys)
    fresh = one_per_key(updates, keys, order_by) if order_by else updates
    kept = target.join(updates.select(*keys), keys, "left_anti")
    return kept.unionByName(fresh.select(*target.columns))


def absent_rows(rows: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct ``rows`` whose key is not in ``existing`` (insert, conflicts ignored)."""
    keys = list(keys)
    return rows.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")

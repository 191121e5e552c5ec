"""Integrity checks: what a database would reject, as queries."""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from .. import schemas


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def pk_violations(
    tables: Mapping[str, DataFrame], keys: Mapping[str, Sequence[str]] = schemas.PRIMARY_KEYS
) -> DataFrame:
    """``(table, key, n)`` for every primary key held by more than one row."""
    return _union([
        tables[name]
        .groupBy(*cols)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .select(
            F.lit(name).alias("table"),
            F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in cols]).alias("key"),
            "n",
        )
        for name, cols in keys.items()
        if name in tables
    ])


def fk_orphans(
    tables: Mapping[str, DataFrame], references: Sequence[tuple[str, str, str, str]] = schemas.FOREIGN_KEYS
) -> DataFrame:
    """``(table, column, key, n)`` for every reference that has no parent, with its row count.

    The keys of a parent and of all its children meet in one aggregate: each table is read once, and a key
    with very many rows reaches the shuffle as one row per task.
    """
    by_parent: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for child, col, parent, parent_col in references:
        if child in tables and parent in tables:
            by_parent.setdefault((parent, parent_col), []).append((child, col))
    return _union([_orphans_of(tables, parent, parent_col, children) for (parent, parent_col), children in by_parent.items()])


def _orphans_of(tables: Mapping[str, DataFrame], parent: str, parent_col: str, children: list[tuple[str, str]]) -> DataFrame:
    rows = [tables[parent].select(F.col(parent_col).alias("key"), F.lit(-1).alias("side"))]
    rows += [tables[child].select(F.col(col).alias("key"), F.lit(i).alias("side")) for i, (child, col) in enumerate(children)]
    counts = [F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(len(children))]
    keys = _union(rows).filter(F.col("key").isNotNull()).groupBy("key").agg(F.count_if(F.col("side") == -1).alias("parents"), *counts)
    names = F.array(*[
        F.struct(F.lit(child).alias("table"), F.lit(col).alias("column"), F.col(f"n{i}").alias("n"))
        for i, (child, col) in enumerate(children)
    ])
    return keys.filter("parents = 0").select("key", F.inline(names)).filter("n > 0").select("table", "column", "key", "n")


def not_null_violations(
    tables: Mapping[str, DataFrame], columns: Mapping[str, Sequence[str]] = schemas.NOT_NULL
) -> DataFrame:
    """``(table, column, n)`` for every required column that holds NULLs; one scan per table."""
    parts = []
    for name, cols in columns.items():
        if name not in tables:
            continue
        counts = tables[name].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
        parts.append(
            counts.unpivot([], list(cols), "column", "n").select(F.lit(name).alias("table"), "column", "n")
        )
    return _union(parts).filter("n > 0")

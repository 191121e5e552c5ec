"""Dense ids without a single-task window."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .lookup import lookup_join
from .staging import stage

# monotonically_increasing_id keeps the partition above these bits.
_ROW_BITS = 33


def dense_ids(
    df: DataFrame,
    id_col: str,
    start: int = 1,
    order_by: Sequence[str | Column] = (),
) -> DataFrame:
    """Add ``id_col`` = ``start``, ``start`` + 1, ... without gaps.

    With ``order_by`` ids follow that order (rows are range-partitioned and sorted
    in many tasks), without it they follow the order of the input partitions.
    The rows are staged once with their partition and position; the offset of a
    partition is the number of rows before it, so no task sees all rows.
    """
    ordered = df.orderBy(*order_by) if order_by else df
    staged = stage(ordered.withColumn("_pos", F.monotonically_increasing_id()), id_col)
    staged = staged.select(
        "*",
        F.shiftright("_pos", _ROW_BITS).alias("_part"),
        F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )
    # One row per input partition: the window over them is small whatever the data.
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = lookup_join(staged, offsets, "_part", spread_by=["_row"])
    return numbered.withColumn(
        id_col, (F.lit(start) + F.col("_offset") + F.col("_row")).cast("long")
    ).drop("_pos", "_part", "_row", "_offset")

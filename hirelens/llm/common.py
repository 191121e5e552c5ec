"""Helpers shared by the operators of this package."""

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hirelens.operators.lookup import fits_broadcast
from hirelens.operators.staging import stage  # noqa: F401  (re-exported for the operators)

# Texts taken together in one step of a Python task are bounded by this many bytes.
STEP_BYTES = 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Rows that a running total takes in one task before totals are summed up.
CHUNK = 4096


def bound_batches(spark: SparkSession) -> None:
    """Let the session hand Python tasks batches of about ``STEP_BYTES`` (one row at least), unless its user set a bound.

    Spark's own bound of 64 MB is held several times over by each task: in Spark's buffers on both ways and in Python.
    """
    if ARROW_BYTES not in spark.conf.getAll:
        spark.conf.set(ARROW_BYTES, str(STEP_BYTES))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def free_name(name: str, taken: Sequence[str]) -> str:
    """``name``, or with underscores before it until no column of ``taken`` has it, in any case."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name = f"_{name}"
    return name


def byte_slices(texts: pa.Array, limit: int = STEP_BYTES, rows: int | None = None) -> Iterator[pa.Array]:
    """Cut an array of texts into slices of about ``limit`` bytes (one text at least) and at most ``rows`` texts."""
    table = pa.RecordBatch.from_arrays([texts], names=["text"])
    for step in byte_steps(iter([table]), "text", limit):
        for at in range(0, step.num_rows, rows or step.num_rows):
            yield step.column("text").slice(at, rows or step.num_rows)


def byte_steps(batches: Iterator[pa.RecordBatch], column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose ``column`` holds about ``limit`` bytes (one row at least)."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)


def table_join(rows: DataFrame, table: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join to a table with one row per key: broadcast if it fits, else by a shuffle that splits hot keys."""
    return rows.join(F.broadcast(table) if fits_broadcast(table) else table, on, how)


def running_total(rows: DataFrame, keys: list[str], order: str, value: str, into: str) -> DataFrame:
    """Add the sum of ``value`` over the rows of equal ``keys`` with smaller ``order`` (whole numbers from 0).

    Rows are summed in chunks of the order, then the chunk totals: no task sees all rows of a key.
    """
    cut = rows.withColumn("_chunk", F.floor(F.col(order) / CHUNK))
    before = (Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(*before)
    chunks = cut.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_n"))
    over = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    bases = chunks.withColumn("_base", F.coalesce(F.sum("_n").over(over.orderBy("_chunk").rowsBetween(*before)), F.lit(0)))
    local = cut.withColumn("_local", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    summed = local.join(bases.drop("_n"), [*keys, "_chunk"])
    return summed.withColumn(into, (F.col("_base") + F.col("_local")).cast("long")).drop("_chunk", "_base", "_local")

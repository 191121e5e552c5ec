"""The stored tables: Spark tables, partitioned by month, written and committed by Spark.

Postings, links, pay, places and the aggregates below the marts are partitioned by the month of the posting, so a
load, a merge or a refresh reads and rewrites only the months it touches.  Appends add files to partitions; merges and
refreshes replace whole partitions (dynamic partition overwrite).  Both write beside the table first and are moved into
place by Spark's job commit, so a load that fails leaves the table as it was.  One writer at a time.

The tables are external, their folders lie below ``root``.  With a permanent catalog they are declared once; a session
without one declares them again over the same folders.  With ``buckets`` the tables that have a ``job_id`` are
bucketed by it inside their partitions and join without a shuffle; every session must then name the same number.
"""

import re
import zlib
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window, functions as F

from ..functions.dates import month_of
from ..operators.ids import dense_ids
from ..operators.staging import hadoop_path, staging_scope
from ..operators.upsert import upsert
from ..schemas import MONTHLY, NOT_NULL, PRIMARY_KEYS, STORED, TABLES

BUCKET_KEY = "job_id"
MONTH = "month"
# Tables without months are one partition, so that they too are replaced by a commit.
WHOLE = "part"


def partition_of(name: str) -> str:
    return {"refreshed": "step"}.get(name, MONTH if name in MONTHLY else WHOLE)


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None, database: str | None = None):
        fs, path = hadoop_path(spark, root)
        self.spark, self.buckets = spark, buckets
        self.root = fs.makeQualified(path).toString().rstrip("/")
        self.database = database or f"hirelens_{zlib.crc32(self.root.encode()):08x}"
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database}")

    def table(self, name: str) -> str:
        """The full name of a stored table, declared where the catalog does not know it."""
        full = f"{self.database}.{name.replace('/', '_')}"
        if not self.spark.catalog.tableExists(full):
            split = partition_of(name)
            fields = [(f.name, f.dataType.simpleString()) for f in STORED[name] if f.name != split]
            kind = {MONTH: "date", WHOLE: "int", "step": "string"}[split]
            columns = ", ".join(f"`{n}` {t}" for n, t in [*fields, (split, kind)])
            clustered = f"CLUSTERED BY ({BUCKET_KEY}) INTO {self.buckets} BUCKETS" if self._bucketed(name) else ""
            fs, path = hadoop_path(self.spark, f"{self.root}/{name}")
            fs.mkdirs(path)
            self.spark.sql(
                f"CREATE TABLE {full} ({columns}) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') "
                f"PARTITIONED BY ({split}) {clustered} LOCATION '{_quoted(self.root)}/{name}'"
            )
            self.spark.sql(f"MSCK REPAIR TABLE {full}")
        return full

    def _bucketed(self, name: str) -> bool:
        return bool(self.buckets) and name in TABLES and BUCKET_KEY in TABLES[name].fieldNames()

    def read(self, name: str, months: Iterable[date | None] | None = None, with_month: bool = False) -> DataFrame:
        """A stored table, empty if never written; only the partitions of ``months`` if given (None: undated postings)."""
        rows = self.spark.table(self.table(name))
        if months is not None:
            rows = rows.filter(in_months(F.col(MONTH), months))
        columns = STORED[name].fieldNames()
        return rows.select(*columns, *([MONTH] if with_month and MONTH not in columns else []))

    def _insert(self, name: str, df: DataFrame, overwrite: bool) -> set:
        """Write rows and give back the partitions they went to; nothing is changed if a row is refused."""
        table, split = self.table(name), partition_of(name)
        rows = df.withColumn(WHOLE, F.lit(0)) if split == WHOLE else df
        rows = rows.select(*[F.col(c) for c in self.spark.table(table).columns])
        if self._bucketed(name):
            rows = rows.repartition(self.buckets, BUCKET_KEY)
        elif split == MONTH:
            # Few files per month; Spark splits a month that holds much and joins small ones.
            rows = rows.hint("rebalance", MONTH)
        seen = Observation()
        with refusals():
            rows.observe(seen, F.collect_set(split).alias("parts"), F.count_if(F.col(split).isNull()).alias("none")) \
                .write.insertInto(table, overwrite=overwrite)
        found = seen.get
        return {*found["parts"], *([None] if found["none"] else [])}

    def append(self, name: str, df: DataFrame, new_keys: bool = False) -> DataFrame:
        """Add rows, all or none.

        Rows without a required column, with repeated keys or with stored keys are refused while they are written.
        With ``new_keys`` the caller knows that keys are new and differ, and only required columns are looked at.
        """
        checked = not_null(name, df)
        if not new_keys:
            checked = unstored_keys(name, unique_keys(name, checked), self.read(name))
        self._insert(name, checked, overwrite=False)
        return self.read(name)

    def overwrite(self, name: str, df: DataFrame, months: Sequence[date | None] | None = None) -> DataFrame:
        """Replace the partitions that ``df`` has rows for, and empty those of ``months`` that it has none for.

        Without ``months`` the whole table is replaced.
        """
        split = partition_of(name)
        before = {0} if split == WHOLE else set(months) if months is not None else self.partitions(name)
        written = self._insert(name, not_null(name, df), overwrite=True)
        for gone in before - written:
            self._clear(name, split, gone)
        return self.read(name)

    def merge(self, name: str, updates: DataFrame, months: Sequence[date | None]) -> DataFrame:
        """Updates replace rows of equal keys, in the partitions of ``months`` only; all updates must be of these months.

        Updates have one row per key.  Other partitions are neither read nor written.
        """
        stored = self.read(name, months, with_month=True)
        merged = upsert(stored, updates.select(*stored.columns), PRIMARY_KEYS[name])
        self._insert(name, not_null(name, merged), overwrite=True)
        return self.read(name)

    def partitions(self, name: str) -> set:
        """The values of the partition column that the table has."""
        split = partition_of(name)
        return {r[0] for r in self.spark.table(self.table(name)).select(split).distinct().collect()}

    def _clear(self, name: str, split: str, value) -> None:
        none = self.spark.createDataFrame([], self.spark.table(self.table(name)).drop(split).schema)
        given = "null" if value is None else f"'{value}'"
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table(name)} PARTITION ({split} = {given}) SELECT * FROM {{none}}", none=none)

    def tables(self, months: Sequence[date | None] | None = None) -> dict[str, DataFrame]:
        """The declared tables; the skills whole, the others only in the given months."""
        return {name: self.read(name, months if name in MONTHLY else None) for name in TABLES}


def in_months(column: Column, months: Iterable[date | None]) -> Column:
    days = [m for m in months if m is not None]
    inside = column.isin(days) if days else F.lit(False)
    return inside | column.isNull() if None in months else inside


# ---- refusals while rows are written ----


class refusals:
    """Turns a row refused inside a Spark job into a ``ValueError`` with its reason."""

    def __enter__(self) -> None:
        return None

    def __exit__(self, kind, error, trace) -> None:
        text = str(error) if error is not None and (isinstance(error, PySparkException) or "Py4J" in kind.__name__) else ""
        reason = re.search(r"\[USER_RAISED_EXCEPTION\] (.*?) SQLSTATE", text, re.S)
        if reason:
            raise ValueError(reason[1]) from error


def refuse(bad: Column, reason: Column, column: Column) -> Column:
    """``column``, or an error with ``reason`` where ``bad``."""
    return F.when(bad, F.raise_error(reason)).otherwise(column)


def not_null(name: str, df: DataFrame) -> DataFrame:
    """``df``; a row without a required column of the table is an error."""
    wanted = NOT_NULL.get(name, [])
    return df.withColumns({c: refuse(F.col(c).isNull(), F.lit(f"a row for {name} without {c}"), F.col(c)) for c in wanted})


def _key_text(keys: Sequence[str]) -> Column:
    return F.concat_ws(",", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in keys])


def unique_keys(name: str, df: DataFrame) -> DataFrame:
    """``df``; a key that stands in two rows is an error."""
    keys = PRIMARY_KEYS[name]
    twice = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys)) > 1
    reason = F.concat(F.lit("key "), _key_text(keys), F.lit(f" stands twice among the new rows for {name}"))
    return df.withColumn("_twice", twice).withColumn(keys[0], refuse(F.col("_twice"), reason, F.col(keys[0]))).drop("_twice")


def unstored_keys(name: str, df: DataFrame, stored: DataFrame) -> DataFrame:
    """``df``; a key that is stored already is an error."""
    keys = PRIMARY_KEYS[name]
    held = stored.select(*keys, F.lit(True).alias("_held"))
    reason = F.concat(F.lit("key "), _key_text(keys), F.lit(f" is stored in {name} already"))
    return df.join(held, keys, "left").withColumn(keys[0], refuse(F.col("_held").isNotNull(), reason, F.col(keys[0]))).drop("_held")


def _quoted(path: str) -> str:
    return path.replace("\\", "\\\\").replace("'", "\\'")


def append_jobs(store: TableStore, postings: DataFrame, order_by: tuple[str, ...] = ()) -> DataFrame:
    """Append postings to ``jobs``; ids continue after the highest stored one, in input order or by ``order_by``.

    The whole load is refused when a posting has no title.  Every call appends, also
    postings that are stored already.
    """
    last_id = store.read("jobs").agg(F.coalesce(F.max("job_id"), F.lit(0))).first()[0]
    with staging_scope(store.spark):
        numbered = dense_ids(postings, "job_id", last_id + 1, order_by=order_by)
        dated = numbered.withColumns({"collected_at": F.localtimestamp(), MONTH: month_of(F.col("post_date"))})
        return store.append("jobs", dated, new_keys=True)

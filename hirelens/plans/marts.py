"""The eight analytics tables.

Every function takes ``t``, a mapping of table name to DataFrame, and returns a
lazy DataFrame.  Stored tables hold each key once (the store refuses others), so a plain
count of the rows of the bridge ``jobs_skills`` equals the count of distinct postings.  Aggregation
is by skill id first; names are joined to the small aggregate afterwards.
"""

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.dates import month_of
from ..functions.text import skill_name
from .pairs import pair_counts

Tables = Mapping[str, DataFrame]

UNKNOWN = "Unknown"


def _names(t: Tables) -> DataFrame:
    return t["skills"].select("skill_id", skill_name().alias("skill"))


def both_bounds(compensation: DataFrame) -> DataFrame:
    return compensation.filter(F.col("min").isNotNull() & F.col("max").isNotNull())


def annual() -> Column:
    return F.col("period").isNull() | (F.col("period") == "year")


def country_name() -> Column:
    return F.coalesce("country", F.lit(UNKNOWN)).alias("country")


def skill_counts(t: Tables) -> DataFrame:
    """Per skill: postings and the latest post date; undated postings count."""
    dated = t["jobs_skills"].join(t["jobs"].select("job_id", "post_date"), "job_id")
    per_id = dated.groupBy("skill_id").agg(
        F.count(F.lit(1)).alias("job_count"), F.max("post_date").alias("last_seen")
    )
    return per_id.join(_names(t), "skill_id").select("skill_id", "skill", "job_count", "last_seen")


def monthly_skill_counts(t: Tables) -> DataFrame:
    """Per skill and month: postings; undated postings are left out."""
    months = t["jobs"].filter(F.col("post_date").isNotNull()).select("job_id", month_of(F.col("post_date")).alias("month"))
    per_id = t["jobs_skills"].join(months, "job_id").groupBy("skill_id", "month").agg(
        F.count(F.lit(1)).alias("job_count")
    )
    return per_id.join(_names(t), "skill_id").select("skill_id", "skill", "month", "job_count")


def skill_cooccurrence(t: Tables, min_count: int = 1) -> DataFrame:
    """Per unordered pair of skills: postings that name both, at least ``min_count``."""
    return named_pairs(pair_counts(t["jobs_skills"], t["skills"], min_count=min_count), t)


def named_pairs(counts: DataFrame, t: Tables) -> DataFrame:
    """Pair counts with the names of both skills."""
    a = _names(t).select(F.col("skill_id").alias("skill_id_a"), F.col("skill").alias("skill_a"))
    b = _names(t).select(F.col("skill_id").alias("skill_id_b"), F.col("skill").alias("skill_b"))
    return counts.join(a, "skill_id_a").join(b, "skill_id_b").select("skill_id_a", "skill_a", "skill_id_b", "skill_b", "pair_count")


def pay_sums_by_skill_id(t: Tables, currency: str | None = None, period: str | None = None) -> DataFrame:
    """Per skill id: sums of both salary bounds and rows, the base of all salary-by-skill tables."""
    pay = both_bounds(t["compensation"])
    if currency is not None:
        pay = pay.filter(F.col("currency") == currency)
    if period is not None:
        pay = pay.filter(F.col("period") == period)
    return (
        t["jobs_skills"]
        .join(pay.select("job_id", "min", "max"), "job_id")
        .groupBy("skill_id")
        .agg(F.sum("min").alias("sum_min"), F.sum("max").alias("sum_max"), F.count(F.lit(1)).alias("n"))
    )


def salary_by_skill(t: Tables, currency: str | None = None, period: str | None = None) -> DataFrame:
    """Per skill: mean of both bounds and rows, over all currencies and periods unless one is given."""
    return pay_sums_by_skill_id(t, currency, period).join(_names(t), "skill_id").select(
        "skill_id",
        "skill",
        (F.col("sum_min") / F.col("n")).alias("avg_min"),
        (F.col("sum_max") / F.col("n")).alias("avg_max"),
        "n",
    )


def jobs_by_country(t: Tables) -> DataFrame:
    """Location rows per country; postings without a location row are not counted."""
    return t["locations"].groupBy(country_name()).agg(F.count(F.lit(1)).alias("jobs"))


def monthly_salary_by_skill(t: Tables) -> DataFrame:
    """Per month and skill name: mean of both bounds and rows; pay per year or without a period."""
    pay = both_bounds(t["compensation"]).filter(annual()).select("job_id", "min", "max")
    months = t["jobs"].filter(F.col("post_date").isNotNull()).select("job_id", month_of(F.col("post_date")).alias("month"))
    per_id = (
        t["jobs_skills"]
        .join(pay.join(months, "job_id"), "job_id")
        .groupBy("month", "skill_id")
        .agg(F.sum("min").alias("sum_min"), F.sum("max").alias("sum_max"), F.count(F.lit(1)).alias("n"))
    )
    return monthly_pay_means(per_id, t)


def monthly_pay_means(per_id: DataFrame, t: Tables) -> DataFrame:
    """Means per month and skill name from sums per month and skill id."""
    return (
        per_id.join(_names(t), "skill_id")
        .groupBy("month", "skill")
        .agg(F.sum("sum_min").alias("sum_min"), F.sum("sum_max").alias("sum_max"), F.sum("n").alias("n"))
        .select(
            "month",
            "skill",
            (F.col("sum_min") / F.col("n")).alias("avg_min"),
            (F.col("sum_max") / F.col("n")).alias("avg_max"),
            "n",
        )
    )


def monthly_jobs_by_country(t: Tables) -> DataFrame:
    """Dated postings per month and country; postings without a location row count as unknown.

    Postings and locations both have one row per job_id, so rows are postings.
    """
    months = t["jobs"].filter(F.col("post_date").isNotNull()).select("job_id", month_of(F.col("post_date")).alias("month"))
    return (
        months.join(t["locations"].select("job_id", "country"), "job_id", "left")
        .groupBy("month", country_name())
        .agg(F.count(F.lit(1)).alias("job_count"))
    )


def skill_mom_growth(monthly: DataFrame) -> DataFrame:
    """Growth of a skill against the previous month in which it occurs, in percent.

    Skills of one name are one skill: their counts are added per month first, so a window group has one row
    per month.
    """
    by_name = monthly.groupBy("skill", "month").agg(F.sum("job_count").alias("job_count"))
    w = Window.partitionBy("skill").orderBy("month")
    now, before = F.col("job_count"), F.col("prev_job_count")
    change = F.round(F.lit(Decimal("100.0")) * (now - before) / F.nullif(before, F.lit(0)), 2)
    return by_name.withColumn("prev_job_count", F.lag("job_count").over(w)).select(
        "skill", "month", "job_count", "prev_job_count", change.cast("double").alias("mom_growth_pct")
    )

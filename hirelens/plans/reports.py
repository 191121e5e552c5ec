"""Ranked and filtered reports.

``orderBy(...).limit(k)`` keeps k rows per task and never sorts a whole table.
Every order ends in a unique key, so ties give the same rows on every run.
"""

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import month_text
from ..functions.text import place_label, skill_name
from .marts import pay_sums_by_skill_id

Tables = Mapping[str, DataFrame]


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


def _asc(name: str) -> Column:
    return F.col(name).asc_nulls_last()


# ---- filters ----


def between_months(df: DataFrame, lo: date, hi: date, col: str = "month") -> DataFrame:
    """Rows with ``lo <= col <= hi``; a table without that column comes back unchanged."""
    return df.filter(F.col(col).between(F.lit(lo), F.lit(hi))) if col in df.columns else df


def in_countries(df: DataFrame, countries: Sequence[str] | None = None) -> DataFrame:
    """Rows of the given countries; none given means all."""
    return df.filter(F.col("country").isin(list(countries))) if countries else df


def latest_month(df: DataFrame) -> DataFrame:
    """Rows of the latest month that occurs in ``df``: an equi-join with a one-row aggregate."""
    last = df.agg(F.max("month").alias("month"))
    return df.join(F.broadcast(last), "month", "left_semi")


# ---- reports on the marts ----


def report_top_skills(counts: DataFrame, k: int = 20) -> DataFrame:
    return counts.select("skill", "job_count", "last_seen", "skill_id").orderBy(
        _desc("job_count"), _asc("skill"), "skill_id"
    ).limit(k).drop("skill_id")


def report_top_trends(monthly: DataFrame, k: int = 50) -> DataFrame:
    top = monthly.orderBy(_desc("month"), _desc("job_count"), _asc("skill"), "skill_id").limit(k)
    return top.select(month_text(F.col("month")).alias("month"), "skill", "job_count")


def report_top_pairs(pairs: DataFrame, k: int = 20) -> DataFrame:
    top = pairs.orderBy(_desc("pair_count"), _asc("skill_a"), _asc("skill_b"), "skill_id_a", "skill_id_b").limit(k)
    return top.select("skill_a", "skill_b", "pair_count")


def report_jobs_by_country(by_country: DataFrame) -> DataFrame:
    return by_country.orderBy(_desc("jobs"), _asc("country"))


def report_salary_by_skill(t: Tables, k: int = 20) -> DataFrame:
    """Rounded means per normalized name; skills without one form a single group."""
    sums = pay_sums_by_skill_id(t).join(t["skills"].select("skill_id", F.col("skill_norm").alias("skill")), "skill_id")
    means = sums.groupBy("skill").agg(
        F.round(F.sum("sum_min") / F.sum("n")).alias("avg_min"),
        F.round(F.sum("sum_max") / F.sum("n")).alias("avg_max"),
        F.sum("n").alias("n"),
    )
    return means.orderBy(_desc("n"), _asc("skill")).limit(k)


def _movers(growth: DataFrame) -> DataFrame:
    return growth.filter(F.col("mom_growth_pct").isNotNull())


def report_top_risers(growth: DataFrame, k: int = 20) -> DataFrame:
    """Largest growth first within the latest months, all months in order."""
    return _movers(growth).orderBy(_desc("month"), _desc("mom_growth_pct"), _asc("skill")).limit(k)


def report_top_fallers(growth: DataFrame, k: int = 20) -> DataFrame:
    return _movers(growth).orderBy(_desc("month"), _asc("mom_growth_pct"), _asc("skill")).limit(k)


def report_salary_trend(monthly_salary: DataFrame, k: int = 50) -> DataFrame:
    top = monthly_salary.orderBy(_desc("month"), _desc("n"), _asc("skill")).limit(k)
    return top.select(
        month_text(F.col("month")).alias("month"),
        "skill",
        F.round("avg_min").alias("avg_min"),
        F.round("avg_max").alias("avg_max"),
        "n",
    )


def report_country_trend(monthly_jobs: DataFrame, k: int = 50) -> DataFrame:
    top = monthly_jobs.orderBy(_desc("month"), _desc("job_count"), _asc("country")).limit(k)
    return top.select(month_text(F.col("month")).alias("month"), "country", "job_count")


# ---- dashboard tables ----


def skill_ranking(counts: DataFrame) -> DataFrame:
    """All skills by postings; the first five are the default selection of the trend table."""
    return counts.select("skill", "job_count", "last_seen").orderBy(_desc("job_count"), _asc("skill"))


def trend_month_bounds(monthly: DataFrame) -> DataFrame:
    return monthly.agg(F.min("month").alias("min_month"), F.max("month").alias("max_month"))


def distinct_countries(monthly_jobs: DataFrame, k: int | None = None) -> DataFrame:
    names = monthly_jobs.filter(F.col("country").isNotNull()).select("country").distinct().orderBy("country")
    return names if k is None else names.limit(k)


def country_snapshot(
    monthly_jobs: DataFrame, lo: date, hi: date, countries: Sequence[str] | None = None, k: int = 20
) -> DataFrame:
    """Postings by country in the latest month of the range."""
    rows = latest_month(in_countries(between_months(monthly_jobs, lo, hi), countries))
    return rows.select("month", "country", "job_count").orderBy(_desc("job_count"), _asc("country")).limit(k)


def skill_trend_selected(monthly: DataFrame, lo: date, hi: date, skills: Sequence[str]) -> DataFrame:
    """Monthly counts of the chosen skills, in order of month and skill."""
    rows = between_months(monthly, lo, hi).filter(F.col("skill").isin(list(skills)))
    return rows.select("month", "skill", "job_count").orderBy("month", "skill")


def salary_by_skill_min_n(t: Tables, min_samples: int = 3) -> DataFrame:
    """Means per skill name from the base tables, names with at least ``min_samples`` rows."""
    sums = pay_sums_by_skill_id(t).join(t["skills"].select("skill_id", skill_name().alias("skill")), "skill_id")
    means = sums.groupBy("skill").agg(
        (F.sum("sum_min") / F.sum("n")).alias("avg_min"),
        (F.sum("sum_max") / F.sum("n")).alias("avg_max"),
        F.sum("n").alias("n"),
    )
    return means.filter(F.col("n") >= min_samples).orderBy(_desc("n"), _asc("skill"))


def salary_by_skill_top(t: Tables, min_samples: int = 3, k: int = 20) -> DataFrame:
    return salary_by_skill_min_n(t, min_samples).limit(k)


def salary_bands_long(salaries: DataFrame) -> DataFrame:
    """One row per skill and band (mean minimum, mean maximum)."""
    return salaries.unpivot(["skill", "n"], ["avg_min", "avg_max"], "band", "salary").orderBy("skill", "band")


def geo_points(t: Tables) -> DataFrame:
    """Locations that have both coordinates."""
    return t["locations"].filter(F.col("lat").isNotNull() & F.col("lon").isNotNull()).select(
        "job_id", "city", "state", "country", "lat", "lon"
    )


def geo_labels(t: Tables, countries: Sequence[str] | None = None) -> DataFrame:
    """Map points with their label."""
    points = in_countries(geo_points(t), countries)
    return points.withColumn("label", place_label(F.col("city"), F.col("state"), F.col("country")))


def top_risers(growth: DataFrame, lo: date, hi: date, k: int = 10) -> DataFrame:
    """Largest growth in the latest month of the range."""
    rows = latest_month(between_months(_movers(growth), lo, hi))
    return _mover_columns(rows.orderBy(_desc("mom_growth_pct"), _asc("skill")).limit(k))


def top_fallers(growth: DataFrame, lo: date, hi: date, k: int = 10) -> DataFrame:
    rows = latest_month(between_months(_movers(growth), lo, hi))
    return _mover_columns(rows.orderBy(_asc("mom_growth_pct"), _asc("skill")).limit(k))


def _mover_columns(rows: DataFrame) -> DataFrame:
    return rows.select("skill", "job_count", "prev_job_count", "mom_growth_pct")


def jobs_count(t: Tables) -> DataFrame:
    return t["jobs"].agg(F.count(F.lit(1)).alias("jobs"))

"""Jobs that keep the stored tables and marts current.

Every step works month by month: a month is stale for a step when postings came in since the step took it in, or, for
the marts, when an enrichment rewrote it since.  Only stale months are read and rewritten; ``full`` takes all.
The marts are rolled up from aggregates per month (``facts/...``), so months that no load touched are never joined again.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions.dates import CANDIDATES, chosen_format, format_fits, month_of, parse_post_date, read_differently
from ..operators.staging import stage, staging_scope
from ..schemas import REFRESHED
from ..sources.csv import MALFORMED, POSITION, read_gazetteer, read_jobs_texts
from ..sources.default_skills import default_gazetteer
from ..sources.tables import MONTH, TableStore, append_jobs
from . import marts
from .enrich import enrich_skills, parsed_pay, parsed_places
from .pairs import pair_counts

MARTS = [
    "skill_counts",
    "monthly_skill_counts",
    "skill_cooccurrence",
    "salary_by_skill",
    "jobs_by_country",
    "monthly_salary_by_skill",
    "monthly_jobs_by_country",
    "skill_mom_growth",
]

Months = Sequence[date | None]


@dataclass
class Load:
    postings: int
    unparsed_dates: int
    formats: tuple[str, ...]
    malformed: int


def load_postings(
    spark: SparkSession,
    store: TableStore,
    csv_path: str,
    multiline: bool = False,
    formats: Sequence[str] | None = None,
    rejects: str | None = None,
) -> Load:
    """Append the postings of a CSV file or folder; ids follow file names and lines.

    Without ``formats`` the date format is the one of ``CANDIDATES`` that fits most dates; if several fit as many and
    read them differently, the load is refused.  Rows with more or fewer fields than the header refuse the load, or,
    if ``rejects`` names a folder, are written there as text with their file and place.  Everything is counted
    while the rows are staged.  Reports how many postings were loaded, how many have a date text that no format
    fits (stored without a date, they leave every monthly mart), the formats, and how many rows were rejected.
    """
    with staging_scope(spark):
        counts, malformed = Observation(), F.col(MALFORMED).isNotNull()
        day = F.when(~malformed, F.col("post_date"))
        given = F.coalesce(*[F.try_to_date(day, f) for f in formats or CANDIDATES[:1]])
        texts = read_jobs_texts(spark, csv_path, multiline).observe(
            counts, F.count_if(~malformed).alias("n"), F.count_if(malformed).alias("malformed"), F.count(day).alias("days"),
            F.count(given).alias("given"), format_fits(day).alias("fits"),
        )
        rows = stage(texts, "postings")
        seen = counts.get
        if seen["malformed"]:
            bad = rows.filter(malformed).select(MALFORMED, *POSITION)
            if rejects is None:
                first = bad.orderBy(*POSITION).first()
                raise ValueError(f"{seen['malformed']} rows do not fit the header, the first in {first[POSITION[0]]}: {first[MALFORMED]}")
            bad.write.mode("append").json(rejects)
        good = rows.filter(~malformed).drop(MALFORMED)
        parsed = seen["given"]
        if formats is None:
            formats = [chosen_format(seen["fits"], lambda one, other: read_differently(good, "post_date", one, other))]
            parsed = seen["fits"][CANDIDATES.index(formats[0])]
        append_jobs(store, parse_post_date(good, formats=formats), order_by=POSITION)
    return Load(seen["n"], seen["days"] - parsed, tuple(formats), seen["malformed"])


# ---- which months a step has to take in ----

ENRICHMENTS = ("skills", "compensation", "locations")


def _stored_months(store: TableStore) -> dict[date | None, tuple[int, int]]:
    """Postings and highest id per month; reads the id column only, and brings back a row per month."""
    rows = store.read("jobs", with_month=True).groupBy(MONTH).agg(F.count(F.lit(1)), F.max("job_id"))
    return {month: (n, last) for month, n, last in rows.collect()}


def stale_months(store: TableStore, step: str, full: bool = False) -> list[date | None]:
    """The months whose postings ``step`` has not taken in; for ``marts`` also those that were enriched since."""
    stored = _stored_months(store)
    if full:
        return list(stored)
    taken = {(r["step"], r["month"]): r for r in store.read("refreshed").collect()}

    def current(month: date | None) -> bool:
        own = taken.get((step, month))
        if own is None or (own["postings"], own["last_job"]) != stored[month]:
            return False
        enriched = [taken[s, month]["at"] for s in ENRICHMENTS if (s, month) in taken] if step == "marts" else []
        return all(at <= own["at"] for at in enriched)

    return [month for month in stored if not current(month)]


def _taken_in(store: TableStore, step: str, months: Months) -> None:
    """Note that ``step`` has taken in all postings of ``months``."""
    at, stored = datetime.now(timezone.utc), _stored_months(store)
    old = [tuple(r) for r in store.read("refreshed").filter(F.col("step") == step).collect() if r["month"] not in set(months)]
    rows = old + [(step, month, *stored[month], at) for month in months]
    store.overwrite("refreshed", store.spark.createDataFrame(rows, REFRESHED), months=[step])


# ---- enrichment ----


def run_skills(store: TableStore, phrases: DataFrame, full: bool = False) -> Months:
    """Extract skills from the postings of stale months; add new skills and new links."""
    months = stale_months(store, "skills", full)
    if months:
        with staging_scope(store.spark):
            jobs = store.read("jobs", months, with_month=True)
            skills, links = enrich_skills(
                jobs, stage(phrases, "gazetteer"), store.read("skills"), store.read("jobs_skills", months)
            )
            links = stage(links.join(jobs.select("job_id", MONTH), "job_id"), "links")
            store.append("skills", skills, new_keys=True)
            store.append("jobs_skills", links, new_keys=True)
        _taken_in(store, "skills", months)
    return months


def run_compensation(store: TableStore, thousands: bool = False, full: bool = False) -> Months:
    """Parse the salary texts of stale months and merge the pay rows."""
    months = stale_months(store, "compensation", full)
    if months:
        store.merge("compensation", parsed_pay(store.read("jobs", months, with_month=True), thousands), months)
        _taken_in(store, "compensation", months)
    return months


def run_locations(
    store: TableStore, places: DataFrame | None = None, full: bool = False, fallback: bool = False
) -> Months:
    """Parse the location texts of stale months and merge the place rows; ``fallback`` as in ``geocode``."""
    months = stale_months(store, "locations", full)
    if months:
        with staging_scope(store.spark):
            store.merge("locations", parsed_places(store.read("jobs", months, with_month=True), places, fallback=fallback), months)
        _taken_in(store, "locations", months)
    return months


# ---- marts ----


def skill_facts(t: marts.Tables) -> DataFrame:
    """One aggregate from which all four skill-and-salary marts follow.

    The bridge meets postings and pay once; the result has a row per skill, month
    and pay kind.  ``n`` counts postings, ``n_pay`` those with both salary bounds.
    """
    pay = marts.both_bounds(t["compensation"]).select("job_id", "min", "max", marts.annual().alias("annual"))
    postings = t["jobs"].select("job_id", "post_date").join(pay, "job_id", "left")
    return (
        t["jobs_skills"]
        .join(postings, "job_id")
        .groupBy("skill_id", month_of(F.col("post_date")).alias("month"), "annual")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("post_date").alias("last_seen"),
            F.sum("min").alias("sum_min"),
            F.sum("max").alias("sum_max"),
            F.count("min").alias("n_pay"),
        )
    )


def pair_facts(t: marts.Tables) -> DataFrame:
    """Postings per pair of skills and month; ``jobs_skills`` must have the month of the posting."""
    return pair_counts(t["jobs_skills"], t["skills"], by=[MONTH])


def country_facts(t: marts.Tables) -> DataFrame:
    """Postings per country and month, undated ones too; ``located`` counts those with a place row."""
    months = t["jobs"].select("job_id", month_of(F.col("post_date")).alias("month"))
    places = t["locations"].select("job_id", "country", F.lit(1).alias("located"))
    return (
        months.join(places, "job_id", "left")
        .groupBy("month", marts.country_name())
        .agg(F.count(F.lit(1)).alias("job_count"), F.count("located").alias("located"))
    )


def marts_from_facts(facts: DataFrame, t: marts.Tables) -> dict[str, DataFrame]:
    """The four marts as roll-ups of ``skill_facts``; equal to the functions of ``marts``."""
    names = t["skills"].select("skill_id", marts.skill_name().alias("skill"))
    counts = facts.groupBy("skill_id").agg(F.sum("n").alias("job_count"), F.max("last_seen").alias("last_seen"))
    monthly = (
        facts.filter(F.col("month").isNotNull()).groupBy("skill_id", "month").agg(F.sum("n").alias("job_count"))
    )
    sums = [F.sum("sum_min").alias("sum_min"), F.sum("sum_max").alias("sum_max"), F.sum("n_pay").alias("n")]
    salary = facts.filter("n_pay > 0").groupBy("skill_id").agg(*sums)
    monthly_pay = facts.filter("annual AND month IS NOT NULL AND n_pay > 0").groupBy("month", "skill_id").agg(*sums)
    return {
        "skill_counts": counts.join(names, "skill_id").select("skill_id", "skill", "job_count", "last_seen"),
        "monthly_skill_counts": monthly.join(names, "skill_id").select("skill_id", "skill", "month", "job_count"),
        "salary_by_skill": salary.join(names, "skill_id").select(
            "skill_id",
            "skill",
            (F.col("sum_min") / F.col("n")).alias("avg_min"),
            (F.col("sum_max") / F.col("n")).alias("avg_max"),
            "n",
        ),
        "monthly_salary_by_skill": marts.monthly_pay_means(monthly_pay, t),
    }


def country_marts(facts: DataFrame) -> dict[str, DataFrame]:
    """The two country marts as roll-ups of ``country_facts``."""
    located = facts.filter("located > 0").groupBy("country").agg(F.sum("located").alias("jobs"))
    return {
        "jobs_by_country": located,
        "monthly_jobs_by_country": facts.filter("month IS NOT NULL").select("month", "country", "job_count"),
    }


def pair_mart(facts: DataFrame, t: marts.Tables) -> DataFrame:
    every = facts.groupBy("skill_id_a", "skill_id_b").agg(F.sum("pair_count").alias("pair_count"))
    return marts.named_pairs(every, t)


def refresh_marts(store: TableStore, full: bool = False) -> dict[str, DataFrame]:
    """Bring all eight marts up to date and return them.

    The large tables are joined in the stale months only, and once: links, postings and pay into one aggregate.
    Monthly marts are replaced in these months; the others are rolled up from the aggregates of all months.
    """
    months = stale_months(store, "marts", full)
    if months:
        with staging_scope(store.spark):
            t = store.tables(months)
            linked = {**t, "jobs_skills": store.read("jobs_skills", months, with_month=True)}
            for name, plan in (("skills", skill_facts(t)), ("pairs", pair_facts(linked)), ("countries", country_facts(t))):
                store.overwrite(f"facts/{name}", plan, months)
            changed = {name: store.read(f"facts/{name}", months) for name in ("skills", "countries")}
            every = {name: store.read(f"facts/{name}") for name in ("skills", "pairs", "countries")}
            dated = [m for m in months if m is not None]
            monthly = {**marts_from_facts(changed["skills"], t), **country_marts(changed["countries"])}
            whole = {**marts_from_facts(every["skills"], t), **country_marts(every["countries"])}
            for name in ("monthly_skill_counts", "monthly_salary_by_skill", "monthly_jobs_by_country"):
                store.overwrite(f"marts/{name}", monthly[name], dated)
            for name in ("skill_counts", "salary_by_skill", "jobs_by_country"):
                store.overwrite(f"marts/{name}", whole[name])
            store.overwrite("marts/skill_cooccurrence", pair_mart(every["pairs"], t))
            store.overwrite("marts/skill_mom_growth", marts.skill_mom_growth(load_mart(store, "monthly_skill_counts")))
        _taken_in(store, "marts", months)
    return {name: load_mart(store, name) for name in MARTS}


def load_mart(store: TableStore, name: str) -> DataFrame:
    return store.read(f"marts/{name}")


def gazetteer(spark: SparkSession, path: str | None) -> DataFrame:
    return read_gazetteer(spark, path) if path else default_gazetteer(spark)


def refresh_all(
    store: TableStore, skills_path: str | None = None, places: DataFrame | None = None, thousands: bool = False,
    full: bool = False,
) -> dict[str, DataFrame]:
    """All enrichments, then all marts; stale months only, unless ``full`` (say so after a change of dictionary or places)."""
    run_skills(store, gazetteer(store.spark, skills_path), full)
    run_compensation(store, thousands, full)
    run_locations(store, places, full)
    return refresh_marts(store, full)

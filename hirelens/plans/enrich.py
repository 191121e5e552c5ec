"""Enrichment jobs: posting text to the skill, pay and place tables."""

from pyspark.sql import DataFrame, functions as F

from ..functions.location import parse_location
from ..functions.salary import parse_salary
from ..operators.geo import geocode
from ..operators.skills import extract_skills, new_links, new_skills
from ..operators.staging import stage
from ..operators.upsert import one_per_key, upsert


def spread_for(df: DataFrame) -> int | None:
    """How many partitions to spread a scan over, or None when it has enough.

    A scan cut into fewer than two partitions per core is a small input in few
    files, for which one shuffle buys use of all cores.  Large inputs have many
    more partitions than cores and are never shuffled for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return 4 * cores if df.rdd.getNumPartitions() < 2 * cores else None


def _texts(jobs: DataFrame, column: str, repeated_ids: bool) -> DataFrame:
    """Postings with a text in ``column``, with their month where the table has one."""
    kept = ["job_id", *(["month"] if "month" in jobs.columns else []), column]
    texts = jobs.select(*kept).filter(F.col(column) != "")
    return one_per_key(texts, ["job_id"], [F.col(column)]) if repeated_ids else texts


def parsed_pay(jobs: DataFrame, thousands: bool = False, repeated_ids: bool = False) -> DataFrame:
    """Pay rows of all postings that have a salary text.

    Stored postings have one row each.  Where ids may repeat, say so: of several rows of one posting the text that
    comes first in code-point order then counts, at the price of a shuffle.
    """
    return parse_salary(_texts(jobs, "salary_raw", repeated_ids), thousands=thousands).drop("salary_raw")


def enrich_compensation(
    jobs: DataFrame, compensation: DataFrame, thousands: bool = False, repeated_ids: bool = False
) -> DataFrame:
    """The pay table after parsing the salary text of all postings that have one; see ``parsed_pay``."""
    return upsert(compensation, parsed_pay(jobs, thousands, repeated_ids), ["job_id"])


def parsed_places(
    jobs: DataFrame, places: DataFrame | None = None, repeated_ids: bool = False, fallback: bool = False
) -> DataFrame:
    """Place rows of all postings that have a location text; ``repeated_ids`` as in ``parsed_pay``.

    With a place table the coordinates are looked up; a place found there brings
    its own confidence, otherwise that of the parser is stored; ``fallback`` as in ``geocode``.
    """
    texts = _texts(jobs, "location_raw", repeated_ids)
    parsed = parse_location(texts).drop("location_raw", "is_remote")
    if places is None:
        none = F.lit(None).cast("double")
        located = parsed.withColumns({"lat": none, "lon": none, "geocode_confidence": none})
    else:
        located = geocode(parsed, places, fallback).drop("geocode_level")
    return located.withColumn("geocode_confidence", F.coalesce("geocode_confidence", "confidence")).drop("confidence")


def enrich_locations(
    jobs: DataFrame, locations: DataFrame, places: DataFrame | None = None, repeated_ids: bool = False
) -> DataFrame:
    """The place table after parsing the location text of all postings that have one; see ``parsed_places``."""
    return upsert(locations, parsed_places(jobs, places, repeated_ids), ["job_id"])


def enrich_skills(
    jobs: DataFrame, gazetteer: DataFrame, skills: DataFrame, jobs_skills: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """New rows for the skills table and for the bridge.

    The matches are staged: the texts are read and cut once, the two results are
    built from the much smaller table of matches.
    """
    texts = jobs.select("job_id", "description_raw")
    matches = stage(extract_skills(texts, gazetteer, spread=spread_for(texts)), "matches")
    added = stage(new_skills(matches, skills), "skills")
    every = skills.select("skill_id", "skill_raw", "skill_norm").unionByName(
        added.select("skill_id", "skill_raw", "skill_norm")
    )
    return added, new_links(matches, every, jobs_skills)

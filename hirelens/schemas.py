"""Declared tables: schemas, keys and references."""

from pyspark.sql import types as T

_S, _L, _D = T.StringType(), T.LongType(), T.DoubleType()

JOBS = T.StructType([
    T.StructField("job_id", _L, False),
    T.StructField("title_raw", _S, False),
    T.StructField("description_raw", _S),
    T.StructField("company", _S),
    T.StructField("source", _S),
    T.StructField("post_date", T.DateType()),
    T.StructField("location_raw", _S),
    T.StructField("salary_raw", _S),
    T.StructField("url", _S),
    T.StructField("collected_at", T.TimestampNTZType()),
])

SKILLS = T.StructType([
    T.StructField("skill_id", _L, False),
    T.StructField("skill_raw", _S, False),
    T.StructField("skill_norm", _S),
    T.StructField("confidence", _D),
    T.StructField("extractor_version", _S),
    T.StructField("created_at", T.TimestampNTZType()),
])

JOBS_SKILLS = T.StructType([
    T.StructField("job_id", _L, False),
    T.StructField("skill_id", _L, False),
])

COMPENSATION = T.StructType([
    T.StructField("job_id", _L, False),
    T.StructField("min", _D),
    T.StructField("max", _D),
    T.StructField("currency", _S),
    T.StructField("period", _S),
    T.StructField("parsed_confidence", _D),
])

LOCATIONS = T.StructType([
    T.StructField("job_id", _L, False),
    T.StructField("city", _S),
    T.StructField("state", _S),
    T.StructField("country", _S),
    T.StructField("lat", _D),
    T.StructField("lon", _D),
    T.StructField("geocode_confidence", _D),
])

TABLES = {
    "jobs": JOBS,
    "skills": SKILLS,
    "jobs_skills": JOBS_SKILLS,
    "compensation": COMPENSATION,
    "locations": LOCATIONS,
}

# What the marts are rolled up from, per month of the posting.
FACTS = {
    "facts/skills": T.StructType([
        T.StructField("skill_id", _L), T.StructField("month", T.DateType()), T.StructField("annual", T.BooleanType()),
        T.StructField("n", _L), T.StructField("last_seen", T.DateType()), T.StructField("sum_min", _D),
        T.StructField("sum_max", _D), T.StructField("n_pay", _L),
    ]),
    "facts/pairs": T.StructType([
        T.StructField("month", T.DateType()), T.StructField("skill_id_a", _L), T.StructField("skill_id_b", _L),
        T.StructField("pair_count", _L),
    ]),
    "facts/countries": T.StructType([
        T.StructField("month", T.DateType()), T.StructField("country", _S), T.StructField("job_count", _L),
        T.StructField("located", _L),
    ]),
}

_MEANS = [T.StructField("avg_min", _D), T.StructField("avg_max", _D), T.StructField("n", _L)]
MARTS = {
    "marts/skill_counts": T.StructType([
        T.StructField("skill_id", _L), T.StructField("skill", _S), T.StructField("job_count", _L),
        T.StructField("last_seen", T.DateType()),
    ]),
    "marts/monthly_skill_counts": T.StructType([
        T.StructField("skill_id", _L), T.StructField("skill", _S), T.StructField("month", T.DateType()),
        T.StructField("job_count", _L),
    ]),
    "marts/skill_cooccurrence": T.StructType([
        T.StructField("skill_id_a", _L), T.StructField("skill_a", _S), T.StructField("skill_id_b", _L),
        T.StructField("skill_b", _S), T.StructField("pair_count", _L),
    ]),
    "marts/salary_by_skill": T.StructType([T.StructField("skill_id", _L), T.StructField("skill", _S), *_MEANS]),
    "marts/jobs_by_country": T.StructType([T.StructField("country", _S), T.StructField("jobs", _L)]),
    "marts/monthly_salary_by_skill": T.StructType([T.StructField("month", T.DateType()), T.StructField("skill", _S), *_MEANS]),
    "marts/monthly_jobs_by_country": T.StructType([
        T.StructField("month", T.DateType()), T.StructField("country", _S), T.StructField("job_count", _L),
    ]),
    "marts/skill_mom_growth": T.StructType([
        T.StructField("skill", _S), T.StructField("month", T.DateType()), T.StructField("job_count", _L),
        T.StructField("prev_job_count", _L), T.StructField("mom_growth_pct", _D),
    ]),
}

# Which postings of a month a step has taken in, and when.
REFRESHED = T.StructType([
    T.StructField("step", _S), T.StructField("month", T.DateType()), T.StructField("postings", _L),
    T.StructField("last_job", _L), T.StructField("at", T.TimestampType()),
])

STORED = {**TABLES, **FACTS, **MARTS, "refreshed": REFRESHED}

# Stored in one partition per month of the posting; undated postings in one of their own.
MONTHLY = {
    "jobs", "jobs_skills", "compensation", "locations", *FACTS,
    "marts/monthly_skill_counts", "marts/monthly_salary_by_skill", "marts/monthly_jobs_by_country",
}

PRIMARY_KEYS = {
    "jobs": ["job_id"],
    "skills": ["skill_id"],
    "jobs_skills": ["job_id", "skill_id"],
    "compensation": ["job_id"],
    "locations": ["job_id"],
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS = [
    ("jobs_skills", "job_id", "jobs", "job_id"),
    ("jobs_skills", "skill_id", "skills", "skill_id"),
    ("compensation", "job_id", "jobs", "job_id"),
    ("locations", "job_id", "jobs", "job_id"),
]

NOT_NULL = {
    "jobs": ["job_id", "title_raw"],
    "skills": ["skill_id", "skill_raw"],
    "jobs_skills": ["job_id", "skill_id"],
    "compensation": ["job_id"],
    "locations": ["job_id"],
}

# Columns a postings CSV must have (fixed values).
CSV_COLUMNS = [
    "title_raw",
    "description_raw",
    "company",
    "source",
    "post_date",
    "location_raw",
    "salary_raw",
    "url",
]

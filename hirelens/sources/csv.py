"""Postings and skill dictionaries from CSV files."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.dates import ISO_DATE, parse_post_date
from ..operators.skills import dedupe_gazetteer
from ..schemas import CSV_COLUMNS

# Field texts that mean "no value".
NA_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# The three seed postings.
SEED_POSTINGS = [
    (
        "Data Scientist",
        "We need NLP, Python, and SQL. Experience with scikit-learn and AWS is a plus.",
        "Acme AI",
        "mock",
        "2025-09-28",
        "New York, NY, USA",
        "$130k-$160k/yr",
        "https://example.com/acme-ds",
    ),
    (
        "Machine Learning Engineer",
        "Deploy ML models to production. PyTorch, Docker, Kubernetes preferred.",
        "Nimbus Tech",
        "mock",
        "2025-10-01",
        "Remote - US",
        "USD 70-90/hour",
        "https://example.com/nimbus-mle",
    ),
    (
        "Data Analyst",
        "Strong SQL, Tableau, and Python for EDA. Optional: dbt.",
        "RetailCo",
        "mock",
        "2025-09-20",
        "Cincinnati, OH, USA",
        "55k-75k",
        "https://example.com/retailco-da",
    ),
]


# Where a row stands: its file, where its part of the file begins, and its place in it.
POSITION = ("_file", "_file_start", "_file_row")


# A line with more or fewer fields than the header, as it stands in the file.
MALFORMED = "_malformed"


def _read(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    """All columns as text, named by the header, ``POSITION``, and ``MALFORMED`` where a row does not fit the header.

    Every file must have the same header; one with other columns, or the same in another order, is an error.
    """
    options = {"header": True, "escape": '"', "multiLine": multiline, "inferSchema": False}
    header = spark.read.options(**options).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, MALFORMED]])
    # All fields are parsed, also those nobody selects: only then can Spark tell that a row has too few or too many.
    strict = {"enforceSchema": False, "columnNameOfCorruptRecord": MALFORMED, "columnPruning": False}
    raw = spark.read.options(**options, **strict).schema(schema).csv(path)
    place = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()]
    return raw.select("*", *[c.alias(n) for c, n in zip(place, POSITION)])


def well_formed(df: DataFrame) -> DataFrame:
    """``df`` without ``MALFORMED``; a row that does not fit the header is an error that shows it."""
    reason = F.concat(F.lit("a row that does not fit the header: "), F.substring(MALFORMED, 1, 200))
    first = df.columns[0]
    bad = F.col(MALFORMED).isNotNull()
    return df.withColumn(first, F.when(bad, F.raise_error(reason)).otherwise(F.col(first))).drop(MALFORMED)


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``df`` itself, or an error that lists the columns it lacks; runs no job."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def read_jobs_texts(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Postings from a CSV file or folder as text columns, dates too, NA texts as NULL; with ``POSITION`` and ``MALFORMED``."""
    raw = require_columns(_read(spark, path, multiline), CSV_COLUMNS)
    return raw.select(*[F.when(~F.col(c).isin(NA_TOKENS), F.col(c)).alias(c) for c in CSV_COLUMNS], MALFORMED, *POSITION)


def read_jobs_csv(
    spark: SparkSession, path: str, multiline: bool = False, formats: Sequence[str] = (ISO_DATE,)
) -> DataFrame:
    """Postings from a CSV file or folder: text columns, ``post_date`` as a date, NA texts as NULL.

    ``multiline`` allows line breaks inside quoted fields but reads each file in one
    task; without it large files split.  A row with more or fewer fields than the header is an error.
    """
    return parse_post_date(well_formed(read_jobs_texts(spark, path, multiline)).drop(*POSITION), formats=formats)


def read_gazetteer(spark: SparkSession, path: str) -> DataFrame:
    """Skill dictionary ``(skill, skill_key, n_tokens)`` from a CSV with a ``skill`` column."""
    raw = well_formed(require_columns(_read(spark, path, multiline=False), ["skill"]))
    return dedupe_gazetteer(raw.select("skill", F.struct(*POSITION).alias("pos")))


def seed_postings(spark: SparkSession) -> DataFrame:
    """The seed postings in the shape of ``read_jobs_csv``."""
    return parse_post_date(spark.createDataFrame(SEED_POSTINGS, ", ".join(f"{c} string" for c in CSV_COLUMNS)))

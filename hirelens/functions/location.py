"""Location text to city, state, country, remote flag and confidence."""

from pyspark.sql import DataFrame, functions as F

from .text import WS, title_case

# ---- fixed values ----
SEPARATORS = ",/|-"
REMOTE = r"(?iU)\bremote\b"
STATE_CODE = r"^[A-Za-z]{2}$"
CONFIDENCE_EMPTY, CONFIDENCE_NOTHING, CONFIDENCE_PARTS = 0.1, 0.3, 0.6
# ---- end of fixed values ----

# A separator with all white space and further separators around it.
_GAP = rf"[{WS}]*[{SEPARATORS}][{WS}{SEPARATORS}]*"
_EDGES = rf"^[{WS}{SEPARATORS}]+|[{WS}{SEPARATORS}]+$"


def parse_location(df: DataFrame, col: str = "location_raw") -> DataFrame:
    """Add ``city, state, country, is_remote, confidence`` parsed from ``col``.

    Three parts are city, state, country.  Of two, the second is a state when it
    has two ASCII letters, else a country.  A single part is a state when it has
    two letters, a city when it has three characters or more.  Text without any
    part (only separators) gives NULLs.
    """
    n = F.size("_parts")
    part = lambda i: F.get(F.col("_parts"), F.lit(i))
    second_is_state = part(1).rlike(STATE_CODE)
    city = F.when((n >= 2) | (F.length(part(0)) >= 3), part(0))
    state = (
        F.when(n >= 3, part(1))
        .when((n == 2) & second_is_state, part(1))
        .when((n == 1) & part(0).rlike(r"^\p{L}{2}$"), part(0))
    )
    country = F.when(n >= 3, part(2)).when((n == 2) & ~second_is_state, part(1))
    found = F.coalesce("city", "state", "country").isNotNull()
    empty = F.coalesce(F.col(col), F.lit("")) == ""
    return (
        # Cased before the split: a part begins after a separator, where a new run of letters begins anyway.
        df.withColumn("_core", title_case(F.regexp_replace(F.col(col), _EDGES, "")))
        .withColumn("_parts", F.when(F.col("_core") != "", F.split("_core", _GAP)).otherwise(F.array()))
        .withColumns({
            "city": city,
            "state": state,
            "country": country,
            "is_remote": F.coalesce(F.col(col).rlike(REMOTE), F.lit(False)),
        })
        .withColumn(
            "confidence",
            F.when(empty, CONFIDENCE_EMPTY).when(found, CONFIDENCE_PARTS).otherwise(CONFIDENCE_NOTHING),
        )
        .drop("_core", "_parts")
    )

"""Date expressions."""

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

ISO_DATE = "yyyy-MM-dd"


def month_of(day: Column) -> Column:
    """First day of the month, as a date."""
    return F.trunc(day, "month")


def month_text(month: Column) -> Column:
    return F.date_format(month, "yyyy-MM")


# Formats looked for where none is named; of ISO dates also the compact form and that with slashes.
CANDIDATES = (
    ISO_DATE, "yyyy/M/d", "yyyyMMdd", "d/M/yyyy", "M/d/yyyy", "d.M.yyyy", "d-M-yyyy", "M-d-yyyy", "d MMM yyyy", "MMM d, yyyy",
    "d MMMM yyyy", "MMMM d, yyyy",
)


def format_fits(text: Column, candidates: Sequence[str] = CANDIDATES) -> Column:
    """How many texts fit each candidate, as an aggregate; one pass counts for all."""
    return F.array(*[F.count(F.try_to_date(text, f)) for f in candidates])


def chosen_format(fits: Sequence[int], differ: Callable[[str, str], bool], candidates: Sequence[str] = CANDIDATES) -> str:
    """The candidate that fits most texts, the first if none fits.

    Of several that fit equally many the first is taken if they read all texts alike; else nobody can
    tell which is meant, and that is an error.
    """
    best = [f for f, n in zip(candidates, fits) if n == max(fits)]
    if max(fits) == 0:
        return candidates[0]
    for other in best[1:]:
        if differ(best[0], other):
            raise ValueError(f"dates fit {best[0]} and {other} alike; name the format")
    return best[0]


def infer_format(df: DataFrame, col: str = "post_date", candidates: Sequence[str] = CANDIDATES) -> str:
    """The date format of a text column, from all its rows."""
    fits = df.agg(format_fits(F.col(col), candidates)).first()[0]
    return chosen_format(fits, lambda one, other: read_differently(df, col, one, other), candidates)


def read_differently(df: DataFrame, col: str, one: str, other: str) -> bool:
    """Whether two formats read any text as different days."""
    days = F.try_to_date(F.col(col), one), F.try_to_date(F.col(col), other)
    return not df.filter(~days[0].eqNullSafe(days[1])).isEmpty()


def parse_post_date(df: DataFrame, col: str = "post_date", formats: Sequence[str] = (ISO_DATE,)) -> DataFrame:
    """Turn date text into a date; text that fits none of ``formats`` becomes NULL."""
    return df.withColumn(col, F.coalesce(*[F.try_to_date(F.col(col), f) for f in formats]))

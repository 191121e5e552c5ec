"""Salary text to numbers, currency, pay period and confidence."""

from pyspark.sql import Column, DataFrame, functions as F

from .text import ascii_digits, strip

# ---- fixed values: they decide the results, so they are stated as they must be ----
CURRENCY_SIGNS = {"$": "USD", "£": "GBP", "€": "EUR", "₹": "INR"}
CURRENCY_WORDS = {
    "usd": "USD",
    "dollar": "USD",
    "dollars": "USD",
    "eur": "EUR",
    "euro": "EUR",
    "euros": "EUR",
    "gbp": "GBP",
    "inr": "INR",
}
PERIOD_WORDS = {
    "year": "year",
    "yr": "year",
    "annum": "year",
    "month": "month",
    "mo": "month",
    "hour": "hour",
    "hr": "hour",
}
NUMBER = r"\d+(?:\.\d+)?[kK]?"
LONE_K = r"(?iU)\bk\b"
SHORT_PERIOD_HINT = r"(?iU)\bhour|hr|mo|month\b"
CONFIDENCE_EMPTY, CONFIDENCE_NO_NUMBER, CONFIDENCE_ONE, CONFIDENCE_TWO = 0.0, 0.2, 0.6, 0.8
CONFIDENCE_ASSUMED_YEAR = 0.7
# ---- end of fixed values ----

GROUPED_NUMBER = r"\d{1,3}(?:,\d{3})+(?:\.\d+)?[kK]?"


def _one_of(words) -> str:
    return "|".join(words)


def _lookup(key: Column, table: dict[str, str]) -> Column:
    """Value of ``key``, NULL when it is not in the table; ``key`` is computed once."""
    entries = F.create_map(*[F.lit(x) for entry in table.items() for x in entry])
    return F.try_element_at(entries, key)


def currency_of(text: Column) -> Column:
    """The first currency sign decides, else the first whole currency word."""
    sign = F.regexp_extract(text, f"[{''.join(CURRENCY_SIGNS)}]", 0)
    word = F.lower(F.regexp_extract(text, rf"(?iU)\b({_one_of(CURRENCY_WORDS)})\b", 1))
    return F.coalesce(_lookup(sign, CURRENCY_SIGNS), _lookup(word, CURRENCY_WORDS))


def period_of(text: Column) -> Column:
    """First whole period word, ``per`` may be glued to it; ``yearly`` is none."""
    word = F.regexp_extract(text, rf"(?iU)\b(?:per)?({_one_of(PERIOD_WORDS)})\b", 1)
    return _lookup(F.lower(word), PERIOD_WORDS)


def _amount(token: Column) -> Column:
    digits = F.replace(F.rtrim(token, F.lit("kK")), F.lit(","), F.lit("")).try_cast("double")
    return digits * F.when(F.lower(token).endswith("k"), 1000.0).otherwise(1.0)


def parse_salary(df: DataFrame, col: str = "salary_raw", thousands: bool = False) -> DataFrame:
    """Add ``min, max, currency, period, parsed_confidence`` parsed from ``col``.

    The first two numbers of the text count; a ``k`` directly after a number
    multiplies by 1000.  By default a comma ends a number, so ``$55,000`` reads
    as 55 and 000; ``thousands=True`` reads it as 55000.
    """
    number = f"{GROUPED_NUMBER}|{NUMBER}" if thousands else NUMBER
    text = F.col("_text")
    low, high = F.col("_first"), F.col("_second")
    assume_year = (
        low.isNotNull() & F.col("_period").isNull() & text.rlike(LONE_K) & ~text.rlike(SHORT_PERIOD_HINT)
    )
    confidence = (
        F.when(F.coalesce(F.col(col), F.lit("")) == "", CONFIDENCE_EMPTY)
        .when(low.isNull(), CONFIDENCE_NO_NUMBER)
        .when(high.isNotNull(), CONFIDENCE_TWO)
        .when(F.col("_assume_year"), CONFIDENCE_ASSUMED_YEAR)
        .otherwise(CONFIDENCE_ONE)
    )
    return (
        df.withColumn("_text", strip(F.col(col)))
        .withColumn("_numbers", F.regexp_extract_all(ascii_digits(text), F.lit(number), F.lit(0)))
        .withColumns({
            "_first": _amount(F.get(F.col("_numbers"), F.lit(0))),
            "_second": _amount(F.get(F.col("_numbers"), F.lit(1))),
            "_period": period_of(text),
        })
        .withColumn("_assume_year", F.coalesce(assume_year, F.lit(False)))
        .withColumns({
            "min": F.least(low, high),
            "max": F.greatest(low, high),
            "currency": currency_of(text),
            "period": F.when(F.col("_assume_year"), "year").otherwise(F.col("_period")),
            "parsed_confidence": confidence,
        })
        .drop("_text", "_numbers", "_first", "_second", "_period", "_assume_year")
    )

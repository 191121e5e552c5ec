import random

import pytest

from hirelens.functions.salary import parse_salary

GOLDEN = [
    ("$130k-$160k/yr", 130000.0, 160000.0, "USD", "year", 0.8),
    ("USD 70-90/hour", 70.0, 90.0, "USD", "hour", 0.8),
    ("55k-75k", 55000.0, 75000.0, None, None, 0.8),
    ("$55,000-$75,000", 0.0, 55.0, "USD", None, 0.8),
    ("55 k", 55.0, 55.0, None, "year", 0.7),
    ("55 k - 60 k", 55.0, 60.0, None, "year", 0.8),
    ("55 k monthly", 55.0, 55.0, None, None, 0.6),
    ("k only", None, None, None, None, 0.2),
    ("£60k per month", 60000.0, 60000.0, "GBP", "month", 0.6),
    ("€45.5k", 45500.0, 45500.0, "EUR", None, 0.6),
    ("120000 dollars per annum", 120000.0, 120000.0, "USD", "year", 0.6),
    ("401k plus $100k-$120k yearly", 100000.0, 401000.0, "USD", None, 0.8),
    ("70 to 90 mo", 70.0, 90.0, None, "month", 0.8),
    ("100 peryear", 100.0, 100.0, None, "year", 0.6),
    ("₹900 or 5 EUR a day", 5.0, 900.0, "INR", None, 0.8),
    ("10 euros 20 usd", 10.0, 20.0, "EUR", None, 0.8),
    ("₹१२k – ٣٤k", 12000.0, 34000.0, "INR", None, 0.8),
    ("1.5.2", 1.5, 2.0, None, None, 0.8),
    ("competitive", None, None, None, None, 0.2),
    ("eur per hr", None, None, "EUR", "hour", 0.2),
    ("   ", None, None, None, None, 0.2),
    ("", None, None, None, None, 0.0),
    (None, None, None, None, None, 0.0),
]
FIELDS = ["salary_raw", "min", "max", "currency", "period", "parsed_confidence"]


def test_golden(spark):
    texts = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "i int, salary_raw string")
    got = [tuple(r[f] for f in FIELDS) for r in parse_salary(texts).orderBy("i").collect()]
    assert got == GOLDEN


@pytest.mark.parametrize(
    "text, low, high",
    [("$55,000-$75,000", 55000.0, 75000.0), ("1,250.5k", 1250500.0, 1250500.0), ("12,34", 12.0, 34.0)],
)
def test_thousands(spark, text, low, high):
    row = parse_salary(spark.createDataFrame([(text,)], "salary_raw string"), thousands=True).first()
    assert (row["min"], row["max"]) == (low, high)


def test_invariants_on_random_text(spark):
    rng = random.Random(7)
    pieces = ["$", "€", "12", "3.5", "70k", "9K", " k ", "per", "hour", "mo", "yr", "-", " to ", ",", " ", "usd", "x"]
    texts = ["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(500)]
    got = parse_salary(spark.createDataFrame([(t,) for t in texts], "salary_raw string")).collect()
    for r in got:
        assert (r["min"] is None) == (r["max"] is None)
        assert r["min"] is None or r["min"] <= r["max"]
        assert r["parsed_confidence"] in {0.0, 0.2, 0.6, 0.7, 0.8}
        assert r["currency"] in {None, "USD", "EUR"}
        assert (r["parsed_confidence"] <= 0.2) == (r["min"] is None)

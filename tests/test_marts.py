import random
from collections import Counter
from datetime import date
from itertools import combinations

import pytest
from fixtures import as_set, month, rows, write_postings_csv, write_skills_csv
from pyspark.sql import functions as F

from hirelens.plans import marts, pairs, refresh, reports
from hirelens.sources.tables import TableStore


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("store")
    store = TableStore(spark, str(folder / "tables"))
    refresh.load_postings(spark, store, write_postings_csv(folder / "postings.csv"))
    refresh.refresh_all(store, write_skills_csv(folder / "skills.csv"))
    return store


@pytest.fixture(scope="module")
def t(store):
    return store.tables()


def mart(store, name):
    return refresh.load_mart(store, name)


def test_skill_counts(store):
    got = {r["skill"]: (r["job_count"], r["last_seen"]) for r in mart(store, "skill_counts").collect()}
    assert len(got) == 8
    assert got["Welding"] == (4, date(2023, 9, 30)) and got["forklift"] == (4, date(2023, 9, 12))
    assert got["brazing"] == (2, date(2023, 9, 30)) and got["cold storage"] == (1, date(2023, 5, 20))
    assert sum(n for n, _ in got.values()) == 15


def test_monthly_skill_counts(store):
    got = as_set(mart(store, "monthly_skill_counts"), "skill", "month", "job_count")
    may, july, september = {("Welding", 1), ("brazing", 1), ("forklift", 2), ("cold storage", 1)}, {
        ("C++", 1), ("CNC", 1), ("CNC milling", 1), ("Welding", 1)}, {("brazing", 1), ("Welding", 1), ("R", 1), ("forklift", 1)}
    assert got == {(s, month(m), n) for m, of in (("2023-05", may), ("2023-07", july), ("2023-09", september)) for s, n in of}


def test_growth(store):
    got = as_set(mart(store, "skill_mom_growth"), "skill", "month", "mom_growth_pct")
    assert len(got) == 12
    assert {g for g in got if g[2] is not None} == {
        ("Welding", month("2023-07"), 0.0), ("Welding", month("2023-09"), 0.0), ("brazing", month("2023-09"), 0.0),
        ("forklift", month("2023-09"), -50.0),
    }


def test_growth_of_one_name_under_two_ids(spark):
    counts = [(1, "a", "2024-01", 4), (2, "a", "2024-01", 5), (2, "a", "2024-02", 18)]
    monthly = spark.createDataFrame(
        [(i, s, month(m), n) for i, s, m, n in counts], "skill_id long, skill string, month date, job_count long"
    )
    assert as_set(marts.skill_mom_growth(monthly)) == {
        ("a", month("2024-01"), 9, None, None), ("a", month("2024-02"), 18, 9, 100.0)
    }


def test_growth_rounds_halves_away_from_zero_and_keeps_zero_base_empty(spark):
    counts = [(1, "a", "2024-01", 0), (1, "a", "2024-03", 5), (1, "a", "2024-04", 3), (2, "b", "2024-01", 20000),
              (2, "b", "2024-02", 20001), (2, "b", "2024-03", 20000)]
    monthly = spark.createDataFrame(
        [(i, s, month(m), n) for i, s, m, n in counts], "skill_id long, skill string, month date, job_count long"
    )
    got = [r["mom_growth_pct"] for r in marts.skill_mom_growth(monthly).orderBy("skill", "month").collect()]
    assert got == [None, None, -40.0, None, 0.01, 0.0]


def test_cooccurrence(store, t):
    got = as_set(mart(store, "skill_cooccurrence"))
    assert len(got) == 12
    assert all(a < b for a, _, b, _, _ in got)
    assert {(a, b, n) for _, a, _, b, n in got if n > 1} == {("Welding", "brazing", 2), ("Welding", "forklift", 2)}
    assert as_set(marts.skill_cooccurrence(t, min_count=2), "skill_a", "skill_b") == {("Welding", "brazing"), ("Welding", "forklift")}


def test_rare_skills_leave_before_pairs_are_built(spark):
    links = spark.createDataFrame([(j, k) for j in range(6) for k in (1, 2, 10 + j, 20 + j)], "job_id long, skill_id long")
    names = spark.range(1, 40).selectExpr("id AS skill_id")
    assert as_set(pairs.pair_counts(links, names, min_count=5)) == {(1, 2, 6)}
    assert as_set(pairs.pair_counts(links, names, wide_skills=3, block=2, min_count=5)) == {(1, 2, 6)}
    assert pairs.by_posting(pairs.frequent(links, 5)).count() == 6 and pairs.by_posting(links).count() == 36


def test_links_to_unknown_skills_make_no_pairs(spark):
    links = spark.createDataFrame([(1, k) for k in (1, 2, 3, 3, 8, 9)], "job_id long, skill_id long")
    names = spark.createDataFrame([(1,), (2,), (3,)], "skill_id long")
    for wide in (2, 10):
        assert as_set(pairs.pair_counts(links, names, wide_skills=wide, block=2)) == {(1, 2, 1), (1, 3, 1), (2, 3, 1)}


def test_salary_by_skill(store, t):
    got = {r["skill"]: (round(r["avg_min"], 2), round(r["avg_max"], 2), r["n"]) for r in mart(store, "salary_by_skill").collect()}
    assert len(got) == 8
    assert got["Welding"] == (26506.25, 28506.25, 4)
    assert got["forklift"] == (10014.33, 11349.0, 3)
    assert got["brazing"] == (33000.0, 37000.0, 2)
    assert got["C++"] == (40000.0, 40000.0, 1)
    hourly = as_set(marts.salary_by_skill(t, currency="EUR", period="hour"), "skill", "avg_min")
    assert hourly == {("forklift", 18.0), ("cold storage", 18.0)}


def test_monthly_salary_by_skill(store):
    got = as_set(mart(store, "monthly_salary_by_skill"))
    pay = {"2023-05": (30000.0, 34000.0, ["Welding", "brazing", "forklift"]), "2023-07": (40000.0, 40000.0, ["C++", "CNC", "CNC milling", "Welding"]),
           "2023-09": (36000.0, 40000.0, ["brazing", "Welding", "R"])}
    assert got == {(month(m), skill, low, high, 1) for m, (low, high, skills) in pay.items() for skill in skills}


def test_countries(store):
    assert as_set(mart(store, "jobs_by_country")) == {("Portugal", 3), ("Austria", 2), ("Unknown", 1)}
    assert as_set(mart(store, "monthly_jobs_by_country")) == {
        (month("2023-05"), "Portugal", 2), (month("2023-07"), "Unknown", 1), (month("2023-07"), "Austria", 1),
        (month("2023-09"), "Portugal", 1), (month("2023-09"), "Unknown", 1),
    }


# ---- generated tables: gaps everywhere ----


@pytest.fixture(scope="module")
def wide(spark):
    """Postings with missing dates, pay and places; one skill in a third of all links; undated and unpaid postings."""
    rng = random.Random(5)
    jobs = [(j, None if j % 7 == 0 else date(2024, rng.randint(1, 12), rng.randint(1, 28))) for j in range(400)]
    links = {(j, s) for j in range(400) for s in rng.sample(range(1, 30), rng.randint(0, 6))} | {(j, 1) for j in range(300)}
    pay = [(j, rng.choice([None, 50.0, 60.0]), rng.choice([None, 90.0, 70.0]), rng.choice(["year", "hour", None]))
           for j in range(400) if j % 4]
    return {
        "jobs": spark.createDataFrame(jobs, "job_id long, post_date date").repartition(5),
        "skills": spark.createDataFrame(
            [(s, f"raw{s}", None if s % 5 == 0 else f"norm{s // 2}") for s in range(1, 30)],
            "skill_id long, skill_raw string, skill_norm string"),
        "jobs_skills": spark.createDataFrame(sorted(links), "job_id long, skill_id long").repartition(3),
        "compensation": spark.createDataFrame(pay, "job_id long, min double, max double, period string"),
        "locations": spark.createDataFrame(
            [(j, rng.choice([None, "A", "B"])) for j in range(400) if j % 3], "job_id long, country string"),
    }


@pytest.mark.parametrize("name", ["skill_counts", "monthly_skill_counts", "salary_by_skill", "monthly_salary_by_skill"])
def test_rollups_of_the_shared_facts_equal_the_marts(spark, wide, name):
    rolled = refresh.marts_from_facts(refresh.skill_facts(wide), wide)[name]
    direct = getattr(marts, name)(wide)
    assert rolled.columns == direct.columns
    assert as_set(rolled) == as_set(direct)
    assert len(as_set(direct)) > 10


def test_unlocated_postings_count_as_unknown_only_by_month(wide):
    jobs, dated = wide["locations"].count(), wide["jobs"].filter("post_date IS NOT NULL").count()
    assert sum(r["jobs"] for r in marts.jobs_by_country(wide).collect()) == jobs
    assert sum(r["job_count"] for r in marts.monthly_jobs_by_country(wide).collect()) == dated


def brute_pairs(bridge):
    by_job = {}
    for job, skill in rows(bridge):
        by_job.setdefault(job, []).append(skill)
    counts = Counter(p for ids in by_job.values() for p in combinations(sorted(ids), 2))
    return {(a, b, n) for (a, b), n in counts.items()}


def counted(pair_rows):
    return as_set(pair_rows.groupBy("skill_id_a", "skill_id_b").agg(F.count("*")))


def test_both_pair_plans_equal_brute_force(wide):
    expected = brute_pairs(wide["jobs_skills"])
    assert counted(pairs.by_posting(wide["jobs_skills"])) == expected
    assert counted(pairs.by_blocks(wide["jobs_skills"])) == expected
    assert counted(pairs.by_blocks(wide["jobs_skills"], block=2)) == expected


def test_pairs_of_a_hot_posting_and_many_copies(spark):
    hot = [(0, s) for s in range(120)]
    copies = [(j, s) for j in range(1, 200) for s in (3, 5, 7)]
    bridge = spark.createDataFrame(hot + copies, "job_id long, skill_id long").repartition(4)
    expected = brute_pairs(bridge)
    assert (3, 5, 200) in expected and len(expected) == 120 * 119 // 2
    dictionary = spark.range(120).select(F.col("id").alias("skill_id"))
    assert as_set(pairs.pair_counts(bridge, dictionary)) == expected
    assert as_set(pairs.pair_counts(bridge, dictionary, wide_skills=50, block=16)) == expected
    assert counted(pairs.by_blocks(bridge, block=16)) == expected


@pytest.mark.parametrize("wide_skills", [4096, 2, 1])
def test_pairs_count_postings_whatever_the_dictionary_size(spark, wide_skills):
    """Repeated links count once, unknown skills and missing keys not at all, on both sides of the bound."""
    links = [(1, 1), (1, 1), (1, 2), (1, 9), (2, 2), (2, 1), (2, 2), (2, 3), (None, 1), (None, 2), (3, None), (3, 1)]
    bridge = spark.createDataFrame(links, "job_id long, skill_id long")
    dictionary = spark.createDataFrame([(1,), (2,), (3,), (3,)], "skill_id long")
    got = as_set(pairs.pair_counts(bridge, dictionary, wide_skills=wide_skills, block=1))
    assert got == {(1, 2, 2), (1, 3, 1), (2, 3, 1)}


# ---- reports ----


def test_reports_on_the_postings(store, t):
    top = rows(reports.report_top_skills(mart(store, "skill_counts"), 4))
    assert [r[:2] for r in top] == [("Welding", 4), ("forklift", 4), ("brazing", 2), ("C++", 1)]
    trends = rows(reports.report_top_trends(mart(store, "monthly_skill_counts")))
    assert trends[0] == ("2023-09", "R", 1) and ("2023-05", "forklift", 2) == trends[8] and len(trends) == 12
    assert rows(reports.report_top_pairs(mart(store, "skill_cooccurrence"), 1)) == [("Welding", "brazing", 2)]
    assert rows(reports.report_jobs_by_country(mart(store, "jobs_by_country"))) == [("Portugal", 3), ("Austria", 2), ("Unknown", 1)]
    assert rows(reports.report_salary_by_skill(t, 2)) == [("Welding", 26506.0, 28506.0, 4), ("forklift", 10014.0, 11349.0, 3)]
    growth = mart(store, "skill_mom_growth")
    assert [r[0] for r in rows(reports.report_top_risers(growth))] == ["Welding", "brazing", "forklift", "Welding"]
    assert [r[0] for r in rows(reports.report_top_fallers(growth))] == ["forklift", "Welding", "brazing", "Welding"]
    assert rows(reports.report_salary_trend(mart(store, "monthly_salary_by_skill"), 1)) == [("2023-09", "R", 36000.0, 40000.0, 1)]
    assert rows(reports.report_country_trend(mart(store, "monthly_jobs_by_country"), 2)) == [
        ("2023-09", "Portugal", 1), ("2023-09", "Unknown", 1)
    ]
    assert rows(reports.jobs_count(t)) == [(7,)]


def test_dashboard_tables(store, t):
    lo, hi, last = month("2023-05"), month("2023-07"), month("2023-09")
    countries = mart(store, "monthly_jobs_by_country")
    assert rows(reports.country_snapshot(countries, lo, hi)) == [(hi, "Austria", 1), (hi, "Unknown", 1)]
    assert rows(reports.country_snapshot(countries, lo, hi, ["Portugal"])) == [(lo, "Portugal", 2)]
    assert rows(reports.country_snapshot(countries, lo, hi, ["Norway"])) == []
    assert rows(reports.distinct_countries(countries, 5)) == [("Austria",), ("Portugal",), ("Unknown",)]
    monthly = mart(store, "monthly_skill_counts")
    assert rows(reports.trend_month_bounds(monthly)) == [(lo, last)]
    assert rows(reports.skill_trend_selected(monthly, lo, hi, ["forklift", "Welding"])) == [
        (lo, "Welding", 1), (lo, "forklift", 2), (hi, "Welding", 1)
    ]
    assert [r[0] for r in rows(reports.skill_ranking(mart(store, "skill_counts")).limit(5))][:3] == ["Welding", "forklift", "brazing"]
    growth = mart(store, "skill_mom_growth")
    assert [r[0] for r in rows(reports.top_risers(growth, lo, last, 2))] == ["Welding", "brazing"]
    assert [r[0] for r in rows(reports.top_fallers(growth, lo, last, 1))] == ["forklift"]
    assert [r[0] for r in rows(reports.top_risers(growth, lo, hi, 2))] == ["Welding"]
    assert [r[0] for r in rows(reports.salary_by_skill_min_n(t, 3))] == ["Welding", "forklift"]
    top = reports.salary_by_skill_top(t, 1, 2)
    assert [r[:3] for r in rows(reports.salary_bands_long(top))] == [
        ("Welding", 4, "avg_max"), ("Welding", 4, "avg_min"), ("forklift", 3, "avg_max"), ("forklift", 3, "avg_min")
    ]


def test_between_months_without_the_column_changes_nothing(spark):
    df = spark.range(3)
    assert reports.between_months(df, month("2024-01"), month("2024-02")) is df


def test_geo(spark):
    t = {"locations": spark.createDataFrame(
        [(1, "Remote", None, "Usa", 1.0, 2.0), (2, None, None, None, 1.0, 2.0), (3, "A", "B", "C", None, 2.0)],
        "job_id long, city string, state string, country string, lat double, lon double")}
    assert as_set(reports.geo_points(t), "job_id") == {(1,), (2,)}
    assert as_set(reports.geo_labels(t), "job_id", "label") == {(1, "Remote, , Usa"), (2, "Unknown")}
    assert as_set(reports.geo_labels(t, ["Usa"]), "job_id") == {(1,)}
